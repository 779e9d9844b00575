"""A seeded shuffle of a whole corpus into shards of equal row counts, in two passes outside memory.

Pass one scatters the rows uniformly into buckets small enough for a task's memory, by a seeded hash of each
row's number. Pass two takes a bucket at a time, shuffles it in place (Fisher-Yates, which is what Spark's
``shuffle`` does to an array) and writes it. The buckets in a row are the shuffled corpus; shard ``s`` of
``n`` is its ``s``-th ``n``-th, cut so that counts are at most one apart. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlens.llm.common import unused
from cardlens.operators.joins import lookup_join


def shuffle_to(df: DataFrame, path: str, size: str, seed: int = 0, bucket_bytes: int = 16 << 20) -> int:
    """Write the rows of ``df`` to ``path`` in a random order fixed by ``seed``; return their number.

    ``size`` names a column with the bytes of each row (null: none); buckets get about ``bucket_bytes``
    each. What a row holds plays no part in where it goes, so copies, nulls and repeated ids are dealt out
    like any other rows, and no bucket is larger than the rest but by chance. All rows and columns are kept.
    The number of a row is its place in the input, so the input should be a table read from files: the same
    files, read in the same splits, then give the same order. A task that is run again may order its
    buckets anew; only one attempt's files are committed, and a row's bucket never changes.
    """
    totals = df.agg(F.count("*").alias("n"), F.sum(size).alias("bytes")).first()
    buckets = max(1, -(-(totals["bytes"] or 0) // bucket_bytes))
    bucket, place, rows, row = (unused(df.columns, n) for n in ("bucket", "place", "rows", "row"))
    number = F.monotonically_increasing_id()
    scattered = df.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), number), F.lit(buckets))).repartition(buckets, bucket)
    # The rows of a bucket lie in one task already, so this groups them without another shuffle.
    held = scattered.groupBy(bucket).agg(F.collect_list(F.struct(*(F.col(f"`{c}`") for c in df.columns))).alias(rows))
    shuffled = held.select(bucket, F.posexplode(F.shuffle(rows, seed)).alias(place, row))
    at = F.struct(F.col(bucket).alias("bucket"), F.col(place).alias("place"))
    shuffled.select(at.alias("at"), F.col(row).alias("row")).write.parquet(path)
    return totals["n"]


def read_shards(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """The shuffled rows with ``row`` (a struct of their columns), ``shard`` and ``slot``, gapless from 0.

    Where a bucket begins is the sum of the buckets before it, taken from the counts of the written rows.
    With fewer rows than shards some shards are empty.
    """
    written = spark.read.parquet(path).select("at.bucket", "at.place", "row")
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    # One row a bucket: this running sum is over thousands of buckets, not over the corpus.
    bases = counts.selectExpr("bucket", "sum(n) OVER (ORDER BY bucket) - n AS base")
    total = F.lit(written.count()).cast("long")
    placed = lookup_join(written, bases, "bucket", ["bucket", "place"]).withColumn("total", total)
    # Shard s begins at s * total div shards, so a row's shard is the last that begins at it or before.
    shard = F.expr(f"CAST(({shards} * (base + place + 1) + total - 1) div total - 1 AS INT)")
    return placed.withColumn("shard", shard).select(
        "row", "shard", F.expr(f"base + place - (shard * total) div {shards}").alias("slot")
    )
