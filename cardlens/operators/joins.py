"""Equi-join of a large table, whose keys may be badly skewed, with a smaller lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from cardlens.names import free_name

# Raw bytes up to which a side is sent whole to every executor.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds more than twice the rows of an average partition of the session's shuffles. The
# part of all rows that makes is kept between these, so there are fewer than 2000 hot keys.
LEAST_HOT_SHARE, MOST_HOT_SHARE = 0.0005, 0.005
# Tasks over which one hot key is spread.
SALT_BUCKETS = 256


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure ``df`` with one aggregate: text at its length, and 16 bytes a row for every column."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema.fields):
        raise ValueError("nested columns have no size that is cheap to measure")
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = F.count("*") * (16 * len(df.columns))
    for name in text:
        size = size + F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
    return df.agg(size.alias("bytes")).first()["bytes"] <= max_bytes


def hot_share(df: DataFrame) -> float:
    """The part of the rows from which a key is hot, by the session's number of shuffle partitions."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(2 / partitions, LEAST_HOT_SHARE), MOST_HOT_SHARE)


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> list:
    """The keys, null among them, that hold more than ``share`` (by default ``hot_share``) of the rows.

    One pass with a mergeable sketch: no key is shuffled, a task sends a few thousand counters, and at
    most ``1 / share`` keys come back. The counts are estimates, which is enough here: hot or not
    decides where a row is joined, not whether. The sketch takes no binary keys, so those go in as hex.
    """
    if share is None:
        share = hot_share(df)
    most = int(1 / share)
    binary = isinstance(df.schema[key].dataType, T.BinaryType)
    item = f"hex(`{key}`)" if binary else f"`{key}`"
    found = df.agg(
        F.expr(f"approx_top_k({item}, {most}, {10 * most})").alias("top"), F.count("*").alias("n")
    ).first()
    items = [row["item"] for row in found["top"] if row["count"] > share * found["n"]]
    return [bytes.fromhex(i) if binary and i is not None else i for i in items]


def shuffle_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Sort-merge join of two large sides that spreads the hot keys of ``facts``.

    Without hot keys it is the plain join. With them, both sides get a salt, 0 but for hot keys: their
    rows are spread by a hash of ``spread_by`` (columns that tell rows apart, so that a retried task
    salts them alike) and only their lookup rows are copied. Exact copies of a row hash alike; a pile
    of those is cut by adaptive execution, which splits a skewed partition of ``facts`` by map output.
    The hint keeps Spark from broadcasting, on the strength of its compressed size, a side that was
    measured to be large.
    """
    hot = hot_keys(facts, key)
    if not hot:
        return facts.join(lookup.hint("merge"), key, how)
    is_hot = F.col(key).isin([k for k in hot if k is not None])
    if None in hot:
        is_hot = F.col(key).isNull() | is_hot
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salt_buckets)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salt_buckets - 1))
    salt = free_name([*facts.columns, *lookup.columns], "_salt")
    salted = facts.withColumn(salt, F.when(is_hot, spread).otherwise(0))
    copies = lookup.where(F.col(key).isNotNull()).withColumn(
        salt, F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))
    )
    return salted.join(copies.hint("merge"), [key, salt], how).drop(salt)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` with ``lookup`` on ``key``, whatever share of ``facts`` one key holds.

    A lookup measured to be small is broadcast, and ``facts`` is not shuffled. A larger one meets
    ``facts`` in a ``shuffle_join``. ``how`` may be any type that keeps no unmatched lookup rows.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup join cannot be {how!r}")
    if fits_broadcast(lookup, max_broadcast_bytes):
        return facts.join(F.broadcast(lookup), key, how)
    return shuffle_join(facts, lookup, key, spread_by, how)
