"""Hard negatives of an embedding table, by exact integer inner products.

Scores are computed by the method of the Four Russians. For each group of eight dimensions an anchor has a
table of the sums of all 256 subsets of its components. A candidate is kept as bit planes of its components, in
two's complement, eight dimensions to a byte; a byte is an index into the table. A score is the sum of the
looked-up numbers, shifted by their plane; the highest plane counts negative.

Anchors and candidates meet in cells of one block of each, whose sizes do not depend on the data. A first pass
finds every anchor's positives, a second the negatives in the range that each positive sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cardlens.llm.common import materialize

_LOW = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Settings:
    """Rows in a block, about: ``anchors`` and ``candidates`` times each other is the size of a cell."""

    anchors: int = 512
    candidates: int = 4096


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """``[group, subset, anchor]``: sums of the components that a byte names, for groups of eight dimensions."""
    count, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((groups * 8, count), anchors.dtype)
    padded[:dims] = anchors.T
    sums = np.zeros((groups, 256, count), anchors.dtype)
    for i in range(8):
        sums[:, 1 << i:2 << i] = sums[:, :1 << i] + padded[i::8, None]
    return sums


def bit_planes(codes: np.ndarray, bits: int) -> np.ndarray:
    """``[plane, row, group]``: the bits of the components in two's complement, eight dimensions to a byte."""
    planes = [np.packbits((codes >> b & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)]
    return np.stack(planes)


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """``[row, anchor]``: inner products, plane by plane from the highest."""
    total = np.zeros((planes.shape[1], sums.shape[2]), sums.dtype)
    for b in range(len(planes))[::-1]:
        total <<= 1
        for g in range(len(sums)):
            looked_up = sums[g].take(planes[b, :, g], axis=0)
            if b == len(planes) - 1:
                total -= looked_up
            else:
                total += looked_up
    return total


def _codes(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    values = column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _cell(anchors: pa.Table, candidates: pa.Table):
    """For each number of dimensions in a cell: anchors, candidates by id, and the keys ``[candidate, anchor]`` of
    their pairs. A key orders pairs of an anchor by score and then smaller id; it is the score times the number of
    candidates, plus the candidates behind."""
    for dims in np.intersect1d(anchors["dims"].to_numpy(), candidates["dims"].to_numpy()).tolist():
        a = anchors.filter(pa.compute.equal(anchors["dims"], dims))
        c = candidates.filter(pa.compute.equal(candidates["dims"], dims)).sort_by([("vec_id", "ascending"), ("row", "ascending")])
        ours, theirs = _codes(a["codes"], dims), _codes(c["codes"], dims)
        if dims:
            bits = int(np.abs(theirs).max()).bit_length() + 1
            # Every partial sum stays below this.
            small = int(np.abs(ours).sum(axis=1).max()) << bits < 1 << 31
            products = scores(subset_sums(ours.astype(np.int32 if small else np.int64)), bit_planes(theirs, bits))
        else:
            products = np.zeros((len(c), len(a)), np.int64)
        behind = np.arange(len(c) - 1, -1, -1)
        yield a, c, products.astype(np.int64) * len(c) + behind[:, None]


def _best(keys: np.ndarray, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest key of each anchor (up to ``bound``), with the candidate's index and the score."""
    if bound is not None:
        keys = np.where(keys <= bound, keys, _LOW)
    best = keys.max(axis=0)
    return best, len(keys) - 1 - best % len(keys), best // len(keys)


def _find_positives(k: int):
    names = ["anchor", "row", "vec_id", "score"]

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        for a, c, keys in _cell(anchors, candidates):
            own, rows = a["row"].to_numpy(), c["row"].to_numpy()
            other = (c["label"].to_numpy()[:, None] == a["label"].to_numpy()) & (rows[:, None] != own)
            keys = np.where(other, keys, _LOW)
            bound = None
            for _ in range(min(k, len(rows))):
                best, index, score = _best(keys, bound)
                there = best > _LOW
                found.append((own[there], rows[index[there]], c["vec_id"].to_numpy()[index[there]], score[there]))
                bound = np.where(there, best - 1, _LOW)
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(x, pa.int64()) for x in columns], names)

    return run


def _find_negatives(k: int, least: int, most: int):
    names = ["anchor", "positive", "row", "vec_id", "score"]

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        for a, c, keys in _cell(anchors, candidates):
            own, rows, ids = a["row"].to_numpy(), c["row"].to_numpy(), c["vec_id"].to_numpy()
            keys = np.where(c["label"].to_numpy()[:, None] != a["label"].to_numpy(), keys, _LOW)
            positives = a["positives"].to_pylist()
            for turn in range(max(map(len, positives), default=0)):
                has = np.array([len(p) > turn for p in positives])
                score = np.array([p[turn]["score"] if len(p) > turn else 0 for p in positives], np.int64)
                row = np.array([p[turn]["row"] if len(p) > turn else -1 for p in positives], np.int64)
                floor, bound = -(-least * score // 100), (most * score // 100 + 1) * len(rows) - 1
                for _ in range(min(k, len(rows))):
                    best, index, reached = _best(keys, bound)
                    there = has & (best > _LOW) & (reached >= floor)
                    if not there.any():
                        break
                    found.append((own[there], row[there], rows[index[there]], ids[index[there]], reached[there]))
                    bound = np.where(there, best - 1, _LOW)
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 5
        return pa.table([pa.array(x, pa.int64()) for x in columns], names)

    return run


def _first(df: DataFrame, group: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group by score and id, with their ``rank``; Spark cuts groups to k rows a task
    before it shuffles them."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id", "row")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings(),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a score is the inner product, larger ones first, ties by smaller id.
    Anchors are the rows whose id is divisible by ``every``, their positives the first other rows of their label.
    For each, the first rows of other labels are returned whose score lies between ``least`` and ``most`` percent of
    the positive's (none, then, below a negative score).

    Rows with a null id, label or vector, or a null or non-finite component, take no part, nor does one whose
    components are so large that 2^50 is exceeded by the sum of their squares' greatest possible value (a
    component of 16,000 and more in 64 dimensions): its scores would leave a long. Vectors of different
    lengths are not compared; empty ones score 0. Rows that repeat an id are rows of their own, and the ranks of an
    anchor or positive that is there twice come twice. An empty table has an empty result.
    """
    spark = df.sparkSession
    vector_of = F.col(vector)
    sound = ~F.exists(vector_of, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    codes = F.transform(vector_of, lambda x: F.floor(x.cast("double") * scale))
    rows = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & vector_of.isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"), F.size(vector_of).cast("long").alias("dims"), codes.alias("codes"),
    )
    largest = F.array_max(F.transform("codes", F.abs)).cast("double")
    rows = materialize(spark, rows.where((F.col("dims") == 0) | (largest * largest * F.col("dims") < 2.0**50)), "vectors")
    is_anchor = F.col("vec_id") % every == 0
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    # Numbers of blocks follow from the counts alone, so no block is fuller than chance makes it.
    wide, high = -(-sizes["rows"] // settings.candidates) or 1, -(-sizes["anchors"] // settings.anchors) or 1

    def cells(frame: DataFrame, own: int, own_name: str, others: int, other_name: str):
        block = F.pmod(F.xxhash64("row"), F.lit(own)).cast("int").alias(own_name)
        every_other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other_name)
        return frame.select("*", block, every_other).groupBy("high", "wide")

    candidates = cells(rows, wide, "wide", high, "high")
    anchors = rows.where(is_anchor)
    near = cells(anchors, high, "high", wide, "wide").cogroup(candidates).applyInArrow(
        _find_positives(positives), "anchor long, row long, vec_id long, score long"
    )
    chosen = materialize(spark, _first(near, ["anchor"], positives), "positives")
    listed = chosen.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("positives"))
    asking = materialize(spark, anchors.join(listed.withColumnRenamed("anchor", "row"), "row"), "anchors")
    far = cells(asking, high, "high", wide, "wide").cogroup(candidates).applyInArrow(
        _find_negatives(negatives, least, most), "anchor long, positive long, row long, vec_id long, score long"
    )
    kept = _first(far, ["anchor", "positive"], negatives).select(
        "anchor", "positive", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    pairs = chosen.select("anchor", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return kept.join(pairs, ["anchor", "positive"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
