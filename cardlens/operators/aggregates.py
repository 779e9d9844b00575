"""Counts, totals, top-k, shares and leaders.

Every aggregate here is combined map-side before its shuffle, so the size of a group does not matter.
Shares and leaders compare group rows with a scalar subquery over the same grouped frame. Spark reuses
that frame's shuffle, and no step moves all groups to one task as an unpartitioned window would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardlens.functions import money_sum
from cardlens.names import free_name
from cardlens.params import parse_top


def count_by(df: DataFrame, column: str, where: Column | None = None, name: str = "COUNT") -> DataFrame:
    """``COUNT(column)`` per value of ``column``; the null group therefore counts 0."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(column).agg(F.count(column).alias(name))


def ranked(groups: DataFrame, value: str, key: str) -> DataFrame:
    """Largest value first, ties by key."""
    return groups.orderBy(F.desc(value), F.asc(key))


def top_by_sum(
    df: DataFrame, key: str, value: str, k: int, name: str, where: Column | None = None
) -> DataFrame:
    """The ``k`` keys with the largest money total, ties by key."""
    rows = df if where is None else df.where(where)
    totals = rows.groupBy(key).agg(money_sum(F.col(value)).alias(name))
    return ranked(totals, name, key).limit(parse_top(k))


def top_by_sum_pruned(
    df: DataFrame, key: str, value: str, k: int, name: str, where: Column | None = None, slots: int = 1 << 16
) -> DataFrame:
    """``top_by_sum`` for many keys of which few are large: only keys that can be among the first are shuffled.

    Keys are hashed to ``slots``. First, the sum of a slot's positive values bounds the total of any key in it
    from above, and costs a row a slot and task. Second, the keys of the slots with the largest bounds are summed
    exactly; the k-th largest total is a bound from below. Third, the keys of the slots that reach it are summed exactly.
    No other key can be among the first, ties included, whatever the signs of its values. Where no slot can be left out
    (totals that hardly differ, fewer than k keys), the third step is ``top_by_sum``. The input is read three times, so
    this pays where a shuffle of all keys costs more than reading two columns twice.
    """
    rows = (df if where is None else df.where(where)).select(key, value)
    survivors = surviving_slots(rows, key, value, parse_top(k), slots)
    if survivors is None:
        return top_by_sum(rows, key, value, k, name)
    return top_by_sum(in_slots(rows, key, survivors, slots), key, value, k, name)


def _slot(key: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def in_slots(rows: DataFrame, key: str, chosen: list[int], slots: int) -> DataFrame:
    """The rows whose key is hashed to one of the ``chosen`` slots, which are at most ``slots`` small numbers."""
    slot = free_name(rows.columns, "slot")
    few = rows.sparkSession.range(1).select(F.explode(F.split(F.lit(",".join(map(str, chosen))), ",").cast("array<int>")).alias(slot))
    return rows.withColumn(slot, _slot(key, slots)).join(F.broadcast(few), slot, "left_semi").drop(slot)


def surviving_slots(rows: DataFrame, key: str, value: str, k: int, slots: int) -> list[int] | None:
    """The slots that can hold one of the ``k`` keys with the largest totals; None if all can."""
    positive = money_sum(F.greatest(F.col(value), F.lit(0.0)))  # NaN is the greatest of all
    bounds = rows.groupBy(_slot(key, slots).alias("slot")).agg(positive.alias("bound"))
    found = {r["slot"]: r["bound"] for r in bounds.collect()}  # ``slots`` rows at most
    if not found:
        return None

    def size(bound: float | None) -> float:
        return float("-inf") if bound is None else float("inf") if bound != bound else bound

    largest = sorted(found, key=lambda s: -size(found[s]))[:4 * k]
    totals = in_slots(rows, key, largest, slots).groupBy(key).agg(money_sum(F.col(value)).alias("total"))
    first = totals.where(F.col("total").isNotNull()).orderBy(F.desc("total")).limit(k).collect()
    if len(first) < k:
        return None
    least = size(first[-1]["total"])
    survivors = [s for s in found if size(found[s]) >= least]
    return survivors if len(survivors) < len(found) else None


def with_share(groups: DataFrame, value: str = "COUNT", name: str = "share") -> DataFrame:
    """Add each group's part of the total, between 0 and 1; null where the total is 0."""
    total = groups.agg(F.sum(value)).scalar()
    return groups.withColumn(name, F.try_divide(F.col(value).cast("double"), total))


def with_top_flag(groups: DataFrame, value: str, k: int = 1, name: str = "is_top") -> DataFrame:
    """Flag the groups that hold one of the ``k`` largest distinct values; a null value never leads."""
    leaders = (
        groups.select(value).where(F.col(value).isNotNull()).distinct()
        .orderBy(F.desc(value)).limit(parse_top(k))
    )
    threshold = leaders.agg(F.min(value)).scalar()
    return groups.withColumn(name, F.coalesce(F.col(value) >= threshold, F.lit(False)))


def composition(df: DataFrame, slice_key: Column) -> DataFrame:
    """Count and share of each slice. Rows whose slice is null are left out; see ``unclassified``."""
    slices = (
        df.select(slice_key.alias("slice")).where(F.col("slice").isNotNull())
        .groupBy("slice").agg(F.count("*").alias("COUNT"))
    )
    return with_share(slices)


def unclassified(df: DataFrame, slice_key: Column) -> DataFrame:
    """One row with the number of rows that ``composition`` leaves out."""
    return df.agg(F.count_if(slice_key.isNull()).alias("unclassified"))
