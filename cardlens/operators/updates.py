"""A batch of keyed account updates applied as one join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardlens.names import free_name
from cardlens.operators.joins import fits_broadcast, lookup_join, shuffle_join
from cardlens.operators.quality import key_violations, value_violations
from cardlens.schemas import CUSTOMER, UPDATABLE, TableSchema


def update_conflicts(updates: DataFrame, key: str, seq: str) -> DataFrame:
    """``(key, seq)`` pairs that occur more than once or hold a null: their order is not defined."""
    return key_violations(updates, [key, seq])


def update_violations(
    updates: DataFrame, key: str = "SSN", columns: Sequence[str] = UPDATABLE, table: TableSchema = CUSTOMER
) -> DataFrame:
    """One row per new value that does not fit the table's type or is too long: key, column, value, rule."""
    rules = TableSchema(table.name, {c: table.columns[c] for c in columns})
    return value_violations(updates, rules, [key])


def apply_updates(
    df: DataFrame,
    updates: DataFrame,
    key: str = "SSN",
    seq: str = "seq",
    columns: Sequence[str] = UPDATABLE,
    as_of: Column | None = None,
    stamp: str | None = "LAST_UPDATED",
) -> DataFrame:
    """The table with the last update of each key applied and the stamp column set to ``as_of``.

    The key alone decides a match: nulls and empty strings among the new values are stored. ``key``
    is the table's primary key; should it repeat after all, every row of it is updated. Two updates of a
    key with the same sequence number, or one without, fail the query when it runs, as does a value that
    cannot be cast to its column; ``update_violations`` lists those beforehand. Updates are reduced to one
    per key before and after their shuffle, so any number may address the same key. A batch measured (by a
    job that runs at once) to be small is broadcast and the table keeps its place; a larger one meets the
    table in a ``shuffle_join``.
    """
    batch = updates.select(key, seq, *columns).where(F.col(key).isNotNull())
    count, update = (free_name([*df.columns, key, seq, *columns], name) for name in ("_n", "_update"))
    # One row a (key, seq) first: it tells ties, and leaves less to compare.
    turns = batch.groupBy(key, seq).agg(F.count("*").alias(count), *(F.first(c).alias(c) for c in columns))
    tie = F.concat(F.lit("updates without an order: "), F.lit(key), F.lit(" "), F.col(key).cast("string"))
    ordered = F.when((F.col(count) == 1) & F.col(seq).isNotNull(), F.col(seq)).otherwise(
        F.raise_error(tie).cast(updates.schema[seq].dataType)
    )
    latest = turns.groupBy(key).agg(F.max(F.struct(ordered.alias(seq), *columns)).alias(update))
    if fits_broadcast(batch):
        joined = df.join(F.broadcast(latest), key, "left")
    else:
        joined = shuffle_join(df, latest, key, df.columns, "left")
    matched = F.col(update).isNotNull()
    stamped = F.current_timestamp() if as_of is None else as_of

    def value(name: str) -> Column:
        if name in columns:
            given, kind = F.col(update)[name], df.schema[name].dataType
            lost = F.raise_error(F.concat(F.lit(f"{name} cannot be "), given.cast("string"))).cast(kind)
            new = F.when(given.isNull() | given.try_cast(kind).isNotNull(), given.try_cast(kind)).otherwise(lost)
        elif name == stamp:
            new = stamped.cast(df.schema[name].dataType)
        else:
            return F.col(name)
        return F.when(matched, new).otherwise(F.col(name)).alias(name)

    return joined.select(*(value(name) for name in df.columns))


def unmatched_updates(df: DataFrame, updates: DataFrame, key: str = "SSN") -> DataFrame:
    """Updates whose key is not in the table, null keys included.

    When the batch's keys are measured to be small, they are broadcast to find the ones that exist,
    which are no more than they are; neither the table nor the batch is shuffled for the join.
    Otherwise the batch meets the table's keys in a ``lookup_join``, however often it repeats a key.
    """
    keys = updates.select(key).where(F.col(key).isNotNull())
    known = df.select(key)
    if fits_broadcast(keys):
        found = known.join(F.broadcast(keys.distinct()), key, "left_semi").distinct()
        return updates.join(F.broadcast(found), key, "left_anti")
    return lookup_join(updates, known, key, updates.columns, "left_anti")
