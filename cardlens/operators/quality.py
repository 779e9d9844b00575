"""Typed projection and the checks a database would make: types, lengths, primary key."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cardlens.schemas import CORRUPT, TableSchema

# The range of an INTEGER.
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def typed_value(df: DataFrame, table: TableSchema, column: str) -> Column:
    """The column in its declared type, null where it does not fit. A number with a fraction does not fit
    an INTEGER or BIGINT."""
    value, wanted = F.col(column), table.spark_type(column)
    kind = df.schema[column].dataType
    if wanted == "integer" and isinstance(kind, T.NumericType):
        # try_cast answers an overflow through an exception for each row; a range test is cheap.
        fits = value.between(_INT_MIN, _INT_MAX)
        if isinstance(kind, T.FractionalType):
            fits = fits & (value == F.floor(value))
        return F.when(fits, value).cast("int")
    if wanted in ("integer", "bigint") and isinstance(kind, T.StringType):
        return F.when(~value.rlike(r"\.0*[1-9]"), value.try_cast("decimal(38,6)")).try_cast(wanted)
    if wanted == "bigint" and isinstance(kind, T.FractionalType):
        return F.when(value == F.floor(value), value).try_cast("bigint")
    return value.try_cast(wanted)


def _lost_in_cast(df: DataFrame, table: TableSchema, column: str) -> Column:
    return F.col(column).isNotNull() & typed_value(df, table, column).isNull()


def apply_schema(df: DataFrame, table: TableSchema) -> DataFrame:
    """The table's columns in its order and types. A value that does not fit becomes null under both
    ANSI settings; ``cast_violations`` and ``violation_counts`` tell which and how many."""
    return df.select(*(typed_value(df, table, c).alias(c) for c in table.columns))


def broken_rules(df: DataFrame, table: TableSchema | None) -> dict[str, Column]:
    """What a row can break, by name: ``cast:COLUMN``, a value lost in the cast; ``length:COLUMN``, a string over
    the limit; and, if the frame has a column of unreadable records, ``unreadable``. Without a table only the latter."""
    columns = table.columns if table else ()
    rules = {f"cast:{c}": _lost_in_cast(df, table, c) for c in columns if table.spark_type(c) != "string"}
    for c, limit in (table.limited.items() if table else ()):
        rules[f"length:{c}"] = F.length(F.col(c).cast("string")) > limit
    if CORRUPT in df.columns:
        rules["unreadable"] = F.col(CORRUPT).isNotNull()
    return rules


def violation_counts(df: DataFrame, table: TableSchema | None) -> list[Column]:
    """Aggregates that count the rows that break each of the ``broken_rules``.

    Meant for ``DataFrame.observe``, which fills them in while the table is being written.
    """
    return [F.count_if(rule).alias(name) for name, rule in broken_rules(df, table).items()]


def unreadable(df: DataFrame) -> DataFrame:
    """The records of a raw dataset that could not be read, as text, with the number of their values that
    could. A frame without a column of such records has none."""
    if CORRUPT not in df.columns:
        return df.sparkSession.createDataFrame([], "record string, values_read int")
    # Spark refuses to read that column alone, so the count of the others is also what lets it be read.
    others = F.array(*(F.col(c).isNotNull().cast("int") for c in df.columns if c != CORRUPT))
    read = F.aggregate(others, F.lit(0), lambda total, one: total + one)
    return df.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"), read.alias("values_read"))


def cast_violations(df: DataFrame, table: TableSchema, row_id: list[str]) -> DataFrame:
    """One row per value that ``apply_schema`` cannot represent: row id, column, value."""
    found = [
        F.when(
            _lost_in_cast(df, table, c),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
        )
        for c in table.columns
        if table.spark_type(c) != "string"
    ]
    return df.select(*row_id, F.inline(F.array_compact(F.array(*found))))


def length_violations(df: DataFrame, limits: dict[str, int], row_id: list[str]) -> DataFrame:
    """One row per string longer than its limit: row id, column, length, limit."""
    found = [
        F.when(
            F.length(c) > limit,
            F.struct(
                F.lit(c).alias("column"),
                F.length(c).cast("int").alias("length"),
                F.lit(limit).cast("int").alias("limit"),
            ),
        )
        for c, limit in limits.items()
    ]
    return df.select(*row_id, F.inline(F.array_compact(F.array(*found))))


def value_violations(df: DataFrame, table: TableSchema, row_id: list[str]) -> DataFrame:
    """One row per value of the table's columns present in ``df`` that breaks a rule: row id, column, value,
    rule (``type`` or ``length``)."""
    found = []
    for column in (c for c in table.columns if c in df.columns):
        text = F.col(column).cast("string")
        if table.spark_type(column) != "string":
            broken = F.when(_lost_in_cast(df, table, column), "type")
        else:
            broken = F.when(F.length(text) > table.max_length(column), "length")
        found.append(
            F.when(broken.isNotNull(), F.struct(F.lit(column).alias("column"), text.alias("value"), broken.alias("rule")))
        )
    return df.select(*row_id, F.inline(F.array_compact(F.array(*found))))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are not unique or hold a null, with their number of rows.

    Counts are combined before the shuffle, so a key that fills a third of the table is one row there.
    """
    has_null = reduce(or_, (F.col(k).isNull() for k in keys))
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | has_null)
