"""Loaded tables as Parquet, and their names in SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlens.schemas import MONTH_COLUMN, TableSchema


def write_table(
    df: DataFrame, path: str, month_of: str | None = None, cluster_by: Sequence[str] = (), looked_up: Sequence[str] = ()
) -> None:
    """Write a new version of a table; an existing path is an error, never overwritten.

    With ``month_of``, a ``yyyymmdd`` column, the table is partitioned by month. ``REBALANCE`` brings
    each month together in files of about the advisory size: it cuts a month that holds much of the
    data and joins small ones. Rows are sorted inside a file by ``cluster_by``, which lets a scan skip
    the pages of other cards. Columns in ``looked_up`` get Bloom filters, by which a scan for one value skips the
    row groups that do not hold it, however the rows are sorted; their size follows the values they hold.
    """
    order = list(cluster_by)
    if month_of:
        month = F.substring(month_of, 1, 6).alias(MONTH_COLUMN)
        df = df.select("*", month).hint("rebalance", MONTH_COLUMN)
        order.insert(0, MONTH_COLUMN)
    if order:
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode("errorifexists")
    for column in looked_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if looked_up:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    (writer.partitionBy(MONTH_COLUMN) if month_of else writer).parquet(path)


def read_table(spark: SparkSession, path: str, table: TableSchema | None = None) -> DataFrame:
    """A written table, with its declared types (an inferred month partition would be a number)."""
    return (spark.read.schema(table.struct()) if table else spark.read).parquet(path)


def month_counts(spark: SparkSession, path: str) -> DataFrame:
    """``ym`` and ``n``, the rows of each month of a month-partitioned table, from the footers of its files.

    The frame belongs to a session of its own (same context and catalogue of paths, other settings): the pushing of
    counts into the scan has to be on when it runs, and the caller's settings are not touched.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    columns = session.read.parquet(path).drop(MONTH_COLUMN).schema.add(MONTH_COLUMN, "string")
    return session.read.schema(columns).parquet(path).groupBy(MONTH_COLUMN).agg(F.count("*").alias("n"))


def register(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    """Name frames for SQL. A name already in use is moved to the new frame."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def load_all(frames: Mapping[str, DataFrame], writer: Callable[[str, DataFrame], None]) -> None:
    """Write several tables, each as a Spark job of its own."""
    for name, frame in frames.items():
        writer(name, frame)
