"""Tables in a database, through Spark's JDBC source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cardlens.schemas import TableSchema


@dataclass(frozen=True)
class JdbcOptions:
    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 10_000
    batch_size: int = 10_000

    def base(self, table: str) -> dict[str, str]:
        given = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {"dbtable": table} | {k: v for k, v in given.items() if v is not None}


def read_jdbc(
    spark: SparkSession,
    options: JdbcOptions,
    table: str,
    partition_on: str | None = None,
    num_partitions: int = 16,
    bounds: tuple[object, object] | None = None,
) -> DataFrame:
    """A whole table, read by ``num_partitions`` tasks over ranges of ``partition_on``.

    Without ``partition_on`` one task reads the whole table, which only small tables bear. Choose an
    evenly spread column such as the transaction id, not a customer or a branch. Its bounds are asked
    of the database in a one-row query unless they are given; they shape the ranges and filter nothing.
    """
    settings = options.base(table) | {"fetchsize": str(options.fetch_size)}
    if partition_on:
        if bounds is None:
            ends = f"(SELECT MIN({partition_on}) AS lo, MAX({partition_on}) AS hi FROM {table}) ends"
            bounds = tuple(spark.read.format("jdbc").options(**options.base(ends)).load().first())
        low, high = bounds
        if low is not None:
            settings |= {
                "partitionColumn": partition_on,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(num_partitions),
            }
    return spark.read.format("jdbc").options(**settings).load()


def write_jdbc(
    df: DataFrame,
    options: JdbcOptions,
    table: TableSchema | str,
    mode: str = "errorifexists",
    num_partitions: int = 16,
) -> None:
    """Write a frame to a database table, created with the declared column types if it is absent.

    ``mode`` is explicit: ``append`` a second time doubles the rows. Each task commits its own
    transaction, so a task that is lost after its commit and run again repeats its rows. Write to a
    new table, compare its keys (``key_violations``), and only then let readers have it.
    """
    settings = options.base(table if isinstance(table, str) else table.name)
    settings |= {"batchsize": str(options.batch_size), "numPartitions": str(num_partitions)}
    if isinstance(table, TableSchema):
        settings["createTableColumnTypes"] = table.jdbc_types()
    # Spark would bring the rows into so many tasks by coalesce, which runs all that is before in them too.
    df = df.repartition(num_partitions)
    df.write.format("jdbc").mode(mode).options(**settings).save()
