"""Monthly partial totals of the transactions, stored, and reports that add them up.

A month's rows are counts and exact money limbs by branch and type, so any report over branches, types and
months adds stored rows and gives what a scan of all transactions would. Only months whose files have changed
are aggregated again; their partitions are replaced, the others are not touched.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlens.functions import LIMBS, merged_limbs, money_limbs, money_of_limbs, month_name
from cardlens.operators.aggregates import ranked, with_top_flag
from cardlens.params import parse_top
from cardlens.schemas import MONTH_COLUMN

_SCHEMA = (
    "BRANCH_CODE int, TRANSACTION_TYPE string, n long, high long, middle long, low long, millionths long, odd double, "
    f"files long, {MONTH_COLUMN} string"
)


def _partials(credit: DataFrame) -> DataFrame:
    limbs = money_limbs(F.col("TRANSACTION_VALUE"))
    return credit.groupBy(MONTH_COLUMN, "BRANCH_CODE", "TRANSACTION_TYPE").agg(
        F.count("*").alias("n"), *(limbs[name].alias(name) for name in LIMBS)
    )


def _months(credit: DataFrame) -> DataFrame:
    """``ym`` and ``files``, a hash of the names, sizes and times of the month's files; no column is read."""
    file = F.struct("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    each = credit.select(MONTH_COLUMN, file.alias("file")).distinct()
    return each.groupBy(MONTH_COLUMN).agg(F.bit_xor(F.xxhash64("file")).alias("files"))


def read_rollup(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows of all months; None before the first refresh."""
    try:
        stored = spark.read.schema(_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.where(F.col("n") > 0)


def _in_order(month: str | None) -> str:
    return month or ""


def changed_months(credit: DataFrame, path: str) -> tuple[list[str | None], list[str | None]]:
    """Months whose files are not those that were rolled up, and months that are gone. Month names only, of which
    there are twelve a year, come to the driver."""
    now = {r[MONTH_COLUMN]: r["files"] for r in _months(credit).collect()}
    stored = read_rollup(credit.sparkSession, path)
    known = {} if stored is None else {r[MONTH_COLUMN]: r["files"] for r in stored.select(MONTH_COLUMN, "files").distinct().collect()}
    changed = {m for m in now if known.get(m) != now[m]}
    return sorted(changed, key=_in_order), sorted(known.keys() - now.keys(), key=_in_order)


def among(months: list[str | None]) -> Column:
    """Rows of some months; the scan opens no others."""
    named = F.col(MONTH_COLUMN).isin([m for m in months if m is not None])
    return named | F.col(MONTH_COLUMN).isNull() if None in months else named


def refresh_rollup(credit: DataFrame, path: str) -> list[str]:
    """Bring the rollup at ``path`` up to date with a month-partitioned table read from files; return the months
    that were written.

    A month is replaced as a whole when the job commits; a job that fails leaves what was there. A month that is gone
    is replaced by one row that counts nothing, which ``read_rollup`` leaves out. Rows without a month
    (a null key) have one of their own. A change during a refresh is found by the next.
    """
    spark = credit.sparkSession
    changed, gone = changed_months(credit, path)
    if not changed and not gone:
        return []

    new = credit.where(among(changed))
    marks = _months(new).select(F.col(MONTH_COLUMN).alias("_month"), "files")
    rows = _partials(new).join(F.broadcast(marks), F.col(MONTH_COLUMN).eqNullSafe(F.col("_month"))).drop("_month")
    columns = spark.createDataFrame([], _SCHEMA).columns
    rows = rows.withColumns({"BRANCH_CODE": F.col("BRANCH_CODE").cast("int")}).select(*columns)
    if gone:
        none = {"n": 0, "files": 0}
        empty = spark.createDataFrame([(m,) for m in gone], f"{MONTH_COLUMN} string")
        kinds = dict(spark.createDataFrame([], _SCHEMA).dtypes)
        rows = rows.unionByName(empty.select(
            *(F.lit(none.get(c)).cast(kinds[c]).alias(c) for c in columns if c != MONTH_COLUMN), MONTH_COLUMN
        ).select(*columns))
    rows.repartition(MONTH_COLUMN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_COLUMN).parquet(path)
    return sorted(changed + gone, key=_in_order)


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    """``n`` and ``value`` by the keys."""
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), money_of_limbs(merged_limbs()).alias("value"))


def rolled_type_totals(rollup: DataFrame, transaction_type: str) -> DataFrame:
    """What ``reports.type_totals`` gives."""
    rows = rollup.where(F.col("TRANSACTION_TYPE") == transaction_type)
    return _added(rows, "TRANSACTION_TYPE").select(
        "TRANSACTION_TYPE", F.col("n").alias("NUMBER_OF_TRANSACTIONS"), F.col("value").alias("TOTAL_VALUE_OF_TRANSACTIONS")
    )


def rolled_branch_totals(branch: DataFrame, rollup: DataFrame, state: str) -> DataFrame:
    """What ``reports.branch_totals`` gives for a table that names each branch once."""
    wanted = branch.where(F.col("BRANCH_STATE") == state).select(F.col("BRANCH_CODE").cast("int").alias("BRANCH_CODE")).distinct()
    made = _added(rollup.where(F.col("BRANCH_CODE").isNotNull()), "BRANCH_CODE")
    return wanted.join(made, "BRANCH_CODE", "left").select(
        "BRANCH_CODE", F.coalesce("n", F.lit(0)).alias("TOTAL_NUMBER_OF_TRANSACTIONS"),
        F.col("value").alias("TOTAL_VALUE_OF_TRANSACTIONS"),
    )


def rolled_top_branches(rollup: DataFrame, transaction_type: str, k: int = 20) -> DataFrame:
    """What ``insights.top_branches`` gives."""
    made = _added(rollup.where(F.col("TRANSACTION_TYPE") == transaction_type), "BRANCH_CODE")
    return ranked(made.select("BRANCH_CODE", F.col("value").alias("Total_value")), "Total_value", "BRANCH_CODE").limit(parse_top(k))


def rolled_volume_by_month(rollup: DataFrame, leaders: int = 3) -> DataFrame:
    """What ``insights.volume_by_month`` gives."""
    month = F.substring(MONTH_COLUMN, 5, 2).alias("Month")
    dated = F.when(F.col(MONTH_COLUMN).isNotNull(), F.col("n")).otherwise(0)
    months = rollup.groupBy(month).agg(F.sum(dated).alias("Volume"))
    named = months.withColumn("Month_N", month_name(F.col("Month")))
    return with_top_flag(named, "Volume", leaders).orderBy("Month")
