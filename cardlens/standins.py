"""The generic test tables seen as card, customer, branch and loan tables.

Each function renames and derives columns in a narrow projection, so Spark prunes whatever a query
does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlens.functions import date_key


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _time_id(day: str) -> Column:
    return date_key(F.year(day), F.month(day), F.dayofmonth(day))


def _within(df: DataFrame, day: str, between: tuple[str, str] | None) -> DataFrame:
    """Rows from one day up to, not including, another.

    A stored ``TIMEID`` is pruned by the reports' own predicates. Here it is computed from a timestamp,
    which the scan cannot see through, so the report's dates are also given as a range of that column.
    """
    if between is None:
        return df
    start, end = (F.lit(d).cast(df.schema[day].dataType) for d in between)
    return df.where((F.col(day) >= start) & (F.col(day) < end))


def orders_as_credit(
    spark: SparkSession, sf_dir: str, between: tuple[str, str] | None = None
) -> DataFrame:
    """Orders as transactions of customers; the customer number, as stored, is also the card number."""
    return _within(read(spark, sf_dir, "orders"), "o_orderdate", between).select(
        F.col("o_custkey").alias("CUST_CC_NO"),
        _time_id("o_orderdate").alias("TIMEID"),
        F.col("o_custkey").alias("CUST_SSN"),
        F.col("o_orderpriority").alias("TRANSACTION_TYPE"),
        F.col("o_totalprice").alias("TRANSACTION_VALUE"),
        F.col("o_orderkey").alias("TRANSACTION_ID"),
    )


def orders_as_raw_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the raw credit dataset, the date in three numbers."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("CREDIT_CARD_NO"),
        F.year("o_orderdate").alias("YEAR"),
        F.month("o_orderdate").alias("MONTH"),
        F.dayofmonth("o_orderdate").alias("DAY"),
        F.col("o_custkey").alias("CUST_SSN"),
        (F.col("o_custkey") % 100).alias("BRANCH_CODE"),
        F.col("o_orderpriority").alias("TRANSACTION_TYPE"),
        F.col("o_totalprice").alias("TRANSACTION_VALUE"),
        F.col("o_orderkey").alias("TRANSACTION_ID"),
    )


def lineitem_as_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions at a branch, the supplier."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("BRANCH_CODE"),
        F.col("l_returnflag").alias("TRANSACTION_TYPE"),
        F.col("l_extendedprice").alias("TRANSACTION_VALUE"),
    )


def supplier_as_raw_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the raw branch dataset, the nation as state; nation 0 has no zip code."""
    nation = read(spark, sf_dir, "nation")
    supplier = read(spark, sf_dir, "supplier")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("BRANCH_CODE"),
        F.col("s_name").alias("BRANCH_NAME"),
        F.concat(F.lit("Street "), F.col("s_suppkey").cast("string")).alias("BRANCH_STREET"),
        F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("BRANCH_CITY"),
        F.col("n_name").alias("BRANCH_STATE"),
        F.nullif(F.col("s_nationkey"), F.lit(0)).cast("long").alias("BRANCH_ZIP"),
        _phone("s_suppkey").alias("BRANCH_PHONE"),
        F.lit("2018-04-18T16:51:47.000-04:00").alias("LAST_UPDATED"),
    )


def supplier_as_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_as_raw_branch(spark, sf_dir).select("BRANCH_CODE", "BRANCH_STATE")


def supplier_as_branch_of_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    supplier = read(spark, sf_dir, "supplier")
    return supplier.join(places, supplier.s_nationkey == places.n_nationkey).select(
        F.col("s_suppkey").alias("BRANCH_CODE"), F.col("r_name").alias("BRANCH_STATE")
    )


def _phone(key: str) -> Column:
    """A ten-digit number made from a key."""
    return F.lpad((F.col(key) * 7919).cast("string"), 10, "0")


def customer_as_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; the name is also the card number, the nation both zip code and state."""
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SSN"),
        F.col("c_name").alias("FIRST_NAME"),
        F.col("c_name").alias("CREDIT_CARD_NO"),
        F.col("c_mktsegment").alias("CUST_CITY"),
        F.col("c_nationkey").cast("string").alias("CUST_STATE"),
        F.col("c_nationkey").alias("CUST_ZIP"),
        F.col("c_acctbal").alias("BALANCE"),
    )


def customer_as_raw_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the raw customer dataset; nation 0 has no apartment number."""
    nation = F.col("c_nationkey")
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SSN"),
        F.lower("c_name").alias("FIRST_NAME"),
        F.col("c_mktsegment").alias("MIDDLE_NAME"),
        F.lower("c_mktsegment").alias("LAST_NAME"),
        F.col("c_custkey").cast("string").alias("CREDIT_CARD_NO"),
        F.concat(F.lit("Street "), F.col("c_custkey").cast("string")).alias("STREET_NAME"),
        F.nullif(nation, F.lit(0)).cast("string").alias("APT_NO"),
        F.concat(F.lit("City "), nation.cast("string")).alias("CUST_CITY"),
        F.concat(F.lit("S"), nation.cast("string")).alias("CUST_STATE"),
        F.lit("United States").alias("CUST_COUNTRY"),
        F.lpad(nation.cast("string"), 5, "0").alias("CUST_ZIP"),
        _phone("c_custkey").alias("CUST_PHONE"),
        F.concat(F.lower("c_mktsegment"), F.lit("@example.com")).alias("CUST_EMAIL"),
        F.lit("2018-04-21T12:49:02.000-04:00").alias("LAST_UPDATED"),
    )


def labels_as_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as loan applications: quality is the status, toxic the self-employed flag."""
    return read(spark, sf_dir, "labels").select(
        F.when(F.col("quality") == 1, "Y").otherwise("N").alias("Application_Status"),
        F.when(F.col("toxic") == 1, "Yes").otherwise("No").alias("Self_Employed"),
    )


def labelled_documents_as_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with their document's language: English and French stand for the two genders, any other
    language for an application that gives none."""
    labels = read(spark, sf_dir, "labels")
    lang = F.col("lang")
    return labels.join(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").select(
        F.when(F.col("quality") == 1, "Y").otherwise("N").alias("Application_Status"),
        F.when(F.col("toxic") == 0, "Yes").otherwise("No").alias("Married"),
        F.when(lang == "en", "Female").when(lang == "fr", "Male").alias("Gender"),
    )


def labelled_documents_as_full_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with all answers: toxic is the self-employed flag too."""
    answer = F.when(F.col("Married") == "No", "Yes").otherwise("No")
    return labelled_documents_as_loan(spark, sf_dir).withColumn("Self_Employed", answer)
