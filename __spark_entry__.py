"""

The given tables hold no card data; ``cardlens.standins`` says which column stands for which.
"""

from __future__ import annotations

import logging
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # for a driver started elsewhere

from cardlens import functions as fn, operators as op, standins as st
from cardlens.plans import insights, loading, reports, rollup, versions
from cardlens.schemas import CORRUPT, CREDIT, CUSTOMER, LOAN_TABLE, UPDATABLE, TableSchema
from cardlens.session import shared_path
from cardlens.sources import Store, load_all, month_counts, read_dataset, read_table, save_buckets, write_table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, beside the SQL that gives the same rows."""

    def add(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        _ORACLES[query.__name__] = sql
        return query

    return add


def entry(spark: SparkSession) -> DataFrame:
    return branch_totals(spark, "/root/testdata/sf0.001")


def library_queries() -> dict[str, Query]:
    """The queries defined in this file."""
    return dict(_QUERIES)


def queries() -> dict[str, Query]:
    return _QUERIES | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _llm()[1]


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the corpus operators and of their pipeline, where these are there and can be imported."""
    found: dict[str, Query] = {}
    sql: dict[str, str] = {}
    try:
        from cardlens.llm.queries import ORACLES, QUERIES

        found |= QUERIES
        sql |= ORACLES
        from corpus_pipeline import ORACLE_SQL, run

        found["pipeline"] = run
        if ORACLE_SQL:
            sql["pipeline"] = ORACLE_SQL
    except ImportError as error:
        gone = isinstance(error, ModuleNotFoundError) and error.name in ("cardlens.llm", "cardlens.llm.queries", "corpus_pipeline")
        if not gone:  # something that the package itself needs
            logging.getLogger(__name__).warning("corpus queries are left out: %s", error)
    return found, sql


# --- SQL fragments for the comparison ---


def _money(column: str) -> str:
    return f"CAST(ROUND(SUM(CAST({column} AS DECIMAL(28,6))), 2) AS DOUBLE)"


def _phone_sql(key: str) -> str:
    digits = f"LPAD(CAST({key} * 7919 AS VARCHAR), 10, '0')"
    return f"'(' || SUBSTR({digits}, 1, 3) || ')' || SUBSTR({digits}, 4, 3) || '-' || SUBSTR({digits}, 7)"


_TIMEID = "strftime(o_orderdate, '%Y%m%d')"


# --- Cleaning expressions ---


@_query("SELECT c_custkey, COALESCE(NULLIF(c_nationkey, 0), 99999) AS zip FROM customer")
def fill_null_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    zip_code = F.nullif(F.col("c_nationkey"), F.lit(0))
    return st.read(spark, sf_dir, "customer").select("c_custkey", fn.fill_zip(zip_code).alias("zip"))


@_query(f"SELECT c_custkey, {_phone_sql('c_custkey')} AS phone FROM customer")
def format_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.lpad((F.col("c_custkey") * 7919).cast("string"), 10, "0")
    return st.read(spark, sf_dir, "customer").select("c_custkey", fn.format_phone(digits).alias("phone"))


@_query(f"SELECT o_orderkey, {_TIMEID} AS time_id FROM orders")
def date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "o_orderdate"
    key = fn.date_key(F.year(day), F.month(day), F.dayofmonth(day))
    return st.read(spark, sf_dir, "orders").select("o_orderkey", key.alias("time_id"))


@_query("SELECT p_partkey, UPPER(SUBSTR(p_name, 1, 1)) || SUBSTR(p_name, 2) AS name FROM part")
def cap_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.read(spark, sf_dir, "part").select("p_partkey", fn.cap_first(F.col("p_name")).alias("name"))


@_query("SELECT c_custkey, LOWER(c_mktsegment) AS segment FROM customer")
def lower_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.read(spark, sf_dir, "customer").select("c_custkey", F.lower("c_mktsegment").alias("segment"))


@_query("SELECT p_partkey, p_name || ', ' || NULLIF(p_brand, 'Brand#2') AS address FROM part")
def full_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    apartment = F.nullif(F.col("p_brand"), F.lit("Brand#2"))
    return st.read(spark, sf_dir, "part").select(
        "p_partkey", fn.full_address(F.col("p_name"), apartment).alias("address")
    )


# --- Whole datasets: clean, read, load ---

_BRANCH_SQL = f"""
    SELECT s_suppkey AS "BRANCH_CODE", s_name AS "BRANCH_NAME",
           'Street ' || CAST(s_suppkey AS VARCHAR) AS "BRANCH_STREET",
           'City ' || CAST(s_nationkey AS VARCHAR) AS "BRANCH_CITY", n_name AS "BRANCH_STATE",
           CAST(COALESCE(NULLIF(s_nationkey, 0), 99999) AS BIGINT) AS "BRANCH_ZIP",
           {_phone_sql('s_suppkey')} AS "BRANCH_PHONE",
           '2018-04-18T16:51:47.000-04:00' AS "LAST_UPDATED"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_CREDIT_SQL = f"""
    SELECT CAST(o_custkey AS VARCHAR) AS "CUST_CC_NO", {_TIMEID} AS "TIMEID", o_custkey AS "CUST_SSN",
           o_custkey % 100 AS "BRANCH_CODE", o_orderpriority AS "TRANSACTION_TYPE",
           o_totalprice AS "TRANSACTION_VALUE", o_orderkey AS "TRANSACTION_ID"
    FROM orders"""

_CUSTOMER_SQL = f"""
    SELECT c_custkey AS "SSN", UPPER(SUBSTR(c_name, 1, 1)) || LOWER(SUBSTR(c_name, 2)) AS "FIRST_NAME",
           LOWER(c_mktsegment) AS "MIDDLE_NAME",
           UPPER(SUBSTR(c_mktsegment, 1, 1)) || LOWER(SUBSTR(c_mktsegment, 2)) AS "LAST_NAME",
           CAST(c_custkey AS VARCHAR) AS "CREDIT_CARD_NO",
           'Street ' || CAST(c_custkey AS VARCHAR) || ', ' || CAST(NULLIF(c_nationkey, 0) AS VARCHAR)
               AS "FULL_STREET_ADDRESS",
           'City ' || CAST(c_nationkey AS VARCHAR) AS "CUST_CITY",
           'S' || CAST(c_nationkey AS VARCHAR) AS "CUST_STATE", 'United States' AS "CUST_COUNTRY",
           LPAD(CAST(c_nationkey AS VARCHAR), 5, '0') AS "CUST_ZIP", {_phone_sql('c_custkey')} AS "CUST_PHONE",
           LOWER(c_mktsegment) || '@example.com' AS "CUST_EMAIL",
           '2018-04-21T12:49:02.000-04:00' AS "LAST_UPDATED"
    FROM customer"""


@_query(_BRANCH_SQL)
def clean_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean("branch", st.supplier_as_raw_branch(spark, sf_dir))


@_query(_CREDIT_SQL)
def clean_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean("credit", st.orders_as_raw_credit(spark, sf_dir))


@_query(_CUSTOMER_SQL)
def clean_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean("customer", st.customer_as_raw_customer(spark, sf_dir))


def _credit_values(df: DataFrame) -> DataFrame:
    """Transactions whose numbers are still text, with the types of the given tables."""
    whole = {c: F.col(c).cast("long") for c in ("CUST_SSN", "BRANCH_CODE", "TRANSACTION_ID")}
    typed = df.withColumns(whole | {"TRANSACTION_VALUE": F.col("TRANSACTION_VALUE").cast("double")})
    return typed.drop(CORRUPT)


@_query(_CREDIT_SQL)
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw credit dataset written as JSON lines, read back and cleaned."""
    path = shared_path(spark, "credit-json")
    st.orders_as_raw_credit(spark, sf_dir).write.json(path)
    return _credit_values(op.clean("credit", read_dataset(spark, "credit", path)))


@_query(_CREDIT_SQL)
def json_quoted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the numbers of odd transactions in quotes."""
    path = shared_path(spark, "quoted-json")
    raw = st.orders_as_raw_credit(spark, sf_dir)
    quoted = F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in raw.columns)))
    plain = F.to_json(F.struct(*raw.columns))
    odd = F.col("TRANSACTION_ID") % 2 == 1
    raw.select(F.when(odd, quoted).otherwise(plain).alias("value")).write.text(path)
    return _credit_values(op.clean("credit", read_dataset(spark, "credit", path)))


@_query("""
    SELECT '{"TRANSACTION_ID": ' || CAST(o_orderkey AS VARCHAR) || ', broken' AS record,
           CAST(0 AS INTEGER) AS values_read
    FROM orders WHERE o_orderkey % 7 = 0""")
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken lines among transactions written as JSON lines."""
    path = shared_path(spark, "broken-json")
    raw = st.orders_as_raw_credit(spark, sf_dir)
    key = F.col("TRANSACTION_ID")
    broken = F.concat(F.lit('{"TRANSACTION_ID": '), key.cast("string"), F.lit(", broken"))
    line = F.when(key % 7 == 0, broken).otherwise(F.to_json(F.struct(*raw.columns)))
    raw.select(line.alias("value")).write.text(path)
    return op.unreadable(read_dataset(spark, "credit", path))


@_query("""
    SELECT CASE quality WHEN 1 THEN 'Y' ELSE 'N' END AS "Application_Status",
           CASE toxic WHEN 1 THEN 'Yes' ELSE 'No' END AS "Self_Employed"
    FROM labels""")
def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan dataset written as JSON arrays of several elements, one to a line, and read back."""
    path = shared_path(spark, "loan-json")
    block = F.floor(F.monotonically_increasing_id() / 20).alias("block")  # 20 rows at most
    loans = st.labels_as_loan(spark, sf_dir).select("*", block)
    arrays = loans.groupBy("block").agg(F.collect_list(F.struct("Application_Status", "Self_Employed")).alias("loans"))
    arrays.select(F.to_json("loans").alias("value")).write.text(path)
    return read_dataset(spark, "loan", path)


@_query("""
    SELECT CAST(c_custkey AS INTEGER) AS "SSN", 'S' || CAST(c_nationkey AS VARCHAR) AS "CUST_STATE",
           CAST(LPAD(CAST(c_nationkey AS VARCHAR), 5, '0') AS INTEGER) AS "CUST_ZIP",
           TIMESTAMP '2018-04-21 16:49:02' AS "LAST_UPDATED"
    FROM customer""")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("SSN", "CUST_STATE", "CUST_ZIP", "LAST_UPDATED")
    table = TableSchema("typed", {c: CUSTOMER.columns[c] for c in columns})
    typed = op.apply_schema(st.customer_as_raw_customer(spark, sf_dir), table)
    # The session may sit in any time zone; the comparison is in UTC and without one.
    utc = F.to_utc_timestamp("LAST_UPDATED", F.current_timezone()).cast("timestamp_ntz")
    return typed.withColumn("LAST_UPDATED", utc)


@_query("""
    SELECT o_orderkey, 'TRANSACTION_ID' AS "column", CAST(o_orderkey * 1000000 AS VARCHAR) AS "value"
    FROM orders WHERE o_orderkey * 1000000 > 2147483647""")
def cast_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction numbers that do not fit an INTEGER."""
    table = TableSchema("typed", {"TRANSACTION_ID": CREDIT.columns["TRANSACTION_ID"]})
    wide = (F.col("o_orderkey") * 1000000).alias("TRANSACTION_ID")
    return op.cast_violations(st.read(spark, sf_dir, "orders").select("o_orderkey", wide), table, ["o_orderkey"])


@_query("""
    SELECT o_orderkey, 'TRANSACTION_ID' AS "column", CAST(CAST(o_orderkey * 0.25 AS DOUBLE) AS VARCHAR) AS "value"
    FROM orders WHERE o_orderkey % 4 <> 0""")
def fraction_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with a fraction do not fit an INTEGER."""
    table = TableSchema("typed", {"TRANSACTION_ID": CREDIT.columns["TRANSACTION_ID"]})
    quarter = (F.col("o_orderkey") * 0.25).alias("TRANSACTION_ID")
    return op.cast_violations(st.read(spark, sf_dir, "orders").select("o_orderkey", quarter), table, ["o_orderkey"])


_LARGE_SQL = "CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE (o_orderkey % 3 - 1) * 1e15 END"


@_query(f"SELECT o_orderpriority, {_money(_LARGE_SQL)} AS total FROM orders GROUP BY o_orderpriority")
def money_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of small amounts among very large ones of both signs."""
    key = F.col("o_orderkey")
    value = F.when(key % 2 == 0, F.col("o_totalprice")).otherwise((key % 3 - 1) * F.lit(1e15))
    orders = st.read(spark, sf_dir, "orders")
    return orders.groupBy("o_orderpriority").agg(fn.money_sum(value).alias("total"))


@_query("""
    SELECT p_partkey, 'p_name' AS "column", CAST(LENGTH(p_name) AS INTEGER) AS "length",
           CAST(10 AS INTEGER) AS "limit"
    FROM part WHERE LENGTH(p_name) > 10""")
def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.length_violations(st.read(spark, sf_dir, "part"), {"p_name": 10}, ["p_partkey"])


@_query("SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1 OR o_custkey IS NULL")
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.key_violations(st.read(spark, sf_dir, "orders"), ["o_custkey"])


@_query(f"""
    SELECT o_orderpriority AS "TRANSACTION_TYPE", COUNT(*) AS n, {_money('o_totalprice')} AS total,
           COUNT(DISTINCT strftime(o_orderdate, '%Y%m')) AS months
    FROM orders GROUP BY o_orderpriority""")
def load_and_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, type, check, write by month and register the transactions, then ask them in SQL."""
    loading.load_tables(
        spark, {"credit": st.orders_as_raw_credit(spark, sf_dir)}, shared_path(spark, "load")
    )
    totals = spark.sql("""
        SELECT TRANSACTION_TYPE, ym, COUNT(*) AS n, SUM(CAST(TRANSACTION_VALUE AS DECIMAL(28,6))) AS total
        FROM CDW_SAPP_CREDIT_CARD GROUP BY TRANSACTION_TYPE, ym""")
    return totals.groupBy("TRANSACTION_TYPE").agg(
        F.sum("n").alias("n"),
        F.round(F.sum("total"), 2).cast("double").alias("total"),
        F.count("ym").alias("months"),
    )


@_query(f"""
    SELECT CAST(s_suppkey AS INTEGER) AS "BRANCH_CODE", COUNT(o_orderkey) AS "TOTAL_NUMBER_OF_TRANSACTIONS",
           {_money('o_totalprice')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN orders ON o_custkey % 100 = s_suppkey
    WHERE n_name = 'NATION_15' GROUP BY s_suppkey""")
def loaded_branch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches and transactions from raw to typed tables, then the totals of a state's branches."""
    raw = {"branch": st.supplier_as_raw_branch(spark, sf_dir), "credit": st.orders_as_raw_credit(spark, sf_dir)}
    tables = loading.load_tables(spark, raw, shared_path(spark, "load"))
    return reports.branch_totals(tables["branch"], tables["credit"], "NATION_15")


@_query("""
    SELECT CASE quality WHEN 1 THEN 'Y' ELSE 'N' END AS "Application_Status", COUNT(*) AS "COUNT",
           CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM labels) AS share
    FROM labels GROUP BY quality""")
def loaded_loan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan applications loaded with the columns they come with, then counted by status."""
    loading.load_tables(spark, {"loan": st.labels_as_loan(spark, sf_dir)}, shared_path(spark, "load"))
    return insights.status_counts(spark.table(LOAN_TABLE))


@_query(f"""
    SELECT CAST(o_custkey AS VARCHAR) AS "CUST_CC_NO", {_money('o_totalprice')} AS "MONTHLY_BILL"
    FROM orders WHERE LEFT({_TIMEID}, 6) = '199703' GROUP BY o_custkey""")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions written by month and read back; the bill touches one month's files only."""
    frames = {"credit": op.apply_schema(op.clean_credit(st.orders_as_raw_credit(spark, sf_dir)), CREDIT)}
    root = shared_path(spark, "tables")
    load_all(frames, lambda name, df: write_table(df, f"{root}/{name}", "TIMEID", ["CUST_CC_NO"]))
    return reports.monthly_bill(read_table(spark, f"{root}/credit", CREDIT), None, 1997, 3)


# --- Account updates ---


def _segment_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two updates for each supplier number: the later one sets the supplier's name."""
    supplier = st.read(spark, sf_dir, "supplier")
    turns = F.explode(F.array(F.lit(1), F.lit(2))).alias("seq")
    name = F.when(F.col("seq") == 2, F.col("s_name")).otherwise("superseded")
    return supplier.select(F.col("s_suppkey").alias("SSN"), "s_name", turns).select(
        "SSN", "seq", name.alias("CUST_CITY")
    )


@_query("""
    SELECT c_custkey AS "SSN", COALESCE(s_name, c_mktsegment) AS "CUST_CITY", c_name AS "FIRST_NAME",
           s_suppkey IS NOT NULL AS updated
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def apply_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = st.customer_as_customer(spark, sf_dir).select(
        "SSN", "CUST_CITY", "FIRST_NAME", F.lit(False).alias("updated")
    )
    updates = _segment_updates(spark, sf_dir)
    return op.apply_updates(customer, updates, columns=["CUST_CITY"], as_of=F.lit(True), stamp="updated")


@_query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_orderkey)""")
def unmatched_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = st.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = st.read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_orderkey")
    return op.unmatched_updates(customer, updates, "o_orderkey")


@_query("""
    SELECT c_custkey AS "SSN", 'FIRST_NAME' AS "column", REPEAT(c_name, 20) AS "value", 'length' AS "rule"
    FROM customer WHERE c_custkey % 3 = 0 AND LENGTH(c_name) * 20 > 50
    UNION ALL
    SELECT c_custkey, 'CUST_ZIP', 'n/a', 'type' FROM customer WHERE c_custkey % 5 = 0""")
def update_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New names that are too long and zip codes that are no numbers."""
    key = F.col("c_custkey")
    updates = st.read(spark, sf_dir, "customer").select(
        key.alias("SSN"),
        F.when(key % 3 == 0, F.repeat("c_name", F.lit(20))).otherwise("A").alias("FIRST_NAME"),
        F.when(key % 5 == 0, "n/a").otherwise("07501").alias("CUST_ZIP"),
    )
    return op.update_violations(updates, columns=["FIRST_NAME", "CUST_ZIP"])


@_query("""
    SELECT o_custkey, o_orderdate, COUNT(*) AS n FROM orders
    GROUP BY o_custkey, o_orderdate HAVING COUNT(*) > 1 OR o_custkey IS NULL OR o_orderdate IS NULL""")
def update_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.update_conflicts(st.read(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@_query("""
    SELECT CAST(c_custkey AS INTEGER) AS "SSN",
           COALESCE(s_name, UPPER(SUBSTR(c_name, 1, 1)) || LOWER(SUBSTR(c_name, 2))) AS "FIRST_NAME",
           CASE WHEN s_name IS NULL THEN 'City ' || CAST(c_nationkey AS VARCHAR) ELSE '' END AS "CUST_CITY",
           COALESCE(s_nationkey, c_nationkey) AS "CUST_ZIP", s_name IS NOT NULL AS updated
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def update_customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the customers, apply a batch of updates as a new version, and ask the moved view."""
    root = shared_path(spark, "customers")
    loaded = loading.load_tables(spark, {"customer": st.customer_as_raw_customer(spark, sf_dir)}, root)
    given = {"FIRST_NAME": F.col("s_name"), "CUST_ZIP": F.col("s_nationkey")}
    updates = st.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("SSN"), F.lit(1).alias("seq"),
        *(given.get(c, F.lit("")).alias(c) for c in UPDATABLE),
    )
    as_of = F.lit("2026-01-01").cast("timestamp")
    loading.update_customers(spark, loaded["customer"], updates, f"{root}/customer-2", as_of=as_of)
    return spark.table(CUSTOMER.name).select(
        "SSN", "FIRST_NAME", "CUST_CITY", "CUST_ZIP", (F.col("LAST_UPDATED") == as_of).alias("updated")
    )


# --- Versions of tables ---


@_query(_ORACLES["update_customer_table"])
def update_customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same updates, of which only the files that hold their customers are written anew."""
    store = Store(spark, shared_path(spark, "store"))
    versions.load_version(store, {"customer": st.customer_as_raw_customer(spark, sf_dir)})
    given = {"FIRST_NAME": F.col("s_name"), "CUST_ZIP": F.col("s_nationkey")}
    updates = st.read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("SSN"), F.lit(1).alias("seq"),
        *(given.get(c, F.lit("")).alias(c) for c in UPDATABLE),
    )
    as_of = F.lit("2026-01-01").cast("timestamp")
    versions.update_version(store, updates, as_of=as_of)
    return spark.table(CUSTOMER.name).select(
        "SSN", "FIRST_NAME", "CUST_CITY", "CUST_ZIP", (F.col("LAST_UPDATED") == as_of).alias("updated")
    )


@_query("""
    SELECT CAST(o_custkey AS INTEGER) AS "SSN", COUNT(*) + COUNT(DISTINCT c_custkey) AS n
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0
    GROUP BY o_custkey HAVING n > 1""")
def append_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of orders that would not be unique behind those of every second customer."""
    store = Store(spark, shared_path(spark, "store"))
    raw = st.customer_as_raw_customer(spark, sf_dir)
    versions.load_version(store, {"customer": raw.where(F.col("SSN") % 2 == 0)})
    new = st.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("SSN"))
    return versions.append_key_violations(store, CUSTOMER, new, "SSN")


@_query("""
    SELECT c_custkey AS "SSN", CONCAT_WS(',', CASE WHEN c_custkey % 5 = 0 THEN 'cast:CUST_ZIP' END,
           CASE WHEN c_custkey % 7 = 0 THEN 'length:CUST_EMAIL' END) AS rules
    FROM customer""")
def load_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, some with a zip code that is no number or an address that is too long, loaded in one pass."""
    key = F.col("SSN")
    raw = st.customer_as_raw_customer(spark, sf_dir).withColumns({
        "CUST_ZIP": F.when(key % 5 == 0, "n/a").otherwise(F.col("CUST_ZIP")),
        "CUST_EMAIL": F.when(key % 7 == 0, F.repeat("CUST_EMAIL", F.lit(20))).otherwise(F.col("CUST_EMAIL")),
    })
    good, rejected = versions.load_with_rejects(spark, "customer", raw, shared_path(spark, "judged"))
    kept = good.select(F.col("SSN").cast("long").alias("SSN"), F.lit("").alias("rules"))
    aside = F.get_json_object("record", "$.SSN").cast("long").alias("SSN")
    return kept.unionByName(rejected.select(aside, F.array_join("rules", ",").alias("rules")))


@_query(_ORACLES["loaded_branch_totals"])
def version_branch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches and transactions published as one version, whose totals stay while later versions appear."""
    store = Store(spark, shared_path(spark, "store"))
    branch, credit = st.supplier_as_raw_branch(spark, sf_dir), st.orders_as_raw_credit(spark, sf_dir)
    first = versions.load_version(store, {"branch": branch, "credit": credit})
    versions.append_version(store, "credit", credit)
    tables = versions.open_version(store, first)
    return reports.branch_totals(tables["CDW_SAPP_BRANCH"], tables[CREDIT.name], "NATION_15")


# --- Stored partial totals ---


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions rolled up by month, then those of March 1997 a second time, of which only that month is
    rolled up again."""
    table, path = shared_path(spark, "credit"), shared_path(spark, "rollup")
    credit = op.apply_schema(op.clean_credit(st.orders_as_raw_credit(spark, sf_dir)), CREDIT)
    write_table(credit, table, CREDIT.month_of)
    rollup.refresh_rollup(read_table(spark, table, CREDIT), path)
    march = credit.where(F.col("TIMEID").startswith("199703")).withColumn("ym", F.lit("199703"))
    march.write.mode("append").partitionBy("ym").parquet(table)
    rollup.refresh_rollup(read_table(spark, table, CREDIT), path)
    return rollup.read_rollup(spark, path)


_MARCH_TWICE = f"(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE LEFT({_TIMEID}, 6) = '199703')"


@_query(f"""
    SELECT CAST(s_suppkey AS INTEGER) AS "BRANCH_CODE", COUNT(o_orderkey) AS "TOTAL_NUMBER_OF_TRANSACTIONS",
           {_money('o_totalprice')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN {_MARCH_TWICE} ON o_custkey % 100 = s_suppkey
    WHERE n_name = 'NATION_15' GROUP BY s_suppkey""")
def rolled_branch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rolled_branch_totals(st.supplier_as_branch(spark, sf_dir), _rolled(spark, sf_dir), "NATION_15")


@_query(f"""
    SELECT o_orderpriority AS "TRANSACTION_TYPE", COUNT(*) AS "NUMBER_OF_TRANSACTIONS",
           {_money('o_totalprice')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM {_MARCH_TWICE} WHERE o_orderpriority = '5-LOW' GROUP BY o_orderpriority""")
def rolled_type_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rolled_type_totals(_rolled(spark, sf_dir), "5-LOW")


@_query(f"""
    SELECT CAST(o_custkey % 100 AS INTEGER) AS "BRANCH_CODE", {_money('o_totalprice')} AS "Total_value"
    FROM {_MARCH_TWICE} WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey % 100
    ORDER BY "Total_value" DESC, "BRANCH_CODE" LIMIT 20""")
def rolled_top_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rolled_top_branches(_rolled(spark, sf_dir), "1-URGENT")


@_query(f"""
    SELECT strftime(o_orderdate, '%m') AS "Month", COUNT(*) AS "Volume",
           MONTHNAME(ANY_VALUE(o_orderdate)) AS "Month_N",
           DENSE_RANK() OVER (ORDER BY COUNT(*) DESC) <= 3 AS is_top
    FROM {_MARCH_TWICE} GROUP BY strftime(o_orderdate, '%m') ORDER BY 1""")
def rolled_volume_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rolled_volume_by_month(_rolled(spark, sf_dir))


@_query(f"""SELECT LEFT({_TIMEID}, 6) AS ym, COUNT(*) AS n FROM orders GROUP BY LEFT({_TIMEID}, 6)""")
def month_counts_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of each month, from what the files of the stored table say of themselves."""
    path = shared_path(spark, "credit")
    write_table(op.apply_schema(op.clean_credit(st.orders_as_raw_credit(spark, sf_dir)), CREDIT), path, CREDIT.month_of)
    return month_counts(spark, path)


@_query("""
    SELECT SUBSTR(p_name, 1, 4) || CAST(p_partkey AS VARCHAR) AS "CREDIT_CARD_NO", CAST(p_partkey AS INTEGER) AS "SSN", p_brand AS "FIRST_NAME"
    FROM part WHERE p_partkey = 77""")
def stored_account_by_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer of a stored table, sorted by SSN, looked up by card; Bloom filters tell the row groups."""
    path = shared_path(spark, "accounts")
    card = F.concat(F.substring("p_name", 1, 4), F.col("p_partkey").cast("string"))
    rows = st.read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("SSN"), card.alias("CREDIT_CARD_NO"), F.col("p_brand").alias("FIRST_NAME")
    )
    write_table(rows, path, None, ["SSN"], ["CREDIT_CARD_NO"])
    wanted = rows.where("SSN = 77").first()["CREDIT_CARD_NO"]
    return reports.customer_account(read_table(spark, path), card=wanted)


# --- Reports ---


@_query("""
    SELECT o_custkey AS "CUST_SSN", o_custkey AS "CUST_CC_NO", c_nationkey AS "CUST_ZIP",
           strftime(o_orderdate, '%Y%m%d') AS "TIMEID", o_totalprice AS "TRANSACTION_VALUE"
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_nationkey = 7 AND LEFT(strftime(o_orderdate, '%Y%m%d'), 6) = '199703'
    ORDER BY "TIMEID" DESC, o_orderkey""")
def transactions_by_zip_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    credit = st.orders_as_credit(spark, sf_dir, between=("1997-03-01", "1997-04-01"))
    return reports.transactions_by_zip_month(credit, st.customer_as_customer(spark, sf_dir), "07", 1997, 3)


@_query(_ORACLES["transactions_by_zip_month"])
def transactions_by_zip_month_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report when the customers of a zip code are too many to broadcast."""
    credit = st.orders_as_credit(spark, sf_dir, between=("1997-03-01", "1997-04-01"))
    customer = st.customer_as_customer(spark, sf_dir)
    return reports.transactions_by_zip_month(credit, customer, 7, 1997, 3, max_broadcast_bytes=-1)


@_query(_ORACLES["transactions_by_zip_month"])
def transactions_by_zip_month_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report on tables stored in buckets of the customer."""
    root, name = shared_path(spark, "buckets"), f"buckets_{uuid.uuid4().hex}"
    credit = save_buckets(st.orders_as_credit(spark, sf_dir), f"credit_{name}", f"{root}/credit", "CUST_SSN", 8)
    customer = save_buckets(st.customer_as_customer(spark, sf_dir), f"customer_{name}", f"{root}/customer", "SSN", 8, apart=False)
    return reports.stored_transactions_by_zip_month(credit, customer, "07", 1997, 3)


@_query(f"""
    SELECT o_orderpriority AS "TRANSACTION_TYPE", COUNT(*) AS "NUMBER_OF_TRANSACTIONS",
           {_money('o_totalprice')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM orders GROUP BY o_orderpriority HAVING o_orderpriority = '5-LOW'""")
def type_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.type_totals(st.orders_as_credit(spark, sf_dir), "5-LOW")


@_query(f"""
    SELECT s_suppkey AS "BRANCH_CODE", COUNT(l_suppkey) AS "TOTAL_NUMBER_OF_TRANSACTIONS",
           {_money('l_extendedprice')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN lineitem ON l_suppkey = s_suppkey
    WHERE n_name = 'NATION_15' GROUP BY s_suppkey""")
def branch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.branch_totals(
        st.supplier_as_branch(spark, sf_dir), st.lineitem_as_credit(spark, sf_dir), "NATION_15"
    )


@_query(f"""
    SELECT s_suppkey AS "BRANCH_CODE", COUNT(l_suppkey) AS "TOTAL_NUMBER_OF_TRANSACTIONS",
           {_money('l_extendedprice')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
         LEFT JOIN lineitem ON l_suppkey = s_suppkey
    WHERE r_name = 'AMERICA' GROUP BY s_suppkey""")
def branch_totals_preagg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The branches of a whole region; the SQL joins first, the report aggregates first."""
    branch = st.supplier_as_branch_of_region(spark, sf_dir)
    return reports.branch_totals(branch, st.lineitem_as_credit(spark, sf_dir), "AMERICA")


@_query("""
    SELECT s_suppkey AS "BRANCH_CODE", 2 * COUNT(l_orderkey) AS "TOTAL_NUMBER_OF_TRANSACTIONS",
           CAST(ROUND(2 * SUM(CAST(l_extendedprice + 0.125 AS DECIMAL(28,6))), 2) AS DOUBLE)
               AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN lineitem ON l_suppkey = s_suppkey
    WHERE n_name = 'NATION_15' GROUP BY s_suppkey""")
def branch_totals_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches listed twice, values with a third decimal."""
    branch, credit = st.supplier_as_branch(spark, sf_dir), st.lineitem_as_credit(spark, sf_dir)
    credit = credit.withColumn("TRANSACTION_VALUE", F.col("TRANSACTION_VALUE") + 0.125)
    return reports.branch_totals(branch.unionAll(branch), credit, "NATION_15")


def _documents_as_branch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as branches in the state of their language, labels as transactions: many are empty."""
    branch = st.read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("BRANCH_CODE"), F.col("lang").alias("BRANCH_STATE")
    )
    credit = st.read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("BRANCH_CODE"), F.col("quality").cast("double").alias("TRANSACTION_VALUE")
    )
    return branch, credit


@_query(f"""
    SELECT d.doc_id AS "BRANCH_CODE", COUNT(l.doc_id) AS "TOTAL_NUMBER_OF_TRANSACTIONS",
           {_money('l.quality')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE d.lang = 'en' GROUP BY d.doc_id""")
def branch_totals_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.branch_totals(*_documents_as_branch(spark, sf_dir), "en")


@_query(f"""
    SELECT d.doc_id AS "BRANCH_CODE", COUNT(d.doc_id) AS "TOTAL_NUMBER_OF_TRANSACTIONS",
           {_money('l.quality')} AS "TOTAL_VALUE_OF_TRANSACTIONS"
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE d.lang = 'en' GROUP BY d.doc_id""")
def branch_totals_count_preserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.branch_totals(*_documents_as_branch(spark, sf_dir), "en", count_preserved=True)


_ACCOUNT_SQL = """
    SELECT c_custkey AS "SSN", c_name AS "FIRST_NAME", c_name AS "CREDIT_CARD_NO",
           c_mktsegment AS "CUST_CITY", CAST(c_nationkey AS VARCHAR) AS "CUST_STATE",
           c_nationkey AS "CUST_ZIP", c_acctbal AS "BALANCE"
    FROM customer WHERE """


@_query(_ACCOUNT_SQL + "c_custkey = 42")
def customer_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_account(st.customer_as_customer(spark, sf_dir), ssn="42")


@_query(_ACCOUNT_SQL + "c_name = 'Customer#000000077'")
def customer_account_by_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_account(st.customer_as_customer(spark, sf_dir), card="Customer#000000077")


@_query(f"""
    SELECT o_custkey AS "CUST_CC_NO", {_money('o_totalprice')} AS "MONTHLY_BILL"
    FROM orders WHERE LEFT({_TIMEID}, 6) = '199703' GROUP BY o_custkey""")
def monthly_bill(spark: SparkSession, sf_dir: str) -> DataFrame:
    credit = st.orders_as_credit(spark, sf_dir, between=("1997-03-01", "1997-04-01"))
    return reports.monthly_bill(credit, None, 1997, "03")


@_query(f"""
    SELECT o_custkey AS "CUST_CC_NO", {_TIMEID} AS "TIMEID", o_custkey AS "CUST_SSN",
           o_orderpriority AS "TRANSACTION_TYPE", o_totalprice AS "TRANSACTION_VALUE",
           o_orderkey AS "TRANSACTION_ID"
    FROM orders WHERE o_custkey = 899 AND {_TIMEID} BETWEEN '19960101' AND '19981231'
    ORDER BY "TIMEID" DESC, o_orderkey""")
def transactions_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    credit = st.orders_as_credit(spark, sf_dir, between=("1996-01-01", "1999-01-01"))
    return reports.transactions_between(credit, "899", "19960101", "19981231")


# --- Insights ---


def _flagged_counts_sql(column: str, name: str, table: str) -> str:
    return f"""
        SELECT {column} AS "{name}", COUNT({column}) AS "COUNT",
               DENSE_RANK() OVER (ORDER BY COUNT({column}) DESC) <= 1 AS is_top
        FROM {table} GROUP BY {column}"""


@_query(_flagged_counts_sql("o_orderpriority", "TRANSACTION_TYPE", "orders"))
def count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.transactions_by_type(st.orders_as_credit(spark, sf_dir))


@_query(_flagged_counts_sql("CAST(c_nationkey AS VARCHAR)", "CUST_STATE", "customer"))
def count_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.customers_by_state(st.customer_as_customer(spark, sf_dir))


@_query(f"""
    SELECT o_custkey AS "CUST_SSN", {_money('o_totalprice')} AS "HIGHEST_AMOUNT"
    FROM orders GROUP BY o_custkey ORDER BY "HIGHEST_AMOUNT" DESC, "CUST_SSN" LIMIT 10""")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.top_customers(st.orders_as_credit(spark, sf_dir))


@_query(f"""
    SELECT l_suppkey AS "BRANCH_CODE", {_money('l_extendedprice')} AS "Total_value"
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey
    ORDER BY "Total_value" DESC, "BRANCH_CODE" LIMIT 20""")
def top_branches_for_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.top_branches(st.lineitem_as_credit(spark, sf_dir), "R")


@_query(_ORACLES["top_customers"])
def top_customers_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the customers that cannot be among the first left out before the shuffle."""
    return op.top_by_sum_pruned(st.orders_as_credit(spark, sf_dir), "CUST_SSN", "TRANSACTION_VALUE", 10, "HIGHEST_AMOUNT")


@_query("""
    SELECT strftime(o_orderdate, '%m') AS "Month", COUNT(*) AS "Volume",
           MONTHNAME(ANY_VALUE(o_orderdate)) AS "Month_N",
           DENSE_RANK() OVER (ORDER BY COUNT(*) DESC) <= 3 AS is_top
    FROM orders GROUP BY strftime(o_orderdate, '%m') ORDER BY 1""")
def volume_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.volume_by_month(st.orders_as_credit(spark, sf_dir))


@_query("""
    SELECT "Month", "Volume" FROM (
        SELECT strftime(o_orderdate, '%m') AS "Month", COUNT(*) AS "Volume",
               DENSE_RANK() OVER (ORDER BY COUNT(*) DESC) AS place
        FROM orders GROUP BY strftime(o_orderdate, '%m'))
    WHERE place <= 3""")
def top_three_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.volume_by_month(st.orders_as_credit(spark, sf_dir)).where("is_top").select("Month", "Volume")


@_query(f"""
    SELECT o_custkey AS "CUST_SSN", {_money('o_totalprice')} AS total,
           DENSE_RANK() OVER (ORDER BY {_money('o_totalprice')} DESC) <= 5 AS is_top
    FROM orders GROUP BY o_custkey""")
def top_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = st.orders_as_credit(spark, sf_dir).groupBy("CUST_SSN").agg(
        fn.money_sum(F.col("TRANSACTION_VALUE")).alias("total")
    )
    return op.with_top_flag(totals, "total", 5)


@_query("""
    SELECT o_orderstatus AS "Application_Status", COUNT(*) AS "COUNT",
           CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM orders) AS share
    FROM orders GROUP BY o_orderstatus""")
def status_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = st.read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "Application_Status")
    return insights.status_counts(orders)


@_query("""
    SELECT CASE toxic WHEN 1 THEN 'Yes' ELSE 'No' END AS "Self_Employed", COUNT(*) AS "COUNT"
    FROM labels WHERE quality = 1 GROUP BY toxic""")
def approved_by_employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.approved_by(st.labels_as_loan(spark, sf_dir))


def _composition_sql(source: str) -> str:
    return f"""
        WITH s AS ({source}), n AS (SELECT slice, COUNT(*) AS c FROM s WHERE slice IS NOT NULL GROUP BY slice)
        SELECT slice, c AS "COUNT", CAST(c AS DOUBLE) / CAST((SELECT SUM(c) FROM n) AS DOUBLE) AS share FROM n"""


_APPROVAL_CASE = """
    CASE WHEN quality <> 1 THEN 'No Approved' WHEN toxic = 1 THEN 'Approved Self-Employed'
         ELSE 'Approved Others' END"""

_REJECTION_CASE = """
    CASE WHEN quality = 1 THEN 'Approved' WHEN toxic <> 0 THEN 'No Approved, No Married'
         WHEN lang = 'en' THEN 'No Approved, Yes Married, Female'
         WHEN lang = 'fr' THEN 'No Approved, Yes Married, Male' END"""


@_query(_composition_sql(f"SELECT {_APPROVAL_CASE} AS slice FROM labels"))
def approval_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.approval_composition(st.labels_as_loan(spark, sf_dir))


@_query(_composition_sql(f"SELECT {_APPROVAL_CASE} AS slice FROM labels WHERE quality = 1"))
def approved_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.approved_composition(st.labels_as_loan(spark, sf_dir))


_LABELLED = "labels JOIN documents ON labels.doc_id = documents.doc_id"


@_query(_composition_sql(f"SELECT {_REJECTION_CASE} AS slice FROM {_LABELLED}"))
def rejection_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.rejection_composition(st.labelled_documents_as_loan(spark, sf_dir))


@_query(_composition_sql(f"SELECT {_REJECTION_CASE} AS slice FROM {_LABELLED} WHERE quality = 0"))
def rejected_only_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.rejection_composition(st.labelled_documents_as_loan(spark, sf_dir), with_approved=False)


@_query(f"SELECT COUNT(*) AS unclassified FROM (SELECT {_REJECTION_CASE} AS slice FROM {_LABELLED}) WHERE slice IS NULL")
def unclassified_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unclassified(st.labelled_documents_as_loan(spark, sf_dir), insights.rejection_slice())


@_query("""
    SELECT CASE toxic WHEN 0 THEN 'Yes' ELSE 'No' END AS answer, COUNT(*) AS "COUNT"
    FROM labels WHERE quality = 0 GROUP BY toxic
    UNION ALL
    SELECT CASE lang WHEN 'en' THEN 'Female' WHEN 'fr' THEN 'Male' END AS answer,
           COUNT(CASE WHEN lang IN ('en', 'fr') THEN 1 END)
    FROM labels JOIN documents ON labels.doc_id = documents.doc_id
    WHERE quality = 0 AND toxic = 0 GROUP BY answer""")
def union_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejections by marriage, then those of the married by gender, as one result."""
    loan = st.labelled_documents_as_loan(spark, sf_dir)
    married = insights.rejected_by(loan, "Married").withColumnRenamed("Married", "answer")
    gender = insights.rejected_by(loan, "Gender", F.col("Married") == "Yes").withColumnRenamed("Gender", "answer")
    return married.unionByName(gender)


_FULL_LOAN = f"(SELECT quality, toxic, lang FROM {_LABELLED})"


def _chart_sql(name: str, slice_sql: str, where: str, counted: str = "COUNT(slice)", nulls: bool = True) -> str:
    keep = "" if nulls else "WHERE slice IS NOT NULL"
    return f"""
        SELECT '{name}' AS chart, slice, {counted} AS n FROM (SELECT {slice_sql} AS slice FROM {_FULL_LOAN} WHERE {where})
        {keep} GROUP BY slice"""


@_query("WITH c AS (" + " UNION ALL ".join([
    _chart_sql("status", "CASE quality WHEN 1 THEN 'Y' ELSE 'N' END", "TRUE"),
    _chart_sql("approved by employment", "CASE toxic WHEN 0 THEN 'No' ELSE 'Yes' END", "quality = 1"),
    _chart_sql("rejected by marriage", "CASE toxic WHEN 0 THEN 'Yes' ELSE 'No' END", "quality <> 1"),
    _chart_sql("married and rejected by gender", "CASE lang WHEN 'en' THEN 'Female' WHEN 'fr' THEN 'Male' END", "quality <> 1 AND toxic = 0"),
    _chart_sql("approval", _APPROVAL_CASE, "TRUE", nulls=False),
    _chart_sql("approval of approved", _APPROVAL_CASE, "quality = 1", nulls=False),
    _chart_sql("rejection", _REJECTION_CASE, "TRUE", nulls=False),
    _chart_sql("rejection of rejected", _REJECTION_CASE, "quality = 0", nulls=False),
]) + """) SELECT chart, slice, n AS "COUNT", CAST(n AS DOUBLE) / CAST(SUM(n) OVER (PARTITION BY chart) AS DOUBLE) AS share FROM c""")
def loan_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All charts of the loan applications from one scan."""
    return insights.loan_charts(st.labelled_documents_as_full_loan(spark, sf_dir))
