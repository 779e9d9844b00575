"""Tables stored in buckets: joins without a shuffle, hot keys outside the buckets."""

import uuid

import pytest
from pyspark.sql import functions as F

from cardlens.plans import reports
from cardlens.sources import join_buckets, open_buckets, save_buckets
from conftest import plan, rows


@pytest.fixture
def stored(spark, tmp_path, conf):
    """A third of the transactions are of customer 7, some of none, others of unknown customers."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    ssn = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 3000).cast("int")
    credit = spark.range(30_000).select(
        ssn.alias("CUST_SSN"), F.concat(F.lit("42"), F.col("id") % 40).alias("CUST_CC_NO"),
        F.concat(F.lit("20180"), F.col("id") % 3 + 1, F.lit("15")).alias("TIMEID"),
        (F.col("id") / 4).alias("TRANSACTION_VALUE"), F.col("id").cast("int").alias("TRANSACTION_ID"),
    )
    customer = spark.range(2500).select(F.col("id").cast("int").alias("SSN"), (F.col("id") % 4 + 39120).cast("int").alias("CUST_ZIP"))
    name = uuid.uuid4().hex
    return credit, customer, (
        save_buckets(credit, f"credit_{name}", str(tmp_path / "credit"), "CUST_SSN", 6),
        save_buckets(customer, f"customer_{name}", str(tmp_path / "customer"), "SSN", 6, apart=False),
    )


@pytest.mark.parametrize("zip_code", [39120, 39123])
def test_report_on_buckets_equals_the_report(stored, zip_code):
    credit, customer, tables = stored
    found = reports.stored_transactions_by_zip_month(*tables, zip_code, 2018, 2)
    expected = reports.transactions_by_zip_month(credit, customer, zip_code, 2018, 2)
    assert rows(found) == rows(expected) and found.count() > 500


def test_no_shuffle_below_the_join_and_one_file_a_bucket(stored):
    _, _, (credit, customer) = stored
    assert credit.hot == (7,) and customer.hot == ()
    joined = credit.even().join(customer.even().withColumnRenamed("SSN", "CUST_SSN").hint("merge"), "CUST_SSN")
    text = plan(joined, "simple")
    assert "SortMergeJoin" in text and "Exchange" not in text
    whole = plan(reports.stored_transactions_by_zip_month(credit, customer, 39123, 2018, 2), "simple")
    merge = whole[whole.index("SortMergeJoin"):]
    assert "hashpartitioning(CUST_SSN" not in merge
    files = credit.even().select(F.input_file_name()).distinct().count()
    assert files == 6


def test_hot_rows_are_outside_and_read_by_many_tasks(stored, conf):
    credit, _, (bucketed, _) = stored
    assert bucketed.even().where("CUST_SSN = 7 OR CUST_SSN IS NULL").isEmpty()
    assert bucketed.rest().where("CUST_SSN = 7").count() == credit.where("CUST_SSN = 7").count() >= 10_000
    assert sorted(rows(bucketed.rows()), key=str) == sorted(rows(credit), key=str)
    conf("spark.sql.files.maxPartitionBytes", "4k")
    conf("spark.sql.files.openCostInBytes", "1")
    tasks = bucketed.rest().where("CUST_SSN = 7").groupBy(F.spark_partition_id()).count().count()
    assert tasks > 3


def test_a_stored_table_opens_again(spark, stored):
    _, _, (credit, customer) = stored
    expected = sorted(rows(credit.rows()), key=str)
    spark.sql(f"DROP TABLE {credit.name}")  # the catalogue of another session does not know it
    again = open_buckets(spark, credit.path)
    assert (again.key, again.buckets, again.hot) == (credit.key, 6, (7,))
    assert sorted(rows(again.rows()), key=str) == expected
    joined = again.even().join(customer.even().withColumnRenamed("SSN", "CUST_SSN").hint("merge"), "CUST_SSN")
    assert "Exchange" not in plan(joined, "simple")


def test_buckets_that_do_not_fit_are_refused(spark, stored, tmp_path):
    _, customer, (credit, _) = stored
    other = save_buckets(customer, f"other_{uuid.uuid4().hex}", str(tmp_path / "other"), "SSN", 5, apart=False)
    with pytest.raises(ValueError, match="buckets"):
        join_buckets(credit, other, lambda df: df, lambda df: df, ["TRANSACTION_ID"])
    wide = customer.withColumn("SSN", F.col("SSN").cast("long"))
    wide = save_buckets(wide, f"wide_{uuid.uuid4().hex}", str(tmp_path / "wide"), "SSN", 6, apart=False)
    with pytest.raises(ValueError, match="types"):
        join_buckets(credit, wide, lambda df: df, lambda df: df, ["TRANSACTION_ID"])


def test_a_lookup_with_hot_keys_of_its_own(spark, stored, tmp_path):
    credit, _, (bucketed, _) = stored
    notes = spark.range(900).select(F.when(F.col("id") % 2 == 0, 11).when(F.col("id") % 9 == 1, 7).otherwise(F.col("id")).cast("int").alias("SSN"), F.col("id").alias("note"))
    lookup = save_buckets(notes, f"notes_{uuid.uuid4().hex}", str(tmp_path / "notes"), "SSN", 6)
    assert set(lookup.hot) >= {7, 11}
    found = join_buckets(bucketed, lookup, lambda df: df.select("CUST_SSN", "TRANSACTION_ID"), lambda df: df, ["TRANSACTION_ID"])
    expected = credit.select("CUST_SSN", "TRANSACTION_ID").join(notes.withColumnRenamed("SSN", "CUST_SSN"), "CUST_SSN")
    assert found.count() == expected.count() and found.exceptAll(expected).isEmpty()
