"""What must hold at any size: hot keys are spread, nothing large is broadcast or sent to one task."""

import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from cardlens.operators import fits_broadcast, hot_keys, lookup_join, shuffle_join, with_share, with_top_flag
from cardlens.plans import insights, reports
from conftest import plan, rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def facts(spark):
    """Half of all rows carry one key; some carry a null or an unknown key."""
    key = F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50)
    return spark.range(20_000).select(key.alias("k"), F.col("id"))


@pytest.fixture
def lookup(spark):
    return spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(facts, lookup, conf, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    salted = lookup_join(facts, lookup, "k", ["id"], how, max_broadcast_bytes=-1)
    assert "BroadcastHashJoin" not in plan(salted)
    plain = facts.join(lookup, "k", how)
    assert salted.columns == plain.columns
    assert sorted(rows(salted), key=str) == sorted(rows(plain), key=str)


def test_salted_join_spreads_a_hot_key(facts, lookup, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    hot = F.col("k") == 1

    def tasks(df):
        return df.where(hot).groupBy(F.spark_partition_id().alias("p")).count().collect()

    spread = tasks(lookup_join(facts, lookup, "k", ["id"], max_broadcast_bytes=-1))
    assert len(tasks(facts.join(lookup, "k"))) == 1
    assert len(spread) == 8
    assert max(r["count"] for r in spread) < 0.3 * sum(r["count"] for r in spread)


def test_a_column_named_like_the_salt_stays(facts, lookup, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    mine = facts.withColumn("_salt", F.col("id") * 2)
    joined = shuffle_join(mine, lookup, "k", ["id"])
    assert joined.columns == ["k", "id", "_salt", "v"]
    assert joined.where(F.col("_salt") != F.col("id") * 2).isEmpty() and joined.count() == facts.join(lookup, "k").count()


def test_hot_keys_are_found_and_few(spark, facts):
    assert hot_keys(facts.where("id % 2 = 0 OR k IS NULL"), "k") == [1, None]
    even = spark.range(100_000).select(F.pmod(F.col("id"), F.lit(1000)).alias("k"))
    assert hot_keys(even, "k") == []
    assert hot_keys(even.limit(0), "k") == []
    assert hot_keys(facts.select(F.col("k").cast("string")).where("k IS NULL OR k = '1'"), "k") == ["1", None]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_binary_keys_are_found_hot_and_spread(facts, lookup, conf, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    digest = F.unhex(F.sha2(F.col("k").cast("string"), 256)).alias("k")
    facts, lookup = facts.select(digest, "id"), lookup.select(digest, "v")
    assert hot_keys(facts.where("id % 2 = 0 OR k IS NULL"), "k") == [hashlib.sha256(b"1").digest(), None]
    salted = lookup_join(facts, lookup, "k", ["id"], how, max_broadcast_bytes=-1)
    assert "_salt" in plan(salted) and "BroadcastHashJoin" not in plan(salted)
    assert sorted(rows(salted), key=str) == sorted(rows(facts.join(lookup, "k", how)), key=str)


def test_without_hot_keys_nothing_is_salted(spark, lookup, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    even = spark.range(10_000).select(F.pmod(F.col("id"), F.lit(1000)).alias("k"), "id")
    assert "_salt" not in plan(lookup_join(even, lookup, "k", ["id"], max_broadcast_bytes=-1))


def test_null_keys_are_spread_in_a_left_join(facts, lookup, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    joined = lookup_join(facts, lookup, "k", ["id"], "left", max_broadcast_bytes=-1)
    nulls = joined.where("k IS NULL").groupBy(F.spark_partition_id()).count()
    assert nulls.count() == 8


def test_only_hot_lookup_rows_are_copied(facts, lookup):
    df = lookup_join(facts.where("k = 1 OR id % 1000 = 3"), lookup, "k", ["id"], max_broadcast_bytes=-1)
    assert "MERGE" in plan(df, "extended").upper()
    assert df.where("k = 1").count() == facts.where("k = 1").count()


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_exact_copies_are_split_while_running(spark, conf, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1000")
    one = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id"))
    facts = spark.range(0, 400_000, 1, 8).select(one.alias("k"), F.when(F.col("id") % 2 == 1, F.col("id")).alias("v"))
    lookup = spark.range(1, 400_000, 3).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    df = shuffle_join(facts, lookup, "k", facts.columns, how)
    plain = facts.join(lookup, "k", how).groupBy((F.col("k") == 7).alias("hot")).count()
    df.collect()
    assert "skew=true" in plan(df, "simple")
    assert set(rows(df.groupBy((F.col("k") == 7).alias("hot")).count())) == set(rows(plain))


def test_lookup_join_measures_before_it_broadcasts(facts, lookup, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" in plan(lookup_join(facts, lookup, "k", ["id"]))
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, "k", ["id"], "full")


def test_fits_broadcast_counts_text(spark):
    text = spark.range(100).select(F.repeat(F.lit("é"), 1000).alias("t"))
    assert fits_broadcast(text, 100 * (16 + 2000))
    assert not fits_broadcast(text, 100 * (16 + 2000) - 1)
    assert fits_broadcast(text.limit(0), 0)
    with pytest.raises(ValueError):
        fits_broadcast(spark.range(1).select(F.array("id")))


def test_month_report_without_broadcast_salts_and_sorts_by_a_total_order(credit, customer, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(reports.transactions_by_zip_month(credit, customer, 39120, 2018, 2, max_broadcast_bytes=-1))
    assert "_salt" in text and "BroadcastHashJoin" not in text
    assert "rangepartitioning(TIMEID" in text and "TRANSACTION_ID" in text.split("rangepartitioning")[1][:80]


@pytest.mark.parametrize("few", [True, False])
def test_branch_totals_aggregates_before_it_joins(branch, credit, conf, monkeypatch, few):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(reports, "fits_broadcast", lambda df: few)
    typed = credit.withColumn("BRANCH_CODE", F.col("BRANCH_CODE").cast("int"))
    df = reports.branch_totals(branch, typed, "NY")
    text = plan(df, "simple")
    join = text.index("SortMergeJoin")
    assert text.index("HashAggregate", join) < text.index("Exchange", join)
    assert text.count("Exchange hashpartitioning") == 2
    assert ("LeftSemi, BuildRight" in text) == few
    assert sorted(rows(df)) == [(7, 0, None), (114, 3, 195.33)]


def test_top_k_keeps_k_rows_per_task(credit):
    for df in (insights.top_customers(credit), insights.top_branches(credit)):
        assert "TakeOrderedAndProject" in plan(df)


def test_shares_and_leaders_use_no_single_task_window(credit):
    groups = insights.count_by(credit, "CUST_SSN")
    for df in (with_share(groups), with_top_flag(groups, "COUNT", 3)):
        df.collect()
        text = plan(df, "simple")
        assert "Window" not in text
        assert "ReusedExchange" in text


@pytest.mark.parametrize("name", list(entry_points.library_queries()))
def test_every_query_stays_in_spark(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow", "Window"):
        assert unwanted not in text, unwanted


def test_a_key_of_a_few_thousandths_is_spread_where_partitions_are_many(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "1000")
    many = spark.range(200_000).selectExpr("id", "IF(id % 1000 < 3, -1L, id) AS k")  # 0.3 % of the rows
    assert hot_keys(many, "k") == [-1]
    names = many.selectExpr("k").distinct().where("k < 2000").selectExpr("k", "k AS name")
    joined = shuffle_join(many, names, "k", ["id"])
    tasks = joined.where("k = -1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in tasks) == 600
    assert len(tasks) > 100
    conf("spark.sql.shuffle.partitions", "8")
    assert hot_keys(many, "k") == []
