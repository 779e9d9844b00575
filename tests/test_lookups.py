"""Look-ups by Bloom filter, pruned top-k, and charts from one scan."""

import random

import pytest
from pyspark.sql import functions as F

import cardlens.operators.aggregates as aggregates
from cardlens.operators import top_by_sum, top_by_sum_pruned
from cardlens.plans import insights, reports
from cardlens.plans.loading import load_table
from cardlens.sources import read_table, write_table
from conftest import plan, rows


def rows_scanned(df):
    """What the scan of an executed plan has handed on: the rows of the row groups it did not skip."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    node = node.executedPlan() if "AdaptiveSparkPlan" in node.nodeName() else node
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("filters", [True, False])
def test_row_groups_without_the_card_are_skipped(spark, tmp_path, conf, filters):
    conf("spark.sql.parquet.enableVectorizedReader", "true")
    conf("parquet.block.size", "200000")
    card = F.sha2(F.col("id").cast("string"), 256)
    accounts = spark.range(0, 60_000, 1, 1).select(F.col("id").cast("int").alias("SSN"), card.alias("CREDIT_CARD_NO"))
    write_table(accounts, str(tmp_path / "t"), None, ["SSN"], ["CREDIT_CARD_NO"] if filters else [])
    stored = read_table(spark, str(tmp_path / "t"))
    wanted = accounts.where("SSN = 41000").first()["CREDIT_CARD_NO"]
    found = stored.where(F.col("CREDIT_CARD_NO") == wanted)
    assert [r["SSN"] for r in found.collect()] == [41000]
    assert (rows_scanned(found) < 20_000) == filters
    absent = stored.where(F.col("CREDIT_CARD_NO") == wanted[::-1])
    assert absent.count() == 0


def test_loaded_accounts_are_found_by_card(spark, raw_customer, tmp_path):
    table = load_table(spark, "customer", raw_customer, str(tmp_path / "c"))
    assert rows(reports.customer_account(table, card="4210653310061055").select("SSN")) == [(123456100,)]


def adversarial(spark, seed):
    """Keys whose totals hide: small parts everywhere, large values that cancel, ties, nulls, no values at all."""
    rng = random.Random(seed)
    data = []
    for key in range(400):
        data += [(key, rng.randint(-100, 100) / 100) for _ in range(rng.randint(1, 6))]
    data += [(1000 + k, 50.0) for k in range(12) for _ in range(40)]  # the first, spread thin, all tied
    data += [(2000 + k, v) for k in range(30) for v in (1e6, -1e6, rng.random())]  # large parts, small totals
    data += [(None, 30.0)] * 50 + [(3000 + k, None) for k in range(20)] + [(3500, -9e5)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k int, v double").repartition(6)


@pytest.mark.parametrize("seed, slots, k", [(1, 1 << 16, 10), (2, 64, 5), (3, 1 << 16, 1), (4, 4096, 12), (5, 1, 7), (6, 1 << 16, 600)])
def test_pruned_top_equals_top(spark, seed, slots, k):
    df = adversarial(spark, seed)
    assert rows(top_by_sum_pruned(df, "k", "v", k, "t", slots=slots)) == rows(top_by_sum(df, "k", "v", k, "t"))
    where = F.col("v") < 40
    assert rows(top_by_sum_pruned(df, "k", "v", k, "t", where, slots)) == rows(top_by_sum(df, "k", "v", k, "t", where))


def test_pruned_top_with_nan_infinities_and_nothing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, -float("inf")), (4, 5.0), (5, -1.0), (6, None)], "k int, v double")
    for k in range(1, 8):
        assert str(rows(top_by_sum_pruned(df, "k", "v", k, "t"))) == str(rows(top_by_sum(df, "k", "v", k, "t")))
    assert rows(top_by_sum_pruned(df.limit(0), "k", "v", 3, "t")) == []
    negative = spark.createDataFrame([(k, -float(k)) for k in range(50)], "k int, v double")
    assert rows(top_by_sum_pruned(negative, "k", "v", 4, "t")) == rows(top_by_sum(negative, "k", "v", 4, "t"))


def test_few_keys_are_shuffled(spark):
    """Of 50,000 keys those of the slots that reach the tenth total, and no others."""
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("k"), F.lit(1.0).alias("v"))
    df = df.unionByName(spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 100.0 + 5000).alias("v")))
    chosen = aggregates.surviving_slots(df, "k", "v", 10, 1 << 16)
    survivors = aggregates.in_slots(df, "k", chosen, 1 << 16).select("k").distinct().count()
    assert 10 <= survivors < 100
    text = plan(top_by_sum_pruned(df, "k", "v", 10, "t"), "simple")
    assert "LeftSemi" in text and text.index("LeftSemi") > text.index("hashpartitioning(k")
    assert rows(top_by_sum_pruned(df, "k", "v", 10, "t")) == rows(top_by_sum(df, "k", "v", 10, "t"))


@pytest.fixture
def wide_loan(spark):
    rng = random.Random(4)
    answers = [["Y", "N", None, "?"], ["Yes", "No", None], ["Male", "Female", None], ["Yes", "No", None]]
    data = [tuple(rng.choice(a) for a in answers) for _ in range(700)]
    return spark.createDataFrame(data, "Application_Status string, Self_Employed string, Gender string, Married string")


@pytest.mark.parametrize("empty", [False, True])
def test_each_chart_equals_its_query(wide_loan, loan, empty):
    for given in (wide_loan.limit(0),) if empty else (wide_loan, loan):
        charts = insights.loan_charts(given)

        def chart(name, *columns):
            return sorted(rows(charts.where(F.col("chart") == name).select("slice", *columns)), key=str)

        married = F.col("Married") == "Yes"
        assert chart("status", "COUNT", "share") == sorted(rows(insights.status_counts(given)), key=str)
        assert chart("approved by employment", "COUNT") == sorted(rows(insights.approved_by(given)), key=str)
        assert chart("rejected by marriage", "COUNT") == sorted(rows(insights.rejected_by(given)), key=str)
        assert chart("married and rejected by gender", "COUNT") == sorted(rows(insights.rejected_by(given, "Gender", married)), key=str)
        for name, expected in (
            ("approval", insights.approval_composition(given)), ("approval of approved", insights.approved_composition(given)),
            ("rejection", insights.rejection_composition(given)), ("rejection of rejected", insights.rejection_composition(given, False)),
        ):
            assert chart(name, "COUNT", "share") == sorted(rows(expected), key=str)


def test_charts_read_the_table_once(spark, wide_loan, tmp_path):
    wide_loan.write.parquet(str(tmp_path / "loan"))
    charts = insights.loan_charts(spark.read.parquet(str(tmp_path / "loan")))
    charts.collect()
    final = plan(charts, "simple").split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
