import pytest
from pyspark.sql import functions as F

from cardlens import operators as op
from cardlens.plans import insights
from conftest import rows


def test_transactions_by_type(credit):
    assert rows(insights.transactions_by_type(credit)) == [
        ("Healthcare", 2, True), ("Bills", 1, False), ("Education", 1, False), ("Entertainment", 1, False),
    ]


def test_null_group_counts_zero_and_never_leads(spark):
    df = spark.createDataFrame([("NY",), (None,), (None,)], "CUST_STATE string")
    assert rows(insights.customers_by_state(df)) == [("NY", 1, True), (None, 0, False)]


def test_top_customers(credit):
    assert rows(insights.top_customers(credit)) == [(123456100, 120.02), (123459988, 93.14)]
    assert rows(insights.top_customers(credit, 1)) == [(123456100, 120.02)]


def test_ties_are_cut_by_key(spark):
    df = spark.createDataFrame([(n, 1.0) for n in range(30, 0, -1)], "CUST_SSN int, TRANSACTION_VALUE double")
    assert [r[0] for r in rows(insights.top_customers(df))] == list(range(1, 11))


def test_top_branches(credit):
    assert rows(insights.top_branches(credit)) == [(114, 59.73), (35, 3.59)]


def test_volume_by_month(credit):
    assert rows(insights.volume_by_month(credit)) == [
        ("02", 3, "February", True), ("03", 1, "March", True), ("12", 1, "December", True),
    ]
    assert [r[3] for r in rows(insights.volume_by_month(credit, leaders=1))] == [True, False, False]


@pytest.mark.parametrize("k", [1, 2, 3, 5, 50])
def test_top_flag_equals_dense_rank(spark, k):
    df = spark.range(40).select("id", F.when(F.col("id") < 35, F.col("id") % 7).alias("v"))
    df.createOrReplaceTempView("flagged")
    ranked = spark.sql(f"""
        SELECT id, v, v IS NOT NULL AND DENSE_RANK() OVER (ORDER BY v DESC NULLS LAST) <= {k} AS is_top
        FROM flagged""")
    assert set(rows(op.with_top_flag(df, "v", k))) == set(rows(ranked))


def test_share_of_nothing_is_null(spark, ansi):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, COUNT long")
    assert {r[2] for r in rows(op.with_share(df))} == {None}


def test_loan_counts(loan):
    counts = {r[0]: (r[1], r[2]) for r in rows(insights.status_counts(loan))}
    assert counts == {"N": (5, 0.625), "Y": (3, 0.375)}
    assert dict(rows(insights.approved_by(loan))) == {"Yes": 1, "No": 1, None: 0}
    married = F.col("Married") == "Yes"
    assert dict(rows(insights.rejected_by(loan, "Gender", married))) == {"Female": 1, "Male": 1, None: 0}


def test_approval_compositions(loan):
    assert dict((r[0], r[1]) for r in rows(insights.approval_composition(loan))) == {
        "No Approved": 5, "Approved Self-Employed": 1, "Approved Others": 1,
    }
    assert set(rows(insights.approved_composition(loan))) == {
        ("Approved Self-Employed", 1, 0.5), ("Approved Others", 1, 0.5),
    }
    assert rows(op.unclassified(loan, insights.approval_slice())) == [(1,)]


def test_rejection_compositions(loan):
    parts = {r[0]: (r[1], round(100 * r[2], 1)) for r in rows(insights.rejection_composition(loan))}
    assert parts == {
        "Approved": (3, 50.0),
        "No Approved, No Married": (1, 16.7),
        "No Approved, Yes Married, Female": (1, 16.7),
        "No Approved, Yes Married, Male": (1, 16.7),
    }
    alone = {r[0]: r[1] for r in rows(insights.rejection_composition(loan, with_approved=False))}
    assert alone == {k: 1 for k in parts if k != "Approved"}
    assert rows(op.unclassified(loan, insights.rejection_slice())) == [(2,)]
