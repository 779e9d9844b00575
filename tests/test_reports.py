import pytest

from cardlens.plans import reports
from conftest import rows

CARD = "4210653310061055"


def test_transactions_by_zip_month(credit, customer):
    df = reports.transactions_by_zip_month(credit, customer, "39120", "2018", "02")
    assert df.columns == ["CUST_SSN", "CUST_CC_NO", "CUST_ZIP", "TIMEID", "TRANSACTION_VALUE"]
    assert rows(df) == [
        (123456100, CARD, 39120, "20180228", 59.73), (123456100, CARD, 39120, "20180208", 56.70),
    ]
    assert rows(reports.transactions_by_zip_month(credit, customer, "07501", 2018, 3))[0][3] == "20180320"


def test_transactions_by_zip_month_is_the_same_without_broadcast(credit, customer):
    broadcast = reports.transactions_by_zip_month(credit, customer, 39120, 2018, 2)
    salted = reports.transactions_by_zip_month(credit, customer, 39120, 2018, 2, max_broadcast_bytes=-1)
    assert rows(broadcast) == rows(salted)


def test_type_totals(credit):
    assert rows(reports.type_totals(credit, "Healthcare")) == [("Healthcare", 2, 63.32)]
    assert rows(reports.type_totals(credit, "healthcare")) == []
    assert rows(reports.type_totals(credit, "x' OR '1'='1")) == []


def test_branch_totals(branch, credit):
    assert sorted(rows(reports.branch_totals(branch, credit, "NY"))) == [(7, 0, None), (114, 3, 195.33)]
    kept = reports.branch_totals(branch, credit, "NY", count_preserved=True)
    assert sorted(rows(kept)) == [(7, 1, None), (114, 3, 195.33)]


def test_branch_totals_of_repeated_and_null_branches(spark, branch, credit):
    more = branch.unionByName(
        spark.createDataFrame([(114, "NY"), (None, "NY"), (7, "NY")], branch.schema)
    )
    kept = reports.branch_totals(more, credit, "NY", count_preserved=True)
    assert set(rows(kept)) == {(7, 2, None), (114, 6, 390.66), (None, 0, None)}
    plain = reports.branch_totals(more, credit, "NY")
    assert set(rows(plain)) == {(7, 0, None), (114, 6, 390.66), (None, 0, None)}


def test_customer_account(customer):
    by_ssn = reports.customer_account(customer, ssn="123456100")
    assert by_ssn.columns == customer.columns
    assert rows(by_ssn) == rows(reports.customer_account(customer, card=CARD))
    assert rows(reports.customer_account(customer, ssn=1)) == []
    for wrong in ({}, {"ssn": 1, "card": "1"}):
        with pytest.raises(ValueError):
            reports.customer_account(customer, **wrong)


def test_monthly_bill(credit):
    assert rows(reports.monthly_bill(credit, CARD, 2018, "02")) == [(CARD, 116.43)]
    assert rows(reports.monthly_bill(credit, CARD, 2018, "03")) == []
    assert sorted(rows(reports.monthly_bill(credit, None, 2018, 2))) == [(CARD, 116.43), ("4210653349028689", 78.9)]


def test_transactions_between(credit):
    ids = [r[-1] for r in rows(reports.transactions_between(credit, CARD, "20180208", "20180301"))]
    assert ids == [4, 3]
    assert reports.transactions_between(credit, CARD, "2018", "2019").columns == credit.columns
    assert rows(reports.transactions_between(credit, CARD, "20180301", "20180208")) == []
