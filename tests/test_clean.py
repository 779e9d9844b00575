import pytest

from cardlens.operators import clean, clean_branch, clean_credit, clean_customer
from conftest import rows


def test_branch(spark, ansi):
    raw = spark.createDataFrame(
        [(7, "Example Bank", "Jefferson Street", "Paterson", "NJ", None, "1234144890", "t")],
        "BRANCH_CODE long, BRANCH_NAME string, BRANCH_STREET string, BRANCH_CITY string, "
        "BRANCH_STATE string, BRANCH_ZIP long, BRANCH_PHONE string, LAST_UPDATED string",
    )
    assert rows(clean_branch(raw)) == [
        (7, "Example Bank", "Jefferson Street", "Paterson", "NJ", 99999, "(123)414-4890", "t")
    ]


def test_credit(raw_credit, ansi):
    cleaned = clean_credit(raw_credit)
    assert cleaned.columns == [
        "CUST_CC_NO", "TIMEID", "CUST_SSN", "BRANCH_CODE", "TRANSACTION_TYPE", "TRANSACTION_VALUE", "TRANSACTION_ID",
    ]
    assert [r[1] for r in rows(cleaned.orderBy("TRANSACTION_ID"))] == [
        "20180214", "20180320", "20180208", "20180228", "20181201",
    ]


def test_customer(raw_customer, ansi):
    first, second = rows(clean_customer(raw_customer).orderBy("SSN"))
    assert first[:6] == (123456100, "Alec", "wm", "Hooper", "4210653310061055", "Main Street North, 656")
    assert first[9:11] == ("39120", "(123)781-8")
    assert second[1:6] == ("Mary ann", None, "McDonald", "4210653349028689", None)


def test_dispatch(raw_credit, loan):
    assert rows(clean("credit", raw_credit)) == rows(clean_credit(raw_credit))
    assert clean("loan", loan) is loan
    with pytest.raises(ValueError, match="unknown dataset"):
        clean("other", loan)
