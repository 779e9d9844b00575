from __future__ import annotations

import contextlib
import io
import os
import sys

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardlens.session import CHECKPOINT_DIR, builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        builder("tests").master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config(CHECKPOINT_DIR, str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=[True, False], ids=["ansi", "not-ansi"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param).lower())
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def plan(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


# --- Hand-made tables ---


@pytest.fixture(scope="session")
def raw_credit(spark):
    return spark.createDataFrame(
        [
            ("4210653349028689", 2018, 2, 14, 123459988, 114, "Education", 78.90, 1),
            ("4210653349028689", 2018, 3, 20, 123459988, 35, "Entertainment", 14.24, 2),
            ("4210653310061055", 2018, 2, 8, 123456100, 114, "Bills", 56.70, 3),
            ("4210653310061055", 2018, 2, 28, 123456100, 114, "Healthcare", 59.73, 4),
            ("4210653310061055", 2018, 12, 1, 123456100, 35, "Healthcare", 3.59, 5),
        ],
        "CREDIT_CARD_NO string, YEAR long, MONTH long, DAY long, CUST_SSN long, BRANCH_CODE long, "
        "TRANSACTION_TYPE string, TRANSACTION_VALUE double, TRANSACTION_ID long",
    )


@pytest.fixture(scope="session")
def credit(raw_credit):
    from cardlens.operators import clean_credit

    return clean_credit(raw_credit)


@pytest.fixture(scope="session")
def branch(spark):
    return spark.createDataFrame(
        [(114, "NY"), (35, "NJ"), (7, "NY")], "BRANCH_CODE int, BRANCH_STATE string"
    )


@pytest.fixture(scope="session")
def raw_customer(spark):
    return spark.createDataFrame(
        [
            (123456100, "alec", "WM", "hooper", "4210653310061055", "Main Street North", "656", "Natchez", "MS",
             "United States", "39120", "1237818", "AHooper@example.com", "2018-04-21T12:49:02.000-04:00"),
            (123459988, "mary ann", None, "mcDonald", "4210653349028689", "Elm", None, "Paterson", "NJ",
             "United States", "07501", "1234565276", "mm@example.com", "2018-04-21T12:49:02.000-04:00"),
        ],
        "SSN long, FIRST_NAME string, MIDDLE_NAME string, LAST_NAME string, CREDIT_CARD_NO string, "
        "STREET_NAME string, APT_NO string, CUST_CITY string, CUST_STATE string, CUST_COUNTRY string, "
        "CUST_ZIP string, CUST_PHONE string, CUST_EMAIL string, LAST_UPDATED string",
    )


@pytest.fixture(scope="session")
def customer(raw_customer):
    from cardlens.operators import apply_schema, clean_customer
    from cardlens.schemas import CUSTOMER

    return apply_schema(clean_customer(raw_customer), CUSTOMER)


@pytest.fixture(scope="session")
def loan(spark):
    return spark.createDataFrame(
        [
            ("Y", "Yes", "Male", "No"), ("Y", "No", "Male", "Yes"), ("N", "No", "Male", "Yes"),
            ("N", "No", "Female", "Yes"), ("N", "No", "Male", "No"), ("N", "No", None, "Yes"),
            ("N", "No", "Male", None), ("Y", None, "Male", "Yes"),
        ],
        "Application_Status string, Self_Employed string, Gender string, Married string",
    )
