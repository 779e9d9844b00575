import datetime

from cardlens.operators import apply_schema, cast_violations, clean_customer, key_violations, length_violations
from cardlens.schemas import CREDIT, CUSTOMER, TableSchema
from conftest import rows


def test_apply_schema(raw_customer, ansi):
    typed = apply_schema(clean_customer(raw_customer), CUSTOMER)
    assert [f.dataType.simpleString() for f in typed.schema.fields] == [
        "int", "string", "string", "string", "string", "string", "string", "string", "string", "int", "string",
        "string", "timestamp",
    ]
    assert sorted(r["CUST_ZIP"] for r in typed.collect()) == [7501, 39120]
    stamp = typed.selectExpr("CAST(LAST_UPDATED AS STRING)").first()[0]
    assert stamp == str(datetime.datetime(2018, 4, 21, 16, 49, 2))


def test_values_that_do_not_fit(spark, ansi):
    table = TableSchema("t", {"a": "INTEGER", "b": "INTEGER", "c": "DOUBLE", "d": "TIMESTAMP"})
    df = spark.createDataFrame(
        [
            (1, 2**31 - 1, "7501", "1.5", "2018-04-18T16:51:47.000-04:00"),
            (2, 2**31, "abc", "x", "never"),
            (3, -(2**31) - 1, None, None, None),
            (4, None, "99999999999", "2", "2018-04-18"),
        ],
        "id int, a long, b string, c string, d string",
    )
    typed = apply_schema(df, table)
    assert [r[:3] for r in rows(typed)] == [
        (2**31 - 1, 7501, 1.5), (None, None, None), (None, None, None), (None, None, 2.0),
    ]
    assert sorted(rows(cast_violations(df, table, ["id"]))) == [
        (2, "a", "2147483648"), (2, "b", "abc"), (2, "c", "x"), (2, "d", "never"),
        (3, "a", "-2147483649"), (4, "b", "99999999999"),
    ]


def test_length_violations(spark):
    df = spark.createDataFrame([(1, "x" * 51, "y" * 60), (2, "x" * 50, None)], "id int, a string, b string")
    assert rows(length_violations(df, {"a": 50, "b": 50}, ["id"])) == [(1, "a", 51, 50), (1, "b", 60, 50)]
    assert set(CREDIT.limited) == {"CUST_CC_NO", "TIMEID", "TRANSACTION_TYPE"}


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert set(rows(key_violations(df, ["k"]))) == {(1, 2), (None, 1)}
    assert set(rows(key_violations(df, ["k", "v"]))) == {(None, "d", 1)}


def test_a_fraction_does_not_fit_an_integer(spark, ansi):
    table = TableSchema("t", {"a": "INTEGER", "b": "INTEGER"})
    df = spark.createDataFrame([(1, 3.7, "3.7"), (2, 4.0, "4")], "id int, a double, b string")
    assert rows(apply_schema(df, table)) == [(None, None), (4, 4)]
    assert sorted(rows(cast_violations(df, table, ["id"]))) == [(1, "a", "3.7"), (1, "b", "3.7")]
