import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cardlens.functions import (
    cap_first, date_key, fill_zip, format_phone, full_address, in_month, in_range, month_name, month_of,
)
from cardlens.functions.expressions import DEFAULT_ZIP
from conftest import rows


def values(spark, expression, kind, *inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_fill_zip(spark, ansi):
    assert values(spark, fill_zip, "long", None, 7501) == [DEFAULT_ZIP, 7501]
    typed = spark.range(1).select(fill_zip(F.col("id")).alias("z"))
    assert typed.schema["z"].dataType.simpleString() == "bigint"


def test_format_phone(spark, ansi):
    assert values(spark, format_phone, "string", "1234565276", "1234565", "12", "", None) == [
        "(123)456-5276", "(123)456-5", "(12)-", "()-", None,
    ]
    assert values(spark, format_phone, "long", 1237818) == ["(123)781-8"]


def test_cap_first(spark, ansi):
    assert values(spark, cap_first, "string", "alec", "a", "", "mary ann", "mcDonald", None) == [
        "Alec", "A", "", "Mary ann", "McDonald", None,
    ]


def test_full_address(spark, ansi):
    df = spark.createDataFrame([("Main", "1"), ("Main", None), (None, "1")], "s string, a string")
    assert [r[0] for r in df.select(full_address(F.col("s"), F.col("a"))).collect()] == ["Main, 1", None, None]
    number = spark.createDataFrame([("Main", 1)], "s string, a long")
    assert number.select(full_address(F.col("s"), F.col("a"))).first()[0] == "Main, 1"


@pytest.mark.parametrize("kind", ["long", "string", "int"])
def test_date_key(spark, ansi, kind):
    convert = str if kind == "string" else int
    data = [tuple(convert(v) for v in day) for day in [(2018, 2, 14), (2018, 12, 1), (2018, 11, 30)]]
    df = spark.createDataFrame(data, f"y {kind}, m {kind}, d {kind}")
    keys = df.select(date_key(F.col("y"), F.col("m"), F.col("d")))
    assert [r[0] for r in keys.collect()] == ["20180214", "20181201", "20181130"]


def test_date_key_takes_padded_strings_and_keeps_null(spark, ansi):
    df = spark.createDataFrame([("2018", "02", "4"), ("2018", None, "4")], "y string, m string, d string")
    keys = df.select(date_key(F.col("y"), F.col("m"), F.col("d")))
    assert [r[0] for r in keys.collect()] == ["20180204", None]


def test_month_name(spark, ansi):
    assert values(spark, month_name, "string", "01", "12", "13", "00", "x", "", None) == [
        "January", "December", None, None, None, None, None,
    ]
    assert values(spark, month_of, "string", "20180214", None) == ["02", None]


def test_range_and_month_predicates_agree_with_their_partition_form(spark):
    keys = ["20171231", "20180101", "20180115", "20180131", "20180201", "20181231", None]
    plain = spark.createDataFrame([(k,) for k in keys], "TIMEID string")
    stored = plain.withColumn("ym", F.substring("TIMEID", 1, 6))
    inferred = stored.withColumn("ym", F.col("ym").cast("int"))
    for bounds in [("20180101", "20180131"), ("201801", "20180201"), ("2018", "2019"), ("20180201", "20180101")]:
        expected = [(k,) for k in keys if k and bounds[0] <= k <= bounds[1]]
        assert rows(plain.where(in_range(plain, *bounds))) == expected
        assert rows(stored.where(in_range(stored, *bounds)).select("TIMEID")) == expected
        assert rows(inferred.where(in_range(inferred, *bounds)).select("TIMEID")) == expected
    expected = [(k,) for k in keys if k and k[:6] == "201801"]
    assert rows(plain.where(in_month(plain, "201801"))) == expected
    assert rows(stored.where(in_month(stored, "201801")).select("TIMEID")) == expected


digits = st.text(alphabet="0123456789", max_size=14)
words = st.text(alphabet="abzÄé Zß'-9", max_size=12)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(digits, words), min_size=1, max_size=30))
def test_text_expressions_equal_slicing(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, d string, w string")
    got = df.select("i", format_phone(F.col("d")), cap_first(F.col("w")), full_address(F.col("w"), F.col("d")))
    expected = [
        (i, f"({d[:3]}){d[3:6]}-{d[6:]}", w[:1].upper() + w[1:], f"{w}, {d}") for i, (d, w) in enumerate(pairs)
    ]
    assert sorted(rows(got)) == expected


@settings(max_examples=20, deadline=None)
@given(st.lists(st.dates(datetime.date(1000, 1, 1)), min_size=1, max_size=30), st.booleans(), st.booleans())
def test_date_keys_equal_strftime(spark, days, text, padded):
    def part(n, width):
        return str(n).zfill(width) if padded and text else str(n) if text else n

    kind = "string" if text else "int"
    data = [(part(d.year, 4), part(d.month, 2), part(d.day, 2)) for d in days]
    df = spark.createDataFrame(data, f"y {kind}, m {kind}, d {kind}")
    keys = [r[0] for r in df.select(date_key(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert keys == [d.isoformat().replace("-", "") for d in days]
