from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cardlens.functions import money_sum


def exact(amounts: list[float]) -> float:
    total = sum((Decimal(repr(a)) for a in amounts), Decimal(0))
    return float(total.quantize(Decimal("0.01"), ROUND_HALF_UP))


def total(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "v double").repartition(3)
    return df.agg(money_sum(F.col("v"))).first()[0]


cents = st.integers(-10**9, 10**9).map(lambda n: n / 100)


@settings(max_examples=25, deadline=None)
@given(st.lists(cents, min_size=1, max_size=200))
def test_equals_decimal_sum(spark, amounts):
    assert total(spark, amounts) == exact(amounts)


def test_rounds_half_up(spark, ansi):
    assert total(spark, [1.005]) == 1.01
    assert total(spark, [2.675]) == 2.68
    assert total(spark, [-1.005]) == -1.01


def test_does_not_drift(spark):
    df = spark.range(1_000_000).select(F.lit(0.1).alias("v"), (F.col("id") * 0 + 90_000_000.01).alias("w"))
    assert df.agg(money_sum(F.col("v")), money_sum(F.col("w"))).first() == (100_000.0, 90_000_000_010_000.0)


def test_nulls_and_odd_values(spark, ansi):
    assert total(spark, [None, None]) is None
    assert total(spark, [None, 1.5]) == 1.5
    assert str(total(spark, [1.0, float("nan")])) == "nan"
    assert total(spark, [1.0, float("inf")]) == float("inf")
    assert total(spark, [2.5e12, 0.25]) == 2.5e12 + 0.25
    for order in ([1e16, 1e9 + 0.25, -1e16], [1e16, -1e16, 1e9 + 0.25]):
        assert total(spark, order) == 1e9 + 0.25
    with pytest.raises(Exception, match="out of range"):
        total(spark, [1e300])


def test_ten_billion_large_rows_neither_wrap_nor_raise(spark, ansi):
    # Each limb of 10^10 rows near 1e9 stays below 10^10 * 2^20, and the whole is a decimal.
    df = spark.range(1000).select(F.lit(2.0**59).alias("v"))
    assert df.agg(money_sum(F.col("v"))).first()[0] == 1000 * 2.0**59
