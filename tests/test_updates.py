import random

import pytest
from pyspark.sql import functions as F

import cardlens.operators.joins as joins_module
import cardlens.operators.updates as updates_module
from cardlens.operators import apply_updates, unmatched_updates, update_conflicts
from cardlens.schemas import UPDATABLE
from conftest import plan, rows


@pytest.fixture(params=["broadcast", "shuffle"])
def size(request, monkeypatch, conf):
    if request.param == "shuffle":
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
        for module in (updates_module, joins_module):
            monkeypatch.setattr(module, "fits_broadcast", lambda *_: False)
    return request.param


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", "then"), (2, "b", "then")], "SSN int, name string, LAST_UPDATED string")


@pytest.fixture
def updates(spark):
    return spark.createDataFrame(
        [(2, 1, "X"), (2, 2, ""), (9, 1, "q"), (None, 1, "z")], "SSN int, seq int, name string"
    )


def test_last_update_of_a_key_wins(base, updates, size):
    result = apply_updates(base, updates, columns=["name"], as_of=F.lit("now"))
    assert result.columns == base.columns
    assert sorted(rows(result)) == [(1, "a", "then"), (2, "", "now")]
    assert ("BroadcastHashJoin" in plan(result)) == (size == "broadcast")


def test_updates_equal_a_sequence_of_single_updates(spark, size):
    rng = random.Random(5)
    accounts = [(n % 60 if n % 3 else 7, f"name {n}", "then") for n in range(300)] + [(None, "nobody", "then")]
    batch = [(rng.choice([7, None, *range(50, 90)]), n, rng.choice([None, "", f"new {n}"])) for n in range(200)]
    expected = list(accounts)
    for ssn, _, name in batch:
        expected = [(s, name, "now") if ssn is not None and s == ssn else (s, old, at) for s, old, at in expected]
    shuffled = rng.sample(batch, len(batch))
    base = spark.createDataFrame(accounts, "SSN int, name string, LAST_UPDATED string")
    updates = spark.createDataFrame(shuffled, "SSN int, seq int, name string")
    result = apply_updates(base, updates, columns=["name"], as_of=F.lit("now"))
    assert sorted(rows(result), key=str) == sorted(expected, key=str)
    known = {s for s, _, _ in accounts if s is not None}
    unmatched = [u for u in batch if u[0] not in known]
    assert sorted(rows(unmatched_updates(base, updates)), key=str) == sorted(unmatched, key=str)


def test_null_is_a_value(base, spark, size):
    updates = spark.createDataFrame([(1, 1, "x"), (1, 2, None)], "SSN int, seq int, name string")
    result = apply_updates(base, updates, columns=["name"], as_of=F.lit("now"))
    assert sorted(rows(result)) == [(1, None, "now"), (2, "b", "then")]


def test_unmatched(base, updates, size):
    assert sorted(rows(unmatched_updates(base, updates)), key=str) == [(9, 1, "q"), (None, 1, "z")]


def test_conflicts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (3, None)], "SSN int, seq int")
    assert sorted(rows(update_conflicts(df, "SSN", "seq")), key=str) == [(1, 1, 2), (3, None, 1)]


def test_account_columns(customer, spark):
    row = (123456100, 1, "New", "m", "Name", "Elm, 1", "Natchez", "MS", "United States", "39121", "(1)2-3", "n@e.com")
    updates = spark.createDataFrame([row], ["SSN", "seq", *UPDATABLE])
    changed = {r["SSN"]: r for r in apply_updates(customer, updates).collect()}
    assert changed[123456100]["CUST_ZIP"] == 39121
    assert changed[123456100]["FIRST_NAME"] == "New"
    assert changed[123456100]["CREDIT_CARD_NO"] == "4210653310061055"
    before = {r["SSN"]: r for r in customer.collect()}
    assert changed[123456100]["LAST_UPDATED"] > before[123456100]["LAST_UPDATED"]
    assert changed[123459988] == before[123459988]


def test_ties_and_values_that_do_not_fit_are_refused(base, spark, size, ansi):
    tied = spark.createDataFrame([(1, 1, "x"), (1, 1, "y")], "SSN int, seq int, name string")
    with pytest.raises(Exception, match="without an order"):
        apply_updates(base, tied, columns=["name"], as_of=F.lit("now")).collect()
    typed = base.withColumn("name", F.lit(5))
    bad = spark.createDataFrame([(1, 1, "n/a")], "SSN int, seq int, name string")
    with pytest.raises(Exception, match="cannot be"):
        apply_updates(typed, bad, columns=["name"], as_of=F.lit("now")).collect()


def test_update_violations(spark):
    from cardlens.operators import update_violations

    df = spark.createDataFrame([(1, "x" * 51, "n/a"), (2, "ok", "07501")], "SSN int, FIRST_NAME string, CUST_ZIP string")
    found = rows(update_violations(df, columns=["FIRST_NAME", "CUST_ZIP"]))
    assert sorted(found) == [(1, "CUST_ZIP", "n/a", "type"), (1, "FIRST_NAME", "x" * 51, "length")]


def test_columns_named_like_those_an_update_adds(spark, size):
    base = spark.createDataFrame([(1, "a", "b", "c"), (2, "d", "e", "f")], "SSN int, _n string, _update string, _salt string")
    updates = spark.createDataFrame([(2, 1, "x", "y"), (2, 2, "z", None)], "SSN int, seq int, _n string, _update string")
    result = apply_updates(base, updates, columns=["_n", "_update"], stamp=None)
    assert result.columns == base.columns
    assert sorted(rows(result)) == [(1, "a", "b", "c"), (2, "z", None, "f")]
