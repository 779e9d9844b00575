"""The stored monthly rollup against reports on all transactions, and what a refresh reads."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardlens.functions import merged_limbs, money_limbs, money_of_limbs, money_sum
from cardlens.plans import insights, reports, rollup
from cardlens.schemas import CREDIT
from cardlens.sources import month_counts, read_table, write_table
from conftest import plan, rows
from test_brute_force import Data


@pytest.fixture
def stored(spark, tmp_path):
    data = Data(spark, 11)
    path = str(tmp_path / "credit")
    write_table(data.credit, path, CREDIT.month_of)
    return data, path, str(tmp_path / "rollup")


def credit_of(spark, path):
    return read_table(spark, path, CREDIT)


def compare(spark, path, rolled, branch):
    credit, stored = credit_of(spark, path), rollup.read_rollup(spark, rolled)
    for kind in ("Bills", "Healthcare", "nothing"):
        assert rows(rollup.rolled_type_totals(stored, kind)) == rows(reports.type_totals(credit, kind))
        assert rows(rollup.rolled_top_branches(stored, kind, 5)) == rows(insights.top_branches(credit, kind, 5))
    once = branch.dropDuplicates()
    for state in ("NY", "PA", "none"):
        assert sorted(rows(rollup.rolled_branch_totals(once, stored, state))) == sorted(rows(reports.branch_totals(once, credit, state)))
    assert rows(rollup.rolled_volume_by_month(stored)) == rows(insights.volume_by_month(credit))


def test_rolled_reports_equal_scans(spark, stored):
    data, path, rolled = stored
    assert rollup.read_rollup(spark, rolled) is None
    written = rollup.refresh_rollup(credit_of(spark, path), rolled)
    assert set(written) == {r[1] and r[1][:6] for r in data.credit_rows} and None in written
    compare(spark, path, rolled, data.branch)


def test_only_changed_months_are_read_and_written(spark, stored):
    data, path, rolled = stored
    rollup.refresh_rollup(credit_of(spark, path), rolled)
    assert rollup.refresh_rollup(credit_of(spark, path), rolled) == []
    before = {p: p.stat().st_mtime_ns for p in Path(rolled).rglob("*.parquet")}
    extra = data.credit.limit(40).withColumn("TIMEID", F.lit("20180315")).withColumn("ym", F.lit("201803"))
    extra.write.mode("append").partitionBy("ym").parquet(path)
    credit = credit_of(spark, path)
    assert rollup.changed_months(credit, rolled) == (["201803"], [])
    scanned = rollup._partials(credit.where(rollup.among(["201803"])))
    assert {r["ym"] for r in scanned.collect()} == {"201803"}
    scan = plan(scanned).split("Scan parquet")[-1]
    assert "PartitionFilters" in scan and "201803" in scan.split("PartitionFilters")[1][:80]
    assert rollup.refresh_rollup(credit, rolled) == ["201803"]
    after = {p: p.stat().st_mtime_ns for p in Path(rolled).rglob("*.parquet")}
    assert {p.parent.name for p in set(before) ^ set(after)} == {"ym=201803"}
    assert all(after[p] == before[p] for p in set(before) & set(after))
    compare(spark, path, rolled, data.branch)


def test_a_refresh_needs_the_files_of_the_changed_month_only(spark, stored):
    """What other months hold may even be no Parquet any more: their names, sizes and times are as they were."""
    import os

    data, path, rolled = stored
    rollup.refresh_rollup(credit_of(spark, path), rolled)
    before = sorted(rows(rollup.read_rollup(spark, rolled).where("ym <> '201805'")), key=str)
    data.credit.limit(9).withColumn("ym", F.lit("201805")).write.mode("append").partitionBy("ym").parquet(path)
    credit = credit_of(spark, path)
    marks = rollup._months(credit).collect()
    assert len({r["files"] for r in marks}) == len(marks)
    for file in Path(path).glob("ym=201705/part*"):
        at, size = os.stat(file).st_mtime_ns, file.stat().st_size
        os.truncate(file, size - 12)
        with open(file, "ab") as out:
            out.write(b"x" * 4 + b"\0" * 4 + b"PAR1")
        os.utime(file, ns=(at, at))
    changed = credit.where(rollup.among(["201805"]))
    assert rollup._partials(changed).count() > 0
    with pytest.raises(Exception):
        rollup._partials(credit).count()
    assert sorted(rows(rollup.read_rollup(spark, rolled).where("ym <> '201805'")), key=str) == before


def test_a_month_that_is_gone_counts_no_more(spark, stored):
    import shutil

    data, path, rolled = stored
    rollup.refresh_rollup(credit_of(spark, path), rolled)
    kept = str(Path(path).parent / "kept")
    shutil.copytree(path, kept, ignore=shutil.ignore_patterns("ym=201801"))
    written = rollup.refresh_rollup(credit_of(spark, kept), rolled)
    assert "201801" in written
    assert rollup.read_rollup(spark, rolled).where("ym = '201801'").isEmpty()
    compare(spark, kept, rolled, data.branch)
    # Other files of the same names are other files: all months were aggregated anew, once.
    assert rollup.refresh_rollup(credit_of(spark, kept), rolled) == []


def test_limbs_can_be_added_in_any_parts(spark):
    rng = random.Random(2)
    values = [rng.choice([1, -1]) * rng.choice([0.005, 1e-7, 123.45, 2.0**40 + 0.25, 2.0**59, 7.0]) for _ in range(600)] + [None, 0.0, -0.0]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "part int, v double")
    whole = df.agg(money_sum(F.col("v")).alias("t")).first()["t"]
    limbs = money_limbs(F.col("v"))
    parts = df.groupBy("part").agg(*(c.alias(f"p_{n}") for n, c in limbs.items()))
    assert parts.agg(money_of_limbs(merged_limbs("p_")).alias("t")).first()["t"] == whole
    odd = df.unionByName(spark.createDataFrame([(1, float("inf"))], "part int, v double"))
    parts = odd.groupBy("part").agg(*(c.alias(n) for n, c in money_limbs(F.col("v")).items()))
    assert parts.agg(money_of_limbs(merged_limbs()).alias("t")).first()["t"] == float("inf")


def test_counts_come_from_footers(spark, stored):
    data, path, _ = stored
    counts = month_counts(spark, path)
    text = plan(counts)
    assert "PushedAggregation: [COUNT(*)]" in text and "PushedGroupBy: [ym]" in text
    expected = credit_of(spark, path).groupBy("ym").count()
    assert sorted(rows(counts), key=str) == sorted(rows(expected), key=str)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
