"""Versioned tables: what is published, what a batch touches, and what stays as it is."""

import hashlib
import random
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

import cardlens.operators.joins as joins_module
from cardlens.operators import apply_updates
from cardlens.plans import reports, versions
from cardlens.plans.loading import LoadRejected
from cardlens.schemas import BRANCH, CREDIT, CUSTOMER, LOAN_TABLE, UPDATABLE
from cardlens.sources import Store, VersionConflict
from conftest import rows

VALUES = ["New", "m", "Name", "Elm, 1", "Natchez", "MS", "United States", "39121", "(1)2-3", "n@e.com"]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def many(raw_customer, spark):
    """A thousand customers, SSN 0 to 9990 in tens."""
    one = raw_customer.limit(1).drop("SSN")
    return spark.range(0, 10_000, 10).select(F.col("id").alias("SSN")).crossJoin(one)


@pytest.fixture
def loaded(store, many, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    versions.load_version(store, {"customer": many})
    return store


def updates_of(spark, keys):
    return spark.createDataFrame([(k, 1, *VALUES) for k in keys], ["SSN", "seq", *UPDATABLE])


def listed(store, version=None):
    return {r["file"]: (r["rows"], int(r["first_key"]), int(r["last_key"])) for r in store.files(CUSTOMER.name, version).collect()}


def content(files):
    return {f: hashlib.sha256(Path(unquote(urlparse(f).path)).read_bytes()).hexdigest() for f in files}


def test_files_hold_ranges_that_do_not_overlap(loaded):
    files = sorted(listed(loaded).values(), key=lambda f: f[1])
    assert len(files) == 8 and sum(f[0] for f in files) == 1000
    assert all(a[2] < b[1] for a, b in zip(files, files[1:]))


def test_an_update_writes_the_touched_files_only(spark, loaded):
    before, bytes_before = listed(loaded), content(listed(loaded))
    ends = sorted(f[1:] for f in before.values())
    keys = [ends[2][0], ends[2][1], ends[5][0], 5, 99_999]  # two files; 5 lies between keys, 99999 behind all
    number, unmatched = versions.update_version(loaded, updates_of(spark, keys), as_of=F.lit("2026-01-01").cast("timestamp"))
    assert number == 2 and sorted(r["SSN"] for r in unmatched.collect()) == [5, 99_999]
    after = listed(loaded)
    stay = set(before) & set(after)
    assert len(stay) == 6 and {before[f][1] for f in set(before) - stay} == {ends[2][0], ends[5][0]}
    assert content(stay) == {f: bytes_before[f] for f in stay}
    assert sum(f[0] for f in after.values()) == 1000
    # The new version is what updating the whole table gives, and the old one is still there.
    old = loaded.read(CUSTOMER.name, CUSTOMER, 1)
    whole = apply_updates(old, updates_of(spark, keys), as_of=F.lit("2026-01-01").cast("timestamp"))
    assert sorted(rows(loaded.read(CUSTOMER.name, CUSTOMER))) == sorted(rows(whole))
    assert old.where("CUST_ZIP = 39121").count() == 0
    assert spark.table(CUSTOMER.name).where("CUST_ZIP = 39121").count() == 3


def test_random_batches_equal_whole_updates(spark, loaded, conf, monkeypatch):
    rng = random.Random(8)
    expected = loaded.read(CUSTOMER.name, CUSTOMER)
    for turn in range(3):
        if turn == 2:  # a batch too large to broadcast
            conf("spark.sql.autoBroadcastJoinThreshold", "-1")
            for module in (versions, joins_module):
                monkeypatch.setattr(module, "fits_broadcast", lambda *_: False)
        batch = updates_of(spark, [rng.randrange(12_000) for _ in range(4)] + [rng.randrange(1000) * 10]).dropDuplicates(["SSN"])
        batch = batch.withColumn("FIRST_NAME", F.concat(F.lit(f"turn {turn} "), F.col("SSN").cast("string")))
        as_of = F.lit(f"2026-01-0{turn + 1}").cast("timestamp")
        expected = spark.createDataFrame(apply_updates(expected, batch, as_of=as_of).collect(), CUSTOMER.struct())
        versions.update_version(loaded, batch, as_of=as_of)
        assert sorted(rows(loaded.read(CUSTOMER.name, CUSTOMER))) == sorted(rows(expected))


def test_a_batch_that_matches_nobody_publishes_nothing(spark, loaded):
    number, unmatched = versions.update_version(loaded, updates_of(spark, [5, -7]))
    assert number == loaded.version() == 1 and unmatched.count() == 2
    nulls = updates_of(spark, [5]).withColumn("SSN", F.lit(None).cast("long"))
    with pytest.raises(LoadRejected):
        versions.update_version(loaded, nulls.withColumn("seq", F.lit(None).cast("int")))


def test_only_files_that_can_hold_a_key_are_read(spark, loaded):
    before = listed(loaded)
    ends = sorted((f[1:], name) for name, f in before.items())
    for module in (False, True):
        keys = spark.createDataFrame([(ends[0][0][0],), (ends[7][0][1],), (ends[3][0][1] + 5,), (None,)], "SSN long")
        assert set(versions.candidate_files(loaded, CUSTOMER, keys, "SSN")) == {ends[0][1], ends[7][1]}
    assert versions.candidate_files(loaded, CUSTOMER, keys.where("SSN IS NULL"), "SSN") == []
    rng = random.Random(3)
    for _ in range(5):
        given = [rng.randrange(-3000, 14_000) for _ in range(rng.randint(1, 6))]
        frame = spark.createDataFrame([(k,) for k in given], "SSN long")
        able = set(versions.candidate_files(loaded, CUSTOMER, frame, "SSN"))
        needed = {name for name, (_, a, b) in before.items() if any(a <= k <= b and k % 10 == 0 for k in given)}
        assert needed <= able <= {name for name, (_, a, b) in before.items() if a <= max(given) and b >= min(given)}
        assert set(versions.touched_files(loaded, CUSTOMER, frame, "SSN")) == needed


def test_append_checks_keys_against_candidate_files_only(spark, loaded, many):
    ends = sorted((f[1:], name) for name, f in listed(loaded).items())
    new = many.limit(3).withColumn("SSN", F.monotonically_increasing_id() + ends[1][0][0] + 1)
    Path(unquote(urlparse(ends[6][1]).path)).unlink()  # a file whose keys are far away need not even be there
    clash = new.unionByName(many.where(F.col("SSN") == ends[1][0][0])).unionByName(new.limit(1))
    first = new.agg(F.min("SSN")).first()[0]
    found = versions.append_key_violations(loaded, CUSTOMER, clash, "SSN")
    assert sorted(rows(found)) == sorted([(ends[1][0][0], 2), (first, 2)])
    with pytest.raises(LoadRejected, match="SSN"):
        versions.append_version(loaded, "customer", clash)
    assert loaded.version() == 1
    assert versions.append_version(loaded, "customer", new) == 2
    assert set(listed(loaded, 1)) < set(listed(loaded))
    assert sum(f[0] for f in listed(loaded).values()) == 1003


def test_a_load_that_fails_leaves_the_old_version(spark, store, raw_credit, raw_customer, loan):
    good = {"credit": raw_credit, "customer": raw_customer, "loan": loan}
    assert store.version() is None and store.manifest().count() == 0
    assert versions.load_version(store, good) == 1
    bad = raw_customer.withColumn("CUST_ZIP", F.lit("n/a"))
    with pytest.raises(LoadRejected) as error:
        versions.load_version(store, {"loan": loan.limit(1), "credit": raw_credit.limit(1), "customer": bad})
    assert "'cast:CUST_ZIP': 2" in str(error.value)
    with pytest.raises(LoadRejected, match="unique"):
        versions.load_version(store, {"credit": raw_credit.limit(1), "customer": raw_customer.unionByName(raw_customer)})
    tables = versions.open_version(store)
    assert store.version() == 1 and {n: df.count() for n, df in tables.items()} == {CREDIT.name: 5, CUSTOMER.name: 2, LOAN_TABLE: 8}
    assert spark.table(CREDIT.name).count() == 5
    bill = reports.monthly_bill(tables[CREDIT.name], "4210653310061055", 2018, 2)
    assert rows(bill) == [("4210653310061055", 116.43)]
    # A version that replaces one table keeps the others, and readers of the old one see no change.
    assert versions.load_version(store, {"loan": loan.limit(3)}) == 2
    assert {n: df.count() for n, df in versions.open_version(store).items()} == {CREDIT.name: 5, CUSTOMER.name: 2, LOAN_TABLE: 3}
    assert tables[LOAN_TABLE].count() == 8


def test_months_are_pruned_in_a_version(store, raw_credit):
    versions.load_version(store, {"credit": raw_credit})
    versions.append_version(store, "credit", raw_credit.withColumn("TRANSACTION_ID", F.col("TRANSACTION_ID") + 100))
    credit = store.read(CREDIT.name, CREDIT)
    assert credit.count() == 10 and credit.columns == CREDIT.struct().names
    march = credit.where("ym = '201803'")
    assert march.count() == 2 and all("ym=201803" in f for f in march.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


def test_one_writer_at_a_time(spark, store, loan):
    versions.load_version(store, {"loan": loan})
    path = store.new_path(LOAN_TABLE)
    loan.write.parquet(path)
    listing = store.listing(LOAN_TABLE, path)
    assert store.publish({LOAN_TABLE: listing}, 1) == 2
    with pytest.raises(VersionConflict):
        store.publish({LOAN_TABLE: listing}, 1)
    store.spark.createDataFrame([(2, "elsewhere")], "version long, manifest string").write.mode("append").parquet(f"{store.root}/published")
    with pytest.raises(VersionConflict):
        store.version()
    with pytest.raises(ValueError):
        Store(spark, f"{store.root}/none").manifest(3)


def test_an_empty_table_can_be_published_and_appended_to(spark, store, raw_customer):
    versions.load_version(store, {"customer": raw_customer.limit(0)})
    assert store.read(CUSTOMER.name, CUSTOMER).count() == 0
    assert versions.update_version(store, updates_of(spark, [1]))[1].count() == 1
    assert versions.append_version(store, "customer", raw_customer) == 2
    assert store.read(CUSTOMER.name, CUSTOMER).count() == 2


def test_rejects_are_set_aside_with_their_rules(spark, raw_customer, tmp_path):
    bad = raw_customer.withColumn("CUST_EMAIL", F.when(F.col("SSN") == 123456100, F.repeat(F.lit("x"), 51)).otherwise("a@b.c"))
    bad = bad.withColumn("CUST_ZIP", F.when(F.col("SSN") == 123456100, "n/a").otherwise("07501"))
    good, rejected = versions.load_with_rejects(spark, "customer", bad, str(tmp_path / "judged"))
    assert [r["SSN"] for r in good.collect()] == [123459988] and good.columns == list(CUSTOMER.columns)
    found = rejected.collect()
    assert [sorted(r["rules"]) for r in found] == [["cast:CUST_ZIP", "length:CUST_EMAIL"]]
    assert '"CUST_ZIP":"n/a"' in found[0]["record"] and '"SSN":123456100' in found[0]["record"]


def test_unreadable_records_are_rejects(spark, tmp_path):
    from cardlens.sources import read_dataset

    (tmp_path / "branch.json").write_text('{"BRANCH_CODE": 7, "BRANCH_STATE": "NY"}\n{"BRANCH_CODE": broken\n{"BRANCH_CODE": 1.5}\n')
    raw = read_dataset(spark, "branch", str(tmp_path / "branch.json"))
    good, rejected = versions.load_with_rejects(spark, "branch", raw, str(tmp_path / "judged"))
    assert [r["BRANCH_CODE"] for r in good.collect()] == [7] and good.columns == list(BRANCH.columns)
    assert sorted((r["rules"], r["record"].startswith('{"BRANCH_CODE": broken')) for r in rejected.collect()) == [
        (["cast:BRANCH_CODE"], False), (["unreadable"], True)]


def test_rejects_read_the_input_once(spark, raw_customer, tmp_path):
    raw_customer.write.json(str(tmp_path / "raw"))
    reads = spark.sparkContext.accumulator(0)
    source = spark.createDataFrame(raw_customer.rdd.map(lambda r: (reads.add(1), r)[1]), raw_customer.schema)
    versions.load_with_rejects(spark, "customer", source, str(tmp_path / "judged"))
    assert reads.value == raw_customer.count()
