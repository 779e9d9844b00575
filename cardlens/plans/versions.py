"""Versions of the loaded tables: several loads published at once, updates and appends that touch few files."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from cardlens.names import free_name
from cardlens.operators.clean import clean
from cardlens.operators.joins import fits_broadcast, lookup_join
from cardlens.operators.quality import apply_schema, broken_rules, key_violations, typed_value
from cardlens.operators.updates import apply_updates, unmatched_updates
from cardlens.plans.loading import CLUSTER_BY, LOOKED_UP, LoadRejected, refuse_updates
from cardlens.schemas import CORRUPT, CUSTOMER, LOAN_TABLE, TABLES, TableSchema
from cardlens.sources.tables import register, write_table
from cardlens.sources.versions import Store

# Ranges into which the keys of an append are cut to tell which files they can clash with.
KEY_RANGES = 1000


def _table_name(dataset: str) -> str:
    return TABLES[dataset].name if dataset in TABLES else LOAN_TABLE


def _key(table: TableSchema | None) -> str | None:
    return table.primary_key[0] if table and table.primary_key else None


def _write_checked(store: Store, dataset: str, raw: DataFrame) -> str:
    """Clean a raw dataset and write it below the store; nothing refers to those files yet.

    A table with a key is dealt out by ranges of it, so that files hold ranges that do not overlap. The rules a
    row breaks travel along as the bits of a number and are counted behind that shuffle: what stands before it runs
    twice, once for the sample that finds the ranges, and would be counted twice.
    """
    table, cleaned = TABLES.get(dataset), clean(dataset, raw)
    path = store.new_path(_table_name(dataset))
    rules = broken_rules(cleaned, table)
    bits = free_name([*cleaned.columns, *(table.columns if table else ())], "_broken")
    mask = sum((F.when(rule, F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules.values())), F.lit(0)).cast("long")
    given = cleaned.drop(CORRUPT).columns
    values = [typed_value(cleaned, table, c).alias(c) for c in table.columns] if table else [F.col(c) for c in given]
    rows = cleaned.select(*values, mask.alias(bits))
    key, clustered, looked_up = _key(table), CLUSTER_BY.get(dataset, ()), LOOKED_UP.get(dataset, ())
    if key:
        rows = rows.repartitionByRange(key)
    seen = Observation(f"load {dataset}")
    if rules:
        counts = [F.count_if(F.col(bits).bitwiseAND(1 << i) != 0).alias(name) for i, name in enumerate(rules)]
        rows = rows.observe(seen, *counts)
    rows = rows.drop(bits)
    write_table(rows, path, table.month_of if table else None, clustered, looked_up)
    broken = {rule: n for rule, n in seen.get.items() if n} if rules else {}
    if broken:
        raise LoadRejected(f"{dataset}: {broken}; below {path}")
    return path


def load_version(store: Store, raw: Mapping[str, DataFrame]) -> int:
    """Load raw datasets and publish them together as the next version; return its number.

    Each replaces its table; tables that are not among them stay as they are. A dataset that is refused, or a
    job that fails, leaves the version before as it is: what was written is not listed anywhere.
    """
    base, listings = store.version(), {}
    for dataset, df in raw.items():
        table, name = TABLES.get(dataset), _table_name(dataset)
        path = _write_checked(store, dataset, df)
        key = _key(table)
        if key and not key_violations(store.spark.read.parquet(path), [key]).isEmpty():
            raise LoadRejected(f"{dataset}: {key} is not a unique, non-null key")
        listings[name] = store.listing(name, path, key)
    return store.publish(listings, base)


def open_version(store: Store, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of one version by their names in SQL, and registered under them."""
    number = store.version() if version is None else version
    schemas = {t.name: t for t in TABLES.values()}
    names = [r["table"] for r in store.manifest(number).select("table").distinct().collect()]
    frames = {name: store.read(name, schemas.get(name), number) for name in names}
    register(store.spark, frames)
    return frames


def touched_files(store: Store, table: TableSchema, keys: DataFrame, key: str, version: int | None = None) -> list[str]:
    """The live files that hold any of ``keys``. Of those whose range of keys can hold one the key column is read."""
    able = candidate_files(store, table, keys, key, version)
    held = store.read_files(table.name, able, table, "file").select(key, "file")
    wanted = keys.select(F.col(key).cast(table.spark_type(key)).alias(key)).where(F.col(key).isNotNull()).distinct()
    if fits_broadcast(wanted):
        found = held.join(F.broadcast(wanted), key, "left_semi")
    else:
        found = lookup_join(held, wanted, key, [key], "left_semi")
    return sorted(r["file"] for r in found.select("file").distinct().collect())  # names of files, as Spark holds them itself


def candidate_files(store: Store, table: TableSchema, keys: DataFrame, key: str, version: int | None = None) -> list[str]:
    """The live files whose range of keys meets one of the ranges in which ``keys`` lie.

    Whole numbers are cut into at most ``KEY_RANGES`` ranges of equal width, each shrunk to the keys in it;
    other keys form one range. Only those ranges and the manifest come to the driver.
    """
    kind = table.spark_type(key)
    typed = keys.select(F.col(key).cast(kind).alias("key")).where(F.col("key").isNotNull())
    whole = kind in ("integer", "bigint")
    ends = typed.agg(F.min("key").alias("first"), F.max("key").alias("last")).first()
    if ends["first"] is None:
        return []
    part = F.lit(0)
    if whole:
        width = (ends["last"] - ends["first"]) // KEY_RANGES + 1
        part = F.floor((F.col("key").cast("decimal(20,0)") - ends["first"]) / width).cast("int")
    ranges = typed.groupBy(part.alias("part")).agg(F.min("key").alias("first"), F.max("key").alias("last"))
    ranges = sorted((r["first"], r["last"]) for r in ranges.collect())
    starts = [first for first, _ in ranges]
    files = store.files(table.name, version).select(
        "file", F.col("first_key").cast(kind).alias("first"), F.col("last_key").cast(kind).alias("last")
    )
    able = []
    for r in files.collect():
        if r["first"] is None:
            continue
        place = bisect_right(starts, r["last"])  # ranges that begin before the file ends; they do not overlap
        if place and ranges[place - 1][1] >= r["first"]:
            able.append(r["file"])
    return sorted(able)


def update_version(
    store: Store, updates: DataFrame, seq: str = "seq", as_of: Column | None = None
) -> tuple[int | None, DataFrame]:
    """Apply a batch of account updates to the customer files that hold their keys; return the new version's number
    and the updates that matched nobody.

    Only those files are read as a whole and written anew; the others are listed again under the names
    they have. A batch that matches nobody publishes nothing. Refused are the batches that ``update_customers`` refuses.
    """
    refuse_updates(updates, seq)
    base = store.version()
    files = touched_files(store, CUSTOMER, updates, "SSN", base)
    part = store.read_files(CUSTOMER.name, files, CUSTOMER)
    if not files:
        return base, unmatched_updates(part, updates)
    path = store.new_path(CUSTOMER.name)
    changed = apply_updates(part, updates, seq=seq, as_of=as_of)
    write_table(changed.repartitionByRange("SSN"), path, None, CLUSTER_BY["customer"], LOOKED_UP["customer"])
    # The list of files is as long as the table's own; the touched ones are some of them.
    gone = store.spark.createDataFrame([(f,) for f in files], "file string")
    stay = store.files(CUSTOMER.name, base).join(gone, "file", "left_anti").select("table", "file", "rows", "first_key", "last_key")
    listing = stay.unionByName(store.listing(CUSTOMER.name, path, "SSN"))
    number = store.publish({CUSTOMER.name: listing}, base)
    register(store.spark, {CUSTOMER.name: store.read(CUSTOMER.name, CUSTOMER, number)})
    return number, unmatched_updates(part, updates)


def append_key_violations(store: Store, table: TableSchema, rows: DataFrame, key: str, version: int | None = None) -> DataFrame:
    """``key`` and ``n``: keys of ``rows`` that would not be unique in the table after an append, with the number of
    rows they would have, and null keys. Only files whose range of keys meets those of ``rows`` are read.
    """
    typed = rows.select(F.col(key).cast(table.spark_type(key)).alias(key))
    new = typed.groupBy(key).agg(F.count("*").alias("n"))
    held = store.read_files(table.name, candidate_files(store, table, typed, key, version), table).select(key)
    wanted = typed.where(F.col(key).isNotNull()).distinct()
    if fits_broadcast(wanted):
        known = held.join(F.broadcast(wanted), key, "left_semi")
    else:
        known = lookup_join(held, wanted, key, [key], "left_semi")
    both = new.unionByName(known.groupBy(key).agg(F.count("*").alias("n")))
    counted = both.groupBy(key).agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") > 1) | F.col(key).isNull())


def append_version(store: Store, dataset: str, raw: DataFrame) -> int:
    """Append raw rows to a table and publish the next version. Keys that are there already, repeat, or are null
    are refused, and so is what ``load_version`` refuses; the files there are not written again."""
    table, name = TABLES.get(dataset), _table_name(dataset)
    base = store.version()
    path = _write_checked(store, dataset, raw)
    key = _key(table)
    if key and not append_key_violations(store, table, store.spark.read.parquet(path), key, base).isEmpty():
        raise LoadRejected(f"{dataset}: {key} would not be a unique, non-null key")
    old = store.files(name, base).select("table", "file", "rows", "first_key", "last_key")
    return store.publish({name: old.unionByName(store.listing(name, path, key))}, base)


# --- Good and rejected rows apart ---

GOOD, REJECTED = "good", "rejected"


def load_with_rejects(spark: SparkSession, dataset: str, raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Load the rows that keep every rule, and set the others aside; the input is read once, for one write.

    Returns the typed table and the rejects: ``rules``, the names of those a row breaks (``cast:COLUMN``,
    ``length:COLUMN``, ``unreadable``), and ``record``, the cleaned row as JSON, or the text that could not be read.
    Keys are not checked: a key is a rule about two rows, and neither of them is the wrong one.
    """
    table, cleaned = TABLES[dataset], clean(dataset, raw)
    rules = broken_rules(cleaned, table)
    named = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    record = F.to_json(F.struct(*(c for c in cleaned.columns if c != CORRUPT)))
    if CORRUPT in cleaned.columns:
        record = F.coalesce(F.col(CORRUPT), record)
    verdict, bad = free_name(table.columns, "verdict"), F.size("rules") > 0
    judged = cleaned.select("*", named.alias("rules"))
    typed = judged.select(
        *(typed_value(cleaned, table, c).alias(c) for c in table.columns),
        F.when(bad, F.col("rules")).alias("rules"), F.when(bad, record).alias("record"),
        F.when(bad, REJECTED).otherwise(GOOD).alias(verdict),
    )
    typed.write.partitionBy(verdict).parquet(path)
    written = spark.read.schema(T.StructType([*typed.drop(verdict).schema.fields, T.StructField(verdict, T.StringType())])).parquet(path)
    good = written.where(F.col(verdict) == GOOD).select(*table.columns)
    return good, written.where(F.col(verdict) == REJECTED).select("rules", "record")
