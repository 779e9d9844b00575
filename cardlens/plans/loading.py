"""Raw datasets -> checked, typed, registered tables; and new versions of the customer table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from cardlens.operators.clean import clean
from cardlens.operators.quality import apply_schema, key_violations, violation_counts
from cardlens.operators.updates import apply_updates, unmatched_updates, update_conflicts, update_violations
from cardlens.schemas import CORRUPT, CUSTOMER, LOAN_TABLE, TABLES, TableSchema
from cardlens.sources.tables import read_table, register, write_table

# Sort inside the files of a table, by the column its look-ups filter on.
CLUSTER_BY = {"credit": ("CUST_CC_NO", "TIMEID"), "customer": ("SSN",)}
# The columns that single values are looked up in, beside those the files are sorted by.
LOOKED_UP = {"credit": ("CUST_CC_NO",), "customer": ("CREDIT_CARD_NO",)}


class LoadRejected(ValueError):
    """Rows break the table's types, lengths or key, or cannot be read. What was written below the path stays
    there, unregistered; give the next attempt another path, or remove it."""


def _require_unique(df: DataFrame, keys: tuple[str, ...], what: str) -> None:
    if keys and not key_violations(df, list(keys)).isEmpty():
        raise LoadRejected(f"{what}: {', '.join(keys)} is not a unique, non-null key")


def load_table(spark: SparkSession, dataset: str, raw: DataFrame, path: str, table: TableSchema | None = None) -> DataFrame:
    """Clean a raw dataset, write it to ``path`` as a typed table and return that table.

    The raw input is read once: values that do not fit their type or length are counted while the
    rows are being written, and the key is checked on the key column of the written table. ``table`` replaces
    the dataset's own, say with a wider transaction id (``TableSchema.with_types``).
    """
    table = table or TABLES.get(dataset)
    cleaned = clean(dataset, raw)
    rules = violation_counts(cleaned, table)
    seen = Observation(f"load {dataset}")
    counted = cleaned.observe(seen, *rules) if rules else cleaned
    if table is None:
        write_table(counted.drop(CORRUPT), path)
    else:
        write_table(
            apply_schema(counted, table), path, table.month_of, CLUSTER_BY.get(dataset, ()), LOOKED_UP.get(dataset, ())
        )
    broken = {rule: n for rule, n in seen.get.items() if n} if rules else {}
    if broken:
        raise LoadRejected(f"{dataset}: {broken}; below {path}")
    if table is None:
        return read_table(spark, path)
    loaded = read_table(spark, path, table)
    _require_unique(loaded, table.primary_key, dataset)
    return loaded


def load_tables(spark: SparkSession, raw: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Load each raw dataset below ``root``, then register all of them under their table names."""
    loaded = {name: load_table(spark, name, df, f"{root}/{name}") for name, df in raw.items()}
    names = {name: TABLES[name].name if name in TABLES else LOAN_TABLE for name in loaded}
    register(spark, {names[name]: df for name, df in loaded.items()})
    return loaded


def refuse_updates(updates: DataFrame, seq: str) -> None:
    """Raise if the order of a batch of account updates is not defined, or a value breaks a type or a length."""
    if not update_conflicts(updates, "SSN", seq).isEmpty():
        raise LoadRejected(f"updates: the same SSN and {seq} occur more than once, or are null")
    broken = update_violations(updates).groupBy("column", "rule").count().collect()  # a row a column at most
    if broken:
        raise LoadRejected(f"updates: {sorted((r['column'], r['rule'], r['count']) for r in broken)}")


def update_customers(
    spark: SparkSession,
    customer: DataFrame,
    updates: DataFrame,
    path: str,
    seq: str = "seq",
    as_of: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Apply a batch of account updates; return the new table and the updates that matched nobody.

    The result is written beside the version it is read from, and the view then moves to it. Updates
    whose order is not defined, or whose values break a type or a length, are refused before anything is
    written; ``update_violations`` lists the latter.
    """
    refuse_updates(updates, seq)
    write_table(apply_updates(customer, updates, seq=seq, as_of=as_of), path, None, CLUSTER_BY["customer"], LOOKED_UP["customer"])
    current = read_table(spark, path, CUSTOMER)
    register(spark, {CUSTOMER.name: current})
    return current, unmatched_updates(customer, updates)
