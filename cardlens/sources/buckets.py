"""Tables stored in buckets of a key, so that large joins on that key need no shuffle.

A bucket is read by one task, so the keys that hold much of a table, null among them, are kept out of the
buckets: their rows are stored beside them in files of ordinary size. What has to be known of a stored table to
open it in another session is stored with it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlens.operators.joins import hot_keys, lookup_join

Narrow = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Buckets:
    """A stored table: its name in the catalogue (the buckets), its key, and the keys that stand outside."""

    spark: SparkSession
    name: str
    path: str
    key: str
    buckets: int
    hot: tuple

    def even(self) -> DataFrame:
        """The rows in buckets."""
        return self.spark.table(self.name)

    def rest(self) -> DataFrame:
        """The rows of the keys that stand outside, null among them."""
        return self.spark.read.schema(self.even().schema).parquet(f"{self.path}/rest")

    def rows(self) -> DataFrame:
        return self.even().unionByName(self.rest())


def save_buckets(df: DataFrame, name: str, path: str, key: str, buckets: int, apart: bool = True) -> Buckets:
    """Store ``df`` below ``path`` in ``buckets`` buckets of ``key``, under ``name`` in the session's catalogue.

    ``apart`` puts the rows of hot keys outside; without it (for a table whose key is unique) only null keys are.
    Rows are dealt by the hash that buckets use, so every bucket is one sorted file.
    """
    spark = df.sparkSession
    hot = tuple(k for k in (hot_keys(df, key) if apart else ()) if k is not None)
    outside = F.col(key).isNull() | (F.col(key).isin(list(hot)) if hot else F.lit(False))
    about = json.dumps({"name": name, "key": key, "buckets": buckets, "hot": hot})
    df.where(~outside).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option(
        "path", f"{path}/buckets"
    ).saveAsTable(name)
    df.where(outside).write.parquet(f"{path}/rest")
    spark.createDataFrame([(about,)], "about string").coalesce(1).write.parquet(f"{path}/about")
    return Buckets(spark, name, path, key, buckets, hot)


def open_buckets(spark: SparkSession, path: str) -> Buckets:
    """A stored table, entered in the catalogue under its name if it is not there."""
    about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
    found = Buckets(spark, about["name"], path, about["key"], about["buckets"], tuple(about["hot"]))
    if not spark.catalog.tableExists(found.name):
        columns = spark.read.parquet(f"{path}/buckets").schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        spark.sql(
            f"CREATE TABLE {found.name} ({ddl}) USING parquet CLUSTERED BY (`{found.key}`) SORTED BY (`{found.key}`) "
            f"INTO {found.buckets} BUCKETS LOCATION '{path}/buckets'"
        )
    return found


def join_buckets(facts: Buckets, lookup: Buckets, of_facts: Narrow, of_lookup: Narrow, spread_by: list[str]) -> DataFrame:
    """Inner join of two stored tables on their keys, each narrowed first by a function that keeps its key.

    Bucket meets bucket where they lie. The facts outside the buckets meet the lookup rows of their few keys (one
    each, if the lookup's key is unique) in a ``lookup_join``, which broadcasts them if they are measured to be
    small and else spreads the facts by ``spread_by``. Null keys match nothing. Both tables must have
    the same number of buckets and the same type of key, and no other column name in common.
    """
    if facts.buckets != lookup.buckets:
        raise ValueError(f"{facts.name} has {facts.buckets} buckets, {lookup.name} has {lookup.buckets}")
    left, right = of_facts(facts.even()), of_lookup(lookup.even())
    if left.schema[facts.key].dataType != right.schema[lookup.key].dataType:
        raise ValueError("keys of different types lie in different buckets")
    named = right.withColumnRenamed(lookup.key, facts.key)
    even = left.join(named.hint("merge"), facts.key)
    # A lookup key may itself stand outside: those rows are read beside their buckets.
    other = of_lookup(lookup.rest()).withColumnRenamed(lookup.key, facts.key)
    if lookup.hot:
        even = even.unionByName(lookup_join(left, other.where(F.col(facts.key).isNotNull()), facts.key, spread_by))
    if not facts.hot:
        return even
    wanted = named.where(F.col(facts.key).isin(list(facts.hot))).unionByName(other.where(F.col(facts.key).isin(list(facts.hot))))
    return even.unionByName(lookup_join(of_facts(facts.rest()), wanted, facts.key, spread_by))
