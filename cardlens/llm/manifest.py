"""A Merkle manifest of a dataset: a hash for every row, a tree of hashes over the rows of each group, one over
the groups, and for every row the proof that it belongs to the root.

The tree is a nested-struct rollup. A row's rank in its group is written in digits of base ``fan``. Inside a
block of ``fan ** levels`` rows the lowest digit is grouped away first: the rows of a run become one struct with
its hash and the run as a nested array; then the next digit, until the block is one row. Blocks are rolled up
the same way, round by round, until a group is one node. On the way down a block meets the path above
it in one more grouping, and transforms and explodes unfold it into its rows, each with its path. No node is
joined with its siblings, and no row holds more than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardlens.llm.common import materialize
from cardlens.operators.joins import fits_broadcast

_IN_PARTITION = (1 << 33) - 1  # the part of a monotonically increasing id that counts inside a partition
_PATH = "array<struct<at: int, run: array<string>>>"


def row_hash(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def siblings(path: Column) -> Column:
    """All hashes of a path but the row's own line, level by level, left to right, as one string."""
    others = F.transform(path, lambda s: F.concat(F.slice(s["run"], 1, s["at"]), F.slice(s["run"], s["at"] + 2, F.size(s["run"]))))
    return F.array_join(F.flatten(others), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""

    def up(own: Column, s: Column) -> Column:
        left = F.array_join(F.slice(s["run"], 1, s["at"]), "")
        right = F.array_join(F.slice(s["run"], s["at"] + 2, F.size(s["run"])), "")
        return F.sha2(F.concat(left, own, right), 256)

    return F.aggregate(path, leaf, up)


def _ranked(df: DataFrame, label: str) -> DataFrame:
    """Rows (g, o, hash, row) with ``at``, their place in their group by o and hash, and ``n``, its size.

    One sort by ranges of (group, order, hash, number of the row), so a large group and even copies of one row
    are cut; places follow from the counts of each partition, of which there is a row a group and partition.
    """
    spark = df.sparkSession
    rows = materialize(spark, df.withColumn("seq", F.monotonically_increasing_id()), f"{label}-rows")
    keys = ("g", "o", "hash", "seq")
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "g", "hash", "row", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias("place"),
    )
    placed = materialize(spark, placed, f"{label}-places")
    counts = placed.groupBy("part", "g").agg(F.min("place").alias("first"), F.count("*").alias("own"))
    group = Window.partitionBy("g")
    before = F.sum("own").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("part", "g", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("base"), F.sum("own").over(group).alias("n"))
    counts = materialize(spark, counts, f"{label}-counts")
    # A partition and group holds one task's rows at most, so the larger join is even too.
    small = F.broadcast(counts) if fits_broadcast(counts) else counts.hint("merge")
    return placed.join(small, ["part", "g"]).select("g", "n", (F.col("place") + F.col("base")).alias("at"), "hash", "row")


def _left(n: str, steps: int, fan: int) -> Column:
    """Nodes left of ``n`` after some steps."""
    return F.ceil(F.col(n) / F.lit(fan**steps)).cast("long")


def _block(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """Blocks (g, n, block, hash, tree) of nodes (g, n, at, hash, row)."""
    digit = [F.floor(F.col("at") / fan**i % fan).cast("int").alias(f"d{i}") for i in range(levels)]
    block = F.floor(F.col("at") / fan**levels).alias("block")
    # Dealt by block once; every grouping below stays where its block is.
    rolled = nodes.select("g", "n", block, *digit, "hash", F.col("row").alias("tree")).repartition("g", "block")
    for i in range(levels):
        own = F.struct(F.col(f"d{i}").alias("digit"), "hash", "tree")
        rolled = rolled.groupBy("g", "n", "block", *(f"d{j}" for j in range(i + 1, levels))).agg(
            F.array_sort(F.collect_list(own)).alias("tree")
        )
        joined = F.sha2(F.array_join(F.transform("tree", lambda x: x["hash"]), ""), 256)
        rolled = rolled.withColumn("hash", F.when(_left("n", i, fan) > 1, joined).otherwise(F.col("tree")[0]["hash"]))
    return rolled.select("g", "n", "block", "hash", "tree")


def _unfold(blocks: DataFrame, paths: DataFrame, fan: int, levels: int) -> DataFrame:
    """Nodes (g, at, row, path, subroot, root) of blocks, with the paths (g, at, path, subroot, root) above them."""
    none = (F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"))
    tree = F.lit(None).cast(blocks.schema["tree"].dataType).alias("tree")
    above = paths.select("g", F.col("at").alias("block"), F.lit(None).cast("long").alias("n"), tree, "path", "subroot", "root")
    met = blocks.select("g", "block", "n", "tree", *none).unionByName(above).groupBy("g", "block").agg(
        F.max("n").alias("n"), F.collect_list("tree")[0].alias("tree"), F.collect_list("path")[0].alias("path"),
        F.max("subroot").alias("subroot"), F.max("root").alias("root"),
    )
    nodes = met.select("g", "n", F.col("block").alias("at"), "tree", "path", "subroot", "root")
    for i in reversed(range(levels)):
        nodes = nodes.withColumn("run", F.transform("tree", lambda x: x["hash"])).withColumn("tree", F.explode("tree"))
        step = F.array(F.struct(F.col("tree.digit").alias("at"), F.col("run")))
        nodes = nodes.select(
            "g", "n", (F.col("at") * fan + F.col("tree.digit")).alias("at"), F.col("tree.tree").alias("tree"),
            F.when(_left("n", i, fan) > 1, F.concat(step, "path")).otherwise(F.col("path")).alias("path"), "subroot", "root",
        )
    return nodes.withColumnRenamed("tree", "row")


def _rise(ranked: DataFrame, label: str, fan: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, and the top node (g, hash) of each group."""
    spark = ranked.sparkSession
    largest = ranked.agg(F.max("n").alias("n")).first()["n"] or 1
    rounds, nodes = [], ranked
    while True:
        rounds.append(materialize(spark, _block(nodes, fan, levels), f"{label}-blocks-{len(rounds)}"))
        nodes = rounds[-1].select("g", _left("n", levels, fan).alias("n"), F.col("block").alias("at"), "hash", F.lit(None).cast("int").alias("row"))
        largest = -(-largest // fan**levels)
        if largest == 1:
            return rounds, nodes


def prove(
    df: DataFrame, group: str = "lang", order: str = "doc_id", leaf: str = "leaf", fan: int = 8, levels: int = 3
) -> DataFrame:
    """Each row of ``df`` as the struct ``row``, with ``subroot`` (of its group), ``root`` and ``path``, the runs that
    it and its ancestors stand in: their place, and all hashes of the run. See ``siblings`` and ``folded``.

    ``leaf`` is the row's hash, ``group`` a column read as text. In a group rows ascend by ``order``, null first,
    then by ``leaf``; rows that repeat are leaves like any others. While a group has several nodes, every
    ``fan`` in a row become the SHA-256 of their joined hashes (the last run may be shorter, even one). The tops of
    the groups, null first and then by bytes, are rolled up alike. A single row is subroot and root itself. An
    empty table has an empty result. Columns of ``df`` must be orderable and narrow: they travel with the hashes.
    """
    if fan < 2 or levels < 1:
        raise ValueError("a tree needs a fan of 2 and a level of 1 at least")
    # Null stands before all texts.
    key = F.coalesce(F.concat(F.lit("."), F.col(group).cast("string")), F.lit(""))
    ranked = _ranked(df.select(key.alias("g"), F.col(order).alias("o"), F.col(leaf).alias("hash"), F.struct("*").alias("row")), "leaves")
    rounds, tops = _rise(ranked, "leaves", fan, levels)
    groups = _ranked(tops.select(F.lit("").alias("g"), F.col("g").alias("o"), "hash", F.struct("g", "hash").alias("row")), "groups")
    group_rounds, top = _rise(groups, "groups", fan, levels)

    paths = top.select("g", F.lit(0).cast("long").alias("at"), F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    for blocks in reversed(group_rounds):
        nodes = _unfold(blocks, paths, fan, levels)
        paths = nodes.select("g", "at", "path", "subroot", "root")
    paths = nodes.select(F.col("row.g").alias("g"), F.lit(0).cast("long").alias("at"), "path", F.col("row.hash").alias("subroot"), "root")
    for blocks in reversed(rounds):
        nodes = _unfold(blocks, paths, fan, levels)
        paths = nodes.select("g", "at", "path", "subroot", "root")
    return nodes.select("row", "subroot", "root", "path")
