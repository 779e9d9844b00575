"""Connected components of a graph given by its edges, by stars that grow and shrink (large star, small star).

Each round moves every node to the smallest of its neighbours, first among the larger ones, then among the
smaller ones, until every component is a star around its smallest node. Minima are combined before their
shuffle and joined back, so a node with very many neighbours is no larger group than any other; its edges
are spread where they meet their minimum. Every round is written to the shared folder,
which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardlens.llm.common import materialize
from cardlens.operators.joins import shuffle_join


def _towards_minimum(pairs: DataFrame, keep: str) -> DataFrame:
    """Link each neighbour ``v`` of ``u`` for which ``keep`` holds, and u, to the smallest of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = shuffle_join(pairs.where(keep), least, "u", ["v"]).select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(own).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that it is connected to, for every node of ``edges``.

    ``edges`` has the two long columns ``a`` and ``b``; direction, repetition and loops do not matter. Nodes
    without an edge to another one are not in the result. No edge comes to the driver.
    """
    spark = edges.sparkSession
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(spark, links, "links")
    before = None
    while True:
        print_of = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if print_of == before or not print_of["n"]:
            break
        before = print_of
        both = links.selectExpr("a AS u", "b AS v").unionByName(links.selectExpr("b AS u", "a AS v"))
        large = _towards_minimum(both, "v > u")
        small = _towards_minimum(large.selectExpr("a AS u", "b AS v"), "true")
        links = materialize(spark, small, "links")
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
