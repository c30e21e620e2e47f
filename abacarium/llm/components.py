"""Connected components by alternating star contractions, in DataFrame operations.

Every round links all larger neighbours of a node to the smallest node around it
(large star), then all smaller ones (small star). Each step is an aggregate, which
combines before its shuffle, and a join, whose hot side adaptive execution can
split. The edges are written to the shared folder each round, which cuts lineage.
Components of any shape end as stars around their smallest node after a number of
rounds that grows with the logarithm of the longest path. One aggregate tells
whether they are stars, so that no round is run to see that nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from abacarium.session import discard, stored_at


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges from all larger neighbours of a node to the smallest around it; some may repeat, which the small star mends."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges from a node and its smaller neighbours to the smallest of these; edges point from the larger to the smaller node."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    ends = edges.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return ends.where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node either has one smaller neighbour and no larger one, or larger ones alone."""
    up = edges.select(F.col("u").alias("node"), F.col("v").alias("parent"))
    ends = up.unionByName(edges.select(F.col("v").alias("node"), F.lit(None).alias("parent")))
    nodes = ends.groupBy("node").agg(F.min("parent").alias("low"), F.max("parent").alias("high"), F.bool_or(F.col("parent").isNull()).alias("has_child"))
    return not nodes.where("low IS NOT NULL AND (low <> high OR has_child)").agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node that has an edge; the root is the smallest node reachable.

    Nodes may be of any type that can be ordered. Edges with NULL ends and loops
    are ignored; direction and repeats do not matter; no edges give no rows.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    current, path = stored_at(pairs.where("_a IS NOT NULL AND _b IS NOT NULL AND u <> v").select("u", "v").distinct(), "edges")
    while not _are_stars(current):
        after, new_path = stored_at(_small_star(_large_star(current)), "edges")
        discard(edges.sparkSession, path)
        current, path = after, new_path
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
