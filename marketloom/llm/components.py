"""Connected components of an edge table by repeated contraction, as joins and aggregates on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of ``edges`` (a bigint, b bigint): root is one node of the component, the same for all.

    In a round every node points at the first of itself and its neighbours in a hashed
    order, and every edge is replaced by that between the nodes its ends point at; loops and
    repeats go. So the edges shrink by a factor that does not depend on the order of ids, and
    after a number of rounds that grows with the logarithm of the largest component none is
    left. A node with many neighbours is a key of partial aggregates and of joins whose other
    side has one row for each node, which adaptive execution splits. Loops and null ends are
    left out; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, roots = checkpointed(edges), None
    while roots is None or not edges.isEmpty():
        first = F.min(F.struct(F.xxhash64("b").alias("order"), "b"))
        ends = edges.union(edges.select("b", "a"))
        points = ends.groupBy("a").agg(first.alias("near"))
        itself = F.struct(F.xxhash64("a").alias("order"), F.col("a").alias("b"))
        points = checkpointed(points.select(F.col("a").alias("node"), F.least("near", itself)["b"].alias("to")))
        if roots is None:
            roots = points.withColumnRenamed("to", "root")
        else:
            moved = points.select(F.col("node").alias("root"), "to")
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        left, right = points.select(F.col("node").alias("a"), F.col("to").alias("x")), points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = checkpointed(edges.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())
    return checkpointed(roots)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every end of ``edges``: label is the smallest node reachable."""
    roots = component_roots(edges)
    return roots.join(roots.groupBy("root").agg(F.min("node").alias("label")), "root").select("node", "label")
