"""Connected components by alternating large and small stars.

Every step is a minimum per node (summed up before the shuffle) and an equi-join that adaptive
execution can split, so a node with very many neighbours does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.staging import stage


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(a, least) for each node a: the least of itself and its neighbours b."""
    return edges.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stage(_least_neighbour(both), "least")
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        # The neighbours of a node and the node itself move to its least neighbour.
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    return stage(moved.where("a <> b").distinct(), "star")


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's least node."""
    edges = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    before, after = None, _state(edges)
    while before != after and after[0]:
        edges = _star(_star(edges, large=True), large=False)
        before, after = after, _state(edges)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
