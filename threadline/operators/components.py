"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _toward_min(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are linked to the smallest of them (and itself).

    Large star: every neighbour above the node; small star: those below it, and the node.
    """
    if large:
        sides = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return sides.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = sides.groupBy("u").agg(F.min("v").alias("m"))
    return sides.join(low, "u").select("v", "m").union(low.select("u", "m")).toDF("a", "b")


def components(edges: DataFrame, kept: Callable[[DataFrame], DataFrame], rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named by its smallest node.

    ``kept`` materialises a table, so that plans do not grow with the rounds.
    """
    now = kept(edges.where("a <> b").select("a", "b").distinct())
    for _ in range(rounds):
        for large in (True, False):
            now = _toward_min(now, large).where("a <> b").distinct()
        now = kept(now)
        # done when each node has one edge, to a node that has none
        several = now.groupBy("a").count().where("count > 1")
        if several.isEmpty() and now.join(now.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
    raise ValueError(f"components did not settle in {rounds} rounds")
