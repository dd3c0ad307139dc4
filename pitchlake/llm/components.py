"""Connected components of a graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchlake.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the greater neighbours of every node on its smallest neighbour or itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), "m")
    return joined.union(least).select("a", F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Node and the smallest node of its component, for nodes that have an edge.

    ``edges`` has numeric columns a and b. Every round keeps components as they are and at
    least halves the depth of the forest; its table is written to the shared folder. Smallest
    neighbours are reduced within each task, and what joins back is an equi-join that adaptive
    execution splits where a centre is hot. The rounds
    end when one has changed no edge.
    """
    current = settle(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not current.isEmpty():
        after = settle(_small_star(_large_star(current)), "edges")
        # Both are sets of edges: they are equal if there are as many and none is new.
        if after.count() == current.count() and after.join(
                current, ["a", "b"], "left_anti").isEmpty():
            break
        current = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
