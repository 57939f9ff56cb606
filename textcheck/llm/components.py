"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.session import materialise


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node of its component, for every node with an edge.

    Edges stay distributed: each round rewrites the edge table in the shared folder,
    and only its row count and a sum of row hashes come to the driver. The number of
    rounds grows with the logarithm of the longest path. Self-loops and null ends are
    ignored; no edges give no rows.
    """
    edges = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct())
        before = state
        edges = materialise(_small_star(materialise(_large_star(edges))))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node of its neighbourhood."""
    both = edges.union(edges.select("v", "u"))
    low = materialise(both.groupBy("u").agg(F.min("v").alias("low"))
                      .select("u", F.least("u", "low").alias("low")))
    return both.join(low, "u").where("v > u").select(
        F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    low = materialise(edges.groupBy("u").agg(F.min("v").alias("low")))
    moved = edges.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", "low")).distinct()
