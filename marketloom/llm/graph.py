"""Connected components of an edge list that no machine needs to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketloom.llm.common import stored


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node of its neighbourhood."""
    around = both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its least node) for all nodes of ``edges`` (``a``, ``b``), by alternating stars.

    Neighbourhoods are never gathered: their least node is a map-side minimum, and a hub's edges may be split. Each
    round is stored, so lineage stays short.
    """
    current, mark = stored(edges.select("a", "b").where("a <> b").distinct(), "edges"), None
    while True:
        seen = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark = seen
        current = stored(_small_star(_large_star(current)).distinct(), "edges")
    roots = current.select(F.col("b").alias("a"), "b").distinct()
    return current.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))
