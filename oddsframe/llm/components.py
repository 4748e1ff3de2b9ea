"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is a grouped minimum (with map-side partial aggregation) joined back to the edges, so
a node with very many neighbours is one aggregation row and a join side that adaptive execution
can split; no neighbour list is ever gathered. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsframe.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = (down.join(low, "u").filter(F.col("v") != F.col("m"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of one orderable type -> ``(node, root)`` for every node of an edge that
    is not itself a root; root is the smallest node reachable. Self loops, repeated and reversed
    edges and an empty table are fine."""
    cur = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .filter("u <> v").distinct(), "cc")
    mark = None
    while True:
        new = _mark(cur)
        if new == mark:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = new
        cur = materialise(_small_star(_large_star(cur)), "cc")


def _mark(edges: DataFrame) -> tuple:
    """Order-free summary of an edge list; equal summaries end the rounds."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.col("v").cast("decimal(38,0)"))).first())
