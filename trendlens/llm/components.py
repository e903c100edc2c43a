"""Connected components of an edge table by alternating large-star and small-star steps.

Each step replaces a node's edges by edges to the least neighbour; the number
of steps grows with the logarithm of the longest path. The least neighbour is
a partial aggregate, and joins on a node with very many edges are sort-merge
joins that adaptive execution splits. Every step is written to the shared
folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """``u > v`` in, likewise out: larger neighbours move to the least one."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours, and the node itself, move to the least one."""
    least = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("c")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge (``u, v``); the root is its component's least node."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    seen = None
    while True:
        e = materialize(_small_star(_large_star(e)), "components")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
