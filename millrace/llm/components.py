"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges(a, b), a > b. Every node is pointed to the smallest of its neighbours and itself.

    Large: neighbours greater than the node move to that minimum. Small: the smaller ones do, and the node itself.
    """
    around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        around = around.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    pairs = around.join(least, F.col("u") == F.col("w"))
    if large:
        out = pairs.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = pairs.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("w").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it is connected with, for every node of links(a, b) that isn't a root itself."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        edges = stored(_star(_star(edges, True), False), "stars")
        # Edges of equal number and digest are the same edges: every node points to its root.
        now = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("digest")).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
