"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is one aggregate and one join on the edge table, written to the shared
scratch folder; the number of steps grows with the logarithm of the longest chain,
and only edges, never adjacency lists, are kept together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerhawk.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    side = down.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return side.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` undirected links of longs -> ``(node, root)`` for every node with a
    link; root is the smallest node reachable. Self-links are dropped; an empty edge
    table gives an empty result."""
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a != b").distinct()
    edges = stored(_small_star(stored(edges, "cc")), "cc")
    before = _mark(edges)
    while True:
        edges = stored(_small_star(stored(_large_star(edges), "cc")), "cc")
        now = _mark(edges)
        if now == before:
            break
        before = now
    star = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
