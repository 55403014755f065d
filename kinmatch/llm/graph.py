"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a long, b long), root the smallest node reachable.

    Each round halves the depth of trees, so rounds grow with the logarithm of the longest chain. Minima are
    pre-aggregated, and joined back by node so that a hub's edges can be split over tasks. Edges with a null end
    are dropped; loops make nodes of their own.
    """
    both = edges.filter("a is not null and b is not null").select(F.col("a").cast("long"), F.col("b").cast("long"))
    nodes = both.filter("a = b").select(F.col("a").alias("node"))
    stars = materialize(both.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    nodes = materialize(nodes.union(stars.select("u")).union(stars.select("v")).distinct(), "nodes")
    state = None
    while True:
        # large star: every greater neighbour goes to the smallest neighbour
        two_way = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = two_way.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = two_way.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every smaller neighbour, and the node, go to the smallest neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        new = materialize(small, "stars")
        now = new.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        drop(stars)
        stars = new
        if now == state:
            break
        state = now
    return nodes.join(stars.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("root"))
