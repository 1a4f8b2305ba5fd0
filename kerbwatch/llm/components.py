"""Connected components of a link table by alternating star operations, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbwatch.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (columns a, b); root is the smallest node reachable.

    Large-star hangs every larger neighbour on a node's smallest one, small-star does so with the smaller
    ones. Both are a minimum per node (combined before the shuffle) and a join with the links, so a node
    with very many links stays splittable. Rounds grow with the logarithm of a component's size. Each round
    is a written table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "links")
    before = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m"))
        large = both.join(least, both.a == least.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        kept = large.join(low, large.a == low.u)
        small = kept.select(F.col("b").alias("a"), F.col("m").alias("b")).union(kept.select("a", F.col("m").alias("b")))
        edges = materialise(small.where("a <> b").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
