"""Connected components by alternating minimum labels, on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitsight.session import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): the least node of each component, for edges (a, b) of one orderable type.

    Rounds of large-star and small-star (Kiveris et al. 2014) until nothing changes; every round
    is written to the shared folder. A star's centre is found by an aggregation with map-side
    combining and its edges are joined back, so that a node with very many edges is no group of rows.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")), label)
        # Large star: neighbours above the node go to the node's least neighbour or itself.
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("up")).join(least, "a").select(F.col("up").alias("a"), F.least("a", "m").alias("b"))
        large = stored(large.where("a <> b").distinct(), label)
        # Small star: neighbours below and the node itself go to the least of them.
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), label)
        small = large.join(least, "a").select("a", "b", "m")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), label)
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
