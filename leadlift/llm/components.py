"""Connected components of an edge table, by alternating star contraction; every round is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.sources.staging import stage

MAX_ROUNDS = 200  # rounds grow with the logarithm of the longest chain; more means a fault


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest node of its component.

    Nodes are integers. Edges may repeat, in either direction; loops and edges with a null end are ignored. Only
    minima are gathered per node, so a node with very many edges is no burden on one task.
    """
    ends = edges.where("a is not null and b is not null and a <> b")
    # each edge points from the larger node to the smaller one
    stars = stage(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low"))
        lowest = lowest.select("a", F.least("a", "low").alias("low"))
        # larger neighbours move to the smallest node around
        large = stars.select(F.col("b").alias("a"), F.col("a").alias("larger")).join(lowest, "a")
        large = large.select(F.col("larger").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = stage(large, "large")
        # so do smaller ones, and the node itself
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        stars = stage(small.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct(), "stars")
        after = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if after == before and after[0] == after[2]:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point within {MAX_ROUNDS} rounds")
    roots = stars.select("b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
