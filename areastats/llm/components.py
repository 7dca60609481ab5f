"""Connected components of a graph of any size by alternating stars.

A large star ties the larger neighbours of every node to its smallest neighbour, a small star the
smaller ones. Both only move edges, and the graph becomes one star per component after a number
of rounds that grows with the logarithm of the longest path. A round is two aggregations that
combine on the map side and two joins; its result is written out, so neither lineage nor the
driver grows, and both join sides are plain tables that Spark can split at a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from areastats.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id it reaches, of every node with an edge to another.

    ``edges`` has integer columns ``a`` and ``b``; direction, repeats and loops do not matter.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = stage(current.distinct(), "edges")
    before = None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "smallest")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "edges")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = current.select(F.col("v").alias("u"), "v").distinct()
    return current.unionByName(roots).select(F.col("u").alias("id"), F.col("v").alias("component"))
