"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum (combined map-side) joined back to the edges, so a node with very
many edges is never gathered; intermediate edge tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

MAX_STEPS = 60


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """Written ``node, root`` for every node of ``edges`` (columns ``a``, ``b``; any order, loops and
    repeats allowed); the root is the smallest node reachable."""
    given = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    spark, e, stored = given.sparkSession, given.where("a <> b"), None
    before = None
    for _ in range(MAX_STEPS):
        # every larger neighbour of a node is linked to the smallest of its neighbourhood
        both = _both_ways(e)
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every node and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
                      .select(F.col("x.b").alias("a"), F.col("x.m").alias("b")).where("a <> b").distinct())
        e = written(small, "edges")
        discard(spark, stored)
        stored = e
        # a fixed point is a set of stars; compare by size and an order-free digest
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
    nodes = _both_ways(given).select(F.col("a").alias("node")).distinct()
    out = written(nodes.join(e.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")), "components")
    discard(spark, given, stored)
    return out
