"""Connected components of a large edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import Scratch


def _large_star(e: DataFrame) -> DataFrame:
    """Each node points its larger neighbours to the smallest node it knows."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, s: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` that isn't its
    component's smallest node. Minima are partially aggregated and joined back,
    so no task holds a hub's neighbours. Each round is written and reread; the
    rounds grow with the logarithm of the longest chain."""
    e = s.table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        e2 = s.table(_small_star(_large_star(e)), "star")
        mark = e2.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        s.drop(e)
        e = e2
        if tuple(mark) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(mark)
