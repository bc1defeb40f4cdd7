"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfacts.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id of the component) of every id in the edges ``a, b`` of longs.

    Every round hangs all neighbours of an id below the smallest of them: first those above the id, then those below
    it, which roughly halves the length of chains. All steps are joins and minima with partial aggregation; an id with
    very many edges is a skewed join key that adaptive execution splits. Only a count and a checksum reach the driver.
    Self-loops, repeated edges and an empty input are allowed.
    """
    now = cut(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        above = now.select(F.col("u").alias("w"), F.col("v").alias("u"))
        large = above.join(low, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        below = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = cut(below.union(lowest.select("u", F.col("m").alias("v"))).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.select("id", F.col("id").alias("component"))
    )
