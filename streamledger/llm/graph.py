"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """(``id``, ``comp``) for every end of an edge (``a``, ``b``); ``comp`` is the smallest
    identifier that can be reached.

    A step only takes a minimum per node and joins it back (both combine or split hot
    nodes), so no task ever holds a node's neighbourhood; the number of steps grows with the
    logarithm of the graph's size. Every step is a written table.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = materialise(edges.where("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    mark = None
    while True:
        # large star: all larger neighbours of u are tied to the smallest one around u
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: u and its smaller neighbours are tied to the smallest of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        before, now = now, materialise(small, "edges")
        discard(before)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("comp"))
    return stars.union(now.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
