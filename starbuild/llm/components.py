"""Connected components by alternating large-star and small-star joins.

Every step is a grouped minimum (added up before the shuffle) and a join back, written
to the shared folder, so a lost executor costs one step and no link list ever leaves
the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    """Count and an order-free checksum."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for every node that has an edge ``u``-``v``."""
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    seen = _print(now)
    while seen[0]:
        now = stage(_small_star(_large_star(now)), "stars")
        new = _print(now)
        if new == seen:
            break
        seen = new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
