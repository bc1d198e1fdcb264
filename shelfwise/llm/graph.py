"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stage, unstage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Staged ``node, root`` of every node with an edge; root is the smallest
    node of its component.

    Alternating large and small stars: every round hangs the larger neighbours
    of a node, then the smaller ones, onto its smallest neighbour, until all
    edges point at a root.  Minima combine before the shuffle, so a hub's edges
    never meet in one task; rounds grow with the logarithm of the diameter.
    """
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(below.select("u", F.col("m").alias("v"))).distinct())
        new = stage(small, "edges")
        new_state = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        unstage(now)
        now = new
        if new_state == state:
            break
        state = new_state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
