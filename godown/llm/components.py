"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a node with any number of links is pre-aggregated and skew-split;
links are never gathered. Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from godown.session import cut_lineage


def free_finished(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written. It does so when the driver collects its
    garbage, which a driver that holds little may not do before the disks are full."""
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(1)  # they go in the background


def _least(pairs: DataFrame) -> DataFrame:
    """Add to (u, v) the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _least(down)
    to_least = near.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_least.unionByName(near.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _only_stars(links: DataFrame) -> bool:
    """Whether every node has one link down, to a node that has none itself: then the least node of each component is known. One
    statement; links that are stars from the first need no step."""
    tops = links.select(F.col("u").alias("v")).distinct()
    many = links.groupBy("u").count().filter("count > 1").select("u")
    return not many.unionByName(links.join(tops, "v", "left_semi").select("u")).limit(1).count()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; a component is named by its least node.

    Links with a null end or from a node to itself say nothing; repeated links count once.
    """
    now = cut_lineage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct())
    while not _only_stars(now):
        now = cut_lineage(_small_star(_large_star(now)))
    ends = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cut_lineage(ends.unionByName(roots))
