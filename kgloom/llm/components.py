"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import cut


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Join each node's (larger, or else smaller) neighbours to the smallest around it."""
    if larger:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    out = both.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    if not larger:
        out = out.union(least.select("a", F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for every node of `links` (columns a, b).

    Links may repeat, point either way or join a node to itself; links with a
    null end are left out.  Each round is written to the shared folder.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        links = cut(_stars(_stars(links, True), False).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        new = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"no fixpoint after {rounds} rounds")
    return links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").union(links.select(F.col("b"), F.col("b")).distinct())
