"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import settled


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each linked node; the root is the smallest node it can reach.

    Each step joins links with one minimum per node, so a node with very many links stays a set of rows.
    Links are written after each round, which cuts the lineage. Links of a node with itself and links with a
    null are left out.
    """
    x, y = F.col(a), F.col(b)
    edges = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges, before = settled(edges, "links"), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        edges = settled(small.where("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
