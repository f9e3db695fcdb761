"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import release, save


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest one around."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, is linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, component)`` of every node with a link; the component is its smallest node.

    Links of null and of a node with itself are left out. A round costs four shuffles of links, the
    number of rounds grows with the logarithm of the longest chain. Each round is written to the
    shared folder; only a count and a checksum reach the driver. Hubs lie on the large side of a
    join against one row per node, which Spark splits where it is skewed.
    """
    now = save(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
               .where("u > v").distinct(), "links")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(now)
    while seen[0]:
        old, now = now, save(_small_star(_large_star(now)).distinct(), "links")
        before, seen = seen, mark(now)
        release(old)
        if before == seen:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
