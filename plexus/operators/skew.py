"""Helpers that keep hot keys from ending up in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.session import materialise


def row_number_by_block(df: DataFrame, keys: Sequence[str], position: str, name: str,
                        start: int = 0, block: int = 50_000) -> DataFrame:
    """Running number of the rows of each key in order of an integer ``position``.

    A key with billions of rows is never sorted in one task: the position range is cut into
    blocks, rows are numbered inside (key, block), and the offsets come from the block counts
    (one small row per block). ``position`` must be unique within the key.
    """
    cut = F.floor(F.col(position) / F.lit(block)).cast("bigint")
    rows = df.withColumn("_block", cut)
    counts = rows.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_block").orderBy(position)
    return (rows.withColumn("_i", F.row_number().over(inside))
            .join(offsets, [*keys, "_block"])
            .withColumn(name, (F.col("_i") + F.col("_offset") + F.lit(start - 1)).cast("bigint"))
            .drop("_i", "_offset", "_block"))


def dense_index(values: DataFrame, column: str, name: str) -> DataFrame:
    """Number distinct values in their order from 0, without one task sorting them all.

    Values are cut into ranges and written once with their range number, so that the numbers stay
    what they are when a task is repeated. Rows are numbered inside each range; the offsets come
    from one count per range.
    """
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = materialise(values.repartitionByRange(parts, column).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(column)
    return (ranges.withColumn("_i", F.row_number().over(inside)).join(offsets, "_range")
            .withColumn(name, F.col("_i") + F.col("_offset") - 1).drop("_range", "_i", "_offset"))


def rank_in_key(df: DataFrame, key: str, order: Column, name: str) -> DataFrame:
    """Add the place of each row, from 0, among the rows of its key in order.

    Rows are cut into ranges of (key, order) and written once with the number of their range, so the
    rows of a hot key lie in many ranges; places are counted inside a range, and what stands before
    it comes from one count per key and range.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_order", order)
    ranges = materialise(rows.repartitionByRange(parts, key, "_order").withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(key, "_range").orderBy("_order")
    return (ranges.withColumn("_i", F.row_number().over(inside)).join(offsets, [key, "_range"])
            .withColumn(name, (F.col("_i") + F.col("_offset") - 1).cast("bigint")).drop("_order", "_range", "_i", "_offset"))
