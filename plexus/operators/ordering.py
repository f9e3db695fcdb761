"""Paging, ordering, sampling, numbering and frame windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.operators.skew import row_number_by_block
from plexus.types import ID


def page(df: DataFrame, batch_id: int = 0, batch_size: int = 100, key: str = ID) -> DataFrame:
    """E01. One page in id order. Pages beyond the first count the ids of each range of them, and then sort the range
    that the page lies in, so no task gathers the rows before it. Ids are not null."""
    first = batch_id * batch_size
    if not first:
        return df.orderBy(key).limit(batch_size)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.select(F.col(key).alias("k")).repartitionByRange(parts, "k").groupBy(F.spark_partition_id().alias("r"))
    counted = ranges.agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).orderBy("low").collect()  # a row per range
    before, hit, skipped = 0, [], 0
    for r in counted:
        if before + r["n"] > first and before < first + batch_size:
            skipped = skipped if hit else before
            hit.append(r)
        before += r["n"]
    if not hit:
        return df.limit(0)
    inside = df.where(F.col(key).between(F.lit(hit[0]["low"]), F.lit(hit[-1]["high"])))
    return inside.orderBy(key).offset(first - skipped).limit(batch_size)


def page_after(df: DataFrame, after: str | None, batch_size: int = 100, key: str = ID) -> DataFrame:
    """E01. The page that follows an id: deep pages cost no more than the first one."""
    rows = df if after is None else df.where(F.col(key) > after)
    return rows.orderBy(key).limit(batch_size)


def head_n(df: DataFrame, n: int, key: str = ID) -> DataFrame:
    """E02. The first ``n`` rows in key order, a wanted cap on what is loaded."""
    return df.orderBy(key).limit(n)


def order_by(df: DataFrame, *columns: str | Column, key: str = ID) -> DataFrame:
    """E03. User order with the id as last column: one value shared by many rows still splits."""
    return df.orderBy(*columns, key)


def sample_hash(key: str | Column, seed: int = 42) -> Column:
    """A repeatable 32-bit number per key."""
    c = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def sample_percent(df: DataFrame, percent: float, key: str, seed: int = 42) -> DataFrame:
    """E04. Exactly ``floor(rows * percent / 100)`` rows, the same ones in every run.

    Rows are ranked by a hash of their key. A histogram of the upper hash bits (at most 65,536
    rows) finds the hash range where the sample ends; only that range is ranked row by row.
    """
    rows = df.withColumn("_h", sample_hash(key, seed)).withColumn("_b", F.shiftright("_h", 16).cast("int"))
    hist = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plan = (hist.withColumn("_upto", F.sum("_n").over(upto))
            .withColumn("_take", F.floor(F.sum("_n").over(everything) * F.lit(percent) / F.lit(100)))
            .select("_b", F.greatest(F.lit(0), F.least("_n", F.col("_take") - (F.col("_upto") - F.col("_n"))))
                    .alias("_keep"), "_n")
            .where("_keep > 0"))
    tagged = rows.join(F.broadcast(plan), "_b")  # at most 65,536 rows by construction
    whole = tagged.where("_keep = _n")
    edge = (tagged.where("_keep < _n")
            .withColumn("_i", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
            .where("_i <= _keep").drop("_i"))
    return whole.unionByName(edge).drop("_h", "_b", "_keep", "_n")


def segment_number(df: DataFrame, document: str, position: str, start: int = 0) -> DataFrame:
    """E05. Running number inside a document, skew-safe for very long documents."""
    return row_number_by_block(df, [document], position, "segment_number", start)


def clip_windows(videos: DataFrame, rate: float = 1.0, frames: str = "n_frames", fps: str = "fps") -> DataFrame:
    """E06. Sample every ceil(fps / rate) frames; one row per clip ``[start, stop)``."""
    step = F.ceil(F.col(fps) / F.lit(float(rate))).cast("bigint")
    n = F.col(frames).cast("bigint")
    return (videos.where((F.col(frames) > 0) & (F.col(fps) > 0)).withColumn("step", step)
            .withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, F.col("step"))))
            .withColumn("stop", F.least(F.col("start") + F.col("step"), n))
            .withColumn("clip", (F.col("start") / F.col("step")).cast("bigint")).drop("step"))


def frame_interval(frames: DataFrame, start: int, stop: int, step: int, frame: str = "frame") -> DataFrame:
    """E07. Frames from ``start`` up to, not including, ``stop``, every ``step``."""
    if step <= 0:
        raise ValueError("step must be positive")
    f = F.col(frame)
    return frames.where((f >= start) & (f < stop) & ((f - F.lit(start)) % F.lit(step) == 0))
