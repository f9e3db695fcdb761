"""Set operations, deduplication, conditional insert, update and delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.operators.constraints import condition
from plexus.types import ID


def union_classes(frames: Sequence[DataFrame]) -> DataFrame:
    """F01. One table from several; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def id_diff(left: DataFrame, right: DataFrame, key: str = ID) -> DataFrame:
    """F02. Ids on one side only, tagged by side."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return (a.join(b, key, "left_anti").withColumn("side", F.lit("left"))
            .unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right"))))


def first_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order``.

    Spark limits each group before the shuffle (WindowGroupLimit), so a key that fills a third
    of the table sends one row per task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def dedup_content(rows: DataFrame, content: str, key: str) -> DataFrame:
    """F03. One row per content, the one with the smallest key.

    Only (digest, key) pairs are aggregated, combined on the map side; the contents themselves
    are never shuffled by digest, so a group of copies cannot overload a task. What is joined back are
    the few keys that go.
    """
    digests = rows.select(F.col(key).alias("_key"), F.unhex(F.sha2(F.col(content), 256)).alias("_digest"))
    copied = (digests.groupBy("_digest").agg(F.min("_key").alias("_keep"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    gone = digests.join(copied, "_digest").where(F.col("_key") != F.col("_keep")).select("_key")
    return rows.join(gone, F.col(key) == F.col("_key"), "left_anti")


def insert_if_not_found(batch: DataFrame, existing: DataFrame, key: Sequence[str],
                        order: Sequence[str]) -> DataFrame:
    """F04. Rows of a batch to append: unknown keys only, the first row of each key."""
    known = existing.select(*key)
    return first_per_key(batch.join(known, list(key), "left_anti"), key, order)


def edge_key(src: Column, dst: Column) -> Column:
    """SHA-1 key of an edge from the keys of its ends."""
    return F.sha1(F.concat(src, dst))


def add_edge_if_not_found(batch: DataFrame, existing: DataFrame, key: str = "wf_sha1_hash") -> DataFrame:
    """F05. Edges to append, by their hash key."""
    return insert_if_not_found(batch, existing, [key], [c for c in batch.columns if c != key])


def update_properties(rows: DataFrame, constraints: Mapping[str, Sequence[Any]],
                      set_values: Mapping[str, Any] | None = None,
                      remove: Sequence[str] = ()) -> DataFrame:
    """F06. The whole table with properties set or removed on the rows that meet the constraints."""
    hit = F.coalesce(condition(rows, constraints), F.lit(False))
    changes = {}
    for name, value in (set_values or {}).items():
        new = value if isinstance(value, Column) else F.lit(value)
        changes[name] = F.when(hit, new).otherwise(F.col(name)) if name in rows.columns else F.when(hit, new)
    for name in remove:
        changes[name] = F.when(~hit, F.col(name))
    return rows.withColumns(changes)


def clean_by_predicate(rows: DataFrame, constraints: Mapping[str, Sequence[Any]]) -> DataFrame:
    """F07. The rows that stay after deleting those that meet the constraints."""
    return rows.where(~F.coalesce(condition(rows, constraints), F.lit(False)))
