"""Stored tables that change in place, part by part.

Plain files know no row delete, but Spark replaces single partitions of a table. A table is cut into parts by a hash of its
key. A delete or an update first counts, from the columns that it needs, which parts hold rows that it hits; only those are
read whole and written anew, all others keep their files. What a part is replaced by is staged until all of it is written, so a
job that fails leaves the table as it was, and one that runs again does the same.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.operators.constraints import condition
from plexus.operators.graph import neighbour_ids
from plexus.operators.upsert import update_properties
from plexus.session import materialise, release
from plexus.types import DST, ID, SRC

PART, HIT = "_part", "_hit"
MAX_PARTS = 10_000  # their numbers and counts go through the driver

Flag = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class PartTable:
    """A Parquet folder with a partition per part."""
    spark: SparkSession
    path: str
    key: str
    parts: int
    schema: T.StructType = field(repr=False)

    @classmethod
    def write(cls, rows: DataFrame, path: str, key: str = ID, parts: int = 64) -> PartTable:
        """Write ``rows`` in ``parts`` parts by a hash of ``key``. A part is one task's; choose parts so that one fits."""
        if not 0 < parts <= MAX_PARTS:
            raise ValueError(f"parts must lie between 1 and {MAX_PARTS}")
        table = cls(rows.sparkSession, path, key, parts, rows.schema)
        rows.withColumn(PART, table._part(F.col(key))).repartition(parts, PART).write.mode("overwrite").partitionBy(PART).parquet(path)
        return table

    def _part(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast(self.schema[self.key].dataType)), F.lit(self.parts)).cast("int")

    def _stored(self) -> DataFrame:
        fields = [*(T.StructField(f.name, f.dataType) for f in self.schema.fields), T.StructField(PART, T.IntegerType())]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.path)

    def rows(self) -> DataFrame:
        return self._stored().drop(PART)

    def rewrite(self, flag: Flag, change: Callable[[DataFrame], DataFrame] | None = None, within: Sequence[int] | None = None) -> list[int]:
        """Replace the parts that hold hit rows; returns their numbers.

        ``flag`` adds the boolean column ``_hit`` to rows of the table, by a condition or a join. Hit rows are deleted, or what
        ``change`` makes of them stays. ``within``: parts that are known to hold all hit rows.
        """
        stored = self._stored() if within is None else self._stored().where(F.col(PART).isin(list(within)))
        hit = F.coalesce(F.col(HIT), F.lit(False))
        counts = flag(stored).groupBy(PART).agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("n")).where("hits > 0").collect()  # a row per part
        touched = sorted(r[PART] for r in counts)
        if not touched:
            return []
        rows = flag(self._stored().where(F.col(PART).isin(touched)))
        kept = rows.where(~hit) if change is None else change(rows.withColumn(HIT, hit))
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        (kept.select(*columns, PART).repartition(len(touched), PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(PART).parquet(self.path))
        if change is None:
            nothing = self.spark.createDataFrame([], self.schema)
            for r in counts:
                if r["hits"] == r["n"]:  # a part without rows is not replaced by the write above
                    nothing.write.mode("overwrite").parquet(f"{self.path}/{PART}={r[PART]}")
        return touched

    def delete(self, constraints: Mapping[str, Sequence[Any]]) -> list[int]:
        """F07. Delete the rows that meet the constraints."""
        return self.rewrite(lambda rows: rows.withColumn(HIT, condition(rows, constraints)))

    def update(self, constraints: Mapping[str, Sequence[Any]], set_values: Mapping[str, Any] | None = None, remove: Sequence[str] = ()) -> list[int]:
        """F06. Set or remove properties of the rows that meet the constraints; columns must exist."""
        unknown = {*(set_values or {}), *remove} - {f.name for f in self.schema.fields}
        if unknown:
            raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")
        if self.key in {*(set_values or {}), *remove}:
            raise ValueError("the key decides on a row's part and stays")
        return self.rewrite(lambda rows: rows.withColumn(HIT, condition(rows, constraints)), lambda rows: update_properties(rows, constraints, set_values, remove))

    def delete_keys(self, ids: DataFrame) -> list[int]:
        """Delete the rows of the keys in the first column of ``ids``. Only the parts that these hash to are looked at."""
        known = ids.select(F.col(ids.columns[0]).cast(self.schema[self.key].dataType).alias("_gone")).where("_gone IS NOT NULL").distinct()
        within = [r[0] for r in known.select(self._part(F.col("_gone"))).distinct().collect()]  # a row per part at most
        return self.rewrite(lambda rows: _among(rows, self.key, known), within=within) if within else []


def _among(rows: DataFrame, column: str, ids: DataFrame, gone: str = "_gone") -> DataFrame:
    marked = ids.select(F.col(gone), F.lit(True).alias("_in"))
    return rows.join(marked, F.col(column) == F.col(gone), "left").withColumn(HIT, F.col("_in").isNotNull()).drop(gone, "_in")


def delete_edges(edges: PartTable, gone: DataFrame) -> list[int]:
    """Delete the edges that begin or end at an id of ``gone``; the ends alone are read to find them."""
    ids = gone.select(F.col(gone.columns[0]).cast("string").alias("_gone")).distinct()

    def flag(rows: DataFrame) -> DataFrame:
        first = _among(rows, SRC, ids).withColumnRenamed(HIT, "_from")
        return _among(first, DST, ids).withColumn(HIT, F.col(HIT) | F.col("_from")).drop("_from")

    return edges.rewrite(flag)


@dataclass(frozen=True)
class StoredWorkflow:
    """Specs, runs, object tables by class and edges, each stored in parts."""
    specs: PartTable
    runs: PartTable
    objects: Mapping[str, PartTable]
    edges: PartTable

    def delete_specs(self, spec_ids: DataFrame, owned: Sequence[str] = ()) -> dict[str, list[int]]:
        """K04, K06. Remove specs with runs, objects, blobs reached from these, and all their edges; the parts that changed by table.

        What goes is found before anything is deleted. A run that fails in between may be run again with the same ids:
        blobs go before the edges that lead to them, edges before the objects, specs last.
        """
        ids = materialise(spec_ids.select(F.col(spec_ids.columns[0]).alias("spec_id")).distinct(), "spec-ids")
        text = lambda c: F.col(c).cast("string").alias(ID)
        runs = materialise(self.runs.rows().join(ids, "spec_id", "left_semi").select(text("run_id")), "runs")
        objects = [t.rows().join(ids, "spec_id", "left_semi").select(text(ID)) for name, t in self.objects.items() if name not in owned]
        gone = materialise(reduce(DataFrame.unionByName, objects, ids.select(text("spec_id")).unionByName(runs)), "gone")
        reached = materialise(neighbour_ids(gone, self.edges.rows(), "out"), "reached")
        blobs = [self.objects[name].rows().join(reached, ID, "left_semi").select(text(ID)) for name in owned]
        ends = materialise(reduce(DataFrame.unionByName, blobs, gone), "ends")
        changed = {name: self.objects[name].delete_keys(reached) for name in owned}
        changed["edges"] = delete_edges(self.edges, ends)
        changed |= {name: t.delete_keys(gone) for name, t in self.objects.items() if name not in owned}
        changed["runs"] = self.runs.delete_keys(runs)
        changed["specs"] = self.specs.delete_keys(ids)
        release(ids, runs, gone, reached, ends)
        return changed
