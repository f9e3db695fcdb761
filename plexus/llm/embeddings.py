"""Embedding near-duplicates: spherical k-means cells, compared block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import save
from plexus.llm.components import components

SAMPLE_ROWS = 20_000   # different vectors that the cells are fitted on, about, at most
CELL_ROWS = 256        # vectors that a cell is planned for
MAX_CELLS = 2_048      # cells at most, so that their table may be broadcast
PROBES = 2             # cells that a vector belongs to: its nearest ones
BLOCK_ROWS = 1_024     # rows of a block; a larger cell is compared in pairs of blocks
_STEPS = 8


def unit_rows(lists: pa.ListArray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one in double precision, and the rows that have one."""
    out, good = np.zeros((len(lists), dimensions)), np.zeros(len(lists), bool)
    sizes = np.asarray(lists.value_lengths().fill_null(-1))
    rows = np.flatnonzero(sizes == dimensions)
    if len(rows):
        flat = lists.take(pa.array(rows)).flatten()
        values = np.array(flat.fill_null(np.nan), dtype=np.float64).reshape(len(rows), dimensions)
        with np.errstate(over="ignore", invalid="ignore"):
            scale = np.abs(values).max(axis=1)
            fine = np.isfinite(values).all(axis=1) & (scale > 0)
            values[fine] /= scale[fine, None]  # large components do not overflow
            out[rows[fine]] = values[fine] / np.linalg.norm(values[fine], axis=1)[:, None]
        good[rows[fine]] = True
    return out, good


def nearest_cells(vectors: np.ndarray, cells: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` cells with the largest cosine of each vector, nearest first."""
    n = min(n, len(cells))
    out = np.empty((len(vectors), n), np.int64)
    for at in range(0, len(vectors), 4096):
        score = vectors[at:at + 4096] @ cells.T
        top = np.argpartition(-score, n - 1, axis=1)[:, :n]
        order = np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable")
        out[at:at + 4096] = np.take_along_axis(top, order, 1)
    return out


def fit_cells(sample: np.ndarray, n_cells: int, steps: int = _STEPS, seed: int = 7) -> np.ndarray:
    """Spherical k-means: unit centres that maximise the cosine to their vectors."""
    random = np.random.default_rng(seed)
    n_cells = max(1, min(n_cells, len(sample)))
    centres = sample[np.sort(random.choice(len(sample), n_cells, replace=False))].copy()
    for _ in range(steps):
        cell = nearest_cells(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        norm = np.linalg.norm(sums, axis=1)
        lost = norm < 1e-12
        centres = np.where(lost[:, None], sample[random.integers(0, len(sample), n_cells)], sums / np.maximum(norm, 1e-12)[:, None])
    return centres


def _dimensions(distinct: DataFrame) -> int:
    top = (distinct.where("size(v) > 0").groupBy(F.size("v").alias("n")).agg(F.sum("copies").alias("c"))
           .orderBy(F.desc("c"), "n").first())
    return int(top["n"]) if top else 0


def _sample(distinct: DataFrame, dimensions: int, rows: int) -> tuple[np.ndarray, int]:
    fitting = distinct.where(F.size("v") == dimensions)
    n = fitting.count()
    part = fitting.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < min(1.0, rows / max(1, n)) * 1_000_000)
    got = part.select(F.col("v").cast("array<double>").alias("v"), "id").orderBy("id").toArrow()
    vectors, good = unit_rows(got.column("v").combine_chunks(), dimensions)
    return vectors[good], n


def _compare(threshold: float):
    """Links of one pair of blocks, summed per vector; groups inside it as stars."""
    def run(table: pa.Table) -> pa.Table:
        first = table.column("first")[0].as_py()
        second = table.column("second")[0].as_py()
        block = np.asarray(table.column("block"))
        cell = table.column("cell")[0].as_py()
        ids, copies = np.asarray(table.column("id")), np.asarray(table.column("copies"))
        width = len(table.column("unit")[0].as_py()) // 8
        vectors = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(-1, width)
        cells = np.array(table.column("cells").to_pylist(), np.int64).reshape(len(ids), -1)
        a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
        i, j = np.nonzero(vectors[a] @ vectors[b].T >= threshold)
        i, j = a[i], b[j]
        if first == second:
            i, j = i[i < j], j[i < j]
        # a pair that meets in several cells counts in the smallest of them
        shared = np.where((cells[i][:, :, None] == cells[j][:, None, :]).any(axis=2), cells[i], np.iinfo(np.int64).max)
        mine = shared.min(axis=1) == cell if len(i) else np.zeros(0, bool)
        i, j = i[mine], j[mine]
        links = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(j, weights=copies[i], minlength=len(ids))
        least = ids.copy()
        while len(i):
            before = least.copy()
            np.minimum.at(least, i, before[j])
            np.minimum.at(least, j, least[i])
            if (before == least).all():
                break
        hit = np.flatnonzero(links > 0)
        return pa.table({"id": pa.array(ids[hit], pa.int64()), "links": pa.array(links[hit].astype(np.int64)), "least": pa.array(least[hit], pa.int64())})
    return run


def embedding_dedup(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS, probes: int = PROBES) -> DataFrame:
    """Op 4. ``key, n_links, component_id, kept`` of every vector.

    Equal vectors are one class with a count, whatever their number. Cells are fitted on a bounded
    sample of classes; every class belongs to its ``probes`` nearest cells, and classes that share one are
    compared there in blocks by cosine in double precision. Links below the threshold do not occur;
    pairs without a common cell are missed (recall is measured in the tests). A cell of any size is cut
    into blocks by a hash; a pair of blocks returns sums and stars, never pairs.

    Vectors that are null, zero, of another length than most, or hold null or non-finite components
    link with nothing and stand alone. Repeated ids are vectors of their own in every count. A null id is
    the smallest and shown as null.
    """
    lowest = -(1 << 63) + 1
    rows = vectors.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("bigint"), F.lit(lowest)).alias("id"), F.col(vector).alias("v"))
    distinct = save(rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    dimensions = _dimensions(distinct)
    kind = vectors.schema[key].dataType
    shown = lambda c: F.when(F.col(c) != lowest, F.col(c)).cast(kind)
    if not dimensions:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("key").cast("bigint").alias("component_id"), F.lit(True).alias("kept"))
    sample, n = _sample(distinct, dimensions, sample_rows)
    cells = fit_cells(sample, min(MAX_CELLS, n // cell_rows + 1)) if len(sample) else np.zeros((1, dimensions))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, good = unit_rows(batch.column(0), dimensions)
            at = np.flatnonzero(good)
            near = nearest_cells(units[at], cells, probes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(at)), batch.column(2).take(pa.array(at)), pa.array([u.tobytes() for u in units[at]], pa.binary()),
                 pa.array(list(near), pa.list_(pa.int64()))], names=["id", "copies", "unit", "cells"])

    placed = (distinct.select(F.col("v").cast("array<double>").alias("v"), "id", "copies")
              .mapInArrow(assign, "id bigint, copies bigint, unit binary, cells array<bigint>"))
    placed = save(placed, "cells")
    in_cell = placed.withColumn("cell", F.explode("cells"))
    blocks = (in_cell.groupBy("cell").count().select("cell", F.ceil(F.col("count") / BLOCK_ROWS).alias("blocks")))  # MAX_CELLS rows at most
    member = (in_cell.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
              .select("cell", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "id", "copies", "unit", "cells"))
    found = save(member.groupBy("cell", "first", "second").applyInArrow(_compare(threshold), "id bigint, links bigint, least bigint"), "pairs")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("u"), F.col("least").alias("v")))
    good = (placed.select("id", "copies").join(links, "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
            .select(F.col("id").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")))
    classes = distinct.select("v", F.col("id").alias("class")).join(good, "class")
    return (rows.join(classes, "v", "left")
            .withColumn("component", F.coalesce("component", "id"))
            .select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    shown("component").cast("bigint").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")))
