"""Exact search for many queries: vectors in cells with a centre and a radius, cells too far away are left out.

Each vector lies in the cell of its nearest centre. A query first meets the nearest cells that hold enough vectors; its k-th
neighbour there bounds what is still of interest. By the triangle inequality no vector of a cell is nearer to a query than
the centre is, less the radius, so of the other cells only those within the bound are met. Nothing is lost, and on data that is not
spread evenly most pairs of a query and a cell never meet.

On evenly spread data a query meets most cells. So it is not sent to each cell by itself: neighbouring cells are a part of as many rows
as a task may hold, and a query goes to a part once, with a bit for each of its cells. What is shuffled is a row per query and part
and a row per vector and block of queries, and never more than that, though each query is scored with all vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.operators.vectors import BLOCK_ROWS, COSINE, EUCLIDEAN, _arrow_vectors, _Best, _final, _hit_schema, _meet, _pair_blocks, placed, to_arrow
from plexus.session import materialise

SAMPLE_ROWS = 20_000  # vectors that the centres are fitted on, about
MAX_CELLS = 2_048     # so that their table goes to every task
BLOCK_BYTES = 32 << 20  # of the vectors of a block in double precision, if BLOCK_ROWS of them are more
_STEPS = 4


class Cells(NamedTuple):
    """Centre, radius and number of vectors of each cell that is not empty."""
    number: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    count: np.ndarray


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def fit(sample: np.ndarray, n: int, seed: int = 5) -> np.ndarray:
    """Centres by a few steps of k-means."""
    random = np.random.default_rng(seed)
    centres = sample[random.choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(_STEPS):
        cell = np.concatenate([distances(sample[at:at + 4096], centres).argmin(axis=1) for at in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        count = np.bincount(cell, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


def least_cost(queries: np.ndarray, cells: Cells, metric: str) -> np.ndarray:
    """Bound of the cost of any vector of each cell: the distance for L2, the negative score otherwise."""
    if metric in (COSINE, EUCLIDEAN):
        rounding = 1e-7 * (1 + np.linalg.norm(queries, axis=1)[:, None] + np.linalg.norm(cells.centre, axis=1)[None, :])
        apart = np.maximum(distances(queries, cells.centre) - cells.radius[None, :] - rounding, 0)
        return apart if metric == EUCLIDEAN else apart ** 2 / 2 - 1
    reach = np.linalg.norm(queries, axis=1)[:, None] * cells.radius[None, :]
    return -(queries @ cells.centre.T) - reach * (1 + 1e-9)


def _first_cells(queries: np.ndarray, cells: Cells, enough: int) -> np.ndarray:
    """The nearest cells that together hold enough vectors, as marks."""
    apart = distances(queries, cells.centre)
    nearest = apart.argmin(axis=1)
    out = np.zeros(apart.shape, bool)
    out[np.arange(len(out)), nearest] = True
    more = np.nonzero(cells.count[nearest] < enough)[0]
    order = np.argsort(apart[more], axis=1, kind="stable")
    before = np.cumsum(cells.count[order], axis=1) - cells.count[order]
    marks = np.zeros(order.shape, bool)
    np.put_along_axis(marks, order, before < enough, axis=1)
    out[more] = marks
    return out


def parts(cells: Cells, rows: int) -> np.ndarray:
    """The part of each cell: neighbouring cells of at most so many vectors together, or a larger cell by itself."""
    coarse = fit(cells.centre, -(-int(cells.count.sum()) // rows))
    out, part, filled = np.zeros(len(cells.number), np.int32), -1, rows
    for i in np.argsort(distances(cells.centre, coarse).argmin(axis=1), kind="stable"):
        if filled + cells.count[i] > rows or part < 0:
            part, filled = part + 1, 0
        out[i], filled = part, filled + cells.count[i]
    return out


def _part_topk(k: int, metric: str, id_column: str, exclude_self: bool, digits: int | None, place: np.ndarray, schema: T.StructType):
    """Best k per query of a block of a part, each cell with the queries that meet it. ``place``: of a cell's bit, by its number."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        target = to_arrow(schema)
        if not len(left) or not len(right):
            return target.empty_table()
        query_ids, limit = left.column("query_id").to_numpy(), left.column("_limit").to_numpy()
        meets = np.frombuffer(b"".join(left.column("_meets").to_pylist()), np.uint8).reshape(len(left), -1)
        order = np.argsort(right.column("_cell").to_numpy(), kind="stable")
        cell, ids = right.column("_cell").to_numpy()[order], right.column("_vid").to_numpy()[order]
        data = _arrow_vectors(right.column("_vec"))[order]
        best = _Best(_arrow_vectors(left.column("query_vector")), k, metric, digits, limit)
        starts = np.nonzero(np.diff(cell, prepend=-1))[0]
        for at, to in zip(starts, [*starts[1:], len(cell)]):
            bit = place[cell[at]]
            rows = np.nonzero(meets[:, bit >> 3] & (128 >> (bit & 7)))[0]
            if len(rows):
                best.add(data[at:to], ids[at:to], query_ids if exclude_self else None, rows)
        index, found, distance = best.rows()
        return pa.Table.from_pydict({"query_id": query_ids[index].tolist(), id_column: found.tolist(), "_distance": distance}, schema=target)
    return run


class CellSearch:
    """The two passes of a search; ``near`` and ``far`` are the queries with the cells that they meet."""

    def __init__(self, asked: DataFrame, pool: DataFrame, n: int, k: int, metric: str, id_column: str, vector_column: str,
                 exclude_self: bool, digits: int | None, block_rows: int) -> None:
        self.metric, self.k, self.digits, self.id_column, self.enough = metric, k, digits, id_column, k + exclude_self
        rows = pool.select(F.col(id_column).alias("_vid"), F.col(vector_column).alias("_vec"))
        self.assigned = self._assigned(rows, self._centres(rows, n, block_rows))
        self.schema = _hit_schema(asked, pool, "query_id", id_column)
        self.asked, self.exclude_self = asked, exclude_self
        self.rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, self.cells.centre.shape[1]))))
        self.near = self._probes(asked, lambda cost, first, bound: first)
        near = _meet(self.near, self.assigned.select("_vid", "_vec", "_cell"), ["_cell"], k, metric, id_column, self.schema, exclude_self, digits, self.rows)
        self.found = materialise(near, "near")  # read for the bounds and for the result
        bound = _final(self.found, k, id_column, metric, salted=True).where(F.col("rank") == k).select("query_id", F.col("_distance").alias("bound"))
        self.bounded = asked.join(bound, "query_id", "left")
        self.far = self._probes(self.bounded, self._within)

    @staticmethod
    def _within(cost: np.ndarray, first: np.ndarray, bound: np.ndarray) -> np.ndarray:
        return ~first & (cost <= bound[:, None])

    def _centres(self, rows: DataFrame, n: int, block_rows: int) -> np.ndarray:
        share = min(1.0, SAMPLE_ROWS / n)
        some = rows.where(F.pmod(F.xxhash64("_vid"), F.lit(1 << 20)) < int(share * (1 << 20))).orderBy("_vid").limit(2 * SAMPLE_ROWS)
        sample = placed(_arrow_vectors(some.select("_vec").toArrow().column(0)), self.metric)
        return fit(sample, min(MAX_CELLS, -(-n // block_rows))) if len(sample) else np.empty((0, 0))

    def _assigned(self, rows: DataFrame, centres: np.ndarray) -> DataFrame:
        """Vectors with their cell and their distance from its centre, written once; sets ``cells``."""
        metric = self.metric
        schema = T.StructType([*rows.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_gap", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                data = placed(_arrow_vectors(batch.column(1)), metric)
                cell, gap = np.zeros(len(data), np.int32), np.zeros(len(data))
                for at in range(0, len(data), 4096):
                    part = distances(data[at:at + 4096], centres)
                    cell[at:at + 4096] = part.argmin(axis=1)
                gap = np.linalg.norm(data - centres[cell], axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(gap)], schema=to_arrow(schema))

        assigned = materialise(rows.mapInArrow(run, schema), "cells")
        sizes = assigned.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_gap").alias("r")).orderBy("_cell").toPandas()  # MAX_CELLS rows at most
        number = sizes["_cell"].to_numpy()
        self.cells = Cells(number, centres[number], sizes["r"].to_numpy(), sizes["n"].to_numpy())
        return assigned

    def _probes(self, queries: DataFrame, choose: Callable[..., np.ndarray], part: np.ndarray | None = None) -> DataFrame:
        """A row per query and cell that it meets; with the cells' ``part``, a row per query and part, its cells as bits."""
        meets = [T.StructField("_cell", T.IntegerType())] if part is None else [
            T.StructField("_part", T.IntegerType()), T.StructField("_limit", T.DoubleType()), T.StructField("_meets", T.BinaryType())]
        schema = T.StructType([queries.schema["query_id"], queries.schema["query_vector"], *meets])
        table, metric, enough = queries.sparkSession.sparkContext.broadcast(tuple(self.cells)), self.metric, self.enough  # no class: workers have no package
        slack = 1e-9 + (0 if self.digits is None else 10.0 ** -self.digits)  # ties among rounded distances count

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = Cells(*table.value)
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    some = batch.slice(at, 1024)
                    data = placed(_arrow_vectors(some.column(1)), metric)
                    if data.shape[1] != cells.centre.shape[1]:
                        raise ValueError(f"query has {data.shape[1]} dimensions, the set {cells.centre.shape[1]}")
                    bound = np.full(len(data), np.inf)
                    if some.num_columns > 2:
                        known = some.column(2).to_numpy(zero_copy_only=False).astype(float)
                        cost = known if metric == EUCLIDEAN else -known
                        bound = np.where(np.isnan(cost), np.inf, cost + slack * (1 + np.abs(cost)))
                    chosen = choose(least_cost(data, cells, metric), _first_cells(data, cells, enough), bound)
                    if part is None:
                        row, cell = np.nonzero(chosen)
                        yield probed(some, row, pa.array(cells.number[cell].astype(np.int32)))
                        continue
                    for p in range(part.max() + 1):
                        bits = np.packbits(chosen[:, part == p], axis=1)
                        row = np.nonzero(bits.any(axis=1))[0]
                        yield probed(some, row, pa.array(np.full(len(row), p, np.int32)), pa.array(bound[row]), pa.array([x.tobytes() for x in bits[row]], pa.binary()))

        def probed(some: pa.RecordBatch, row: np.ndarray, *columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row)), *columns], schema=to_arrow(schema))

        return queries.mapInArrow(run, schema)

    def partial(self) -> DataFrame:
        """The best k of each query and block."""
        part = parts(self.cells, self.rows)
        place = np.zeros(self.cells.number.max() + 1, np.int64)
        for p in range(part.max() + 1):
            place[self.cells.number[part == p]] = np.arange((part == p).sum())
        of = self.asked.sparkSession.createDataFrame([(int(c), int(p)) for c, p in zip(self.cells.number, part)], "_cell int, _part int")
        right = self.assigned.select("_vid", "_vec", "_cell").join(F.broadcast(of), "_cell")
        run = _part_topk(self.k, self.metric, self.id_column, self.exclude_self, self.digits, place, self.schema)
        return self.found.unionByName(_pair_blocks(self._probes(self.bounded, self._within, part), right, ["_part"], run, self.schema, self.rows))

    def visits(self) -> DataFrame:
        """The pairs of a query and a cell that meet; all others are skipped."""
        return self.near.select("query_id", "_cell").unionByName(self.far.select("query_id", "_cell"))
