"""Nearest-neighbour search, diversity re-ranking and vector packing.

Exact search never forms (query, vector) pair rows. A task multiplies a block of queries with a
block of vectors and keeps the best k per query, so what is shuffled is k rows per query and block.

* A few queries (size checked): every task gets the query block; the vectors are scanned where they lie.
* Many queries: vectors lie in cells, and a query meets the cells that may hold one of its neighbours (``cells``).
  Both sides are cut into blocks by count, so no cell can outgrow a task.
* For cosines a task first multiplies unit vectors in single precision. That product's error has a bound, so only pairs that
  may still be among the best k are scored in double precision; no pair is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.operators.constraints import constrain

# Metrics; for the first two the largest value is the nearest.
COSINE, INNER_PRODUCT, EUCLIDEAN = "CS", "IP", "L2"

SCAN_QUERY_BYTES = 32 << 20  # a query block that every task may hold
SCAN_QUERIES = 4096          # and its rows
HIT_BYTES = 64               # of a hit, about
BLOCK_ROWS = 20_000          # rows of a block in the two-sided search
SALTS = 16                   # parts of a query's hits that are ranked by themselves first
CHUNK_SCORES = 4 << 20       # scores that a task holds at a time
CHUNK_VALUES = 1 << 20       # components of vectors that are laid side by side
FEW_PAIRS = 0.05             # share of a chunk up to which pairs are scored one by one


def check_search(k: int, metric: str = COSINE, **inputs: Any) -> None:
    """Arguments of a search: exactly one input, a positive k, a known metric."""
    if inputs and sum(v is not None for v in inputs.values()) != 1:
        raise ValueError(f"give exactly one of {', '.join(inputs)}")
    if k is None or k <= 0:
        raise ValueError("k must be a positive integer")
    if metric not in (COSINE, INNER_PRODUCT, EUCLIDEAN):
        raise ValueError(f"unknown metric {metric}")


def _matrix(values: Sequence, dimensions: int | None = None) -> np.ndarray:
    m = np.asarray([np.asarray(v, dtype=np.float64) for v in values])
    if m.ndim != 2 or (dimensions is not None and m.shape[1] != dimensions):
        raise ValueError(f"vectors must be numeric and have {dimensions} dimensions")
    return m


def placed(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Where vectors lie: cosines depend on directions alone."""
    if metric != COSINE:
        return vectors
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def _scores(queries: np.ndarray, vectors: np.ndarray, metric: str, digits: int | None) -> np.ndarray:
    """Distances of all queries to all vectors of two blocks; for CS and IP larger is nearer."""
    if metric == EUCLIDEAN:
        # differences per query: exact where the expanded form would cancel
        out = np.stack([np.sqrt(np.square(vectors - q).sum(axis=1)) for q in queries])
    else:
        out = queries @ vectors.T
        if metric == COSINE:
            norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
            out = np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)
    return out if digits is None else np.round(out, digits)


class _Best:
    """The best k vectors per query seen so far; ties go to the smaller id.

    ``limit``: a cost per query that its k-th neighbour is known not to exceed; what costs more is left out.
    """

    def __init__(self, matrix: np.ndarray, k: int, metric: str, digits: int | None, limit: np.ndarray | None = None):
        self.matrix, self.k, self.metric, self.digits = matrix, k, metric, digits
        self.sign = 1.0 if metric == EUCLIDEAN else -1.0
        self.cost = np.full((len(matrix), k), np.inf)
        self.ids: np.ndarray | None = None
        self.limit = np.full(len(matrix), np.inf) if limit is None else limit
        self.last = self.limit.copy()  # costs up to this are of interest
        self.rough = placed(matrix, metric).astype(np.float32) if metric == COSINE else None

    def add(self, vectors: np.ndarray, ids: np.ndarray, own: np.ndarray | None = None, rows: np.ndarray | None = None) -> None:
        """Score a batch, a chunk at a time. ``own``: the id that each query leaves out. ``rows``: the queries, if not all."""
        if not len(vectors):
            return
        if self.ids is None:
            self.ids = np.full(self.cost.shape, ids[0], dtype=ids.dtype)  # free places have an infinite cost
        rows = np.arange(len(self.matrix)) if rows is None else rows
        whole = len(rows) == len(self.matrix)
        rough = None if self.rough is None else (self.rough if whole else self.rough[rows], placed(vectors, COSINE).astype(np.float32))
        matrix = None
        step = max(1, CHUNK_SCORES // max(1, len(rows)))
        for at in range(0, len(vectors), step):
            part = slice(at, at + step)
            pairs = None if rough is None else self._near(rough[0], rough[1][part], self.last[rows])
            if pairs is not None:
                self._merge_pairs(rows[pairs[0]], pairs[1], vectors[part], ids[part], own)
                continue
            if matrix is None:
                matrix = self.matrix if whole else self.matrix[rows]
            cost = self.sign * _scores(matrix, vectors[part], self.metric, self.digits)
            if own is not None:
                cost[own[rows][:, None] == ids[part][None, :]] = np.inf
            self._merge(rows, cost, ids[part])

    def _near(self, queries: np.ndarray, vectors: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Places of the pairs whose cosine may reach what is of interest, None if they are not few.

        A sum of d products of unit vectors' components is off by less than (d + 8) / 2**23 in single precision.
        """
        error = (queries.shape[1] + 8) * 2.0 ** -23 + (0 if self.digits is None else 10.0 ** -self.digits)
        near = queries @ vectors.T >= (-last - error).astype(np.float32)[:, None]
        return np.divmod(np.flatnonzero(near), len(vectors)) if np.count_nonzero(near) <= FEW_PAIRS * near.size else None  # faster than by two axes

    def _merge_pairs(self, query: np.ndarray, place: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: np.ndarray | None) -> None:
        norms = np.linalg.norm(vectors, axis=1)
        cost, step = np.empty(len(query)), max(1, CHUNK_VALUES // max(1, vectors.shape[1]))
        for at in range(0, len(query), step):
            part = slice(at, at + step)
            a, b = self.matrix[query[part]], place[part]
            product, norm = np.einsum("ij,ij->i", a, vectors[b]), np.linalg.norm(a, axis=1) * norms[b]
            cost[part] = -np.divide(product, norm, out=np.zeros_like(product), where=norm > 0)
        if self.digits is not None:
            cost = np.round(cost, self.digits)
        keep = (cost <= self.last[query]) & np.isfinite(cost)
        if own is not None:
            keep &= own[query] != ids[place]
        if not keep.any():
            return
        query, cost, found = query[keep], cost[keep], ids[place[keep]]
        rows, line = np.unique(query, return_inverse=True)
        line = np.concatenate([np.repeat(np.arange(len(rows)), self.k), line])
        all_cost, all_ids = np.concatenate([self.cost[rows].ravel(), cost]), np.concatenate([self.ids[rows].ravel(), found])
        order = np.lexsort((all_ids, all_cost, line))
        best = order[np.searchsorted(line[order], np.arange(len(rows)))[:, None] + np.arange(self.k)]
        self.cost[rows], self.ids[rows] = all_cost[best], all_ids[best]
        self.last[rows] = np.minimum(self.limit[rows], self.cost[rows].max(axis=1))

    def _merge(self, rows: np.ndarray, cost: np.ndarray, ids: np.ndarray) -> None:
        some = np.nonzero(((cost <= self.last[rows][:, None]) & np.isfinite(cost)).any(axis=1))[0]
        if not len(some):
            return
        rows, cost = rows[some], cost[some]
        all_cost = np.concatenate([self.cost[rows], cost], axis=1)
        all_ids = np.concatenate([self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        bound = np.partition(all_cost, self.k - 1, axis=1)[:, self.k - 1]
        near = all_cost <= bound[:, None]
        exact = near.sum(axis=1) == self.k
        at = np.nonzero(near[exact])[1].reshape(-1, self.k)
        self.cost[rows[exact]] = np.take_along_axis(all_cost[exact], at, axis=1)
        self.ids[rows[exact]] = np.take_along_axis(all_ids[exact], at, axis=1)
        for i in np.nonzero(~exact)[0]:  # ties at the border: smaller ids first
            places = np.nonzero(near[i])[0]
            places = places[np.lexsort((all_ids[i, places], all_cost[i, places]))][: self.k]
            self.cost[rows[i]], self.ids[rows[i]] = all_cost[i, places], all_ids[i, places]
        self.last[rows] = np.minimum(self.limit[rows], self.cost[rows].max(axis=1))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, vector id, distance) of everything kept."""
        query, place = np.nonzero(np.isfinite(self.cost) & (self.cost <= self.limit[:, None]))
        ids = np.empty(0) if self.ids is None else self.ids[query, place]
        return query, ids, self.sign * self.cost[query, place]


def _arrow_vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if n == 0:
        return np.empty((0, 0))
    if len(flat) % n or (np.diff(column.offsets.to_numpy()) != len(flat) // n).any():
        raise ValueError("vectors of one set must all have the same number of dimensions")
    return flat.reshape(n, -1).astype(np.float64)


def _hit_schema(queries: DataFrame, vectors: DataFrame, query_id: str, id_column: str) -> T.StructType:
    return T.StructType([T.StructField("query_id", queries.schema[query_id].dataType),
                         T.StructField(id_column, vectors.schema[id_column].dataType),
                         T.StructField("_distance", T.DoubleType())])


def _final(partial: DataFrame, k: int, id_column: str, metric: str, salted: bool = False) -> DataFrame:
    """The best k of what the blocks found. ``salted``: of parts of it first, where a query may meet very many blocks."""
    order = F.asc("_distance") if metric == EUCLIDEAN else F.desc("_distance")
    if salted:
        part = Window.partitionBy("query_id", F.pmod(F.xxhash64(id_column), F.lit(SALTS))).orderBy(order, F.asc(id_column))
        partial = partial.withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= k).drop("_place")
    w = Window.partitionBy("query_id").orderBy(order, F.asc(id_column))
    return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def find_similar(queries: DataFrame, vectors: DataFrame, k: int = 10, metric: str = COSINE, *,
                 query_id: str = "query_id", query_vector: str = "query_vector", id_column: str = "_uniqueid",
                 vector_column: str = "_vector", constraints: Mapping[str, Sequence[Any]] | None = None,
                 knn_first: bool = True, exclude_self: bool = False, digits: int | None = None,
                 max_scan_bytes: int = SCAN_QUERY_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """H01. The k nearest vectors of each query: ``query_id, <id>, _distance, rank``.

    H02. With ``constraints``: ``knn_first`` true searches and then filters (may give fewer than k),
    false filters the vectors first. Ids are unique. Rows and queries without a vector find nothing.
    """
    hits, _ = _search(queries, vectors, k, metric, query_id, query_vector, id_column, vector_column, constraints, knn_first, exclude_self,
                      digits, max_scan_bytes, block_rows)
    return hits


def _search(queries: DataFrame, vectors: DataFrame, k: int, metric: str, query_id: str, query_vector: str, id_column: str, vector_column: str,
            constraints: Mapping[str, Sequence[Any]] | None, knn_first: bool, exclude_self: bool, digits: int | None, max_scan_bytes: int,
            block_rows: int) -> tuple[DataFrame, int | None]:
    """The hits, and how many there are at most if that is known."""
    check_search(k, metric)
    vectors = vectors.where(F.col(vector_column).isNotNull())
    pool = vectors if constraints is None or knn_first else constrain(vectors, constraints)
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("query_vector")).where("query_vector IS NOT NULL")
    block = _query_block(asked, max_scan_bytes)
    if block is not None:
        partial = _scan(asked, block, pool, k, metric, id_column, vector_column, exclude_self, digits)
    else:
        partial = _many(asked, pool, k, metric, id_column, vector_column, exclude_self, digits, block_rows)
    hits = _final(partial, k, id_column, metric, salted=block is None)
    most = None if block is None else len(block[0]) * k
    if constraints is not None and knn_first:
        allowed = constrain(vectors, constraints).select(id_column)
        if most is not None and most * HIT_BYTES <= SCAN_QUERY_BYTES:  # so few hits go to the ids, which stay where they lie
            hits = allowed.join(F.broadcast(hits), id_column)
        else:
            hits = hits.join(allowed, id_column, "left_semi")
    return hits.select("query_id", id_column, "_distance", "rank"), most


def _query_block(asked: DataFrame, max_bytes: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Queries as one block when they are few enough to give to every task, else None.

    The dimension is read from one row, the number of queries is bounded before anything is fetched.
    """
    first = asked.select(F.size("query_vector").alias("d")).first()
    if first is None:
        return np.empty(0), np.empty((0, 0))
    limit = min(max_bytes // (8 * max(1, first["d"])), SCAN_QUERIES)
    rows = asked.limit(limit + 1).toPandas()
    if len(rows) > limit:
        return None
    return rows["query_id"].to_numpy(), _matrix(rows["query_vector"], first["d"])


def _scan(asked: DataFrame, block: tuple[np.ndarray, np.ndarray], pool: DataFrame, k: int, metric: str, id_column: str,
          vector_column: str, exclude_self: bool, digits: int | None) -> DataFrame:
    """Best k per query and task, the vectors read where they lie."""
    schema = _hit_schema(asked, pool, "query_id", id_column)
    shared = pool.sparkSession.sparkContext.broadcast(block)  # bounded by SCAN_QUERIES and max_scan_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, matrix = shared.value
        if not len(own):
            return
        best = _Best(matrix, k, metric, digits)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data = _arrow_vectors(batch.column(1))
            if not len(data):
                continue
            if data.shape[1] != matrix.shape[1]:
                raise ValueError(f"query has {matrix.shape[1]} dimensions, the set {data.shape[1]}")
            best.add(data, ids, own if exclude_self else None)
        index, ids, distance = best.rows()
        if len(index):
            yield pa.RecordBatch.from_pydict({"query_id": own[index].tolist(), id_column: ids.tolist(), "_distance": distance},
                                             schema=to_arrow(schema))

    return pool.select(id_column, vector_column).mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 64, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that what Python makes of one is bounded by ``rows`` and, by the size of the first ones, about ``most_bytes``.

    Spark's batches grow with the table, to 10,000 rows of any size; as Python objects they are many times as large.
    """
    for batch in batches:
        head = batch.slice(0, rows)
        step = max(1, min(rows, head.num_rows * most_bytes // max(1, head.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def to_arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _block_topk(k: int, metric: str, id_column: str, exclude_self: bool, digits: int | None, schema: T.StructType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        target = to_arrow(schema)
        if not len(left) or not len(right):
            return target.empty_table()
        query_ids, ids = (t.column(c).to_numpy() for t, c in ((left, "query_id"), (right, "_vid")))
        matrix, data = _arrow_vectors(left.column("query_vector")), _arrow_vectors(right.column("_vec"))
        if data.shape[1] != matrix.shape[1]:
            raise ValueError(f"query has {matrix.shape[1]} dimensions, the set {data.shape[1]}")
        best = _Best(matrix, k, metric, digits)
        best.add(data, ids, query_ids if exclude_self else None)
        index, found, distance = best.rows()
        return pa.Table.from_pydict({"query_id": query_ids[index].tolist(), id_column: found.tolist(), "_distance": distance}, schema=target)
    return run


def _meet(left: DataFrame, right: DataFrame, bucket: Sequence[str], k: int, metric: str, id_column: str,
          schema: T.StructType, exclude_self: bool, digits: int | None, block_rows: int) -> DataFrame:
    """Best k per query inside every bucket, the buckets cut into blocks of bounded size on both sides.

    ``left`` has query_id, query_vector and the bucket columns; ``right`` has _vid, _vec and them.
    """
    return _pair_blocks(left, right, bucket, _block_topk(k, metric, id_column, exclude_self, digits, schema), schema, block_rows)


def _pair_blocks(left: DataFrame, right: DataFrame, bucket: Sequence[str], run: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType,
                 block_rows: int) -> DataFrame:
    """``run`` on all blocks of queries and vectors of a bucket; their number comes from counts that are combined on the map side."""
    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias(name))

    # buckets that only one side fills meet nothing and fall away here
    plan = blocks(left, "_lb").join(blocks(right, "_rb"), list(bucket))
    a = (left.join(plan, list(bucket)).withColumn("_l", F.pmod(F.xxhash64("query_id"), F.col("_lb")).cast("int"))
         .withColumn("_r", F.explode(F.sequence(F.lit(0), F.col("_rb") - 1))).drop("_lb", "_rb"))
    b = (right.join(plan, list(bucket)).withColumn("_r", F.pmod(F.xxhash64("_vid"), F.col("_rb")).cast("int"))
         .withColumn("_l", F.explode(F.sequence(F.lit(0), F.col("_lb") - 1))).drop("_lb", "_rb"))
    keys = [*bucket, "_l", "_r"]
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(run, schema)


def _many(asked: DataFrame, pool: DataFrame, k: int, metric: str, id_column: str, vector_column: str, exclude_self: bool, digits: int | None,
          block_rows: int) -> DataFrame:
    """Best k per query and block, cell by cell; vectors of a single block are one cell that all queries meet."""
    from plexus.operators.cells import CellSearch
    n = pool.count()
    if n > block_rows:
        return CellSearch(asked, pool, n, k, metric, id_column, vector_column, exclude_self, digits, block_rows).partial()
    right = pool.select(F.col(id_column).alias("_vid"), F.col(vector_column).alias("_vec"))
    cell = F.lit(0).alias("_cell")
    return _meet(asked.select("*", cell), right.select("*", cell), ["_cell"], k, metric, id_column, _hit_schema(asked, pool, "query_id", id_column),
                 exclude_self, digits, block_rows)


def find_similar_mmr(queries: DataFrame, vectors: DataFrame, k: int = 5, fetch_k: int | None = None,
                     weight: float = 0.5, *, query_id: str = "query_id", query_vector: str = "query_vector",
                     id_column: str = "_uniqueid", vector_column: str = "_vector", constraints: Mapping[str, Sequence[Any]] | None = None,
                     knn_first: bool = True, exclude_self: bool = False, digits: int | None = None, max_scan_bytes: int = SCAN_QUERY_BYTES,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """H03. Maximal marginal relevance (Carbonell and Goldstein 1998) over the ``fetch_k`` nearest vectors.

    ``weight`` 1 is plain nearest neighbours. One group holds one query's ``fetch_k`` candidates.
    """
    fetch = fetch_k if fetch_k is not None else 4 * k
    if fetch < k:
        raise ValueError("fetch_k must not be below k")
    hits, most = _search(queries, vectors, fetch, COSINE, query_id, query_vector, id_column, vector_column, constraints, knn_first, exclude_self,
                         digits, max_scan_bytes, block_rows)
    few = most is not None and most * HIT_BYTES <= SCAN_QUERY_BYTES
    # a bounded number of hits goes to the vectors, which are not shuffled
    rows = vectors.select(id_column, F.col(vector_column).alias("_vec")).join(F.broadcast(hits) if few else hits, id_column)
    schema = T.StructType([hits.schema["query_id"], hits.schema[id_column], T.StructField("_distance", T.DoubleType()),
                           T.StructField("rank", T.IntegerType())])

    def select(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rank"]).reset_index(drop=True)
        unit = _matrix(pdf["_vec"])
        unit = unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)
        relevance, among = pdf["_distance"].to_numpy(), unit @ unit.T
        chosen: list[int] = []
        closest = np.full(len(pdf), -np.inf)
        while len(chosen) < min(k, len(pdf)):
            value = relevance if not chosen else weight * relevance - (1 - weight) * closest
            value = np.where(np.isin(np.arange(len(pdf)), chosen), -np.inf, np.round(value, 12))
            pick = int(np.argmax(value))
            chosen.append(pick)
            closest = np.maximum(closest, among[pick])
        out = pdf.loc[chosen, ["query_id", id_column, "_distance"]].copy()
        out["rank"] = range(1, len(out) + 1)
        return out

    return rows.groupBy("query_id").applyInPandas(select, schema)


def recall(found: DataFrame, exact: DataFrame, id_column: str = "_uniqueid") -> DataFrame:
    """Share of the exact neighbours that an approximate search found, over all queries."""
    hit = found.select("query_id", id_column, F.lit(1).alias("_hit"))
    return (exact.select("query_id", id_column).join(hit, ["query_id", id_column], "left")
            .agg(F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_found"))
            .withColumn("recall", F.try_divide("n_found", "n_exact")))


@F.pandas_udf(T.BinaryType())
def pack_vector(v: pd.Series) -> pd.Series:
    """H05. ``array<float>`` to little-endian float32 bytes."""
    return pd.Series([None if x is None else np.asarray(x, dtype="<f4").tobytes() for x in v])


@F.pandas_udf(T.ArrayType(T.FloatType()))
def unpack_vector(b: pd.Series) -> pd.Series:
    """H05. Little-endian float32 bytes to ``array<float>``."""
    return pd.Series([None if x is None else np.frombuffer(x, dtype="<f4") for x in b])


def length(vector: str | Column) -> Column:
    """Euclidean length of a vector column."""
    c = F.col(vector) if isinstance(vector, str) else vector
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
