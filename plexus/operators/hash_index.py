"""Approximate search in a written hash index with several probes a table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.operators.vectors import BLOCK_ROWS, COSINE, _arrow_vectors, _final, _meet, check_search, to_arrow
from plexus.session import shared_dir


def hyperplanes(dimensions: int, tables: int, bits: int, seed: int = 42) -> np.ndarray:
    """Random directions of the hash tables, the same for the same seed."""
    return np.random.default_rng(seed).standard_normal((tables, bits, dimensions))


def margins(matrix: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Distance of each vector from each plane: row, table, bit."""
    tables, bits, dimensions = planes.shape
    return (matrix @ planes.reshape(-1, dimensions).T).reshape(len(matrix), tables, bits)


def codes(margin: np.ndarray) -> np.ndarray:
    """Bucket in each table: the sides of its planes."""
    return ((margin > 0) * (1 << np.arange(margin.shape[2]))).sum(axis=2).astype(np.int32)


def probe_codes(margin: np.ndarray, probes: int) -> np.ndarray:
    """Row, table, probe: the own bucket, then those across the planes that are nearest, one or two at a time."""
    bits = margin.shape[2]
    sets = [(), *((b,) for b in range(bits)), *combinations(range(bits), 2)]
    flips = np.array([sum(1 << b for b in s) for s in sets], np.int32)
    member = np.array([[b in s for b in range(bits)] for s in sets], float)
    cost = np.square(margin) @ member.T
    nearest = np.argsort(cost, axis=2, kind="stable")[:, :, :probes]
    return codes(margin)[:, :, None] ^ flips[nearest]


@dataclass(frozen=True)
class HashIndex:
    """Where an index lies and how it hashes."""
    path: str
    dimensions: int
    tables: int
    bits: int
    seed: int

    def planes(self) -> np.ndarray:
        return hyperplanes(self.dimensions, self.tables, self.bits, self.seed)

    def rows(self, spark: SparkSession) -> DataFrame:
        """``_table, _code, _vid, _vec``, sorted by the first two, so that a bucket is read from few row groups."""
        return spark.read.parquet(self.path)


def write_index(vectors: DataFrame, *, dimensions: int, tables: int = 4, bits: int = 6, seed: int = 42, id_column: str = "_uniqueid",
                vector_column: str = "_vector", path: str | None = None) -> HashIndex:
    """H04. Write each vector into its bucket of each table. Rows without a vector have none.

    A bucket is cut over files by the vectors' ids, so a bucket with a third of all vectors is written by many tasks.
    """
    index = HashIndex(path or shared_dir(vectors.sparkSession, "hash-index"), dimensions, tables, bits, seed)
    planes = index.planes()
    rows = vectors.select(F.col(id_column).alias("_vid"), F.col(vector_column).alias("_vec")).where("_vec IS NOT NULL")
    schema = T.StructType([T.StructField("_table", T.IntegerType()), T.StructField("_code", T.IntegerType()), *rows.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = _arrow_vectors(batch.column(1))
            if data.shape[1] != dimensions:
                raise ValueError(f"vectors have {data.shape[1]} dimensions, the index {dimensions}")
            found = codes(margins(data, planes))
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(data), t, np.int32)), pa.array(found[:, t]), *batch.columns], schema=to_arrow(schema))

    hashed = rows.mapInArrow(run, schema)
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (hashed.repartitionByRange(parts, "_table", "_code", F.xxhash64("_vid")).sortWithinPartitions("_table", "_code")
     .write.mode("overwrite").parquet(index.path))
    return index


def _probe_rows(asked: DataFrame, index: HashIndex, probes: int) -> DataFrame:
    planes = index.planes()
    schema = T.StructType([*asked.schema.fields, T.StructField("_table", T.IntegerType()), T.StructField("_code", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = _arrow_vectors(batch.column(1))
            if data.shape[1] != index.dimensions:
                raise ValueError(f"query has {data.shape[1]} dimensions, the set {index.dimensions}")
            found = probe_codes(margins(data, planes), probes)
            n, tables, each = found.shape
            rows = pa.array(np.repeat(np.arange(n), tables * each))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), each), n)),
                                              pa.array(found.reshape(-1))], schema=to_arrow(schema))

    return asked.mapInArrow(run, schema)


def approx_similar(queries: DataFrame, vectors: DataFrame | HashIndex, k: int = 10, metric: str = COSINE, *, dimensions: int | None = None,
                   tables: int = 4, bits: int = 6, probes: int = 12, seed: int = 42, query_id: str = "query_id",
                   query_vector: str = "query_vector", id_column: str = "_uniqueid", vector_column: str = "_vector",
                   exclude_self: bool = False, digits: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """H04. Approximate search: vectors of the buckets that a query probes, ranked exactly.

    ``vectors`` is an index, or a table that is indexed first. In each table a query looks into its own bucket and into those
    beyond the nearest planes, ``probes`` in all; only vectors of these buckets are read further and scored. Buckets meet
    their probes block by block, so a bucket with a third of all vectors is many groups and no (query, vector) pairs are
    written. A vector found in several buckets counts once. Rows and queries without a vector find nothing.
    """
    check_search(k, metric)
    index = vectors if isinstance(vectors, HashIndex) else write_index(
        vectors, dimensions=dimensions, tables=tables, bits=bits, seed=seed, id_column=id_column, vector_column=vector_column)
    right = index.rows(queries.sparkSession)
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("query_vector")).where("query_vector IS NOT NULL")
    schema = T.StructType([T.StructField("query_id", asked.schema["query_id"].dataType), T.StructField(id_column, right.schema["_vid"].dataType),
                           T.StructField("_distance", T.DoubleType())])
    partial = _meet(_probe_rows(asked, index, probes), right, ["_table", "_code"], k, metric, id_column, schema, exclude_self, digits, block_rows)
    once = partial.groupBy("query_id", id_column).agg(F.first("_distance").alias("_distance"))  # the same in all buckets
    return _final(once, k, id_column, metric).select("query_id", id_column, "_distance", "rank")
