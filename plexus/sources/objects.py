"""Object stores, manifests, fetched urls, annotation files and record sets."""

from __future__ import annotations

import re
import time
import urllib.request
from collections import Counter, deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Semaphore

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import bucket_creator_key, mime_from_path
from plexus.operators.vectors import to_arrow

# Media types that the object scan keeps, by object type.
OBJECT_TYPES = {
    "image": ("image/png", "image/jpeg"),
    "document": ("application/pdf",),
    "video": ("video/mp4",),
}


def scan_objects(spark: SparkSession, path: str, mime_types: Sequence[str] | None = OBJECT_TYPES["image"],
                 glob: str | None = None, content: bool = False, folder_suffix: str | None = None) -> DataFrame:
    """A09. List an object store, keeping objects by guessed media type.

    Bytes are read only with ``content=True``; otherwise the listing never opens a file. With ``folder_suffix`` a folder
    whose name ends so is one object, as large as its files together: a table may be a file or a folder of part files.
    """
    if folder_suffix and content:
        raise ValueError("an object in several files has no content of its own")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path)
    if folder_suffix:
        found = (found.groupBy(_up_to_folder(path, folder_suffix).alias("path"))
                 .agg(F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime")))
    found = (found.withColumn("name", F.substring_index("path", "/", -1))
             .withColumn("mime_type", mime_from_path("path")))
    if mime_types is not None:
        found = found.where(F.col("mime_type").isin(*mime_types))
    columns = ["path", "name", "mime_type", "length", "modificationTime"]
    return found.select(*columns, *(["content"] if content else []))


def _up_to_folder(root: str, suffix: str) -> Column:
    """The path of a file, or of the first folder below the root whose name ends with the suffix."""
    below = re.sub(r"/+", "/", re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*(?=/))?", "", root)).rstrip("/") + "/"
    at = F.instr("path", below)
    start = F.when(at > 0, at + len(below)).otherwise(1)
    inside = F.substring(F.col("path"), start, F.length("path"))
    folder = F.regexp_extract(inside, f"^((?:[^/]+/)*?[^/]*{re.escape(suffix)})/", 1)
    return F.when(folder == "", F.col("path")).otherwise(F.concat(F.substring(F.col("path"), F.lit(1), start - 1), folder))


def object_manifest(paths: DataFrame, scheme: str, bucket: str, ingest_date: str | Column | None = None,
                    add_object_paths: bool = False, workflow_id: str | None = None,
                    path: str = "path", url_column: str = "url") -> DataFrame:
    """A10. Manifest of bucket objects: url, hash, ingest date, creator, creator key, media type."""
    url = F.concat(F.lit(f"{scheme}//{bucket}/"), F.col(path))
    when = (F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss") if ingest_date is None
            else F.lit(ingest_date) if isinstance(ingest_date, str) else ingest_date)
    out = paths.select(F.col(path).alias("filename"), url.alias(url_column), F.sha1(url).alias("wf_sha1_hash"),
                       when.alias("wf_ingest_date"), F.lit("bucket_ingestor").alias("wf_creator"),
                       bucket_creator_key(scheme, bucket).alias("wf_creator_key"),
                       mime_from_path(url).alias("adb_mime_type"))
    if add_object_paths:
        out = out.withColumn("wf_object_path", F.concat(F.lit(f"{bucket}/"), "filename"))
    if workflow_id:
        out = out.withColumn("wf_workflow_id", F.lit(workflow_id))
    return out


# Object classes that property files may describe.
PROPERTY_CLASSES = ("Image", "Video", "Pdf", "Document")
OTHER_CLASSES = ("Blob", "BoundingBox", "Polygon", "Descriptor", "DescriptorSet", "Connection", "Clip", "Frame")


# Read and written alike: quotes are doubled, blanks kept, NULL (nothing) told apart from an empty text (two quotes).
PROPERTY_CSV = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                "nullValue": "\u0001", "emptyValue": ""}


def property_file_class(name: str) -> str | None:
    """Object class a ``<class>.adb.csv`` file describes; None for a file of entities."""
    prefix = name.removesuffix(".adb.csv").removeprefix("_").lower()
    for known in PROPERTY_CLASSES + OTHER_CLASSES:
        if prefix == known.lower():
            if known in OTHER_CLASSES:
                raise ValueError(f"{name}: properties of {known} cannot be loaded from a file")
            return "Document" if known == "Pdf" else known
    return None


def property_csv(spark: SparkSession, path: str, name: str | None = None,
                 schema: str | None = None) -> DataFrame:
    """A11. A property file. Without a known object class its first column must be ``EntityClass``.

    Quoted texts may hold quotes, commas and line breaks; an empty field is NULL, a quoted empty one is
    an empty text. A file with line breaks in its texts cannot be split, so large tables come as many files.
    """
    file_name = name or path.rstrip("/").rsplit("/", 1)[-1]
    if not file_name.endswith(".adb.csv"):
        raise ValueError(f"{file_name}: not a property file")
    reader = spark.read.options(**PROPERTY_CSV, multiLine="true")
    if schema:
        reader = reader.schema(schema)
    df = reader.csv(path)
    known = property_file_class(file_name)
    if known is None and df.columns[0] != "EntityClass":
        raise ValueError(f"{file_name}: the first column must be EntityClass")
    return df.withColumn("file_name", F.lit(file_name))


def fetch_one(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=60) as response:  # noqa: S310 - urls are the caller's data
        return response.read()


def _tried(fetch: Callable[[str], bytes], url: str | None, retries: int, pause: float, gate: Semaphore) -> tuple[bytes | None, str | None]:
    """Content or error of one url; a try that failed is followed by a pause, each twice as long as the one before."""
    error = "no url"
    for n in range(retries if url else 0):
        if n:
            time.sleep(pause * 2 ** (n - 1))
        try:
            with gate:
                return fetch(url), None
        except Exception as e:  # noqa: BLE001 - any failure becomes the error column
            error = f"{type(e).__name__}: {e}"
    return None, error


def fetch_urls(df: DataFrame, key: str, url: str, retries: int = 3, fetch: Callable[[str], bytes] = fetch_one, *, at_once: int = 16,
               per_host: int = 2, pause: float = 0.5, batch_bytes: int = 32 << 20) -> DataFrame:
    """A15. Bytes behind a url column, with retries: ``key, content, error``; a failure is a row, not an abort.

    The rows of a host are one task's, so ``per_host`` holds for the whole cluster; a task fetches ``at_once`` urls at a time and
    hands them on in the order of its rows, in batches of about ``batch_bytes``. At most twice ``at_once`` objects and a batch
    are in memory, and the gates of no more hosts.
    """
    schema = T.StructType([df.schema[key], T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gates: dict[str, Semaphore] = {}  # of hosts that are waited for: without a host there are as many as urls
        asked_of: Counter[str] = Counter()
        target = to_arrow(schema)
        done: list[tuple] = []
        size = 0
        with ThreadPoolExecutor(at_once) as pool:
            waiting: deque = deque()

            def rows() -> Iterator[tuple]:
                for whole in batches:
                    for at in range(0, whole.num_rows, 2 * at_once):
                        for k, u, host in zip(*(c.to_pylist() for c in whole.slice(at, 2 * at_once).columns), strict=True):
                            gate = gates.setdefault(host, Semaphore(per_host))
                            asked_of[host] += 1
                            waiting.append((k, host, pool.submit(_tried, fetch, u, retries, pause, gate)))
                            if len(waiting) >= 2 * at_once:
                                yield waiting.popleft()
                while waiting:
                    yield waiting.popleft()

            for k, host, future in rows():
                done.append((k, *future.result()))
                asked_of[host] -= 1
                if not asked_of[host]:
                    del asked_of[host], gates[host]
                size += len(done[-1][1] or b"")
                if size >= batch_bytes or len(done) >= 1024:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), target, strict=True)], schema=target)
                    done, size = [], 0
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), target, strict=True)], schema=target)

    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    asked = df.select(key, url, F.coalesce(F.nullif(host, F.lit("")), F.col(url), F.lit("")).alias("_host"))  # without a host: each for itself
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return asked.repartition(parts, "_host").mapInArrow(run, schema)


def whitespace_table(spark: SparkSession, paths: Sequence[str], columns: Sequence[str],
                     skip: Sequence[str] = ()) -> DataFrame:
    """A16. Whitespace-delimited lines; the count line and header (by first field) are left out."""
    fields = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(list(paths)).select(fields.alias("_f")).where(F.size("_f") == len(columns))
    if skip:
        rows = rows.where(~F.get("_f", F.lit(0)).isin(*skip))
    return rows.select(*[F.get("_f", F.lit(i)).alias(c) for i, c in enumerate(columns)])


# Layout of an annotation file.
ANNOTATION_SCHEMA = """
  images array<struct<id bigint, file_name string, height int, width int, license int, coco_url string,
                      flickr_url string, date_captured string>>,
  annotations array<struct<id bigint, image_id bigint, category_id bigint, bbox array<double>, area double,
                           iscrowd int, segmentation array<array<double>>>>,
  categories array<struct<id bigint, name string>>"""


@dataclass
class AnnotationTables:
    images: DataFrame
    annotations: DataFrame
    categories: DataFrame


def annotation_tables(files: DataFrame) -> AnnotationTables:
    """A17. Annotation documents (one per row) as image, annotation and category tables."""
    def rows(name: str) -> DataFrame:
        return files.select("corpus", F.explode(name).alias("r")).select("corpus", "r.*")

    return AnnotationTables(rows("images"), rows("annotations"),
                            files.select(F.explode("categories").alias("r")).select("r.*").distinct())


def annotations_json(spark: SparkSession, path: str, multi_line: bool = True) -> AnnotationTables:
    """A17. Read annotation files; the corpus is the last part of the file name before the year.

    Segmentations of crowds are objects, not point lists, and come back NULL; crowds are no
    polygons anyway. A file is one JSON value and so read in one task, but its rows are spread before
    anything else is done with them; with ``multi_line=False`` a file holds one document per line and splits. The three tables read the same files, each its own fields.
    """
    files = (spark.read.schema(ANNOTATION_SCHEMA).option("multiLine", multi_line).json(path)
             .withColumn("corpus", F.regexp_extract(F.col("_metadata.file_name"), r"_([A-Za-z]+)\d*\.json$", 1)))
    tables = annotation_tables(files)
    if multi_line:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables = AnnotationTables(tables.images.repartition(n, "id"), tables.annotations.repartition(n, "id"), tables.categories)
    return tables


def _unpacked(layout: np.dtype, most: int = 1024):
    """Records as rows, at most ``most`` at a time, without an object for each; a NULL holds none."""
    def table(data: np.ndarray) -> pa.RecordBatch:
        vectors = data["vector"]
        ends = pa.array(np.arange(len(data) + 1, dtype=np.int32) * np.int32(vectors.shape[1]))
        values = pa.array(np.ascontiguousarray(vectors).reshape(-1), pa.float32())
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(data["id"]), pa.int64()), pa.ListArray.from_arrays(ends, values)], names=["id", "vector"])

    def rows(values: list[pa.Buffer]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(values[0] if len(values) == 1 else b"".join(values), layout)
        for start in range(0, len(data), most):
            yield table(data[start:start + most])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, size = [], 0
            for value in batch.column(0):
                if not value.is_valid:
                    continue
                values.append(value.as_buffer())
                size += values[-1].size
                if values[-1].size % layout.itemsize:
                    raise ValueError(f"records of {layout.itemsize} bytes expected")
                if size >= most * layout.itemsize:
                    yield from rows(values)
                    values, size = [], 0
            if size:
                yield from rows(values)
    return run


def packed_vectors(records: DataFrame, dimensions: int, ids: DataFrame | None = None,
                   column: str = "record") -> DataFrame:
    """A18. Fixed-width records (int64 id, float32 x N) as ``id, vector``, optionally only some ids.

    ``column`` may hold one record or a whole run of records, which come as rows a thousand at a time. Only the wanted ids are kept after
    a semi join on the id, which is decoded first.
    """
    run = _unpacked(np.dtype([("id", "<i8"), ("vector", "<f4", (dimensions,))]))
    out = records.select(column).mapInArrow(run, "id bigint, vector array<float>")
    return out if ids is None else out.join(ids.select(F.col(ids.columns[0]).alias("id")), "id", "left_semi")


def packed_vector_file(spark: SparkSession, path: str, dimensions: int, ids: DataFrame | None = None) -> DataFrame:
    """A18. The same from files of records, which Spark splits at record borders."""
    width = 8 + 4 * dimensions
    rows = spark.sparkContext.binaryRecords(path, width).map(lambda r: (bytearray(r),))
    return packed_vectors(spark.createDataFrame(rows, "record binary"), dimensions, ids)


@dataclass
class RecordSets:
    datasets: DataFrame
    record_sets: DataFrame
    records: dict[str, DataFrame]


def record_sets(url: str, tables: Mapping[str, DataFrame], sample_count: int = -1,
                flatten: Mapping[str, tuple[str, str]] | None = None) -> RecordSets:
    """A19. Dataset, record sets and records, linked by name; ``sample_count`` -1 takes all, else those with
    the smallest hash, so that records and counts agree in every evaluation.

    ``flatten`` names a JSON column and its schema per record set; its fields become columns.
    """
    records, sets, spark = {}, None, None
    for name, df in tables.items():
        spark = df.sparkSession
        rows = df if sample_count < 0 else df.orderBy(F.xxhash64(*df.columns), *df.columns[:1]).limit(sample_count)
        if flatten and name in flatten:
            column, schema = flatten[name]
            rest = [c for c in rows.columns if c != column]
            rows = (rows.withColumn("_s", F.from_json(column, schema)).select(*rest, "_s.*"))
        records[name] = rows.withColumn("record_set", F.lit(name))
        one = (rows.agg(F.count(F.lit(1)).alias("n_records"))
               .select(F.lit(url).alias("dataset"), F.lit(name).alias("record_set"), "n_records"))
        sets = one if sets is None else sets.unionByName(one)
    if spark is None:
        raise ValueError("no record sets given")
    return RecordSets(spark.range(1).select(F.lit(url).alias("dataset")), sets, records)
