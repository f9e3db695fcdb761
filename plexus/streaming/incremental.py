"""Continuous and one-off enrichment with Structured Streaming (L)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

Enrich = Callable[[DataFrame], DataFrame]

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_new_files(spark: SparkSession, path: str, schema, format: str = "parquet",
                   max_files: int | None = None, glob: str | None = None) -> DataFrame:
    """A stream of the files that appear below a path."""
    reader = spark.readStream.schema(schema).format(format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


_PLAIN = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_SLICE = 65_536  # rows that a task takes up before it keeps the smallest of each key


def _smallest(key: Sequence[str], order: Sequence[str], tie: str):
    """Of the rows of a task the smallest of each key: NULL first, then values, not-a-number last, as in Spark."""
    def best(rows: pa.Table) -> pa.Table:
        by = []
        for c in order:
            values = rows.column(c)
            if pa.types.is_floating(values.type):
                odd = pc.fill_null(pc.is_nan(values), False)
                by += [odd, pc.if_else(odd, pa.scalar(0, values.type), values)]
            else:
                by.append(values)
        names = [str(i) for i in range(len(by) + 1)]
        sorted_ = rows.take(pc.sort_indices(pa.table([*by, rows.column(tie)], names=names), null_placement="at_start",
                                            sort_keys=[(n, "ascending") for n in names]))
        keys = [f"k{i}" for i in range(len(key))]
        places = pa.table([*(sorted_.column(c) for c in key), pa.array(np.arange(len(rows)))], names=[*keys, "at"])
        return sorted_.take(places.group_by(keys, use_threads=False).aggregate([("at", "min")]).column("at_min"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, more, n = None, [], 0
        for batch in batches:
            more.append(batch)
            n += batch.num_rows
            if n >= max(_SLICE, 0 if kept is None else len(kept)):
                kept = best(pa.concat_tables([*([] if kept is None else [kept]), pa.Table.from_batches(more)]))
                more, n = [], 0
        if more:
            kept = best(pa.concat_tables([*([] if kept is None else [kept]), pa.Table.from_batches(more)]))
        if kept is not None:
            yield from kept.drop_columns([tie]).combine_chunks().to_batches(max_chunksize=10_000)
    return run


class _FirstOfKey(StatefulProcessor):
    """Lets the first row of a key pass, once; a key's state is that it has been seen."""

    def __init__(self, order: Sequence[str]) -> None:
        self.order = tuple(order)

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self.seen.exists():
            self.seen.update((True,))
            # NULL comes first, as in Spark; rows that tie are told apart by all that they hold
            yield min(rows, key=lambda r: ([(r[c] is not None, r[c]) for c in self.order], repr(r)))

    def close(self) -> None:
        pass


def first_of_keys(rows: DataFrame, key: Sequence[str], order: Sequence[str] | None) -> DataFrame:
    """The rows of a stream whose key comes for the first time, of one batch the smallest by ``order``.

    What is known of a key is that it is in the state store, dealt over the shuffle partitions of the query's first
    run; only keys of the batch at hand are looked up. No batch depends on what earlier ones have written.
    A batch is first cut down to the smallest row of each key, in slices of Arrow rows; a task keeps one row for each key that
    the batch deals to it. Then, as without ``order``, any row of a key will do, so the JVM's own deduplication serves.
    Only nested keys and orders, which Arrow does not sort, go to the state key by key through Python.
    """
    if not order:
        return rows.dropDuplicates(list(key))
    if not all(isinstance(rows.schema[c].dataType, _PLAIN) for c in (*key, *order)):
        return rows.groupBy(*key).transformWithState(_FirstOfKey(order), rows.schema, "Append", "None")
    tie = "_" + "".join(rows.columns)
    told = [F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in rows.dtypes]  # of rows that tie the one with the least hash
    dealt = rows.withColumn(tie, F.xxhash64(*told)).repartition(*key)
    return dealt.mapInArrow(_smallest(key, order, tie), rows.schema).dropDuplicates(list(key))


@contextmanager
def _rocksdb(spark: SparkSession):
    """State outside the JVM's heap, saved as changes, for queries started inside; a store set by the user stays."""
    own = spark.conf.get(_STORE, None)
    if not own or "HDFSBacked" in own:
        spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if own:
            spark.conf.set(_STORE, own)
        else:
            spark.conf.unset(_STORE)


def _start(source: DataFrame, enrich: Enrich, target: str, checkpoint: str, key: Sequence[str], order: Sequence[str] | None, **trigger) -> StreamingQuery:
    """Output goes to one folder per batch, replaced as a whole; a batch that is repeated after a failure starts
    from the state before it and writes the same rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        enrich(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    with _rocksdb(source.sparkSession):
        return (first_of_keys(source, key, order).writeStream.foreachBatch(write).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def incremental_enrich(source: DataFrame, enrich: Enrich, target: str, checkpoint: str, key: Sequence[str],
                       order: Sequence[str] | None = None, interval: str = "30 seconds") -> StreamingQuery:
    """L01. Keep enriching new rows, at least once, with the output of each key written once."""
    return _start(source, enrich, target, checkpoint, key, order, processingTime=interval)


def run_once(source: DataFrame, enrich: Enrich, target: str, checkpoint: str, key: Sequence[str],
             order: Sequence[str] | None = None) -> None:
    """L02. Enrich what is there now, then stop. A second call finds only what came since."""
    _start(source, enrich, target, checkpoint, key, order, availableNow=True).awaitTermination()


def enriched(spark: SparkSession, target: str) -> DataFrame:
    """What the jobs have written so far."""
    return spark.read.parquet(target)
