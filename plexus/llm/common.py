"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.session import shared_dir

# Fixed value: white space between words is ASCII only, as bytes.split() has it.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write once to the cluster's shared folder and read back; cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Give back the disk of saved tables that nothing reads any more: what was made of them is written."""
    for df in frames:
        nothing = df.sparkSession.createDataFrame([], df.schema)
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            nothing.write.mode("overwrite").parquet(path)


def utf8(text: str = "text") -> Column:
    """The bytes of a text; null counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def n_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def partitions(df: DataFrame) -> int:
    """Number of shuffle partitions, the cluster's own measure for the size of its data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def word_runs(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in runs of bounded size, so that a very long text is never one list."""
    at, n = 0, len(text)
    while at < n:
        end = min(at + size, n)
        if end < n:
            gap = _SPACE.search(text, end)
            end = gap.start() if gap else n
        yield text[at:end].split()
        at = end


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... (count values) of each row, one after the other."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    out = np.arange(ends[-1], dtype=np.int64)
    return out + np.repeat(starts - (ends - counts), counts)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals; touching ones become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > ends[:-1]]
    return starts[new], ends[np.r_[np.flatnonzero(new)[1:] - 1, len(ends) - 1]]
