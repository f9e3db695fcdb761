"""SimHash near-duplicates: fingerprints of word shingles, linked by sharded BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import save, utf8, word_runs
from plexus.llm.components import components

SHINGLE = 3
RADIUS = 2
SHARD_ROWS = 20_000   # rows that a shard of trees is planned for
HOT_BUCKET = 2_000    # fingerprints of a bucket beyond which it is cut again
_BLOCKS = ((43, 21), (22, 21), (0, 22))  # shift and width of the three blocks of a fingerprint


def fingerprint(text: bytes, shingle: int = SHINGLE, run_bytes: int = 1 << 20) -> int:
    """64-bit SimHash of a text; bit b is set if more than half of the shingle hashes have it."""
    ones, total, tail, words_seen = np.zeros(64, np.int64), 0, [], 0
    digest = xxhash.xxh64_intdigest

    def count(hashes: list[int]) -> None:
        nonlocal ones, total
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for words in word_runs(text.lower(), run_bytes):
        words_seen += len(words)
        words = tail + words
        if len(words) >= shingle:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.r_[0, ends[:-1] + 1][:len(words) - shingle + 1].tolist()
            for at in range(0, len(starts), 65536):
                count([digest(line[s:e], 42) for s, e in zip(starts[at:at + 65536], ends[shingle - 1 + at:shingle - 1 + at + 65536].tolist())])
        tail = words[-(shingle - 1):] if shingle > 1 else []
    if not total and words_seen:
        count([digest(b" ".join(tail), 42)])
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``key, fp``: the fingerprint of each whole text as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, fp bigint")


class BKTree:
    """Values by Hamming distance: a child hangs at its distance from the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of all values within the radius; only edges within it of the distance are followed."""
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            stack.extend(c for d, c in self.children[at].items() if abs(d - distance) <= radius)
        return found

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        at, new = 0, len(self.values) - 1
        while new:
            distance = (self.values[at] ^ value).bit_count()
            if distance not in self.children[at]:
                self.children[at][distance] = new
                return
            at = self.children[at][distance]


def star_links(values: list[int], names: list[int], radius: int) -> list[tuple[int, int]]:
    """One link per value that is not the first of its group; groups are the tree's components."""
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree = BKTree()
    for i, value in enumerate(values):
        for j in tree.near(value, radius):
            parent[root(i)] = root(j)
        tree.add(value)
    least: dict[int, int] = {}
    for i in range(len(values)):
        r = root(i)
        least[r] = min(least.get(r, names[i]), names[i])
    return [(names[i], least[root(i)]) for i in range(len(values)) if names[i] != least[root(i)]]


def _buckets(nodes: DataFrame, hot: int) -> DataFrame:
    """``bucket, fp, node``: fingerprints within radius 2 agree on one of three blocks, so they meet in its bucket.

    A bucket with more than ``hot`` fingerprints is cut in the same way by the rest of the bits, so
    that pairs still meet and its rows spread out.
    """
    fp = F.col("fp")
    block = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in _BLOCKS]
    rows = nodes.select("fp", "node", F.posexplode(F.array(*block)).alias("block", "value"))
    hot_rows = rows.groupBy("block", "value").count().where(F.col("count") > hot).select("block", "value", F.lit(True).alias("hot"))
    rest = (F.when(F.col("block") == 0, fp.bitwiseAND(F.lit((1 << 43) - 1)))
            .when(F.col("block") == 1, fp.bitwiseAND(F.lit((1 << 22) - 1)).bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, 43), 22)))
            .otherwise(F.shiftrightunsigned(fp, 22)))
    cuts = F.array(*[F.concat_ws(":", "block", "value", F.lit(j), F.shiftrightunsigned(rest, 15 * j).bitwiseAND(F.lit(0x7FFF))) for j in range(3)])
    return (rows.join(hot_rows, ["block", "value"], "left")
            .select("fp", "node", F.explode(F.when(F.col("hot"), cuts).otherwise(F.array(F.concat_ws(":", "block", "value")))).alias("bucket")))


def simhash_links(nodes: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, hot: int = HOT_BUCKET) -> DataFrame:
    """Links ``u, v`` (stars) that join all fingerprints within the radius; ``nodes`` is ``fp, node`` with distinct fp.

    Shards of bounded size hold one BK-tree per bucket. A shard's tree travels to a task of its own
    with the values that look for neighbours in it, since the trees together grow with the data and
    could not be broadcast. Group members are linked to the smallest, never pairwise.
    """
    if not 0 <= radius <= 2:
        raise ValueError("three blocks find pairs up to a distance of 2")
    n = nodes.count()
    shards = 3 * n // shard_rows + 1
    rows = _buckets(nodes, hot).withColumn("shard", F.pmod(F.xxhash64("bucket"), F.lit(shards)))

    def link(shard: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        shard = shard[shard.duplicated("bucket", keep=False)].sort_values(["bucket", "node"])
        codes, values, names = pd.factorize(shard["bucket"])[0], shard["fp"].to_numpy().view(np.uint64).tolist(), shard["node"].tolist()
        cuts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1], True]).tolist() if len(codes) else []
        for s, e in zip(cuts, cuts[1:]):
            out += star_links(values[s:e], names[s:e], radius)
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return rows.groupBy("shard").applyInPandas(link, "u bigint, v bigint")


def simhash_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Op 3. ``key, fp, fingerprint, component_id`` of every document; the id is a whole number.

    Texts are lower-cased in A-Z; words are runs without ASCII white space. Null and empty texts have the
    fingerprint zero and are linked like any other. Documents with one fingerprint are one node, so a
    group of copies costs one row. A null id takes part but is never a component's id, unless it
    stands alone: then the id is null. Repeated rows are returned as often as they come.
    """
    rows = save(fingerprints(docs, key, text, shingle), "fingerprints")
    all_nodes = save(rows.groupBy("fp").agg(F.min("key").cast("bigint").alias("node")), "nodes")
    nodes = all_nodes.where("node IS NOT NULL")
    joined = components(simhash_links(nodes, radius))
    roots = nodes.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return (rows.join(roots, "fp", "left")
            .select(F.col("key").alias(key), "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Op 3. The rows of ``docs`` but those whose group has a smaller id. A null id stays."""
    gone = simhash_dedup(docs, key, text, **options).where(F.col(key) != F.col("component_id")).select(F.col(key).alias("key")).distinct()
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.`{key}`") == F.col("g.key"), "left_anti")
