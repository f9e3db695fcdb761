"""Near copies: candidates from SimHash fingerprints and from bands of least hashes, verified on the shingles of the whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import ranges, release, save, utf8
from plexus.llm.components import components
from plexus.llm.seeds import U8, Hasher, Unit, _whole_units, mix
from plexus.llm.simhash import fingerprint, simhash_links

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32       # a pair of similarity s agrees on at least one band with 1 - (1 - s ** BAND_ROWS) ** BANDS
BAND_ROWS = 5
BLOCK_NODES = 1_024   # nodes of a bucket that meet at a time
_WORDS = Unit(words=True, window=SHINGLE, gram=SHINGLE, within=False)
_SALTS = np.random.default_rng(20240301).integers(1, 1 << 63, (2, BANDS * BAND_ROWS), dtype=np.int64).astype(U8) | U8(1)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles of a text; all words together if they are fewer; none without words."""
    values = _whole_units(_WORDS, text.lower())
    n = min(shingle, len(values))
    return np.unique(Hasher(values, 0).grams(n)) if n else np.zeros(0, U8)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of shingles; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A 64-bit key per band: of the least hashes under ``BAND_ROWS`` orders, and the band's number."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * BAND_ROWS, ~U8(0))
    for at in range(0, len(hashes), 1024):  # of any text a bounded table at a time
        table = (hashes[None, at:at + 1024] ^ _SALTS[0][:, None]) * _SALTS[1][:, None]
        np.minimum(least, (table ^ (table >> U8(29))).min(1), out=least)
    keys = np.arange(1, BANDS + 1, dtype=U8)
    for row in least.reshape(BANDS, BAND_ROWS).T:
        keys = mix(keys * U8(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column(2)]
        prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(2)), U8, len(sets)).view(np.int64)
        digests = np.fromiter((xxhash.xxh64_intdigest(s.tobytes()) for s in sets), U8, len(sets)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests), pa.array([len(s) for s in sets], pa.int64()),
                                          pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())), pa.array(prints)], names=["key", "mark", "node", "n", "bands", "fp"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())], names=["node", "hashes"])


def _verify(at_least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(np.frombuffer(a.as_buffer(), U8), np.frombuffer(b.as_buffer(), U8)) >= at_least - 1e-9 for a, b in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(good, pa.bool_()))
    return run


def _search(at_least: float):
    """Links of the nodes that ask to the members of a block of a bucket that are similar: as few as join the same groups."""
    def run(asks: pa.Table, members: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if len(asks) and len(members):
            blobs = members.column("hashes").to_pylist()
            sizes = np.array([len(b) // 8 for b in blobs])
            hashes = np.frombuffer(b"".join(blobs), U8)
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], np.repeat(np.arange(len(blobs)), sizes)[order]
            nodes, of = members.column("node").to_pylist(), np.asarray(members.column("of"))
            group = {g: g for g in {*of.tolist(), *asks.column("of").to_pylist()}}

            def top(g: int) -> int:
                while group[g] != g:
                    group[g] = group[group[g]]
                    g = group[g]
                return g

            for u, u_of, blob in zip(asks.column("node").to_pylist(), asks.column("of").to_pylist(), asks.column("hashes"), strict=True):
                own = np.frombuffer(blob.as_buffer(), U8)
                first = np.searchsorted(hashes, own)
                places = ranges(first, np.searchsorted(hashes, own, "right") - first)
                both = np.bincount(owner[places], minlength=len(blobs))
                for k in np.flatnonzero((both >= (at_least - 1e-9) * (len(own) + sizes - both)) & (of != u_of)).tolist():
                    a, b = top(u_of), top(int(of[k]))
                    if a != b:  # not joined yet by links that go out
                        group[max(a, b)] = min(a, b)
                        out.append((max(u, nodes[k]), min(u, nodes[k])))
        return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})
    return run


def simhash_pairs(rows: DataFrame) -> DataFrame:
    """Pairs ``u, v`` of nodes by op 3's operator: fingerprints within its radius, and nodes that share one; stars, never all pairs."""
    prints = rows.select("fp", "node").distinct()
    first = prints.groupBy("fp").agg(F.min("node").alias("node"))
    shared = prints.select("fp", F.col("node").alias("u")).join(first.select("fp", F.col("node").alias("v")), "fp").select("u", "v")
    linked = simhash_links(first).unionByName(shared).where("u != v")
    return linked.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def near_links(rows: DataFrame, texts: DataFrame, at_least: float = SIMILARITY) -> DataFrame:
    """Links ``u, v`` that join the nodes of ``rows`` (``key, mark, node, n, bands, fp``) as all pairs of that similarity in a band would.

    ``texts`` (``key, mark, text``) has their texts. First come the pairs that SimHash links, and each node of a band's bucket
    with the bucket's smallest node, so a large group costs a comparison or two a node; all are compared as wholes.
    Nodes that are not joined to the smallest one by then search the whole bucket: they meet
    its members block by block, and what the blocks have in common is counted from lists of the members of each shingle, so no
    pair is written that is not a link. No bucket is capped and no pair is left out.
    """
    nodes = rows.groupBy("node").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min(F.struct("key", "mark")).alias("one"))
    in_band = nodes.select("node", "n", "one", F.explode("bands").alias("bucket"))
    # buckets of the same nodes are one
    alike = (in_band.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("head"), F.bit_xor(F.xxhash64("node")).alias("mark"))
             .where("size > 1").groupBy("size", "head", "mark").agg(F.min("bucket").alias("bucket")))
    members = save(in_band.join(alike.select("bucket", "head"), "bucket"), "buckets")
    prints = save(simhash_pairs(rows), "simhash")
    in_pairs = members.select("node").unionByName(prints.select(F.explode(F.array("u", "v")).alias("node"))).distinct()
    asked = in_pairs.join(nodes, "node").select("node", F.struct("one.key", "one.mark").alias("one"))
    named = texts.select(F.struct("key", "mark").alias("one"), "text").join(asked, "one").select("node", "text")  # a null id is part of a struct and joins
    sets = save(named.mapInArrow(_sets, "node bigint, hashes binary").dropDuplicates(["node"]), "sets")

    pairs = (members.where((F.col("node") != F.col("head.node")) & (F.least("n", "head.n") >= at_least * F.greatest("n", "head.n") - F.lit(1e-6)))
             .select(F.col("node").alias("u"), F.col("head.node").alias("v")).unionByName(prints).distinct())
    met = (pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v"))
    stars = save(met.select("u", "v", "a", "b").mapInArrow(_verify(at_least), "u bigint, v bigint"), "stars")
    joined = components(stars)
    known = members.select("bucket", "node", F.col("head.node").alias("head")).join(joined, "node", "left").select("bucket", "node", "head", F.coalesce("component", "node").alias("of"))
    heads = joined.withColumnsRenamed({"node": "head", "component": "head_of"})
    known = save(known.join(heads, "head", "left").select("bucket", "node", "of", (F.col("of") != F.coalesce("head_of", "head")).alias("asks")), "known")

    cut = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    plan = (known.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NODES).alias("mb"), F.ceil(F.count_if("asks") / BLOCK_NODES).alias("lb")).where("lb > 0"))
    here = known.join(plan, "bucket").join(sets, "node")
    asks = here.where("asks").select("bucket", F.pmod(cut, "lb").alias("l"), F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("m"), "node", "of", "hashes")
    others = here.select(F.col("bucket").alias("b"), F.pmod(cut, "mb").alias("bm"), F.explode(F.sequence(F.lit(0), F.col("lb") - 1)).alias("bl"),
                         *[F.col(c).alias(c) for c in ("node", "of", "hashes")])
    found = (asks.groupBy("bucket", "l", "m").cogroup(others.groupBy("b", "bl", "bm"))
             .applyInArrow(_search(at_least), "u bigint, v bigint"))
    links = save(stars.unionByName(found.distinct()), "found")
    release(members, prints, sets, stars, known, joined)
    return links


def drop_shingle_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", at_least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` but those whose group of near copies has a smaller id. A null id stays.

    Two texts are near copies if the sets of their ``SHINGLE``-word shingles have a Jaccard similarity of
    ``at_least``; groups are the connected components. Texts are lower-cased in A-Z, words are runs
    without ASCII white space, a shorter text is one shingle, and texts without words, null ones too, are equal. A pair
    is found if SimHash links it (op 3: three words, 2 of 64 bits) or if it shares one of the bands, which reach down to the
    similarity asked for, and counts only if the sets of both whole texts are similar. Rows that repeat
    id and text stay or go together; an empty table stays empty; other columns may have any name. Sets of shingles are told apart by a
    64-bit hash of theirs. Working tables are emptied when their last reader is done.
    """
    plain = docs.select(F.col(key).alias("key"), F.xxhash64(utf8(text)).alias("mark"), utf8(text).alias("text"))
    kind = dict(plain.dtypes)["key"]
    rows = save(plain.mapInArrow(_signatures, f"key {kind}, mark bigint, node bigint, n bigint, bands array<bigint>, fp bigint"), "shingles")
    links = near_links(rows, plain, at_least)
    joined = components(links)
    of = rows.select("key", "mark", "node").join(joined, "node", "left").select("key", "mark", F.coalesce("component", "node").alias("of"))
    least = of.groupBy("of").agg(F.min("key").alias("least"))
    gone = save(of.join(least, "of").where("key != least").select(F.struct("key", "mark").alias("gone")).distinct(), "gone")
    release(rows, links, joined)
    marked = F.struct(F.col(f"d.`{key}`").alias("key"), F.xxhash64(utf8(f"d.`{text}`")).alias("mark"))
    return docs.alias("d").join(gone.alias("g"), marked == F.col("g.gone"), "left_anti")
