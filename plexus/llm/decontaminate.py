"""Benchmark passages in training texts: a hash set of the test items' word windows on every task, hits verified word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import merged, save, utf8
from plexus.llm.seeds import _TABLE, U8, Hasher

WINDOW = 10
SET_WINDOWS = 400_000        # windows, and bytes of them, that go to every task as a hash set; beyond that they stay a table
SET_BYTES = 48 << 20
FILTER_BITS = 27             # of the bitmap that takes the place of the set, 16 MB whatever the number of windows
SLICE_BYTES = 1 << 20        # bytes of texts that are hashed together
_CHUNK_BITS = 19
_BLANK = 0x20
# Fixed value: A-Z become a-z, ASCII but for letters and digits parts words, all else belongs to them.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else _BLANK for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Words:
    """Where the words of some folded bytes start and end, and hashes of any window of them."""

    def __init__(self, folded: bytes) -> None:
        data = np.frombuffer(folded, np.uint8)
        edge = np.diff(np.r_[False, data != _BLANK, False].astype(np.int8))
        self.folded, self.starts, self.ends = folded, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.sums = Hasher(Hasher(_TABLE[data], 2).of(self.starts, self.ends), 0)

    def windows(self, n: int) -> np.ndarray:
        return self.sums.grams(n) if len(self.starts) >= n else np.zeros(0, U8)

    def window(self, i: int, n: int) -> bytes:
        return b" ".join(self.folded[self.starts[i]:self.ends[i + n - 1]].split())


def item_windows(texts: Iterator[bytes], window: int) -> Iterator[tuple[int, int, bytes]]:
    """``(text, words, window)`` of all windows of ``window`` words; a text of fewer words, but not none, is one."""
    for k, text in enumerate(texts):
        words = words_of(text)
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            yield k, n, b" ".join(words[i:i + n])


class WindowSet:
    """A hash set of windows by number of words, with the items that have them."""

    def __init__(self, rows: list[tuple[int, bytes, list]]) -> None:
        self.tables = {}
        for n in sorted({r[0] for r in rows}):
            mine = [r for r in rows if r[0] == n]
            hashes = np.array([Words(w).windows(n)[0] for _, w, _ in mine], U8)
            order = np.argsort(hashes, kind="stable")
            bits = max(16, len(mine).bit_length() + 4)
            seen = np.zeros(1 << bits, bool)  # where most windows of a text end
            seen[hashes >> U8(64 - bits)] = True
            self.tables[n] = (seen, U8(64 - bits), hashes[order], [mine[k][1] for k in order], [mine[k][2] for k in order])

    def hits(self, words: Words) -> Iterator[tuple[int, int, list]]:
        """``(first word, words, items)`` of each window that is in the set, compared word for word."""
        for n, (seen, shift, hashes, windows, items) in self.tables.items():
            values = words.windows(n)
            at = np.flatnonzero(seen[values >> shift])
            first, last = np.searchsorted(hashes, values[at]), np.searchsorted(hashes, values[at], "right")
            for i, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
                text = words.window(i, n) if a < b else None
                for k in range(a, b):
                    if windows[k] == text:
                        yield i, n, items[k]


class Bitmap:
    """What the hashes of all windows begin with, in place of a set that is too large. Its hits are candidates."""

    def __init__(self, chunks: dict[int, bytes], lengths: list[int]) -> None:
        empty = bytes(1 << (_CHUNK_BITS - 3))
        self.lengths = lengths
        self.bits = np.frombuffer(b"".join(chunks.get(c, empty) for c in range(1 << (FILTER_BITS - _CHUNK_BITS))), np.uint8)

    @staticmethod
    def chunks(windows: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        places = np.unique(np.array([Words(w).windows(n)[0] for n, w in windows], U8) >> U8(64 - FILTER_BITS)).astype(np.int64)
        for c in np.unique(places >> _CHUNK_BITS).tolist():
            bits = np.zeros(1 << _CHUNK_BITS, bool)
            bits[places[places >> _CHUNK_BITS == c] & ((1 << _CHUNK_BITS) - 1)] = True
            yield c, np.packbits(bits, bitorder="little").tobytes()

    def hits(self, words: Words) -> Iterator[tuple[int, int, list]]:
        for n in self.lengths:
            places = words.windows(n) >> U8(64 - FILTER_BITS)
            found = (self.bits[places >> U8(3)] >> (places & U8(7)).astype(np.uint8)) & 1
            for i in np.flatnonzero(found).tolist():
                yield i, n, [words.window(i, n)]


def _pieces(texts: list[bytes], overlap: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Slices as lists of ``(text, words before, bytes before, folded bytes)``; a long text comes in pieces that share ``overlap`` words."""
    out: list[tuple[int, int, int, bytes]] = []
    filled = 0
    for k, text in enumerate(texts):
        folded = text.translate(FOLD)
        at, before, size = 0, 0, SLICE_BYTES
        while len(folded) - at > size:
            cut = folded.find(b" ", at + size)
            if cut < 0:
                break
            piece = folded[at:cut]
            words = len(piece.split())
            if words <= overlap:  # very long words
                size *= 2
                continue
            yield [(k, before, at, piece)]
            at += len(piece.rsplit(None, overlap)[0])
            before += words - overlap
        rest = folded[at:]
        if out and filled + len(rest) > SLICE_BYTES:
            yield out
            out, filled = [], 0
        out.append((k, before, at, rest))
        filled += len(rest)
    if out:
        yield out


def scan(texts: list[bytes], found: WindowSet | Bitmap, window: int = WINDOW) -> tuple[list[int], list[list[tuple]]]:
    """The number of words of each text, and ``(first word, words, first byte, last byte, items)`` of its hits."""
    n_words, hits = [0] * len(texts), [[] for _ in texts]
    for piece in _pieces(texts, window - 1):
        words = Words(b" ".join(p[3] for p in piece))
        lengths = np.array([len(p[3]) + 1 for p in piece])
        byte = np.cumsum(lengths) - lengths
        first = np.searchsorted(words.starts, byte)
        last = np.r_[first[1:], len(words.starts)]
        for k, (text, before, _, _) in enumerate(piece):
            n_words[text] = before + int(last[k] - first[k])
        for i, n, items in found.hits(words):
            k = int(np.searchsorted(first, i, "right")) - 1
            if i + n <= last[k]:  # else it goes on in the next text
                text, before, at, _ = piece[k]
                shift = at - int(byte[k])
                hits[text].append((before + i - int(first[k]), n, int(words.starts[i]) + shift, int(words.ends[i + n - 1]) + shift, items))
    return n_words, hits


def _spans(hits: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    first, n = np.array([h[0] for h in hits], np.int64), np.array([h[1] for h in hits], np.int64)
    return merged(first, first + n)


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """A text without the words from each start to each end."""
    words = Words(text.translate(FOLD))
    out, at = [], 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        out.append(text[at:words.starts[a]])
        at = words.ends[b - 1]
    return b"".join([*out, text[at:]])


def _rows(found, window: int):
    """Task of the usual case: the set is at hand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hits = scan(batch.column(1).to_pylist(), found.value, window)
            spans = [_spans(h) for h in hits]
            items = [sorted({i for h in hs for i in h[4] if i is not None}) for hs in hits]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array([s for s, _ in spans], pa.list_(pa.int64())), pa.array([e for _, e in spans], pa.list_(pa.int64())),
                 pa.array(items, pa.list_(pa.string()))], names=["k", "n_words", "starts", "ends", "items"])
    return run


def _candidates(found, window: int):
    """Task beyond the bound: windows that may be an item's, as rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, hits = scan(batch.column(1).to_pylist(), found.value, window)
            owner = [k for k, hs in enumerate(hits) for _ in hs]
            flat = [h for hs in hits for h in hs]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), pa.array([h[0] for h in flat], pa.int64()),
                                              pa.array([h[1] for h in flat], pa.int32()), pa.array([h[4][0] for h in flat], pa.binary())], names=["mark", "i", "n", "window"])
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [_spans([(h["i"], h["n"]) for h in hs or []]) for hs in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in spans], pa.list_(pa.int64())), pa.array([e for _, e in spans], pa.list_(pa.int64())),
                                          batch.column(2)], names=["mark", "starts", "ends", "items"])


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, set_windows: int = SET_WINDOWS, set_bytes: int = SET_BYTES) -> DataFrame:
    """Op 11. One row per document: ``key, n_words, starts, ends, items``.

    A text's words are its letters and digits, A-Z lower-cased; all beyond ASCII belongs to words. A window is ``window``
    consecutive words of a test item; an item of fewer words, but not none, is one window. ``starts, ends`` are the
    stretches of words that windows cover, in words from 0, ends exclusive; ``items`` are the ids, as sorted strings, of the items that
    have a window there.

    The different windows are counted first. Up to ``set_windows`` of them, in up to ``set_bytes`` bytes, go to every task as
    a hash set; the documents are then a map without a shuffle, each hit compared word for word. More windows
    stay a table: a bitmap of a fixed size goes out instead, and only windows of texts that it lets pass are joined with the
    table, on their words; equal texts count once there.

    Null and empty texts have no words and hit nothing, items without words have no window. An item that comes in several rows is one; an item
    with a null id makes hits but is not listed. Rows that repeat, ids that are null and other columns of any name do
    no harm; an empty table on either side gives no rows, or rows without hits. Long texts are looked at in pieces.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_key).cast("string").alias("item"), utf8(item_text).alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(item_windows((t.as_py() for t in batch.column(1)), window))
            for at in range(0, len(found), 10_000):
                part = found[at:at + 10_000]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k for k, _, _ in part], pa.int64())), pa.array([n for _, n, _ in part], pa.int32()),
                                                  pa.array([w for _, _, w in part], pa.binary())], names=["item", "n", "window"])

    windows = save(items.mapInArrow(cut, "item string, n int, window binary").distinct(), "windows")
    known = windows.groupBy("n", "window").agg(F.collect_list("item").alias("items"))
    size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("window") + 40 * F.size("items")), F.lit(0))).first()
    if size[0] <= set_windows and size[1] <= set_bytes:
        found = spark.sparkContext.broadcast(WindowSet([(r.n, bytes(r.window), r["items"]) for r in known.collect()]))
        rows = docs.select(F.col(key).alias("k"), utf8(text).alias("t"))
        out = rows.mapInArrow(_rows(found, window), f"k {dict(rows.dtypes)['k']}, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>")
        return out.withColumnRenamed("k", key)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(Bitmap.chunks(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in made], pa.int32()), pa.array([b for _, b in made], pa.binary())], names=["chunk", "bits"])

    def either(table: pa.Table) -> pa.Table:
        out = np.zeros(1 << (_CHUNK_BITS - 3), np.uint8)
        for b in table.column("bits"):
            out |= np.frombuffer(b.as_py(), np.uint8)
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    chunks = known.select("n", "window").mapInArrow(bits, "chunk int, bits binary").groupBy("chunk").applyInArrow(either, "chunk int, bits binary")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())
    found = spark.sparkContext.broadcast(Bitmap({r.chunk: bytes(r.bits) for r in chunks.collect()}, lengths))
    mark = F.sha2(utf8(text), 256)
    maybe = docs.select(mark.alias("mark"), utf8(text).alias("t")).mapInArrow(_candidates(found, window), "mark string, i bigint, n int, window binary")
    hits = maybe.groupBy("mark", "i", "n", "window").agg(F.lit(1).alias("one")).join(known, ["n", "window"])
    of_text = hits.groupBy("mark").agg(F.collect_list(F.struct("i", "n")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    spans = of_text.select("mark", "hits", "items").mapInArrow(_merge, "mark string, starts array<bigint>, ends array<bigint>, items array<string>")
    n_words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint")
    none = F.array().cast("array<bigint>")
    return (docs.select(F.col(key).alias("_k"), mark.alias("mark"), n_words.alias("n_words")).join(spans, "mark", "left")
            .select(F.col("_k").alias(key), "n_words", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", remove: str = "spans", **options) -> DataFrame:
    """Op 11. ``docs`` without what :func:`contamination` finds: ``remove="spans"`` cuts the words out of their texts, from the first
    to the last byte of a stretch, ``remove="documents"`` leaves out documents with any. Columns stay as they are, null texts too."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    marked = contamination(whole, benchmark, "row", "text", **options)
    if remove == "documents":
        return marked.where(F.size("items") + F.size("starts") == 0).select("row.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_cut(t, np.array(a), np.array(b)) if a else t for t, a, b in rows], pa.binary())], names=["row", "t"])

    kind = dict(marked.dtypes)["row"]
    cut = marked.select("row", F.col(f"row.`{text}`").cast("binary").alias("t"), "starts", "ends").mapInArrow(run, f"row {kind}, t binary")
    return cut.select(*[F.col("t").cast("string").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
