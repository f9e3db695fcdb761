"""Where texts repeat: seeds chosen by content, met in buckets, settled first as whole stretches.

Both operators on repeated passages ask, for each window of W units (bytes or words) of a text,
whether the same window also starts earlier. Windows are far too many to shuffle. So each window
picks the gram with the least hash in it, its seed; equal windows pick equal seeds at the same place.
Consecutive windows with one seed make a stretch, and only stretches are shuffled, one for tens
of bytes: the seed's hash, a hash of all units of the stretch, and where it lies. A bucket settles
stretches that equal an earlier one as a whole. Those whose seed also occurs around other units are
asked for: only their windows are compared one by one, each operator in its own way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import merged, partitions, ranges, save, utf8

SLICE_BYTES = 1 << 20     # bytes hashed at a time
BATCH_BYTES = 16 << 20    # bytes whose stretches go out together, once per bucket
HOT_SEED = 1_000          # different stretches of a seed beyond which it is cut further
U8 = np.uint64
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(U8) | U8(1)
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1, 0xA24BAED4963EE407 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers, one to one."""
    x = x ^ (x >> U8(32))
    x = x * U8(0xD6E8FEB86659FD93)
    x = x ^ (x >> U8(32))
    x = x * U8(0xD6E8FEB86659FD93)
    return x ^ (x >> U8(32))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.up, self.down = base, np.ones(1, U8), np.ones(1, U8)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.r_[U8(1), np.full(size - 1, self.base, U8)], dtype=U8)
            self.down = np.cumprod(np.r_[U8(1), np.full(size - 1, pow(self.base, -1, 1 << 64), U8)], dtype=U8)
        return self.up, self.down


_POWERS = [_Powers(b) for b in _BASES]


class Hasher:
    """Hashes of any stretch of a row of 64-bit values, from running sums."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        up, self.down = _POWERS[base].get(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U8)
        np.cumsum(values * up[:len(values)], out=self.sums[1:], dtype=U8)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, n: int) -> np.ndarray:
        last = len(self.sums) - n
        return mix((self.sums[n:] - self.sums[:last]) * self.down[:last])


@dataclass(frozen=True)
class Unit:
    """What is compared: bytes or words, in windows of ``window``, with seeds of ``gram``.

    ``within``: an earlier place in the same document counts too.
    """
    words: bool
    window: int
    gram: int
    within: bool


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a row of bytes."""
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    inside = np.r_[False, ~blank[data], False].astype(np.int8)
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def unit_values(unit: Unit, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit value of each unit, and the byte at which it starts. A word's value is its XXH64, a byte's comes from a table."""
    if not unit.words:
        return _TABLE[data], np.arange(len(data), dtype=np.int64)
    words = data.tobytes().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), U8, len(words)), word_bounds(data)[0]


def _pieces(unit: Unit, texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Slices of about ``SLICE_BYTES``: lists of (text, units before, bytes). A longer text comes in pieces that overlap by a window."""
    piece: list[tuple[int, int, bytes]] = []
    size = 0
    for k, text in enumerate(texts):
        if len(text) <= SLICE_BYTES:
            if size + len(text) > SLICE_BYTES and piece:
                yield piece
                piece, size = [], 0
            piece.append((k, 0, text))
            size += len(text) + 1
            continue
        at = before = 0
        while at < len(text):
            part = text[at:at + SLICE_BYTES]
            if at + len(part) < len(text) and unit.words:
                starts, ends = word_bounds(np.frombuffer(part, np.uint8))
                if len(starts) and ends[-1] == len(part):  # the last word may go on
                    if len(starts) <= 2 * unit.window:  # hardly a word in a whole slice: take the rest of the text as one
                        part = text[at:]
                    else:
                        part = part[:starts[-1]]
            yield [(k, before, part)]
            if at + len(part) >= len(text):
                break
            if unit.words:
                starts, _ = word_bounds(np.frombuffer(part, np.uint8))
                keep = min(unit.window - 1, len(starts))
                at += int(starts[len(starts) - keep]) if keep else len(part)
                before += len(starts) - keep
            else:
                at += len(part) - unit.window + 1
                before += len(part) - unit.window + 1
    if piece:
        yield piece


def stretches(unit: Unit, texts: list[bytes]) -> dict[str, np.ndarray]:
    """All stretches of the texts: ``k`` (text), ``pos`` (first window), ``n`` (windows), ``o`` (place of the seed), ``h``, ``g``."""
    out: list[list[np.ndarray]] = []
    w, size = unit.window - unit.gram + 1, unit.window
    for piece in _pieces(unit, texts):
        glue = b" " if unit.words else b""
        data = np.frombuffer(glue.join(t for _, _, t in piece), np.uint8)
        values, first_byte = unit_values(unit, data)
        total = len(values)
        if total < size:
            continue
        lengths = np.fromiter((len(t) for _, _, t in piece), np.int64, len(piece))
        byte_start = np.cumsum(lengths + len(glue)) - lengths - len(glue)
        start = np.searchsorted(first_byte, byte_start) if unit.words else byte_start
        end = np.r_[start[1:], total]
        sums = Hasher(values, 0)
        grams = sums.grams(unit.gram)
        low = U8((1 << 24) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=U8)
        span = 1
        while span * 2 <= w:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < w:
            least = np.minimum(least[:len(least) - (w - span)], least[w - span:])
        seed = (least & low).astype(np.int64)  # of the window that starts here
        many = np.maximum(end - start - size + 1, 0)
        window = ranges(start, many)
        if not len(window):
            continue
        owner = np.repeat(np.arange(len(piece)), many)
        at = seed[window]
        new = np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])]
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(window)])
        p, a, who = window[first], at[first], owner[first]
        whole = Hasher(values, 1).of(p, p + n - 1 + size)
        o = a - p
        whole = mix(whole + n.astype(U8) * U8(0x9E3779B97F4A7C15) + o.astype(U8) * U8(0xC2B2AE3D27D4EB4F))
        ks = np.fromiter((k for k, _, _ in piece), np.int64, len(piece))
        before = np.fromiter((b for _, b, _ in piece), np.int64, len(piece))
        out.append([ks[who], p - start[who] + before[who], n, o, grams[a], whole])
    names = ("k", "pos", "n", "o", "h", "g")
    if not out:
        return {c: np.zeros(0, U8 if c in "hg" else np.int64) for c in names}
    return {c: np.concatenate(x) for c, x in zip(names, zip(*out))}


#: Columns of packed rows: a row of a frame holds the columns of many stretches, one after the other.
STRETCH = {"h": "<u8", "g": "<u8", "doc": "<i8", "tag": "<u4", "pos": "<u4", "n": "u1", "o": "u1"}
SPAN = {"doc": "<i8", "tag": "<u4", "start": "<u4", "end": "<u4"}
ASK = {"h": "<u8", "doc": "<i8", "tag": "<u4", "pos": "<u4", "n": "u1", "o": "u1", "hot": "u1"}


def sized(kind: dict[str, str], unit: Unit) -> dict[str, str]:
    """The columns with room for the windows of a stretch, fewer than a window has units."""
    return kind if unit.window < 256 else {c: "<u4" if c in ("n", "o") else t for c, t in kind.items()}


def pack(columns: dict[str, np.ndarray], kind: dict[str, str], rows: np.ndarray | slice = slice(None)) -> bytes:
    """Columns one after the other, each byte by byte, so that bytes that hardly change lie together."""
    out = []
    for c, t in kind.items():
        x = np.ascontiguousarray(columns[c][rows], dtype=t)
        out.append(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes())
    return b"".join(out)


def unpack(blobs: list[bytes], kind: dict[str, str]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {c: [] for c in kind}
    width = sum(np.dtype(t).itemsize for t in kind.values())
    for blob in blobs:
        n, at = len(blob) // width, 0
        for c, t in kind.items():
            size = np.dtype(t).itemsize
            parts[c].append(np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n).T.reshape(-1).view(t))
            at += n * size
    return {c: (np.concatenate(parts[c]) if parts[c] else np.zeros(0, t)).astype(t) for c, t in kind.items()}


def _packed_by(bucket: np.ndarray, columns: dict[str, np.ndarray], kind: dict[str, str]) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    sorted_ = bucket[order]
    cuts = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1], True]) if len(order) else np.zeros(1, np.int64)
    for s, e in zip(cuts[:-1], cuts[1:]):
        yield int(sorted_[s]), pack(columns, kind, order[s:e])


def _later(unit: Unit, c: dict[str, np.ndarray], new: np.ndarray) -> np.ndarray:
    """Rows, sorted inside groups that begin at ``new``, that have an earlier one in their group."""
    if not len(new):
        return new
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return ~new if unit.within else c["doc"] > c["doc"][first]


def _spans(unit: Unit, c: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    pos = c["pos"][rows].astype(np.int64)
    return {"doc": c["doc"][rows], "tag": c["tag"][rows], "start": pos, "end": pos + c["n"][rows] - 1 + unit.window}


def joined_spans(s: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Spans of each document as a union."""
    if not len(s["doc"]):
        return s
    order = np.lexsort((s["start"], s["tag"], s["doc"]))
    doc, tag, start, end = (s[c][order] for c in ("doc", "tag", "start", "end"))
    start, end = start.astype(np.int64), end.astype(np.int64)
    owner = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
    big = int(end.max()) + 2
    a, b = merged(start + owner * big, end + owner * big)
    who = np.searchsorted(owner, a // big)
    return {"doc": doc[who], "tag": tag[who], "start": a - (a // big) * big, "end": b - (a // big) * big}


def _take(c: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[rows] for k, v in c.items()}


_ROWS = "bucket long, kind int, blob binary"


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "blob"])


def _find(unit: Unit, buckets: int, doc_buckets: int):
    """Map: stretches by bucket of the seed (kind 0), and spans that the batch settles by itself (kind 1).

    Of stretches that are equal as a whole only the first of a batch goes on, so a passage that a
    third of all documents share costs one row per batch.
    """
    def flush(ids: list[int], tags: list[int], texts: list[bytes]) -> pa.RecordBatch:
        c = stretches(unit, texts)
        doc, tag = np.array(ids, np.int64), np.array(tags, np.int64)
        c = {**c, "doc": doc[c["k"]], "tag": tag[c["k"]]}
        order = np.lexsort((c["pos"], c["tag"], c["doc"], c["g"], c["h"]))
        c = _take(c, order)
        new = np.r_[True, (c["h"][1:] != c["h"][:-1]) | (c["g"][1:] != c["g"][:-1])] if len(order) else np.zeros(0, bool)
        later = _later(unit, c, new)
        again = ~new & np.r_[False, (c["doc"][1:] == c["doc"][:-1]) & (c["tag"][1:] == c["tag"][:-1]) & (c["pos"][1:] == c["pos"][:-1])] if len(order) else new
        settled = joined_spans(_spans(unit, c, np.flatnonzero(later & ~again)))
        go = _take(c, np.flatnonzero(~later & ~again))
        go = _take(go, np.lexsort((go["pos"], go["doc"])))  # columns in order are compressed well
        rows = [(b, 0, blob) for b, blob in _packed_by((go["h"] >> U8(20)) % U8(buckets), go, sized(STRETCH, unit))]
        rows += [(b, 1, blob) for b, blob in _packed_by(doc_bucket(settled["doc"], doc_buckets), settled, SPAN)]
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _text_batches(batches):
            yield flush([i for i, _, _ in rows], [t for _, t, _ in rows], [x for _, _, x in rows])
    return run


def doc_bucket(doc: np.ndarray, n: int) -> np.ndarray:
    return np.mod(doc.astype(np.int64), n)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Rows of one bucket at a time from a partition sorted by bucket."""
    now, rows = None, []
    for batch in batches:
        for b, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if b != now and rows:
                yield now, rows
                rows = []
            now = b
            rows.append((kind, blob.as_py()))
    if rows:
        yield now, rows


def _meet(unit: Unit, doc_buckets: int):
    """Reduce: per bucket of seeds, spans settled as whole stretches (kind 1) and stretches to compare (kind 2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            out: list[tuple[int, int, bytes]] = []
            c = unpack([blob for _, blob in rows], sized(STRETCH, unit))
            c = _take(c, np.argsort(c["h"], kind="stable"))
            edge = np.r_[True, c["h"][1:] != c["h"][:-1], True] if len(c["h"]) else np.ones(1, bool)
            c = _take(c, np.flatnonzero(~(edge[:-1] & edge[1:])))
            if len(c["h"]):
                c = _take(c, np.lexsort((c["pos"], c["tag"], c["doc"], c["g"], c["h"])))
                # a row that repeats id and text in another batch is the same document: its stretches count once
                same = np.logical_and.reduce([c[k][1:] == c[k][:-1] for k in ("h", "g", "doc", "tag", "pos")])
                c = _take(c, np.flatnonzero(np.r_[True, ~same]))
                seed = np.r_[True, c["h"][1:] != c["h"][:-1]]
                new = seed | np.r_[True, c["g"][1:] != c["g"][:-1]]
                later = _later(unit, c, new)
                group = np.cumsum(seed) - 1
                kinds = np.bincount(group, weights=new)[group]
                settled = joined_spans(_spans(unit, c, np.flatnonzero(later)))
                asked = _take({**c, "hot": (kinds > HOT_SEED).astype(np.uint8)}, np.flatnonzero(~later & (kinds > 1)))
                out += [(b, 1, blob) for b, blob in _packed_by(doc_bucket(settled["doc"], doc_buckets), settled, SPAN)]
                out += [(b, 2, blob) for b, blob in _packed_by(doc_bucket(asked["doc"], doc_buckets), asked, sized(ASK, unit))]
            if out:
                yield _rows(out)
    return run


def _prime(n: int) -> int:
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def _pack_docs(doc_buckets: int):
    """Map: documents by their bucket, compressed together, since they are shuffled twice."""
    def flush(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        bucket = doc_bucket(np.array([i for i, _, _ in rows], np.int64), doc_buckets)
        order = np.argsort(bucket, kind="stable").tolist()
        cuts = [k for k in range(len(order)) if not k or bucket[order[k]] != bucket[order[k - 1]]] + [len(order)]
        out = []
        for s, e in zip(cuts, cuts[1:]):
            own = [rows[k] for k in order[s:e]]
            ids, tags = np.array([i for i, _, _ in own], "<i8"), np.array([t for _, t, _ in own], "<i8")
            sizes = np.array([len(x) for _, _, x in own], "<i8")
            out.append((int(bucket[order[s]]), 4, zstandard.compress(
                np.int64(len(own)).tobytes() + ids.tobytes() + tags.tobytes() + sizes.tobytes() + b"".join(x for _, _, x in own), 3)))
        return _rows(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _text_batches(batches):
            yield flush(rows)
    return run


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Rows of ``id, tag, text`` in lists of about ``BATCH_BYTES``."""
    rows: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        for i, t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            rows.append((i, t, x.as_py()))
            size += len(rows[-1][2])
            if size >= BATCH_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def open_docs(blobs: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """``(id, tag, text)`` of packed documents."""
    for blob in blobs:
        raw = zstandard.decompress(blob)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        ids, tags, sizes = (np.frombuffer(raw, "<i8", n, 8 + 8 * n * k).tolist() for k in range(3))
        at = 8 + 24 * n
        for i, t, size in zip(ids, tags, sizes):
            yield i, t, raw[at:at + size]
            at += size


def _fetch(unit: Unit, buckets: int):
    """Cogroup: the units of the stretches asked for, by bucket of the seed (kind 3)."""
    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, bytes]] = []
        c = unpack(asked.column("blob").to_pylist(), sized(ASK, unit))
        if len(c["doc"]):
            c = _take(c, np.lexsort((c["tag"], c["doc"])))
            seen = set()
            for i, t, text in open_docs(docs.column("blob").to_pylist()):
                if (i, t) in seen:
                    continue
                seen.add((i, t))
                s, e = np.searchsorted(c["doc"], i), np.searchsorted(c["doc"], i, side="right")
                mine = s + np.flatnonzero(c["tag"][s:e] == t)
                if len(mine):
                    values = _whole_units(unit, text)
                    rows += list(_packed_records(unit, buckets, values, _take(c, mine)))
        return pa.Table.from_batches([_rows(rows)])
    return run


def _whole_units(unit: Unit, text: bytes) -> np.ndarray:
    """Bytes, or a 64-bit value per word, of a whole text."""
    data = np.frombuffer(text, np.uint8)
    if not unit.words:
        return data
    out = []
    at = 0
    while at < len(data):  # in runs that end at a word's end
        part = data[at:at + SLICE_BYTES]
        starts, ends = word_bounds(part)
        if at + len(part) < len(data) and len(ends) and ends[-1] == len(part):
            if len(starts) == 1:
                part = data[at:]
            else:
                part = part[:starts[-1]]
        out.append(unit_values(unit, part)[0])
        at += len(part)
    return np.concatenate(out) if out else np.zeros(0, U8)


def _packed_records(unit: Unit, buckets: int, values: np.ndarray, c: dict[str, np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """Stretches with their units. A hot seed's windows are cut into classes by their distance from the seed;
    what all windows of a class have in common, nearly a whole window, takes the place of the seed."""
    pos, n, seed, h = c["pos"].astype(np.int64), c["n"].astype(np.int64), c["pos"].astype(np.int64) + c["o"], c["h"]
    hot = c["hot"] > 0
    if hot.any():
        step = max(1, (unit.window - unit.gram + 1) // 4)
        w = ranges(pos[hot], n[hot])
        who = np.repeat(np.flatnonzero(hot), n[hot])
        cls = (seed[who] - w) // step
        new = np.r_[True, (who[1:] != who[:-1]) | (cls[1:] != cls[:-1])]
        at = np.flatnonzero(new)
        p, m, o, k = w[at], np.diff(np.r_[at, len(w)]), who[at], cls[at]
        core = np.maximum(seed[o] - k * step, 0)
        core_end = np.minimum(seed[o] - (k + 1) * step + 1 + unit.window, len(values))
        wide = values if unit.words else _TABLE[values]
        key = mix(Hasher(wide, 1).of(core, core_end) + k.astype(U8) * U8(0x9E3779B97F4A7C15))
        pos, n, h = np.r_[pos[~hot], p], np.r_[n[~hot], m], np.r_[h[~hot], key]
        doc, tag = np.r_[c["doc"][~hot], c["doc"][o]], np.r_[c["tag"][~hot], c["tag"][o]]
    else:
        doc, tag = c["doc"], c["tag"]
    bucket = (h >> U8(20)) % U8(buckets)
    for b in np.unique(bucket):
        rows = np.flatnonzero(bucket == b)
        count = n[rows] - 1 + unit.window
        body = values[ranges(pos[rows], count)]
        head = pack({"h": h, "doc": doc, "tag": tag, "pos": pos, "n": n}, sized(RECORD, unit), rows)
        yield int(b), 3, len(rows).to_bytes(4, "little") + head + body.tobytes()


RECORD = {"h": "<u8", "doc": "<i8", "tag": "<u4", "pos": "<u4", "n": "u1"}


def unpack_records(unit: Unit, blobs: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Stretches, and all their units one after the other."""
    kind = sized(RECORD, unit)
    width = sum(np.dtype(t).itemsize for t in kind.values())
    heads, bodies = [], []
    for blob in blobs:
        n = int.from_bytes(blob[:4], "little")
        heads.append(blob[4:4 + n * width])
        bodies.append(np.frombuffer(blob, "<u8" if unit.words else np.uint8, offset=4 + n * width))
    return unpack(heads, kind), np.concatenate(bodies) if bodies else np.zeros(0, np.uint8)


def _compare(unit: Unit, doc_buckets: int, covered: Callable):
    """Reduce: per bucket, the windows that also start earlier, as spans (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in by_bucket(batches):
            c, body = unpack_records(unit, [blob for _, blob in rows])
            n = c["n"].astype(np.int64)
            size = n - 1 + unit.window
            offset = np.cumsum(size) - size
            hit = covered(c, offset, body)  # a flag for each window, stretch by stretch
            who = np.repeat(np.arange(len(n)), n)
            place = ranges(np.zeros(len(n), np.int64), n)
            rows_hit = np.flatnonzero(hit)
            spans = {"doc": c["doc"][who[rows_hit]], "tag": c["tag"][who[rows_hit]],
                     "start": c["pos"].astype(np.int64)[who[rows_hit]] + place[rows_hit]}
            spans["end"] = spans["start"] + unit.window
            spans = joined_spans(spans)
            out = [(b, 1, blob) for b, blob in _packed_by(doc_bucket(spans["doc"], doc_buckets), spans, SPAN)]
            if out:
                yield _rows(out)
    return run


def repeated_spans(docs: DataFrame, unit: Unit, covered: Callable, finish: Callable, result: str,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """Repeated spans of each text; ``finish(texts, spans)`` makes the columns ``result`` of them.

    Documents are told apart by id and a hash of the text: rows that repeat both are one document
    and get one answer. A null id counts as the smallest number. Three shuffles carry stretches and
    spans, two carry the texts to their spans; each task holds one bucket of either at a time.
    """
    spark = docs.sparkSession
    parts = partitions(docs)
    buckets, doc_buckets = 8 * parts, _prime(4 * parts)
    lowest = F.lit(-(1 << 63) + 1).cast("bigint")
    rows = docs.select(F.coalesce(F.col(key).cast("bigint"), lowest).alias("id"),
                       F.shiftrightunsigned(F.xxhash64(utf8(text)), 33).alias("tag"), utf8(text).alias("text"))
    found = rows.mapInArrow(_find(unit, buckets, doc_buckets), _ROWS)
    # spans settled in the map share the shuffle; they keep the bucket of their document
    met = save(found.repartition("bucket", "kind").sortWithinPartitions("bucket", "kind")
               .mapInArrow(_pass_or(_meet(unit, doc_buckets)), _ROWS), "met")
    packed = rows.mapInArrow(_pack_docs(doc_buckets), _ROWS).select("bucket", "blob").groupBy("bucket")
    records = packed.cogroup(met.where("kind = 2").select("bucket", "blob").groupBy("bucket")).applyInArrow(_fetch(unit, buckets), _ROWS)
    compared = records.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_compare(unit, doc_buckets, covered), _ROWS)
    spans = met.where("kind = 1").unionByName(compared).select("bucket", "blob").groupBy("bucket")
    done = packed.cogroup(spans).applyInArrow(_finish(finish), f"id bigint, {result}")
    whole = F.when(F.col("id") != lowest, F.col("id")).cast(docs.schema[key].dataType)
    return done.select(whole.alias(key), *[c for c in done.columns if c != "id"])


def _pass_or(run: Callable):
    """Let rows of kind 1 pass, hand the others on."""
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[pa.RecordBatch] = []

        def others() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                settled = np.asarray(batch.column(1)) == 1
                passed.append(batch.filter(pa.array(settled)))
                yield batch.filter(pa.array(~settled))

        for out in run(others()):
            yield from (b for b in passed if b.num_rows)
            passed.clear()
            yield out
        yield from (b for b in passed if b.num_rows)
    return both


def _finish(finish: Callable):
    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        s = joined_spans(unpack(spans.column("blob").to_pylist(), SPAN))
        texts, found = [], []
        ids = []
        for i, t, text in open_docs(docs.column("blob").to_pylist()):
            a, b = np.searchsorted(s["doc"], i), np.searchsorted(s["doc"], i, side="right")
            mine = a + np.flatnonzero(s["tag"][a:b] == t)
            ids.append(i)
            texts.append(text)
            found.append((s["start"][mine].astype(np.int64), s["end"][mine].astype(np.int64)))
        return pa.table({"id": pa.array(ids, pa.int64()), **finish(texts, found)})
    return run
