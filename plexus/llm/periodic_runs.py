"""Periodic runs of words: branching tandem squares read off an enhanced suffix array, rotated and merged into runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import merged, ranges, utf8, word_runs

MIN_LENGTH = 24
MIN_EXPONENT = 3
SLICE_BYTES = 4 << 20    # bytes of texts whose suffixes are sorted together; a longer text is a slice of its own
_LISTED = 1 << 22        # suffixes of smaller children looked at together

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Texts:
    """The words of some texts as numbers, one text after the other."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        self.values, self.starts, self.ends = values, starts, ends
        self.owner = np.repeat(np.arange(len(starts)), ends - starts)
        self.end = ends[self.owner]  # of the text that holds a word

    def only(self, keep: np.ndarray) -> Texts:
        """The texts marked by ``keep``."""
        sizes = (self.ends - self.starts)[keep]
        ends = np.cumsum(sizes)
        return Texts(self.values[ranges(self.starts[keep], sizes)], ends - sizes, ends)


def doubled_ranks(texts: Texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(h, rank, open)`` for h = 1, 2, 4, ...: ranks of all suffixes by text and first h words, and the places that share theirs.

    A rank is the number of smaller suffixes of the slice, so it is final once no other place has it. The end of
    a text counts as a word before all others. Only places that still share a rank are sorted again.
    """
    n = len(texts.values)
    place = np.lexsort((texts.values, texts.owner))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    whole = np.zeros(n, np.int64)  # rank of the group that is being split, at the first step one group
    step = texts.owner[place] * (texts.values.max(initial=0) + 1) + texts.values[place]
    h = 1
    while True:
        at = np.arange(len(place))
        new = np.r_[True, step[1:] != step[:-1]][:len(place)]
        outer = np.r_[True, whole[1:] != whole[:-1]][:len(place)]
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank[place] = whole + head - np.maximum.accumulate(np.where(outer, at, 0))
        alone = new & np.r_[new[1:], True][:len(place)]
        place = np.sort(place[~alone])
        yield h, rank, place
        if not len(place):
            return
        follow = place + h
        second = np.where(follow < texts.end[place], rank[np.minimum(follow, n)] + 1, 0)
        step = rank[place] * (n + 1) + second
        order = np.argsort(step, kind="stable")
        place, step = place[order], step[order]
        whole = rank[place]
        h *= 2


def _smaller(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest places before and after each one with a smaller value; found by following the pointers of the places between."""
    at = np.arange(len(lcp))
    before, after = at - 1, at + 1
    for pointer in (before, after):
        todo = np.flatnonzero(lcp > 0)
        while len(todo):
            todo = todo[lcp[pointer[todo]] >= lcp[todo]]
            pointer[todo] = pointer[pointer[todo]]
    return before, after


def _squares(texts: Texts, array: np.ndarray, rank: np.ndarray, lcp: np.ndarray, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(start, period)`` of the squares that branch: the word after the square is not the one that would go on with it.

    Such a square's halves start two suffixes that share just the half, so they lie in different children of the
    LCP interval of that depth. One of the two children is not the largest, so it is enough that each suffix of a
    smaller child looks up the rank of the places a depth after and before it.
    """
    left, right = _smaller(lcp)
    size = (texts.ends - texts.starts)[texts.owner[array[np.minimum(np.arange(len(lcp)), len(array) - 1)]]]
    cut = np.flatnonzero((lcp > 0) & (lcp * min_exponent <= size))  # the borders between children
    if not len(cut):
        return
    cut = cut[np.lexsort((cut, right[cut], left[cut]))]
    l, r = left[cut], right[cut]
    first = np.flatnonzero(np.r_[True, (l[1:] != l[:-1]) | (r[1:] != r[:-1])])  # of each interval
    last = np.r_[first[1:], len(cut)]
    begin, end = np.insert(cut, first, l[first]), np.insert(cut, last, r[first])
    interval = np.repeat(np.arange(len(first)), last - first + 1)
    sizes = end - begin
    largest = np.lexsort((-sizes, interval))[first + np.arange(len(first))]
    small = np.ones(len(begin), bool)
    small[largest] = False
    begin, sizes, interval = begin[small], sizes[small], interval[small]
    depth, low, high = lcp[cut[first]][interval], l[first][interval], r[first][interval]
    parts = np.searchsorted(np.cumsum(sizes), np.arange(_LISTED, sizes.sum() + _LISTED, _LISTED))
    values = np.r_[texts.values, 0]
    n = len(array)
    for a, b in zip(np.r_[0, parts], np.r_[parts, len(sizes)], strict=True):
        if a == b:
            continue
        i = array[ranges(begin[a:b], sizes[a:b])]
        d, lo, hi = (np.repeat(x[a:b], sizes[a:b]) for x in (depth, low, high))
        stop, start = texts.end[i], texts.starts[texts.owner[i]]
        for j, inside, second in ((i + d, i + d < stop, i + d), (i - d, i - d >= start, i)):  # second: where the other half starts
            met = rank[np.where(inside, j, n)]
            ends = second + d >= stop
            good = inside & (met >= lo) & (met < hi) & (ends | (values[np.minimum(second, n)] != values[np.minimum(second + d, n)]))
            yield np.minimum(i, j)[good], d[good]


def runs_of(texts: Texts, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of every run: a maximal stretch with that smallest period, of at least
    ``min_length`` words and ``min_exponent`` periods."""
    nothing = (np.zeros(0, np.int64),) * 4
    sizes = texts.ends - texts.starts
    kept = np.flatnonzero(sizes >= min_length)
    # a run of period q shares all but q words with itself q words on: texts without such a repeat have no run
    shared = min_length - min_length // min_exponent
    part = texts.only(kept)
    open_ = np.zeros(0, np.int64)
    for h, _, open_ in doubled_ranks(part) if len(part.values) else ():
        if 2 * h > shared:
            break
    kept = kept[np.unique(part.owner[open_])]
    if not len(kept):
        return nothing
    part = texts.only(kept)
    n = len(part.values)
    levels = [(h, rank.astype(np.int32)) for h, rank, _ in doubled_ranks(part)]
    rank = levels[-1][1]
    array = np.empty(n, np.int64)
    array[rank[:n]] = np.arange(n)
    lcp = np.zeros(n + 1, np.int64)  # of a suffix and the one before it
    a, b = array[:-1].copy(), array[1:].copy()
    for h, level in levels[::-1]:
        same = level[a] == level[b]
        lcp[1:n][same] += h
        a[same] += h
        b[same] += h
    found = [np.unique(s * (n + 1) + d) for s, d in _squares(part, array, rank, lcp, min_exponent)]
    if not found:
        return nothing
    start, period = np.divmod(np.unique(np.concatenate(found)), n + 1)
    end = start + 2 * period
    first = part.starts[part.owner[np.minimum(start, n - 1)]]
    for h, level in levels[::-1]:  # rotate: h words to the left at once if the h words before both halves are the same
        back = start - h
        same = (back >= first) & (level[np.maximum(back, 0)] == level[np.maximum(back, 0) + period])
        start = np.where(same, back, start)
    good = end - start >= np.maximum(min_length, min_exponent * period)
    start, end, period = start[good], end[good], period[good]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][:len(start)]  # multiples of a period are the same run
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    own = part.owner[start] if len(start) else start
    return kept[own], start - part.starts[own], end - start, period


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    out: list[bytes] = []
    size = 0
    for t in texts:
        if out and size + len(t) > SLICE_BYTES:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


def _numbered(slice_: list[bytes]) -> tuple[Texts, list[bytes]]:
    """The words of the texts as numbers, and the word of each number."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    rows = []
    for t in slice_:
        rows.append(np.concatenate([np.zeros(0, np.int32)] + [np.fromiter((number(w, len(known)) for w in run), np.int32, len(run)) for run in word_runs(t)]))
    ends = np.cumsum([len(r) for r in rows])
    return Texts(np.concatenate(rows).astype(np.int64), ends - [len(r) for r in rows], ends), list(known)


def _collapsed(values: np.ndarray, names: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    keep = np.ones(len(values), bool)
    for a, b in zip(*merged(start + period, start + length), strict=True):
        keep[a:b] = False
    return b" ".join([names[v] for v in values[keep].tolist()])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Op 13. One row per document: ``key, n_words, runs, collapsed``.

    A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least
    ``min_length`` words and ``min_exponent`` periods long, that cannot be made longer with that period. ``runs``
    are in order of start, then period, in word numbers from 0. ``collapsed`` is the text's words, joined by one blank,
    without those that any run contains after its first period. Words are runs without ASCII white space, unchanged.

    The suffixes of a slice of texts are sorted together, text by text, by doubling; texts in which no stretch repeats
    that is long enough are done then. For the others the LCP values give the intervals of equal beginnings. In each
    interval the suffixes outside the largest child look up, by the inverse array, whether the suffix a depth further on
    or back lies in the interval too: that is a square that branches. Squares are rotated left as far as they go, and
    those that end in the same run are one.

    A map without a shuffle. A text is the unit of work and takes about 300 bytes of memory a word while it is looked
    at, in time of n log n; texts are never cut. Null and empty texts have no words and no runs, repeated rows repeat
    theirs, ids may be null, an empty table gives no rows; other columns, whatever their names, are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for slice_ in _slices(batch.column(1).to_pylist()):
                texts, names = _numbered(slice_)
                owner, start, length, period = runs_of(texts, min_length, min_exponent)
                bounds = np.searchsorted(owner, np.arange(len(slice_) + 1))
                kept = []
                for k, t in enumerate(slice_):
                    a, b = bounds[k], bounds[k + 1]
                    values = texts.values[texts.starts[k]:texts.ends[k]]
                    kept.append(_collapsed(values, names, start[a:b], length[a:b], period[a:b]) if a < b or len(t) > SLICE_BYTES else b" ".join(t.split()))
                struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(slice_)), pa.array(texts.ends - texts.starts, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), struct), pa.array(kept, pa.binary())], names=["k", "n_words", "runs", "collapsed"])
                at += len(slice_)

    rows = docs.select(F.col(key).alias("k"), utf8(text).alias("t"))
    out = rows.mapInArrow(run, f"k {dict(rows.dtypes)['k']}, n_words bigint, runs {RUNS}, collapsed binary")
    return out.select(F.col("k").alias(key), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def with_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a tenth of the texts made periodic from some word on, to have runs to find.

    With h the CRC-32 of the id's digits and g = h div 10: if h ends in 0 and there are n words, those from
    a = g mod n on repeat the p = 1 + (n - a) div (3 + g mod 8) words there. Null ids and texts stay as they are.
    """
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words).cast("bigint")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    times = F.ceil((n - a) / p)
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), times.cast("int"))), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), repeated), " ")
    return docs.withColumn(text, F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), made).otherwise(F.col(text)))
