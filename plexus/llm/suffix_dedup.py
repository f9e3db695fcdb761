"""Repeated byte strings: suffix arrays of batches in a logarithmic family of levels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plexus.llm.common import ranges
from plexus.llm.seeds import _TABLE, Hasher, Unit, repeated_spans

BATCH_WINDOWS = 1 << 19   # suffixes of a batch


class SuffixFamily:
    """Sorted levels of suffix keys, each about twice the next; a new batch is scanned against all, then merged.

    The key of a suffix is its first eight bytes, then a 64-bit hash of its whole window: suffixes are in
    the order of their text as far as eight bytes go, and equal windows are neighbours.
    """

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Merge-scan of a sorted batch against each level: which keys are in one."""
        found = np.zeros(len(keys), bool)
        for level in self.levels:
            at = np.searchsorted(level, keys)
            at[at == len(level)] = 0
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        """A sorted batch of new keys becomes a level; levels of about one size are merged."""
        if len(keys):
            self.levels.append(keys)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            last = self.levels.pop()
            self.levels[-1] = np.sort(np.concatenate([self.levels[-1], last]), kind="stable")


def suffix_keys(body: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """16-byte keys of the suffixes at ``starts``, which compare as bytes."""
    keys = np.empty((len(starts), 2), ">u8")
    first = np.zeros(len(starts), np.uint64)
    for i in range(8):
        first = (first << np.uint64(8)) | body[starts + i].astype(np.uint64)
    keys[:, 0] = first
    keys[:, 1] = Hasher(_TABLE[body], 1).of(starts, starts + window)
    return keys.reshape(-1).view("S16")


def covered(unit: Unit):
    """For each window of a bucket's stretches: does the same string start earlier?"""
    def run(c: dict[str, np.ndarray], offset: np.ndarray, body: np.ndarray) -> np.ndarray:
        n = c["n"].astype(np.int64)
        flags = np.zeros(int(n.sum()), bool)
        place = np.cumsum(n) - n
        order = np.lexsort((c["pos"], c["tag"], c["doc"]))  # batches come in the order of the corpus
        family = SuffixFamily()
        cuts = np.r_[0, np.flatnonzero(np.diff(np.cumsum(n[order]) // BATCH_WINDOWS)) + 1, len(order)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            rows = order[s:e]
            size = n[rows] - 1 + unit.window
            text = body[ranges(offset[rows], size)]
            starts = ranges(np.cumsum(size) - size, n[rows])
            keys = suffix_keys(text, starts, unit.window)
            suffixes = np.argsort(keys, kind="stable")  # the batch's suffix array; equal ones in corpus order
            keys = keys[suffixes]
            again = np.r_[False, keys[1:] == keys[:-1]]
            heads = np.flatnonzero(~again)
            old = family.holds(keys[heads])
            family.add(keys[heads[~old]])
            again[heads] = old
            flags[ranges(place[rows], n[rows])[suffixes]] = again
        return flags
    return run


def _finish(texts: list[bytes], spans: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, pa.Array]:
    kept = []
    for text, (starts, ends) in zip(texts, spans):
        cuts = [0, *np.stack([starts, ends], 1).reshape(-1).tolist(), len(text)]
        kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
    return {"n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "starts": pa.array([s for s, _ in spans], pa.list_(pa.int64())), "ends": pa.array([e for _, e in spans], pa.list_(pa.int64())),
            "kept": pa.array(kept, pa.binary())}


def suffix_dedup(docs: DataFrame, window: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Op 5. ``key, n_bytes, starts, ends, kept``: bytes that lie in a string of ``window`` bytes that also starts earlier.

    Earlier is a smaller id, or the same text at an earlier place; overlaps count, and strings are
    judged on the input. Spans are maximal, in bytes; ``kept`` is the rest. Seeds bring equal stretches
    together (see ``seeds``). What is not settled there goes to buckets of a seed, where each
    batch of stretches gets a suffix array of its windows, is scanned against the existing levels for
    windows they hold, and becomes a level; levels of one size merge. A stretch never crosses texts.

    Null and empty texts have no bytes. A text of one character repeated is one span after its first
    window. Rows with the same id and text are one document; null ids come first.
    """
    unit = Unit(words=False, window=window, gram=max(8, min(24, window // 4)), within=True)
    return repeated_spans(docs, unit, covered(unit), _finish,
                          "n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary", key, text)
