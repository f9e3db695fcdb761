"""Repeated word windows: windows of documents looked up in the blocks around shared seeds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plexus.llm.seeds import Hasher, Unit, repeated_spans


def factors(unit: Unit):
    """For each window of a bucket's stretches: does a factor from an earlier document cover it whole?

    The stretches of a bucket are the reference blocks, the neighbourhoods of shared seeds. A greedy parse into
    factors that looks at every boundary between them meets each window once; so there is no parse here: all windows of a
    bucket are sorted by two hashes, and those that a smaller document has too are covered.
    """
    def run(c: dict[str, np.ndarray], offset: np.ndarray, body: np.ndarray) -> np.ndarray:
        n = c["n"].astype(np.int64)
        who = np.repeat(np.arange(len(n)), n)
        start = offset[who] + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        if not len(start):
            return np.zeros(0, bool)
        one = Hasher(body, 0).of(start, start + unit.window)
        two = Hasher(body, 1).of(start, start + unit.window)
        doc = c["doc"][who]
        order = np.lexsort((doc, two, one))
        new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
        smallest = doc[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        found = np.empty(len(start), bool)
        found[order] = doc[order] > smallest
        return found
    return run


def _finish(texts: list[bytes], spans: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, pa.Array]:
    n_words, kept = [], []
    for text, (starts, ends) in zip(texts, spans):
        words = text.split()  # ASCII white space
        n_words.append(len(words))
        cuts = [0, *np.stack([starts, ends], 1).reshape(-1).tolist(), len(words)]
        kept.append(b" ".join(w for a, b in zip(cuts[::2], cuts[1::2]) for w in words[a:b]))
    return {"n_words": pa.array(n_words, pa.int64()),
            "starts": pa.array([s for s, _ in spans], pa.list_(pa.int64())), "ends": pa.array([e for _, e in spans], pa.list_(pa.int64())),
            "kept": pa.array(kept, pa.binary())}


def substring_dedup(docs: DataFrame, window: int = 13, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Op 6. ``key, n_words, starts, ends, kept``: words covered by ``window`` words that a smaller document has too.

    Windows are judged on the input. Spans are maximal, in words; ``kept`` is the rest, joined by one
    blank. Stretches that equal one of a smaller document as a whole are factors without further
    look; the others are parsed against the reference blocks of their seed (see ``factors``).

    Words are runs without ASCII white space; null and empty texts have none. Documents with the same
    id are not smaller than each other; rows that repeat id and text are one document; null ids come first.
    """
    unit = Unit(words=True, window=window, gram=max(1, min(5, window // 2)), within=False)
    return repeated_spans(docs, unit, factors(unit), _finish,
                          "n_words bigint, starts array<bigint>, ends array<bigint>, kept binary", key, text)
