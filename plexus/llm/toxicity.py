"""Toxicity: significant passages by maximum-scoring segments over token log-odds."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import save

TRAIN_ROWS = 20_000    # labelled rows of each class that a model is fitted on, about, at most
MODEL_TOKENS = 20_000  # tokens and prefixes that a model holds at most: the safest
PRIOR = 0.05           # weight of the Dirichlet prior, as a share of the counts of each class
DEVIATIONS = 2.0       # a token scores its log-odds less so many standard deviations
MIN_ODDS = 1.0         # and counts from here
MAX_ODDS = 6.0
DRIFT = 0.25           # cost of a token that does not count
PREFIX_SHARE = 5.0       # documents that a word adds to the count of its beginnings at most, so that one word makes no family
PREFIXES = (5, 4, 3)   # an unseen word is judged by its longest known beginning
_TOKEN = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]")


@dataclass
class Model:
    """Log-odds of tokens (prefixes end in ``*``), extreme-value constants and the final scale."""
    odds: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    rate: float = 1.0
    slope: float = 0.0
    offset: float = -50.0


class _Odds(dict):
    """Score of a token, looked up once; forgotten when too many were seen."""

    def __init__(self, odds: dict[str, float], most: int = 200_000) -> None:
        super().__init__()
        self.odds, self.most = odds, most

    def __missing__(self, token: str) -> float:
        value = self.odds.get(token, 0.0)
        if not value:
            for n in PREFIXES:
                if len(token) > n and (value := self.odds.get(token[:n] + "*", 0.0)):
                    break
        if len(self) >= self.most:
            self.clear()
        self[token] = value
        return value


def tokens(text: str, size: int = 1 << 20) -> Iterator[list[str]]:
    """Lower-case words in runs of bounded size."""
    at, n = 0, len(text)
    while at < n:
        end = min(at + size, n)
        if end < n:
            gap = _GAP.search(text, end)
            end = gap.start() if gap else n
        yield _TOKEN.findall(text[at:end].lower())
        at = end


def segments(places: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, first, last)``, in linear time.

    ``places`` are the tokens with a positive score; every other token costs ``drift``. A candidate
    joins to its left the nearest one that starts lower, if it ends higher than that one; links to the
    next lower start let each candidate be passed only once.
    """
    out: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, first, last, place of the next lower start
    total, before = 0.0, -1
    for at, score in zip(places, scores):
        total -= drift * (at - before - 1)
        before = at
        left, right, first = total, total + score, at
        total = right
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][0] >= left:
                j = out[j][4]
            if j < 0 or out[j][1] >= right:
                out.append((left, right, first, at, j))
                break
            left, first, lower = out[j][0], out[j][2], out[j][4]
            del out[j:]
            j = lower
    return [(right - left, first, last) for left, right, first, last, _ in out]


def scan(text: str, odds: _Odds) -> tuple[int, list[tuple[float, int, int]]]:
    """Number of tokens and the maximal segments of a whole text."""
    n, places, scores = 0, [], []
    for run in tokens(text):
        values = [odds[t] for t in run]
        for i, v in enumerate(values):
            if v:
                places.append(n + i)
                scores.append(v)
        n += len(run)
    return n, segments(places, scores)


def evidence(model: Model, n: int, found: list[tuple[float, int, int]]) -> float:
    """Sum statistic of the best segments: the largest ``lambda * sum - r * ln(K n) + ln r!`` over r of them."""
    best, total, base = 0.0, 0.0, max(0.0, math.log(max(model.rate * max(n, 1), 1e-12)))
    for r, score in enumerate(sorted((s for s, _, _ in found), reverse=True), 1):
        total += model.decay * score - base + math.log(r)
        best = max(best, total)
    return best


def probability(model: Model, x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, model.slope * math.log1p(x) + model.offset))))


def is_held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _family(text: str) -> int:
    """Least hash of three words in a row: near copies have it in common, other texts do not."""
    least, tail = None, []
    for run in tokens(text):
        run = tail + run
        for i in range(max(1, len(run) - 2)):
            h = xxhash.xxh64_intdigest(" ".join(run[i:i + 3]))
            least = h if least is None or h < least else least
        tail = run[-2:]
    return (least or 0) >> 1


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                  rows: int = TRAIN_ROWS) -> DataFrame:
    """``text, y, fold`` of labelled documents that are not held out, about ``rows`` of each class at most.

    The choice is by a hash of the id. It has at most a few more than two times ``rows`` rows, so it
    may be broadcast, and the documents are filtered where they lie. Of near copies one counts, or
    every word of a text copied often would seem to mark its class.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~is_held_out(key))
             .groupBy(key).agg(F.max(label).cast("int").alias("y")))
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, rows / max(1, counts.get(1, 0)))).otherwise(min(1.0, rows / max(1, counts.get(0, 0))))
    chosen = known.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1_000_000)) < share * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            family = pa.array([_family(t.as_py()) for t in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, family], names=["text", "y", "family"])

    marked = (docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), key)
              .select("text", "y").mapInArrow(run, "text string, y int, family bigint"))
    return save(marked.groupBy("family", "y").agg(F.min("text").alias("text"))
                .select("text", "y", F.pmod(F.xxhash64("family"), F.lit(4)).cast("int").alias("fold")), "train")


def _token_counts(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: Counter[str] = Counter()
        clean: Counter[str] = Counter()
        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                words = {t for part in tokens(text.as_py()) for t in part}
                (toxic if y == 1 else clean).update(words)
        names = list(toxic)  # a token of clean documents alone never counts
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[t] for t in names], pa.int64()),
                                          pa.array([0] * len(names), pa.int64())], names=["token", "y1", "y0"])
        names = list(clean)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([0] * len(names), pa.int64()),
                                          pa.array([clean[t] for t in names], pa.int64())], names=["token", "y1", "y0"])

    words = (rows.select("text", "y").mapInArrow(run, "token string, y1 bigint, y0 bigint")
             .groupBy("token").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")))
    words = words.select("token", F.col("y1").cast("double"), F.col("y0").cast("double"))
    part = F.least(F.lit(1.0), F.lit(PREFIX_SHARE) / (F.col("y1") + F.col("y0")))
    starts = F.array(*[F.when(F.length("token") > n, F.concat(F.substring("token", 1, n), F.lit("*"))) for n in PREFIXES])
    prefixes = (words.select(F.explode(starts).alias("token"), (F.col("y1") * part).alias("y1"), (F.col("y0") * part).alias("y0"))
                .where("token IS NOT NULL").groupBy("token").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")))
    return words.unionByName(prefixes)


def fit(rows: DataFrame, prior: float = PRIOR, deviations: float = DEVIATIONS, most: int = MODEL_TOKENS) -> Model:
    """A model from ``training_rows``: three quarters give the log-odds, the rest calibrates the scores.

    Log-odds compare document frequencies under an informative Dirichlet prior, which gives each
    token its share of all documents in both classes; a token scores the safe side of its log-odds,
    so that chance among many rare words finds nothing. Without documents of both classes the model
    finds nothing. To the driver come two numbers per class, at most ``most`` tokens and one row of
    figures per calibration document.
    """
    n = {r["y"]: r["count"] for r in rows.where("fold > 0").groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model()
    counts = save(_token_counts(rows.where("fold > 0")), "counts")
    sums = counts.where("token LIKE '%*'").agg(F.sum("y1"), F.sum("y0")).first()
    starts = F.col("token").endswith("*")  # beginnings are shares of all words, words are shares of all documents
    n1 = F.when(starts, F.lit(float(sums[0] or 1))).otherwise(F.lit(float(n[1])))
    n0 = F.when(starts, F.lit(float(sums[1] or 1))).otherwise(F.lit(float(n[0])))
    share = F.lit(prior) * (F.col("y1") + F.col("y0")) / (n1 + n0)
    a1, a0 = F.col("y1") + share * n1, F.col("y0") + share * n0
    odds = F.log(a1 / (n1 * (1 + prior))) - F.log(a0 / (n0 * (1 + prior)))
    safe = odds - F.lit(deviations) * F.sqrt(1 / a1 + 1 / a0)
    kept = (counts.where("y1 > 1").select("token", safe.alias("odds"))
            .where(F.col("odds") >= MIN_ODDS).orderBy(F.desc("odds"), "token").limit(most).collect())
    model = Model({r["token"]: min(MAX_ODDS, float(r["odds"])) for r in kept})
    return _calibrate(model, rows.where("fold = 0"))


def _calibrate(model: Model, rows: DataFrame) -> Model:
    """Extreme-value constants from clean documents, then a logistic scale from both classes."""
    odds = model.odds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Odds(odds)
        for batch in batches:
            found = [scan(t.as_py(), cache) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([[s for s, _, _ in f] for _, f in found], pa.list_(pa.float64()))], names=["y", "n", "scores"])

    got = rows.select("text", "y").mapInArrow(run, "y int, n bigint, scores array<double>").orderBy("y", "n", "scores").collect()
    clean = [r for r in got if r["y"] == 0]
    size = max(1.0, float(sum(r["n"] for r in clean)))
    hits = np.array([s for r in clean for s in r["scores"] if s >= MIN_ODDS] or [MIN_ODDS + 1.0])
    # the tail of scores above the least one is exponential; its median bears a few mislabelled documents
    model.decay = min(3.0, max(0.2, math.log(2) / max(1e-9, float(np.median(hits)) - MIN_ODDS)))
    model.rate = len(hits) / size * math.exp(model.decay * MIN_ODDS)
    x = np.log1p(np.array([evidence(model, r["n"], [(s, 0, 0) for s in r["scores"]]) for r in got]))
    y = np.array([float(r["y"]) for r in got])
    if not len(x) or not 0 < y.sum() < len(y):
        model.slope, model.offset = 1.0, -2.0
        return model
    scale = max(1e-9, float(x.std()))
    w, b = 1.0, -1.0
    for _ in range(200):  # Newton steps, with a weak prior on the slope
        p = 1 / (1 + np.exp(-np.clip(w * x / scale + b, -50, 50)))
        q = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * x / scale).sum() + 0.1 * w, (p - y).sum() + 0.01 * b])
        h = np.array([[(q * (x / scale) ** 2).sum() + 0.1, (q * x / scale).sum()], [(q * x / scale).sum(), q.sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        w, b = w - float(step[0]), b - float(step[1])
        if abs(step).max() < 1e-9:
            break
    model.slope, model.offset = max(0.0, w / scale), b
    return model


PASSAGES = "array<struct<first: bigint, last: bigint, score: double, e_value: double>>"


def toxicity(docs: DataFrame, model: Model, columns: Sequence[str] = ("doc_id",), text: str = "text", most_e: float = 1.0,
             score: str = "score", passages: str = "passages") -> DataFrame:
    """Op 7. The named columns, a score and passages: chance of toxicity, and passages expected by chance under ``most_e`` times.

    A passage is a maximal segment ``[first, last]`` of tokens. Its E-value is ``K n exp(-lambda S)``; the
    score comes from the sum statistic over all segments. A map over whole texts without a shuffle: null
    and empty texts have no segment, very long ones are read in runs, repeated rows are scored alike,
    an empty table gives no rows. Columns may have any names; give the two new ones other names if they clash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Odds(model.odds)
        for batch in batches:
            scores, places = [], []
            for value in batch.column(1):
                n, found = scan(value.as_py() or "", cache)
                scores.append(probability(model, evidence(model, n, found)))
                rated = [(s, f, l, model.rate * n * math.exp(-model.decay * s)) for s, f, l in found]
                places.append([{"first": f, "last": l, "score": s, "e_value": e} for s, f, l, e in rated if e <= most_e])
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(places, kind)], names=["row", "score", "passages"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]).alias("row"), F.col(text).alias("t"))
    scored = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double, passages {PASSAGES}")
    return scored.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)], F.col("score").alias(score), F.col("passages").alias(passages))


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", **options) -> Model:
    """A model learned from the labelled documents that are not held out."""
    return fit(training_rows(docs, labels, key, text, label), **options)
