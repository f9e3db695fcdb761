"""Hard negatives by one-bit codes: popcount estimates with a certain interval decide which pairs are scored."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import partitions, save

SCALE = 256              # components become floor(SCALE * x)
LARGEST = 2.0 ** 1000    # magnitude of a component; beyond it the scaled one is no double
_EXACT = 1 << 62         # products and sums below it are 64-bit integers
LEVELS = 4               # codes of a vector: of its rotation, then of what the codes before leave over
PLANES = 8               # bits of a component of a rotated anchor
ANCHOR_ROWS = 16_384     # anchors of a block, about
BLOCK_ROWS = 65_536      # rows of a block, about
_LEAST, _MOST = 1 - (1 << 63), (1 << 63) - 1  # a score beyond is returned as the end of the range
_ANCHORS, _FIRST_ROWS, _ROWS = 128, 256, 2_048  # pairs of these are estimated at a time, the first ones of few rows


def rotation(dimensions: int, seed: int = 11) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths, also of vectors whose squares are no doubles."""
    top = np.abs(vectors).max(axis=1, initial=0)
    return top * np.linalg.norm(vectors / np.maximum(top, 1e-300)[:, None], axis=1)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    width = -(-bits.shape[-1] // 64) * 64
    padded = np.zeros((*bits.shape[:-1], width), np.uint8)
    padded[..., :bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


class Codes:
    """One-bit codes of rows: ``bits[level]``, their ``alignment`` with what they stand for, what is left over and the norm.

    A rotated unit vector u is a sum of alignment[l] * code[l] over the levels and a residual of length ``left`` that is
    perpendicular to the last code; code[l] has components of +-1/sqrt(dimensions).
    """

    def __init__(self, vectors: np.ndarray, turn: np.ndarray, levels: int = LEVELS) -> None:
        d = vectors.shape[1]
        self.norm = _norms(vectors)
        rest = (vectors / np.maximum(self.norm, 1e-300)[:, None]) @ turn
        self.bits, self.alignment = [], []
        for _ in range(levels):
            up = rest >= 0
            code = np.where(up, 1.0, -1.0) / np.sqrt(d)
            align = (code * rest).sum(axis=1)
            rest = rest - align[:, None] * code
            self.bits.append(_packed(up))
            self.alignment.append(align)
        self.left = np.linalg.norm(rest, axis=1)


class Planes:
    """Rotated unit anchors in ``PLANES`` bits a component: bit planes, what they stand for, and the length of what they miss."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray) -> None:
        d = vectors.shape[1]
        self.norm = _norms(vectors)
        v = (vectors / np.maximum(self.norm, 1e-300)[:, None]) @ turn
        self.low = v.min(axis=1)
        self.step = np.maximum((v.max(axis=1) - self.low) / ((1 << PLANES) - 1), 1e-300)
        t = np.rint((v - self.low[:, None]) / self.step[:, None])
        known = self.low[:, None] + self.step[:, None] * t
        self.total, self.length = known.sum(axis=1) / np.sqrt(d), np.linalg.norm(known, axis=1)
        self.missed = np.linalg.norm(v - known, axis=1)
        t = t.astype(np.int64)
        self.planes = [_packed((t >> p) & 1) for p in range(PLANES)]


def _counts(planes: list[np.ndarray], bits: np.ndarray) -> np.ndarray:
    """Sums of ``2 ** p`` x the ones that plane p of an anchor shares with the bits of a row, for all pairs."""
    shape = len(planes[0]), len(bits)
    total = np.zeros(shape, np.uint16 if bits.shape[1] == 1 else np.int64)
    both, one, two = np.empty(shape, np.uint64), np.empty(shape, np.uint8), np.empty(shape, np.uint8)
    for w in range(bits.shape[1]):
        word = bits[None, :, w]
        for p in range(0, PLANES, 2):  # ones of a word and twice those of another are 192 at most
            np.bitwise_count(np.bitwise_and(planes[p][:, w, None], word, out=both), out=one)
            if p + 1 < PLANES:
                np.bitwise_count(np.bitwise_and(planes[p + 1][:, w, None], word, out=both), out=two)
                one += two
                one += two
            total += one.astype(total.dtype) << p
    return total


def interval(anchors: Planes, a: slice, rows: Codes, r: slice, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of some anchors and rows.

    Popcounts of codes and planes give the product with each code; the residual adds at most its length times that of
    the anchor (Cauchy-Schwarz).
    """
    unit = 2 / np.sqrt(dimensions)
    sums, fixed, factor = 0.0, 0.0, 0.0
    for bits, align in zip(rows.bits, rows.alignment, strict=True):
        part = bits[r]
        sums = sums + _counts([p[a] for p in anchors.planes], part) * align[r][None, :]
        fixed = fixed + np.bitwise_count(part).sum(axis=1, dtype=np.int64) * align[r]
        factor = factor + align[r]
    sums *= unit * anchors.step[a][:, None]
    sums += unit * anchors.low[a][:, None] * fixed[None, :]
    sums -= anchors.total[a][:, None] * factor[None, :]
    reach = anchors.length[a][:, None] * rows.left[r][None, :]
    reach += anchors.missed[a][:, None] + 1e-9
    with np.errstate(over="ignore"):
        scale = np.minimum(anchors.norm[a][:, None] * rows.norm[r][None, :], 1e300)
    sums *= scale
    reach *= scale
    reach += 1e-3
    return np.clip(sums - reach, _LEAST, _MOST), np.clip(sums + reach, _LEAST, _MOST)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of rows; those that could leave 64 bits on the way are added up in integers of any size."""
    if a.dtype == b.dtype == np.float32:  # see _narrow
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    out = np.empty(len(a), np.int64)
    for at in range(0, len(a), 1 << 16):
        p, q = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
        tops = [np.abs(z).max(axis=1, initial=0).astype(np.float64) for z in (p, q)]
        with np.errstate(over="ignore"):
            wide = (tops[0] >= _EXACT) | (tops[1] >= _EXACT) | (tops[0] * tops[1] * p.shape[1] >= _EXACT)
        if wide.any():
            part = np.empty(len(p), np.int64)
            part[~wide] = np.einsum("ij,ij->i", p[~wide].astype(np.int64), q[~wide].astype(np.int64))
            part[wide] = [min(max(sum(int(x) * int(y) for x, y in zip(*pair)), _LEAST), _MOST) for pair in zip(p[wide].tolist(), q[wide].tolist(), strict=True)]
        else:
            part = np.einsum("ij,ij->i", p.astype(np.int64, copy=False), q.astype(np.int64, copy=False))
        out[at:at + (1 << 16)] = part
    return out


def _narrow(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and anchors as 32-bit floats, if these hold every product and sum of them exactly."""
    tops = [float(np.abs(z).max(initial=0)) for z in (x, y)]
    if max(tops) < 1 << 24 and tops[0] * tops[1] * x.shape[1] < 1 << 24:
        return x.astype(np.float32), y.astype(np.float32)
    return x, y


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row, minus infinity if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return -np.partition(-values, k - 1, axis=1)[:, k - 1]


def _first(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, row: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k pairs of each anchor and slot: higher scores, then smaller ids."""
    order = np.lexsort((ids[row], -score, slot, anchor))
    new = np.r_[True, (anchor[order][1:] != anchor[order][:-1]) | (slot[order][1:] != slot[order][:-1])][:len(order)]
    at = np.arange(len(order))
    return order[at - np.maximum.accumulate(np.where(new, at, 0)) < k]


def best_pairs(x: np.ndarray, ids: np.ndarray, y: np.ndarray, meets: Callable, low: np.ndarray, high: np.ndarray, k: int, levels: int = LEVELS) -> tuple[np.ndarray, ...]:
    """``anchor, slot, row, score`` of the first k rows of each anchor and slot, exactly, and how many pairs were scored.

    x: rows, y: anchors, ``meets(a, r)``: which of them may meet, ``low, high`` (anchor x slot): least and greatest score allowed.
    A pair is scored if its interval reaches into that of a slot and over the k-th best lower bound or score of pairs
    that are certainly allowed there.
    """
    d = x.shape[1]
    turn = rotation(d)
    rows, anchors = Codes(x.astype(np.float64), turn, levels), Planes(y.astype(np.float64), turn)
    x, y = _narrow(x, y)
    slots = low.shape[1]
    out, scored = [], 0
    for at in range(0, len(y), _ANCHORS):
        a = slice(at, min(at + _ANCHORS, len(y)))
        best = [np.zeros(0, np.int64)] * 4
        floor = np.full((a.stop - a.start, slots), -np.inf)
        top = high[a].max(axis=1)
        start, size = 0, _FIRST_ROWS
        while start < len(x):
            r = slice(start, min(start + size, len(x)))
            start, size = r.stop, min(2 * size, _ROWS)  # few rows at first: the scores known after them spare most others
            may = meets(a, r)
            least, most = interval(anchors, a, rows, r, d)
            if np.isneginf(floor).any():
                for s in range(slots):
                    sure = np.where(may & (most <= high[a, s][:, None]) & (least >= low[a, s][:, None]), least, -np.inf)
                    floor[:, s] = np.maximum(floor[:, s], _kth(sure, k))
            needed = np.maximum(low[a], floor)
            may &= most >= needed.min(axis=1)[:, None]
            may &= least <= top[:, None]
            i, j = np.nonzero(may)
            least, most = least[i, j], most[i, j]
            wanted = np.zeros(len(i), bool)
            for s in range(slots):
                wanted |= (least <= high[a, s][i]) & (most >= needed[i, s])
            i, j = i[wanted], j[wanted]
            score = scores(y[a.start + i], x[r.start + j])
            scored += len(i)
            for s in range(slots):
                fits = (score >= low[a, s][i]) & (score <= high[a, s][i]) & (score >= floor[i, s])
                new = [a.start + i[fits], np.full(fits.sum(), s), r.start + j[fits], score[fits]]
                best = [np.concatenate(z) for z in zip(best, new, strict=True)]
            kept = _first(best[0], best[1], best[3], best[2], ids, k)
            best = [z[kept] for z in best]
            full = np.flatnonzero(np.bincount((best[0] - a.start) * slots + best[1], minlength=floor.size) >= k)
            if len(full):  # the k-th best score known so far
                worst = np.full(floor.size, np.inf)
                np.minimum.at(worst, (best[0] - a.start) * slots + best[1], best[3])
                floor.flat[full] = np.maximum(floor.flat[full], worst[full])
        out.append(best)
    none = [np.zeros(0, np.int64)] * 4
    return *(np.concatenate(z) for z in zip(none, *out, strict=True)), scored


def _matrix(column: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    """Whole numbers, as integers if all of them are 64-bit ones."""
    values = np.asarray(column.combine_chunks().flatten()).reshape(-1, dimensions)
    return values.astype(np.int64) if np.abs(values).max(initial=0) < _EXACT else values


_PAIR = "anchor bigint, anchor_row bigint, slot bigint, positive bigint, positive_score bigint, other bigint, score bigint"


def _tile(k: int, other_label: bool, levels: int):
    """Pairs of a block of rows and a block of anchors, all of one length."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        names = ("anchor", "anchor_row", "slot", "positive", "positive_score", "other", "score")
        if not len(rows) or not len(anchors):
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        dimensions = rows.column("d")[0].as_py()
        x, y = _matrix(rows.column("x"), dimensions), _matrix(anchors.column("x"), dimensions)
        ids, marks = np.asarray(rows.column("id")), np.asarray(rows.column("row"))
        of, own = np.asarray(anchors.column("id")), np.asarray(anchors.column("row"))
        if other_label:
            numbers = np.unique(np.r_[np.asarray(rows.column("label")), np.asarray(anchors.column("label"))], return_inverse=True)[1]
            label, mine = numbers[:len(rows)], numbers[len(rows):]
            given = anchors.column("positives").to_pylist()
            slots = max(map(len, given))
            positive, ps = np.zeros((len(given), slots), np.int64), np.zeros((len(given), slots), np.int64)
            low, high = np.ones((len(given), slots), np.int64), np.zeros((len(given), slots), np.int64)  # no score is in between
            for i, row in enumerate(given):
                for s, p in enumerate(row):
                    positive[i, s], ps[i, s] = p["id"], p["score"]
                    low[i, s], high[i, s] = -(-50 * p["score"] // 100), 95 * p["score"] // 100

            def meets(a: slice, r: slice) -> np.ndarray:
                return mine[a][:, None] != label[r][None, :]
        else:
            positive = ps = np.zeros((len(of), 1), np.int64)
            low, high = np.full((len(of), 1), _LEAST), np.full((len(of), 1), _MOST)

            def meets(a: slice, r: slice) -> np.ndarray:
                return (of[a][:, None] != ids[r][None, :]) | (own[a][:, None] != marks[r][None, :])
        a, s, r, score, _ = best_pairs(x, ids, y, meets, low, high, k, levels)
        values = (of[a], own[a], s, positive[a, s], ps[a, s], ids[r], score)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, values, strict=True)})
    return run


def _blocks(n: Column, rows: int, tasks: int) -> Column:
    """Blocks of about ``rows`` rows, but one per task as long as these have a thousand rows."""
    return F.greatest(F.ceil(n / rows), F.least(F.lit(tasks), F.ceil(n / 1024))).cast("bigint")


def _met(rows: DataFrame, anchors: DataFrame, keys: list[str], run) -> DataFrame:
    """Blocks of rows next to blocks of anchors, inside each value of ``keys``; ``rs, as``: the numbers of blocks.

    Both sides number blocks as long: equal numbers of other types are dealt to other tasks and would not meet.
    """
    hashed = F.xxhash64("id", "row")
    own = lambda n: F.pmod(hashed, n).cast("bigint")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1))
    r = rows.withColumn("r", own("rs")).withColumn("a", each("as")).drop("rs", "as")
    a = anchors.withColumn("a", own("as")).withColumn("r", each("rs")).drop("rs", "as")
    a = a.select(*[F.col(c).alias(c) for c in a.columns])  # of the same table as r
    tile = [*keys, "a", "r"]
    return r.groupBy(*tile).cogroup(a.groupBy(*tile)).applyInArrow(run, _PAIR)


def hard_negatives(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 50, positives: int = 5,
                   negatives: int = 3, levels: int = LEVELS) -> DataFrame:
    """Op 12. ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(256 * x). A row's score is its integer inner product with the anchor; higher scores come
    first, then smaller ids. Anchors are rows whose id is divisible by ``every``; their positives are the first
    ``positives`` other rows of their label. For each anchor and positive come the first ``negatives`` rows of
    other labels that score between 50 and 95 hundredths of the positive, fewer if there are no more.

    Vectors are rotated; a vector's signs are its code, and its length along the code is stored with it, so that a few popcounts
    with the bit planes of an anchor estimate the score and bound its error by the residuals' lengths. Only pairs
    whose interval can still be among the first are scored, as integers. The first k of a block are certain, so
    are those of all blocks: no pair is left to chance. All rows meet all anchors, block by block; for positives, those of their
    label. A block of anchors is large, since rows are copied once for each. A tile returns k pairs a slot.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part (nor do components beyond
    ``LARGEST``). Vectors of several lengths meet those of their own, since only these have an inner product. Components may be of any
    size: sums that could leave 64 bits are added up exactly, and a score that does not fit a long is the end of its range. Rows that
    repeat id, label and vector are one; an id with several vectors or labels is several rows. Other columns, whatever their names, are
    not read; an empty table or one without anchors gives no rows.
    """
    tasks = partitions(vectors)
    times = lambda x: x.cast("double") * SCALE
    scaled = F.transform(F.col("v"), lambda x: F.when(F.abs(times(x)) < 1 << 53, F.floor(times(x)).cast("double")).otherwise(times(x)))  # from there on doubles are whole
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > LARGEST))
    rows = (vectors.select(F.col(key).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
            .where("id IS NOT NULL AND label IS NOT NULL AND size(v) > 0").where(~bad)
            .select("id", "label", scaled.alias("x")))
    rows = rows.select("id", "label", "x", F.xxhash64("label", "x").alias("row"), F.size("x").alias("d")).dropDuplicates(["id", "row", "label", "x"])
    rows = save(rows, "vectors")
    anchors = rows.where(F.col("id") % every == 0)
    sizes = F.count_if(F.col("id") % every == 0).alias("n"), F.count(F.lit(1)).alias("m")
    of_anchors, of_rows = F.ceil(F.col("n") / ANCHOR_ROWS).alias("as"), _blocks(F.col("m"), BLOCK_ROWS, tasks).alias("rs")

    def cut(df: DataFrame, keys: list[str]) -> DataFrame:
        """With the numbers of blocks of their keys; without an anchor there is nothing to meet."""
        return df.join(rows.groupBy(*keys).agg(*sizes).where("n > 0").select(*keys, of_anchors, of_rows), keys)

    pairs = _met(cut(rows, ["label", "d"]), cut(anchors, ["label", "d"]), ["label", "d"], _tile(positives, False, levels))
    order = Window.partitionBy("anchor", "anchor_row").orderBy(F.desc("score"), "other")
    near = pairs.withColumn("no", F.row_number().over(order)).where(F.col("no") <= positives)
    given = near.groupBy(F.col("anchor").alias("id"), F.col("anchor_row").alias("row")).agg(F.sort_array(F.collect_list(F.struct("no", F.col("other").alias("id"), "score"))).alias("positives"))
    asked = save(anchors.join(given, ["id", "row"]), "anchors")

    found = _met(cut(rows, ["d"]), cut(asked, ["d"]), ["d"], _tile(negatives, True, levels))
    order = Window.partitionBy("anchor", "anchor_row", "slot").orderBy(F.desc("score"), "other")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
