"""Periodic runs, benchmark windows and hard negatives against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plexus.llm import decontaminate as dc
from plexus.llm import hard_negatives as hn
from plexus.llm.periodic_runs import _numbered, periodic_runs, runs_of, with_repeats
from tests.llm.conftest import CLASHING, prose, rows_of


def brute_runs(words, least=24, times=3):
    out = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                out.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = max(j, i) + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def brute_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def periodic(r, n, alphabet):
    """Words with stretches of all kinds of periods, next to and over one another."""
    out = []
    while len(out) < n:
        unit = [f"w{r.randrange(alphabet)}" for _ in range(r.choice([1, 2, 3, 5, 8, 13, 40]))]
        if r.random() < 0.3:
            unit = unit * 2 + [f"w{r.randrange(alphabet)}"]
        out += (unit * r.randrange(1, 9))[r.randrange(3):]
    return out[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs(seed):
    r = random.Random(seed)
    texts = [periodic(r, r.randrange(0, 400), r.choice([1, 2, 3, 30])) for _ in range(25)] + [[], ["a"], ["a"] * 24, ["a"] * 23, ["a", "b"] * 300]
    for least, times in ((24, 3), (6, 2), (10, 4)):
        whole, _ = _numbered([" ".join(t).encode() for t in texts])
        got = defaultdict(list)
        for k, s, n, q in zip(*(x.tolist() for x in runs_of(whole, least, times)), strict=True):
            got[k].append((s, n, q))
        for k, t in enumerate(texts):
            assert got[k] == brute_runs(t, least, times), (k, least, times)


def test_runs_with_other_depths():
    """Fibonacci and Thue-Morse words: many squares, overlapping runs, no cubes in the second."""
    a, b = "a", "ab"
    while len(b) < 3000:
        a, b = b, b + a
    t = "".join("ab"[k.bit_count() & 1] for k in range(2048))
    for words in (list(b[:3000]), list(t), list(b[:500]) * 3):
        whole, _ = _numbered([" ".join(words).encode()])
        assert list(zip(*(x.tolist() for x in runs_of(whole, 24, 3)[1:]), strict=True)) == brute_runs(words)


def test_periodic_runs(edge, edge_texts):
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs(edge).collect())
    want = Counter()
    for i, t in edge_texts:
        words = [w.decode() for w in (t or "").encode().split()]
        if i != 7:  # no run in the long one, as the next lines check
            runs = brute_runs(words)
            want[(i, len(words), tuple(runs), brute_collapsed(words, runs))] += 1
    long = next(t for i, t in edge_texts if i == 7)
    want[(7, len(long.split()), (), " ".join(long.split()))] += 1
    assert got == want
    assert any(r for _, _, r, _ in want)


def test_periodic_runs_of_nothing(empty):
    assert periodic_runs(empty).count() == 0


def test_a_long_periodic_text(spark):
    words = [f"w{k % 1000}" for k in range(200_000)] + ["x"] + ["y"] * 5000
    got = periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id bigint, text string")).first()
    assert [tuple(r) for r in got.runs] == [(0, 200_000, 1000), (200_001, 5000, 1)]
    assert got.collapsed == " ".join([*words[:1000], "x", "y"])


def test_with_repeats(spark, edge, edge_texts):
    import zlib
    more = spark.createDataFrame(rows_of([(k, prose(5 + k % 70, k)) for k in range(300)]), edge.schema)
    got = {r.doc_id: r.text for r in with_repeats(more).collect()}
    changed = 0
    for k in range(300):
        words, h = prose(5 + k % 70, k).split(), zlib.crc32(str(k).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert got[k].split() == words
    assert changed > 10
    kept = {r.doc_id: r.text for r in with_repeats(edge.where("doc_id IN (0, 1, 10)")).collect()}
    assert kept == {0: None, 1: "", 10: "  \x0b "}


BENCH = [(1, prose(30, 11)), (2, prose(12, 12)), (3, "Two, WORDS!"), (4, None), (5, " .,- "), (6, prose(30, 11)), (None, prose(15, 13)), (2, "Élan vital 99")]


def planted():
    r = random.Random(5)
    out = [(k, prose(60, 100 + k)) for k in range(20)]
    for k, (_, t) in enumerate(BENCH):
        if t:
            words = t.split()
            out.append((100 + k, f"{prose(20, 200 + k)} {t.upper()} {prose(20, 300 + k)}"))
            out.append((200 + k, ";\n".join(words[r.randrange(3):])))
            out.append((300 + k, " ".join(words[:9])))
    return [*out, (400, prose(50, 9) + " two - words " + prose(5, 8) + " Two words"), (401, " ".join(prose(30, 11).split()[5:25] * 2)), (402, None), (403, ""), (None, prose(30, 11)),
            (404, prose(30, 11)), (404, prose(30, 11)), (405, "two " + " ".join(prose(15, 13).split()[3:]))]


def brute_hits(text, window=10):
    words = dc.words_of((text or "").encode())
    hit, items = set(), set()
    for item, t in BENCH:
        w = dc.words_of((t or "").encode())
        n = min(window, len(w))
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                items |= {str(item)} if item is not None else set()
    return len(words), sorted(hit), sorted(items)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in BENCH], "item_id bigint, text string, window string").repartition(3)


@pytest.mark.parametrize("set_windows", [1000, 0])
def test_contamination(spark, edge, bench, set_windows):
    texts = planted()
    docs = spark.createDataFrame(rows_of(texts), edge.schema).repartition(3)
    got = Counter((r.doc_id, r.n_words, tuple(k for a, b in zip(r.starts, r.ends) for k in range(a, b)), tuple(r["items"]))
                  for r in dc.contamination(docs, bench, set_windows=set_windows).collect())
    want = Counter((i, n, tuple(hit), tuple(items)) for i, t in texts for n, hit, items in [brute_hits(t)])
    assert got == want
    assert sum(1 for _, _, h, _ in want if h) > 15


def test_contamination_of_edges(edge, bench, empty):
    assert dc.contamination(edge, bench).count() == edge.count()
    assert dc.contamination(empty, bench).count() == 0
    none = dc.contamination(edge, bench.where("false"))
    assert none.where("size(starts) > 0").count() == 0 and none.count() == edge.count()
    assert dc.contamination(edge, bench.where("false"), set_windows=-1).where("size(starts) > 0").count() == 0


@pytest.mark.parametrize("size", [40, 300, 5000])
def test_long_texts_come_in_pieces(monkeypatch, size):
    monkeypatch.setattr(dc, "SLICE_BYTES", size)
    rows = [(n, w, [str(i)]) for i, t in BENCH if t for _, n, w in dc.item_windows([t.encode()], 10)]
    texts = [t for _, t in planted()] + [" ".join(t or "" for _, t in planted()), "x" * 9000 + " two words " + "y" * 700]
    n_words, hits = dc.scan([(t or "").encode() for t in texts], dc.WindowSet(rows))
    for t, n, hs in zip(texts, n_words, hits, strict=True):
        want = brute_hits(t)
        assert n == want[0] and sorted({k for h in hs for k in range(h[0], h[0] + h[1])}) == want[1]
        raw = (t or "").encode()
        assert all(dc.words_of(raw[h[2]:h[3]]) == dc.words_of(raw)[h[0]:h[0] + h[1]] for h in hs)


def test_words_whose_hashes_are_equal():
    """Words whose sums agree for every base (Thue-Morse) are told apart by the words themselves."""
    a = "".join("ab"[k.bit_count() & 1] for k in range(1024))
    b = "".join("ba"[k.bit_count() & 1] for k in range(1024))
    shared = prose(9, 1)
    found = dc.WindowSet([(10, f"{shared} {a}".encode(), ["1"])])
    assert [len(h) for h in dc.scan([f"{shared} {b}".encode(), f"{shared} {a}".encode()], found)[1]] == [0, 1]


@pytest.mark.parametrize("remove", ["spans", "documents"])
def test_decontaminate(spark, edge, bench, remove):
    texts = planted()
    docs = spark.createDataFrame(rows_of(texts), edge.schema)
    out = dc.decontaminate(docs, bench, remove=remove)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    want = Counter()
    for i, t in texts:
        n, hit, items = brute_hits(t)
        if remove == "documents":
            want[(i, t)] += not hit
        else:
            words, gone = dc.words_of((t or "").encode()), set(hit)
            want[(i, None if t is None else tuple(w for k, w in enumerate(words) if k not in gone))] += 1
    if remove == "spans":
        got = Counter({(i, None if t is None else tuple(dc.words_of(t.encode()))): n for (i, t), n in got.items()})
    assert got == +want


def brute_negatives(rows, every=50, k=5, m=3):
    """Of rows ``(id, vector, label)``."""
    sizes = Counter(len(v) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v))
    d = min(sizes, key=lambda n: (-sizes[n], n)) if sizes else 0
    good = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
            if i is not None and lab is not None and v and len(v) == d and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in good:
        if a[0] % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in good if r != a))
        for s, p, _ in [x for x in scored if x[2] == a[1]][:k]:
            fits = [x for x in scored if x[2] != a[1] and -50 * s <= -100 * x[0] <= -95 * s]
            out += [(a[0], p, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fits[:m])]
    return sorted(out)


def vectors(seed, n, d, labels, hot=0.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, d))
    out = []
    for i in range(n):
        lab = 0 if r.random() < hot else int(r.integers(labels))
        out.append((i, [float(x) for x in np.float32(0.3 * centres[(lab + (r.random() < 0.3)) % labels] + 0.15 * r.normal(size=d))], lab))
    return out


@pytest.mark.parametrize("seed,n,d,labels,hot", [(0, 900, 64, 10, 0.0), (1, 700, 7, 3, 0.5), (2, 400, 100, 2, 0.0), (3, 300, 1, 4, 0.0)])
def test_hard_negatives(spark, monkeypatch, seed, n, d, labels, hot):
    rows = vectors(seed, n, d, labels, hot)
    rows += [(i + 5000, v, lab) for i, v, lab in rows[:40]] + rows[:60]  # ties and repeated rows
    rows += [(None, rows[0][1], 1), (9000, None, 1), (9050, [], 1), (9100, rows[0][1], None), (9150, [None] * d, 2), (9200, [float("nan")] * d, 2),
             (9250, [float("inf")] * d, 2), (9300, [1.0] * (d + 1), 2), (9350, [0.0] * d, 1)]
    if d == 64:  # tiles of several blocks
        monkeypatch.setattr(hn, "ANCHOR_ROWS", 5)
        monkeypatch.setattr(hn, "BLOCK_ROWS", 100)
    df = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], "vec_id bigint, embedding array<float>, label int, " + ", ".join(f"`{c}` string" for c in CLASHING))
    got = sorted(tuple(r) for r in hn.hard_negatives(df.repartition(3)).collect())
    want = brute_negatives(rows)
    assert got == want and want


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hn.hard_negatives(df).count() == 0
    assert hn.hard_negatives(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], df.schema)).count() == 0


def test_hard_negatives_in_several_tasks(spark, monkeypatch):
    """Blocks of rows and anchors meet where shuffle partitions stay what they are."""
    rows = vectors(5, 500, 16, 4)
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 4)
    monkeypatch.setattr(hn, "BLOCK_ROWS", 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
        assert sorted(tuple(r) for r in hn.hard_negatives(df).collect()) == brute_negatives(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", [0, 1])
def test_hard_negatives_of_large_components(spark, seed):
    """Components of any size take part, as exact integers; so do positives that share an id and a score."""
    rows = vectors(seed, 300, 8, 3)
    r = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x * 10.0 ** (r.integers(3, 6) if i % 3 == 0 else 0))) for x in v], lab) for i, v, lab in rows]
    rows += [(7001 + i, [0.0] * 7 + [float(np.float32(z))], i % 3) for i, z in enumerate([1e5, -3e6, 1e8, 2e4])]
    rows += [(8000, [0.001] * 8, 1), (8001, [1e5] * 8, 1), (8001, [1e5, 1e5] * 3 + [2e5, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted(tuple(x) for x in hn.hard_negatives(df.repartition(3)).collect())
    want = brute_negatives(rows)
    assert got == want and max(abs(x[4]) for x in want) > 1 << 40


def test_hard_negatives_beyond_a_long(spark):
    """A component that no score of fits still takes part; the other anchors find what they find."""
    rows = [*vectors(3, 200, 8, 3), (9001, [3e38] * 8, 1), (9002, [-3e38] * 8, 2)]
    got = {tuple(x) for x in hn.hard_negatives(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()}
    fits = {x for x in brute_negatives(rows) if abs(x[4]) < 1 << 62 and abs(x[5]) < 1 << 62}
    assert fits <= got and all(x[4] == (1 << 63) - 1 for x in got - fits)


def test_intervals_hold_and_spare_work():
    r = np.random.default_rng(4)
    x = np.floor(256 * 0.2 * (r.normal(size=(40, 64))[r.integers(0, 40, 3000)] + 0.4 * r.normal(size=(3000, 64)))).astype(np.int64)
    y = x[::50]
    rows, anchors = hn.Codes(x.astype(float), hn.rotation(64)), hn.Planes(y.astype(float), hn.rotation(64))
    least, most = hn.interval(anchors, slice(0, len(y)), rows, slice(0, len(x)), 64)
    exact = y @ x.T
    assert (least <= exact).all() and (exact <= most).all()
    own = np.arange(0, 3000, 50)
    ids = np.arange(3000)
    far = np.full((len(y), 1), 1 << 62)
    a, _, row, score, scored = hn.best_pairs(x, ids, y, lambda a, s: own[a][:, None] != ids[s][None, :], -far, far, 5)
    assert scored < 0.1 * len(x) * len(y)
    for k in range(len(y)):
        order = sorted((j for j in range(3000) if j != own[k]), key=lambda j: (-exact[k, j], j))[:5]
        assert sorted(row[a == k].tolist()) == sorted(order)


def test_scores_known_spare_work():
    """Vectors without clusters, where no lower bound is of help: the scores of the first rows spare most of the others."""
    r = np.random.default_rng(6)
    x = r.normal(size=(6000, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    ids = np.arange(6000)
    y, exact = x[::60], x[::60] @ x.T
    exact[np.arange(100), ids[::60]] = -1 << 40
    best = np.sort(exact, axis=1)[:, ::-1][:, :5]
    low, high = -(-50 * best // 100), 95 * best // 100
    a, s, row, score, scored = hn.best_pairs(x, ids, y, lambda a, s: ids[::60][a][:, None] != ids[s][None, :], low, high, 3)
    assert scored < 0.25 * len(x) * len(y)
    for k in range(len(y)):
        for t in range(5):
            order = sorted((j for j in range(6000) if low[k, t] <= exact[k, j] <= high[k, t]), key=lambda j: (-exact[k, j], j))[:3]
            assert sorted(row[(a == k) & (s == t)].tolist()) == sorted(order)
            assert sorted(score[(a == k) & (s == t)].tolist()) == sorted(exact[k, order].tolist())
