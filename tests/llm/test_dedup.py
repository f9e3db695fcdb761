import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plexus.llm import seeds
from plexus.llm.components import components
from plexus.llm.embeddings import embedding_dedup
from plexus.llm.exact_dedup import drop_copies, exact_dedup
from plexus.llm.simhash import BKTree, drop_near_copies, fingerprint, simhash_dedup, simhash_links, star_links
from plexus.llm.substring_dedup import substring_dedup
from plexus.llm.suffix_dedup import SuffixFamily, suffix_dedup
from tests.llm.conftest import prose


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, n) for n in range(501, 560)]
    got = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    want = groups(edges, {n for e in edges for n in e})
    assert got == {n: want[n] for e in edges if e[0] != e[1] for n in e}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact(edge, edge_texts, keep):
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in exact_dedup(edge, keep=keep).collect())
    ids = defaultdict(list)
    for i, t in edge_texts:
        ids[t or ""].append(i)
    want = Counter()
    for i, t in edge_texts:
        known = [x for x in ids[t or ""] if x is not None]
        k = (min if keep == "min" else max)(known) if known else None
        want[(i, k, len(ids[t or ""]), i == k, hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert got == want


def test_exact_has_no_python(edge):
    plan = exact_dedup(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_drop_copies(edge):
    kept = sorted((r.doc_id is None, r.doc_id) for r in drop_copies(edge, keep="max").select("doc_id").collect())
    assert [k for _, k in kept if k in (2, 3)] == [3] and [k for _, k in kept if k in (8, 9)] == [9]
    assert [k for _, k in kept].count(13) == 2  # rows of one id and text stay together
    assert [k for _, k in kept].count(None) == 1  # the null copy of a known text goes, the other stays


@pytest.mark.parametrize("text", ["", "  \t", "one", "one two", "one two three", "A b C d e f a b c", "a " * 500, " ".join(map(str, range(3000)))])
def test_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        want = 0
    else:
        grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert fingerprint(text.encode()) == want
    assert fingerprint(text.encode(), run_bytes=20) == want


def test_bk_tree():
    r = random.Random(5)
    values = list({r.getrandbits(10) for _ in range(300)})
    tree = BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 1024, 17):
        assert sorted(tree.values[i] for i in tree.near(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)


@pytest.mark.parametrize("hot", [2, 2000])
def test_simhash_links(spark, hot):
    r = random.Random(9)
    values = set()
    for _ in range(60):
        v = r.getrandbits(64)
        values.add(v)
        for _ in range(r.randrange(6)):
            v ^= (1 << r.randrange(64)) | (1 << r.randrange(64)) if r.random() < 0.7 else 0b1110000
            values.add(v)
    values = sorted(values)
    nodes = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)), k) for k, v in enumerate(values)], "fp bigint, node bigint")
    got = groups([(x.u, x.v) for x in simhash_links(nodes, hot=hot).collect()], range(len(values)))
    want = groups([(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 2], range(len(values)))
    assert got == want
    assert star_links(values, list(range(len(values))), 64)[0][1] == 0


def test_simhash_edge(edge, edge_texts):
    fps = [(i, fingerprint((t or "").encode())) for i, t in edge_texts]
    least = {}
    for i, f in fps:
        least[f] = min((x for x, g in fps if g == f and x is not None), default=None)
    known = {f: n for f, n in least.items() if n is not None}
    roots = groups([(known[a], known[b]) for a in known for b in known if (a ^ b).bit_count() <= 2], set(known.values()))
    got = Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash_dedup(edge).collect())
    assert got == Counter((i, f, roots[known[f]] if f in known else None) for i, f in fps)
    left = [r.doc_id for r in drop_near_copies(edge).select("doc_id").collect()]
    assert left.count(13) == 2 and left.count(3) == 0 and left.count(None) == 2


def vectors(seed=3):
    r = np.random.default_rng(seed)
    base = r.normal(size=(300, 16))
    near = base[:80] + r.normal(scale=0.05, size=(80, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(np.vstack([base, near, base[:20], np.repeat(base[:1], 30, 0), 1e200 * base[5:9]]))]
    n = len(rows)
    return rows + [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] + [1.0] * 15), (n + 3, [float("inf")] * 16), (n + 4, [None] + [1.0] * 15),
                   (n + 5, [1.0, 2.0]), (n + 6, []), (None, base[3].tolist()), (7, base[7].tolist()), (n + 7, (-base[3]).tolist())]


def test_embeddings_against_brute_force(spark):
    rows = vectors()
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in
                  embedding_dedup(spark.createDataFrame([(k, v, "x", "y") for k, v in rows], "vec_id bigint, embedding array<double>, id string, cell string"), cell_rows=16).collect())
    good = [k for k, (_, v) in enumerate(rows) if v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    m = np.array([rows[k][1] for k in good])
    m /= np.abs(m).max(1)[:, None]
    m /= np.linalg.norm(m, axis=1)[:, None]
    link = (m @ m.T >= 0.95) & ~np.eye(len(m), dtype=bool)
    ids = [(-1 if rows[k][0] is None else rows[k][0]) for k in range(len(rows))]
    comp = groups([(ids[good[a]], ids[good[b]]) for a, b in zip(*np.nonzero(link))], set(ids))
    links = dict(zip(good, link.sum(1)))
    want = Counter((None if i < 0 else i, int(links.get(k, 0)), None if comp[i] < 0 else comp[i], comp[i] == i) for k, i in enumerate(ids))
    found = sum(x[1] * n for x, n in got.items())
    assert found >= 0.9 * link.sum() and sum(got.values()) == len(rows)
    assert sum((got - want).values()) <= 0.02 * len(rows)


def test_embeddings_of_nothing(spark):
    assert embedding_dedup(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    one = embedding_dedup(spark.createDataFrame([(1, None), (2, [])], "vec_id bigint, embedding array<float>")).collect()
    assert sorted(map(tuple, one)) == [(1, 0, 1, True), (2, 0, 2, True)]


def brute_bytes(texts, window):
    seen, out = set(), {}
    lowest = -1
    for i, t in sorted({(lowest if i is None else i, t or "") for i, t in texts}, key=lambda x: (x[0], x[1])):
        b = t.encode()
        mark = bytearray(len(b))
        for p in range(len(b) - window + 1):
            w = b[p:p + window]
            if w in seen:
                mark[p:p + window] = b"\1" * window
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if mark[k] and (not k or not mark[k - 1]))
        out[(None if i == lowest else i, t)] = (len(b), sum(mark), spans, bytes(x for x, y in zip(b, mark) if not y))
    return out


def brute_words(texts, window):
    least = {}
    docs = {(-1 if i is None else i, t or "") for i, t in texts}
    for i, t in docs:
        w = t.encode().split()
        for p in range(len(w) - window + 1):
            g = tuple(w[p:p + window])
            least[g] = min(least.get(g, i), i)
    out = {}
    for i, t in docs:
        w = t.encode().split()
        gone = {q for p in range(len(w) - window + 1) if least[tuple(w[p:p + window])] < i for q in range(p, p + window)}
        out[(None if i < 0 else i, t)] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("window,slice_bytes,hot", [(100, 1 << 20, 1000), (30, 700, 1)])
def test_suffix(monkeypatch, edge, edge_texts, window, slice_bytes, hot):
    monkeypatch.setattr(seeds, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(seeds, "HOT_SEED", hot)
    texts = [(i, t) for i, t in edge_texts if i != 7] + [(7, edge_texts[7][1][:30000])] if window == 30 else edge_texts
    docs = edge.withColumn("text", F.when(F.col("doc_id") == 7, F.substring("text", 1, 30000)).otherwise(F.col("text"))) if window == 30 else edge
    got = Counter((r.doc_id, r.n_bytes, sum(r.ends) - sum(r.starts), len(r.starts), bytes(r.kept)) for r in suffix_dedup(docs, window).collect())
    want = brute_bytes(texts, window)
    assert {k[0] for k in got} == {i for i, _ in texts} and sum(got.values()) == len(texts)
    # texts of one null id have no order of their own, so compare the others
    assert Counter({k: n for k, n in got.items() if k[0] is not None}) == Counter((i, *want[(i, t or "")]) for i, t in texts if i is not None)


def test_suffix_row_repeated_in_two_partitions(spark):
    texts = [(1, prose(300, 71)), (2, prose(300, 72) + prose(60, 71)), (None, prose(200, 73))]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(texts + texts, 2), "doc_id bigint, text string")
    got = Counter((r.doc_id, r.n_bytes, sum(r.ends) - sum(r.starts), len(r.starts), bytes(r.kept)) for r in suffix_dedup(docs).collect())
    assert got == Counter({(i, *brute_bytes(texts, 100)[(i, t)]): 2 for i, t in texts})
    assert {k[2] == 0 for k in got if k[0] != 2} == {True} and all(k[2] for k in got if k[0] == 2)


@pytest.mark.parametrize("window,slice_bytes,hot", [(13, 1 << 20, 1000), (5, 700, 1)])
def test_substring(monkeypatch, edge, edge_texts, window, slice_bytes, hot):
    monkeypatch.setattr(seeds, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(seeds, "HOT_SEED", hot)
    got = Counter((r.doc_id, r.n_words, sum(r.ends) - sum(r.starts), bytes(r.kept)) for r in substring_dedup(edge, window).collect())
    want = brute_words(edge_texts, window)
    assert got == Counter((i, *want[(i, t or "")]) for i, t in edge_texts)


def test_words_whose_sums_agree_are_told_apart(spark):
    """Two words that a sum of powers modulo 2**64 cannot tell apart, whatever its base (Thue-Morse)."""
    a, b = ("".join(letters[k.bit_count() & 1] for k in range(1024)) for letters in ("ab", "ba"))
    head = prose(12, 90)
    texts = [(1, f"{head} {a}"), (2, f"{head} {b}"), (3, f"{head} {a}")]
    got = {r.doc_id: sum(r.ends) - sum(r.starts) for r in substring_dedup(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 13}


@pytest.mark.parametrize("window", [400, 1000])
def test_windows_of_many_units(spark, window):
    """Stretches of more windows than a byte counts."""
    r = random.Random(window)
    letters = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    shared = letters(window + 300)
    texts = [(1, letters(200) + shared + letters(90)), (2, letters(50) + shared + letters(10)), (3, shared[100:])]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_bytes, sum(r.ends) - sum(r.starts), len(r.starts), bytes(r.kept)) for r in suffix_dedup(docs, window).collect()}
    want = brute_bytes(texts, window)
    assert got == {i: want[(i, t)] for i, t in texts} and got[2][1] == window + 300
    shared = prose(window + 300, 5)
    texts = [(1, prose(50, 6) + " " + shared), (2, shared + " " + prose(70, 7)), (3, " ".join(shared.split()[9:]))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, sum(r.ends) - sum(r.starts), bytes(r.kept)) for r in substring_dedup(docs, window).collect()}
    want = brute_words(texts, window)
    assert got == {i: want[(i, t)] for i, t in texts} and got[2][1] == window + 300


@pytest.mark.parametrize("run", [suffix_dedup, substring_dedup, exact_dedup, simhash_dedup])
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_suffix_family():
    r = np.random.default_rng(1)
    family, seen = SuffixFamily(), set()
    for _ in range(40):
        keys = np.unique(r.integers(0, 3000, r.integers(1, 200))).astype(">u8").repeat(2).view("S16")
        found = family.holds(keys)
        assert found.tolist() == [k in seen for k in keys.tolist()]
        family.add(keys[~found])
        seen.update(keys.tolist())
        sizes = [len(x) for x in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
