"""The pipeline and the queries as registered."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from plexus.llm import near_copies
from plexus.llm import sentencepiece as sp
from plexus.llm.queries import QUERIES, SQL
from tools.check import TABLES, plain

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    for t in TABLES:
        duck.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(v) for v in r]) for r in df.select(*columns).collect())
    if name not in SQL:
        base = duck.execute(f"SELECT count(*) FROM {'pages' if 'op8' in name else 'embeddings' if 'op4' in name else 'documents'}").fetchone()[0]
        assert len(got) == base or name.startswith("op9")
        return
    duck.execute(SQL[name])
    names = [d[0] for d in duck.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert got == sorted(repr([plain(r[i]) for i in order]) for r in duck.fetchall())


def test_stages(spark):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (_, stage) in enumerate(pipeline.STAGES[:4]):
        out = stage(spark, docs, SF)
        assert out.columns == columns
        out = spark.createDataFrame(out.toPandas(), docs.schema)
        kept.append({r.doc_id for r in out.collect()})
        before = {r.doc_id: r.text or "" for r in docs.collect()}
        if k == 0:
            toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
            assert len(toxic & before.keys() - kept[0]) <= 0.05 * len(toxic)  # clean documents stay
        if k == 1:
            groups = defaultdict(list)
            for i, t in before.items():
                groups[hashlib.sha256(t.encode()).hexdigest()].append(i)
            assert kept[1] == {max(g) for g in groups.values()}
        if k == 2:
            groups, _ = exact_groups(before)
            assert kept[2] == {i for i in groups if groups[i] == i}
        if k == 3:
            copies = Counter(r.doc_id for r in out.collect())
            assert max(copies.values()) <= 2 and copies.keys() <= before.keys()
            assert all(before[r.doc_id] == r.text for r in out.collect())
        docs = out
    last = pipeline.STAGES[4][1](spark, docs, SF)
    v = sp.load_vocabulary()
    rows = last.collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert Counter(sp.decode_ids(v, r.ids) for r in rows) == Counter(r.text for r in docs.collect())


def test_run_repeats(spark):
    a, b = (pipeline.run(spark, SF).select("doc_id", "source", F.hash("ids")) for _ in range(2))
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_stages_edge(spark, edge, empty, tmp_path):
    """Nulls, repeated rows, clashing columns and empty tables go through every stage."""
    spark.createDataFrame([(2, 1, 0), (5, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (edge, empty):
        for k, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            assert k == 4 or out.columns == docs.columns
            n = out.count()
            assert n <= 2 * max(1, docs.count())
            docs = out


def exact_groups(texts):
    """Smallest id of each document's group by exact Jaccard similarity of its five-word shingles, and the number of pairs."""
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := t.encode().lower().split()) else set() for i, t in texts.items()}
    root, pairs = {i: i for i in sets}, 0

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(sets):
        for b in (b for b in sets if b > a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                x, y = sorted((top(a), top(b)))
                root[y], pairs = x, pairs + 1
    return {i: top(i) for i in sets}, pairs


def test_near_stage_against_exact_jaccard(spark):
    """Random texts with words changed, the similarity from 0.8 up; chains whose ends are not alike; a large group."""
    r, texts = random.Random(11), {}

    def put(words):
        texts[len(texts)] = " ".join(words)

    def changed(words, n):
        words = list(words)
        for k in r.sample(range(len(words)), n):
            words[k] = f"y{r.randrange(10 ** 9)}"
        return words

    for size, n, times in ((300, 1, 40), (300, 5, 40), (100, 2, 40), (1000, 10, 20), (60, 1, 20), (4, 0, 2), (0, 0, 2)):
        for _ in range(times):
            base = [f"w{r.randrange(10 ** 6)}" for _ in range(size)]
            put(base)
            put(changed(base, n))
    chain = [f"w{r.randrange(10 ** 6)}" for _ in range(200)]
    for _ in range(12):
        put(chain)
        chain = changed(chain, 3)
    group = [f"w{r.randrange(10 ** 6)}" for _ in range(150)]
    for _ in range(60):
        put(changed(group, 2))
    want, pairs = exact_groups(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(4)
    kept = {x.doc_id for x in pipeline.near_stage(spark, docs, SF).collect()}
    assert pairs > 500 and kept == {i for i in want if want[i] == i}


def test_near_stage_recall(spark):
    """The share of pairs that share a band, beside what the bands promise: 0.99999 at a similarity of 0.8."""
    assert 1 - (1 - near_copies.SIMILARITY ** near_copies.BAND_ROWS) ** near_copies.BANDS > 0.99999
    r, hits, n = np.random.default_rng(3), 0, 400
    for _ in range(n):
        pool = r.integers(1, 1 << 62, 400).astype(np.uint64)
        a, b = np.sort(pool[:360]), np.sort(pool[40:])
        assert near_copies.similarity(a, b) == 0.8
        hits += bool((near_copies.band_keys(a) == near_copies.band_keys(b)).any())
    assert hits == n
    assert near_copies.similarity(near_copies.shingles(b"A b c d e f"), near_copies.shingles(b"a B c\td e g")) == 1 / 3


def test_near_stage_links_by_simhash(spark):
    """Without any band, SimHash alone brings the pairs within two bits; the exact check drops those whose shingles differ."""
    r, texts = random.Random(5), []
    for _ in range(12):
        words = [f"w{r.randrange(10 ** 6)}" for _ in range(4000)]
        texts += [" ".join(words), " ".join([*words[:-1], "changed"])]
    texts += ["", "  ", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string")
    plain_rows = docs.select("key", F.xxhash64(near_copies.utf8("text")).alias("mark"), near_copies.utf8("text").alias("text"))
    rows = plain_rows.mapInArrow(near_copies._signatures, "key bigint, mark bigint, node bigint, n bigint, bands array<bigint>, fp bigint").cache()
    of = {x.key: x for x in rows.collect()}
    close = {(a, a + 1) for a in range(0, 24, 2) if ((of[a].fp ^ of[a + 1].fp) & (2 ** 64 - 1)).bit_count() <= 2}
    assert len(close) > 3
    none = rows.withColumn("bands", F.array().cast("array<bigint>"))
    want = {(max(of[a].node, of[b].node), min(of[a].node, of[b].node)) for a, b in close}
    assert {tuple(x) for x in near_copies.near_links(none, plain_rows).collect()} == want
    apart = none.withColumn("fp", F.lit(7).cast("bigint"))  # one fingerprint for all: only similar texts are linked
    assert {tuple(x) for x in near_copies.near_links(apart, plain_rows).collect()} <= {(max(of[a].node, of[a + 1].node), min(of[a].node, of[a + 1].node)) for a in range(0, 24, 2)}
