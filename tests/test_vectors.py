import numpy as np
import pytest
from pyspark.sql import functions as F

from plexus.operators import cells as C
from plexus.operators import hash_index as A
from plexus.operators import vectors as V
from plexus.operators.cells import CellSearch
from plexus.operators.models import colour_histogram, hashed_words, register_model

D = 16


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((600, D)).astype(np.float32)
    vectors[:200] = vectors[0]  # a third of the set are copies of one vector
    queries = np.vstack([rng.standard_normal((25, D)), vectors[:5]]).astype(np.float32)
    v = spark.createDataFrame([(i, i % 4, x.tolist()) for i, x in enumerate(vectors)], "_uniqueid long, label int, _vector array<float>")
    q = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(queries)], "query_id long, query_vector array<float>")
    return v.repartition(4).cache(), q.cache(), vectors.astype(np.float64), queries.astype(np.float64)


def brute(queries, vectors, k, metric, keep=None):
    out = {}
    for qi, q in enumerate(queries):
        if metric == "L2":
            cost = np.linalg.norm(vectors - q, axis=1)
        else:
            cost = -(vectors @ q) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(q) if metric == "CS" else 1)
        cost = np.round(cost, 6)
        order = [i for i in np.lexsort((np.arange(len(cost)), cost)) if keep is None or keep(i)]
        out[qi] = [int(i) for i in order[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r["_uniqueid"])
    return out


@pytest.mark.parametrize("metric", ["CS", "IP", "L2"])
@pytest.mark.parametrize("way", ["scan", "blocks"])
def test_exact_search(data, metric, way):
    v, q, vectors, queries = data
    kw = {} if way == "scan" else {"max_scan_bytes": 0, "block_rows": 70}
    assert found(V.find_similar(q, v, 7, metric, digits=6, **kw)) == brute(queries, vectors, 7, metric)


def test_scores_come_in_chunks(data, monkeypatch):
    v, q, vectors, queries = data
    best = V._Best(queries, 3, "CS", 6)
    monkeypatch.setattr(V, "CHUNK_SCORES", 100)
    best.add(vectors, np.arange(len(vectors)))
    got = {}
    for qi, i, d in zip(*best.rows()):
        got.setdefault(qi, set()).add(i)
    assert got == {k: set(x) for k, x in brute(queries, vectors, 3, "CS").items()}


def test_blocks_do_not_outgrow_their_bound(data):
    """No task sees more than about a block, though a third of the vectors are equal."""
    v, q, *_ = data
    right = v.select(F.col("_uniqueid").alias("_vid"), F.lit(0).alias("_bucket"))
    sizes = right.groupBy(F.pmod(F.xxhash64("_vid"), F.lit(600 // 50))).count().agg(F.max("count")).first()[0]
    assert sizes < 100


def test_constraints_before_and_after(data):
    v, q, vectors, queries = data
    before = found(V.find_similar(q, v, 5, digits=6, constraints={"label": ["==", 1]}, knn_first=False))
    assert before == brute(queries, vectors, 5, "CS", keep=lambda i: i % 4 == 1)
    after = found(V.find_similar(q, v, 5, digits=6, constraints={"label": ["==", 1]}))
    plain = found(V.find_similar(q, v, 5, digits=6))
    assert all(set(ids) <= set(plain[k]) and all(i % 4 == 1 for i in ids) for k, ids in after.items())


def test_arguments(data, spark):
    v, q, *_ = data
    for k in (0, -1, None):
        with pytest.raises(ValueError):
            V.find_similar(q, v, k)
    with pytest.raises(ValueError):
        V.check_search(1, "CS", text="a", vector=[1.0])
    with pytest.raises(ValueError):
        V.check_search(1, "XX")
    short = spark.createDataFrame([(1, [1.0, 2.0])], "query_id long, query_vector array<float>")
    with pytest.raises(Exception, match="dimensions"):
        V.find_similar(short, v, 3).collect()
    assert V.find_similar(q.where("query_id < 0"), v, 3).count() == 0
    assert V.find_similar(q, v, 10_000).where("query_id = 0").count() == 600


def test_mmr(data):
    v, q, vectors, queries = data
    assert found(V.find_similar_mmr(q, v, 5, weight=1.0, digits=6)) == brute(queries, vectors, 5, "CS")
    got = found(V.find_similar_mmr(q, v, 4, fetch_k=30, weight=0.5, digits=6))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = brute(queries, vectors, 30, "CS")
    for qi, q_ in enumerate(queries):
        rel = {i: round(float(unit[i] @ q_ / np.linalg.norm(q_)), 6) for i in near[qi]}
        chosen = [near[qi][0]]
        while len(chosen) < 4:
            rest = [i for i in near[qi] if i not in chosen]
            chosen.append(max(rest, key=lambda i: (round(0.5 * rel[i] - 0.5 * max(float(unit[i] @ unit[j]) for j in chosen), 12), -near[qi].index(i))))
        assert got[qi] == chosen


def clustered(spark, n=3000, clusters=40, d=16, seed=3):
    r = np.random.default_rng(seed)
    centres = 4 * r.normal(size=(clusters, d))
    x = (centres[r.integers(0, clusters, n)] + 0.5 * r.normal(size=(n, d))).astype(np.float32)
    x[10:14] = 0
    x[20:40] = x[50]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    return x.astype(float), spark.createDataFrame(rows, "_uniqueid long, _vector array<float>").repartition(5)


@pytest.mark.parametrize("metric,digits", [("CS", 6), ("IP", None), ("L2", 3), ("L2", None)])
def test_cells_lose_nothing_and_spare_work(spark, metric, digits):
    """Every 7th vector as a query: as brute force finds it, in a small part of the cells."""
    x, v = clustered(spark)
    q = v.where("_uniqueid % 7 = 0").select(F.col("_uniqueid").alias("query_id"), F.col("_vector").alias("query_vector"))
    asked = q.unionByName(spark.createDataFrame([(9999, None)], q.schema))
    search = CellSearch(q, v, 3000, 5, metric, "_uniqueid", "_vector", True, digits, 60)
    visits, cells = search.visits(), len(search.cells.number)
    assert cells > 40 and visits.count() == visits.distinct().count()
    share = visits.count() / (q.count() * cells)
    assert share < (0.9 if metric == "IP" else 0.25), share  # inner products have no triangle inequality, lengths count
    got = found(V.find_similar(asked, v, 5, metric, exclude_self=True, digits=digits, max_scan_bytes=0, block_rows=60))
    for qi in range(0, 3000, 7):
        cost = V._scores(x[qi:qi + 1], x, metric, digits)[0] * (1 if metric == "L2" else -1)
        cost[qi] = np.inf
        order = np.lexsort((np.arange(3000), cost))[:5]
        if digits is None:  # equal vectors come in any order where products are summed in another one
            assert np.allclose(np.sort(cost[got[qi]]), cost[order], rtol=1e-9, atol=1e-6)
        else:
            assert got[qi] == order.tolist(), qi
    assert 9999 not in got


def test_cells_when_k_is_large(spark):
    x, v = clustered(spark, n=300, clusters=5)
    q = v.where("_uniqueid < 3").select(F.col("_uniqueid").alias("query_id"), F.col("_vector").alias("query_vector"))
    assert V.find_similar(q, v, 1000, digits=6, max_scan_bytes=0, block_rows=50).count() == 900
    few = V.find_similar(q, v, 4, "L2", digits=6, max_scan_bytes=0, block_rows=50, constraints=None)
    assert few.groupBy("query_id").count().where("count <> 4").count() == 0


@pytest.mark.parametrize("metric", ["CS", "IP", "L2"])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_cells_meet_in_parts(spark, monkeypatch, metric, exclude_self):
    """Every vector of a spread out set with a large group of copies as a query: a row per query and part, none per cell, and nothing lost."""
    monkeypatch.setattr(C, "BLOCK_ROWS", 300)
    x = np.random.default_rng(11).normal(size=(1200, D)).astype(np.float32)
    x[100:500] = x[0]
    x[700:704] = 0
    v = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(x)], "_uniqueid long, _vector array<float>").repartition(4)
    q = v.select(F.col("_uniqueid").alias("query_id"), F.col("_vector").alias("query_vector"))
    search = CellSearch(q, v, 1200, 5, metric, "_uniqueid", "_vector", exclude_self, 6, 30)
    part = C.parts(search.cells, 300)
    held = np.bincount(part, weights=search.cells.count)
    assert all(n <= 300 or (part == p).sum() == 1 for p, n in enumerate(held)) and 4 <= len(held) <= 12
    sent = search._probes(search.bounded, search._within, part)
    assert sent.count() == sent.select("query_id", "_part").distinct().count() < search.far.count() / 2
    got = found(V.find_similar(q, v, 5, metric, exclude_self=exclude_self, digits=6, max_scan_bytes=0, block_rows=30))
    x = x.astype(float)
    for i in range(1200):
        cost = V._scores(x[i:i + 1], x, metric, 6)[0] * (1 if metric == "L2" else -1)
        if exclude_self:
            cost[i] = np.inf
        assert got[i] == np.lexsort((np.arange(1200), cost))[:5].tolist(), i


@pytest.mark.parametrize("digits", [None, 3, 6])
def test_single_precision_loses_no_pair(digits):
    """Cosines that differ less than single precision tells, in small and large lengths: as in double precision alone."""
    r = np.random.default_rng(2)
    x = r.normal(size=(1, D)) + 1e-7 * r.normal(size=(4000, D))
    x[::2] = r.normal(size=(2000, D))
    x *= 10.0 ** r.integers(-18, 18, size=(4000, 1))
    q = x[:40]
    want = -V._scores(q, x, "CS", digits)
    kth = np.sort(want, axis=1)[:, 6]
    for limit in (None, kth + 1e-9):
        best = V._Best(q, 7, "CS", digits, limit)
        for at in range(0, 4000, 500):
            best.add(x[at:at + 500], np.arange(at, at + 500))
        query, ids, cosine = best.rows()
        assert np.bincount(query).tolist() == [7] * 40
        assert np.allclose(np.sort(-cosine.reshape(40, 7), axis=1), np.sort(want, axis=1)[:, :7], rtol=0, atol=1e-14)
        if digits is not None:
            order = [set(np.lexsort((np.arange(4000), c))[:7].tolist()) for c in want]
            assert [set(a) for a in ids.reshape(40, 7).tolist()] == order


def test_hits_are_sent_only_if_they_are_few(data, monkeypatch):
    v, q, *_ = data
    plain = found(V.find_similar(q, v, 9, digits=6, constraints={"label": ["==", 1]}))
    monkeypatch.setattr(V, "SCAN_QUERY_BYTES", 8 * D * 100)
    wide = V.find_similar(q, v, 9, digits=6, constraints={"label": ["==", 1]}, max_scan_bytes=1 << 20)
    assert found(wide) == plain
    assert V._search(q, v, 9, "CS", "query_id", "query_vector", "_uniqueid", "_vector", None, True, False, 6, 1 << 20, 100)[1] == 9 * q.count()


def test_approximate_search_scores_its_buckets_only(spark):
    x, v = clustered(spark)
    v = v.unionByName(spark.createDataFrame([(7000 + i, None) for i in range(5)], v.schema))
    q = v.where("_uniqueid % 50 = 0").select(F.col("_uniqueid").alias("query_id"), F.col("_vector").alias("query_vector"))
    q = q.unionByName(spark.createDataFrame([(8000, None)], q.schema))
    index = A.write_index(v, dimensions=16, tables=4, bits=7)
    assert index.rows(spark).count() == 4 * 3000
    exact = V.find_similar(q, v, 5, digits=6)
    near = A.approx_similar(q, index, 5, digits=6, probes=8)
    own = A.approx_similar(q, index, 5, digits=6, probes=1)
    scored = A._probe_rows(q.where("query_vector IS NOT NULL"), index, 8).join(index.rows(spark), ["_table", "_code"])
    assert scored.select("query_id", "_vid").distinct().count() < 0.35 * 60 * 3000
    assert V.recall(near, exact).first().recall > 0.95 >= V.recall(own, exact).first().recall - 0.05
    assert near.where("query_id = 8000 OR _uniqueid >= 7000").count() == 0
    # a table instead of an index is indexed first
    assert found(A.approx_similar(q, v, 5, dimensions=16, tables=4, bits=7, digits=6, probes=8)) == found(near)


@pytest.mark.parametrize("block_rows", [20_000, 40])
def test_approximate_search_with_a_hot_bucket(data, block_rows):
    v, q, vectors, queries = data
    exact = V.find_similar(q, v, 5, digits=6)
    # one bit: half of all vectors per bucket, cut into blocks of 40
    near = A.approx_similar(q, v, 5, dimensions=D, tables=12, bits=1, digits=6, probes=1, block_rows=block_rows)
    assert V.recall(near, exact).first().recall > 0.95
    assert near.groupBy("query_id", "_uniqueid").count().where("count > 1").count() == 0
    # and what is found is ranked exactly
    truth = {(r.query_id, r["_uniqueid"]): r["_distance"] for r in V.find_similar(q, v, 600, digits=6).collect()}
    assert all(abs(truth[(r.query_id, r["_uniqueid"])] - r["_distance"]) < 1e-9 for r in near.collect())


def test_probes():
    planes = A.hyperplanes(8, 3, 4)
    margin = A.margins(np.random.default_rng(0).normal(size=(20, 8)), planes)
    probes = A.probe_codes(margin, 6)
    assert probes.shape == (20, 3, 6) and (probes[:, :, 0] == A.codes(margin)).all()
    assert all(len(set(p)) == 6 for row in probes for p in row)
    nearest = np.abs(margin).argmin(axis=2)
    assert (probes[:, :, 1] == A.codes(margin) ^ (1 << nearest)).all()


def test_pack(data):
    v, *_ = data
    back = v.withColumn("p", V.pack_vector("_vector")).withColumn("u", V.unpack_vector("p"))
    assert back.where("u <> _vector or octet_length(p) <> 64").count() == 0
    assert v.sparkSession.createDataFrame([(None,)], "x array<float>").select(V.pack_vector("x")).first()[0] is None


def test_limit_before_the_shuffle(data):
    v, q, *_ = data
    plan = V.find_similar(q, v, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_register_model(spark):
    from plexus.operators.models import REGISTRY_SCHEMA
    empty = spark.createDataFrame([], REGISTRY_SCHEMA)
    one = register_model(empty, "s", 64, "builtin", "hashed_words", None, hashed_words(64))
    row = one.first()
    assert row.dimensions == 64 and len(row.fingerprint) == 64 and row.pretrained is None
    filled = register_model(one, "s", 64, "builtin", "hashed_words", "v1", hashed_words(64))
    assert filled.first().pretrained == "v1" and filled.count() == 1
    for bad in (("other", "hashed_words", "v1"), ("builtin", "x", "v1"), ("builtin", "hashed_words", "v2")):
        with pytest.raises(ValueError):
            register_model(filled, "s", 64, *bad, hashed_words(64))
    with pytest.raises(ValueError):
        register_model(filled, "s", 32, "builtin", "hashed_words", "v1", hashed_words(32))
    assert register_model(filled, "s", 32, "builtin", "hashed_words", "v1", hashed_words(32), clean=True).first().dimensions == 32


def test_stand_in_models():
    run = hashed_words(32)()
    a, b, c = run(["Hello world", "hello WORLD", ""])
    assert np.allclose(a, b) and abs(np.linalg.norm(a) - 1) < 1e-9 and not np.any(c)
    h = colour_histogram(4)()([np.zeros((2, 2, 3), np.uint8)])[0]
    assert h[0] == 1.0 and h.sum() == 1.0


def test_search_by_text_or_vector(spark):
    from plexus.operators.retrieval import find_similar_to
    docs = spark.createDataFrame([("a", "green apples"), ("b", "red cars"), ("c", "fast red cars")], "_uniqueid string, text string")
    v = M_embed(docs)
    assert [r["_uniqueid"] for r in find_similar_to(v, text="Red cars", load=hashed_words(64), k=2).orderBy("rank").collect()] == ["b", "c"]
    first = v.where("_uniqueid = 'c'").first()["_vector"]
    assert find_similar_to(v, vector=first, k=1).first()["_uniqueid"] == "c"
    for bad in (dict(), dict(text="x", vector=[1.0]), dict(text="x"), dict(vector=["x"]), dict(vector=first, k=0)):
        with pytest.raises(ValueError):
            find_similar_to(v, **bad)


def M_embed(docs):
    from plexus.operators.models import embed_texts
    return embed_texts(docs, "text", hashed_words(64))


@pytest.mark.parametrize("way", [{}, {"max_scan_bytes": 0, "block_rows": 70}])
def test_text_ids_and_fewer_vectors_than_asked(data, way):
    v, q, *_ = data
    named = v.withColumn("_uniqueid", F.format_string("v%04d", "_uniqueid"))
    asked = q.withColumn("query_id", F.format_string("v%04d", "query_id"))

    def plain(df):
        return [(str(r.query_id)[-4:].lstrip("v0") or "0", r["_distance"], r["rank"]) for r in df.collect()]

    a = V.find_similar(asked, named, 7, digits=6, exclude_self=True, **way)
    b = V.find_similar(q, v, 7, digits=6, exclude_self=True, **way)
    assert sorted(plain(a)) == sorted(plain(b))
    assert a.where("query_id = _uniqueid").count() == 0
    few = named.where("_uniqueid < 'v0003'")
    assert V.find_similar(asked, few, 7, digits=6, **way).groupBy("query_id").count().where("count <> 3").count() == 0
    near = {"block_rows": 40} if way else {}
    assert A.approx_similar(asked, few, 7, dimensions=D, bits=2, digits=6, **near).groupBy("query_id").count().where("count > 3").count() == 0


def test_face_vectors(spark):
    from plexus.operators.models import face_vectors
    picture = (3, 4, 1, 0, bytearray(range(12)))
    rows = [("a", picture, [0.9, 0.2, 0.8], [[1.0, 0.0, 3.0, 2.0], [0.0, 0.0, 1.0, 1.0], [-1.5, 1.2, 2.0, 9.0]]),
            ("b", picture, [0.95], [[7.0, 7.0, 9.0, 9.0]]), ("c", picture, [], []), ("d", None, [0.9], [[0.0, 0.0, 1.0, 1.0]]), ("e", picture, None, None)]
    df = spark.createDataFrame(rows, "id string, image struct<height: int, width: int, nChannels: int, mode: int, data: binary>, scores array<double>, boxes array<array<double>>")
    calls = spark.sparkContext.accumulator(0)

    def load():
        def run(crops):
            calls.add(1)
            return [(c.sum(), c.shape[0], c.shape[1]) for c in crops]
        return run

    faces = face_vectors(df.coalesce(1), "id", load, "faces", threshold=0.7, batch_size=2)
    boxes = {(r.id, r.box_index): r["_uniqueid"] for r in faces.boxes.collect()}
    assert set(boxes) == {("a", 0), ("a", 2), ("b", 0), ("d", 0)}
    vectors = {r.box_id: (r["_uniqueid"], r["_vector"]) for r in faces.vectors.collect()}
    assert {k: vectors[v][1] for k, v in boxes.items() if v in vectors} == {("a", 0): [1 + 2 + 5 + 6, 2, 2], ("a", 2): [4 + 5 + 8 + 9, 2, 2]}
    edges = {(r["_src"], r["_dst"], r["class"]) for r in faces.edges.collect()}
    assert edges == {(i, v, "imageHasBox") for (i, _), v in boxes.items()} | {(b, v, "boxHasVector") for b, (v, _) in vectors.items()}
    assert {r.id: (r.n_faces, r.faces_done) for r in faces.done.collect()} == {"a": (2, True), "b": (1, True), "c": (0, True), "d": (1, True), "e": (0, True)}
    assert calls.value == 1  # two crops of one batch, once


def test_search_by_text_needs_a_model(spark):
    from plexus.operators.models import REGISTRY_SCHEMA, embed_texts
    from plexus.operators.retrieval import find_similar_to
    load = hashed_words(16)
    rows = spark.createDataFrame([("a", "red green", "s"), ("b", "blue sky", "s"), ("c", "red green", "t")], "_uniqueid string, text string, set string")
    v = embed_texts(rows, "text", load)
    registry = register_model(spark.createDataFrame([("t", 16, "CS", "p", None, None, None)], REGISTRY_SCHEMA), "s", 16, "p", "m", "x", load)
    got = find_similar_to(v, text="red green", load=load, k=1, registry=registry, set_name="s").collect()
    assert [r["_uniqueid"] for r in got] == ["a"]
    for name in ("t", "unknown"):
        with pytest.raises(ValueError, match="cannot be searched"):
            find_similar_to(v, text="red", load=load, registry=registry, set_name=name)
    assert find_similar_to(v, vector=[0.0] * 15 + [1.0], registry=registry, set_name="t").count() == 1
