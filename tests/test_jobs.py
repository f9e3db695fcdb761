"""Models, images, datasets, provenance and streams."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.operators import images as I
from plexus.operators import models as M
from plexus.plans import datasets as J
from plexus.plans import provenance as K
from plexus.streaming import incremental as L


def png(pixels):
    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def picture(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("img")
    rgb = np.random.default_rng(0).integers(0, 256, (6, 4, 3), dtype=np.uint8)
    (path / "a.png").write_bytes(png(rgb))
    (path / "bad.png").write_bytes(b"no picture")
    return I.read_images(spark, str(path)).cache(), rgb[:, :, ::-1]  # blue, green, red


def apply(df, *ops):
    return I.pixels(I.image_operations(df, ops).first().image)


def test_operations(picture):
    df, bgr = picture
    assert df.count() == 1
    assert (apply(df, {"type": "flip", "code": 0}) == bgr[::-1]).all()
    assert (apply(df, {"type": "FLIP", "code": 1}) == bgr[:, ::-1]).all()
    assert (apply(df, {"type": "flip", "code": -1}) == bgr[::-1, ::-1]).all()
    assert (apply(df, {"type": "crop", "x": 1, "y": 2, "width": 2, "height": 3}) == bgr[2:5, 1:3]).all()
    assert (apply(df, {"type": "threshold", "value": 100}) == np.where(bgr > 100, bgr, 0)).all()
    assert (apply(df, {"type": "rotate", "angle": 180}) == bgr[::-1, ::-1]).all()
    assert apply(df, {"type": "rotate", "angle": 90, "resize": True}).shape == (4, 6, 3)
    assert apply(df, {"type": "resize", "width": 8}).shape == (12, 8, 3)
    assert apply(df, {"type": "resize", "scale": 0.5}).shape == (3, 2, 3)
    assert (apply(df, {"type": "resize", "width": 4, "height": 6}) == bgr).all()
    steps = ({"type": "crop", "x": 0, "y": 0, "width": 2, "height": 2}, {"type": "flip", "code": 1})
    assert (apply(df, *steps) == bgr[:2, :2][:, ::-1]).all()
    with pytest.raises(ValueError, match="unknown image operation"):
        I.image_operations(df, [{"type": "blur"}])


def test_embed_images(picture):
    df, _ = picture
    row = I.embed_images(df, M.colour_histogram(2), side=8).first()
    assert len(row["_vector"]) == 8 and abs(sum(x * x for x in row["_vector"]) - 1) < 1e-5


def test_batch_infer(spark):
    df = spark.range(10).withColumn("t", F.col("id").cast("string"))
    assert M.batch_infer(df, ["id", "t"], lambda: lambda rows: [f"{a}{b}" for a, b in rows], {"o": T.StringType()}, 3).where(
        "o = concat(id, t)").count() == 10
    with pytest.raises(Exception, match="one result per input"):
        M.batch_infer(df, "t", lambda: lambda rows: [], {"o": T.StringType()}).collect()


def test_detections(spark):
    df = spark.createDataFrame([(1, [0.9, 0.69, 0.7], [[1.0, 2.0, 3.6, 5.9], [0.0] * 4, [-3.2, 4.0, 1.0, 6.0]], [0, 1, 1])],
                               "img int, scores array<double>, boxes array<array<double>>, labels array<int>")
    names = spark.createDataFrame([(0, "cat"), (1, "dog")], "label int, name string")
    got = [(r.label, r.x, r.y, r.width, r.height) for r in M.detections_to_boxes(df, "img", names, "m").orderBy("box_index").collect()]
    assert got == [("cat", 2, 4, 5, 7), ("dog", -6, 8, 8, 4)]
    faces = [(r.label, r.x, r.y, r.width) for r in M.detections_to_boxes(df, "img", None, "m").orderBy("box_index").collect()]
    assert faces == [("face", 1, 2, 2), ("face", 0, 4, 4)]


def test_nested_records(spark):
    person = '[{"id": 1, "name": "ann LEE", "gender": 1, "character": "X", "cast_id": 7}]'
    rows = [(10, "movie A", person, '[{"id": 1, "name": "ann LEE", "gender": 1, "department": "D", "job": "J", "credit_id": "c"}]',
             '[{"id": 5, "name": "Drama"}]'), (11, "movie B", person, "[]", '[{"id": 5, "name": "Drama"}]'), (12, "movie C", "[]", None, "[]")]
    df = spark.createDataFrame(rows, "movie_id long, title string, cast string, crew string, genres string")
    for c in ("budget", "overview", "popularity", "tagline", "vote_average", "vote_count", "production_companies", "keywords", "spoken_languages"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    g = J.nested_to_graph(df)
    counts = {n: d.count() for n, d in {**g.nodes, **g.edges}.items()}
    assert counts == {"Movie": 3, "Professional": 1, "Genre": 1, "ProductionCompany": 0, "Keyword": 0, "SpokenLanguage": 0, "HasCast": 2,
                      "HasCrew": 1, "HasGenre": 2, "HasProductionCompany": 0, "HasKeyword": 0, "HasSpokenLanguage": 0}
    assert g.nodes["Professional"].first().uniqueid == "Ann lee" and g.edges["HasCast"].first().character == "X"


def test_spec_and_run(spark):
    specs = spark.createDataFrame([("a", "crawl")], "spec_id string, workflow_name string")
    with pytest.raises(ValueError, match="exists"):
        K.create_spec(specs, "a")
    assert K.create_spec(specs, "a", {"workflow_name": "new"}, clean=True).collect() == [("a", "new")]
    runs = spark.createDataFrame([], "run_id string, spec_id string, run_start timestamp, run_end timestamp, linked_types array<string>")
    done = K.finish_run(K.add_run(runs, "a", "r1", F.current_timestamp()), "r1", F.current_timestamp(), ["Image"]).first()
    assert done.run_end >= done.run_start and done.linked_types == ["Image"]


def test_delete_leaves_no_dangling_edge(spark):
    specs = spark.createDataFrame([("s1", "crawl"), ("s2", "crawl"), ("s3", "ocr")], "spec_id string, workflow_name string")
    runs = spark.createDataFrame([("r1", "s1"), ("r2", "s2"), ("r3", "s3")], "run_id string, spec_id string")
    docs = spark.createDataFrame([("d1", "s1"), ("d2", "s2"), ("d3", "s3")], "_uniqueid string, spec_id string")
    blobs = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "_uniqueid string")
    edges = spark.createDataFrame([("r1", "d1"), ("r2", "d2"), ("r3", "d3"), ("d1", "b1"), ("d2", "b2"), ("d3", "b3"), ("s1", "d1")], "_src string, _dst string")
    left = K.delete_all(K.Workflow(specs, runs, {"D": docs, "B": blobs}, edges), "crawl", owned=["B"])
    assert {r["_uniqueid"] for r in left.objects["B"].collect()} == {"b3"} and left.runs.count() == 1
    assert {tuple(r) for r in left.edges.select("_src", "_dst").collect()} == {("r3", "d3"), ("d3", "b3")}


def test_shared_vector_set(spark):
    v = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("b", "s1"), ("c", None)], "set string, spec_id string")
    left, registry = K.delete_shared_sets(v, spark.createDataFrame([("a",), ("b",), ("c",)], "name string"), "s1")
    assert left.count() == 2 and {r.name for r in registry.collect()} == {"a", "c"}


def test_delete_lineage(spark):
    nodes = spark.createDataFrame([(i, f"u{i}") for i in ("ds", "rs", "r", "f", "other")], "_uniqueid string, url string")
    edges = spark.createDataFrame([("ds", "rs", "x"), ("rs", "r", "x"), ("r", "f", "x"), ("other", "f", "x")], "_src string, _dst string, class string")
    left, e = K.delete_lineage(nodes, edges, spark.createDataFrame([("uds",)], "url string"))
    assert [r["_uniqueid"] for r in left.collect()] == ["other"] and e.count() == 0


def test_creator_and_pending(spark):
    df = spark.createDataFrame([("a", "k1", True), ("b", None, None), ("c", "k2", False)], "_uniqueid string, wf_creator_key string, done boolean")
    stay, edges = K.delete_by_creator({"X": df}, creator_key="k1", edges=spark.createDataFrame([("a", "b"), ("b", "c")], "_src string, _dst string"))
    assert stay["X"].count() == 2 and edges.count() == 1
    with pytest.raises(ValueError):
        K.delete_by_creator({"X": df})
    assert {r["_uniqueid"] for r in K.pending(df, "done").collect()} == {"b", "c"}
    ledger = K.mark_done(df.where("_uniqueid = 'a'"), spark.createDataFrame([("a",), ("a",)], "source_id string"), "ocr", "r")
    assert ledger.first().n_derived == 2
    assert {r["_uniqueid"] for r in K.pending_by_ledger(df, ledger, "ocr").collect()} == {"b", "c"}


def test_stream_handles_each_key_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    spark.range(0, 10).withColumn("v", F.col("id") * 2).coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def run():
        L.run_once(L.read_new_files(spark, source, schema), lambda d: d.withColumn("w", F.col("v") + 1), target, mark, ["id"], ["v"])
        return L.enriched(spark, target)

    assert run().count() == 10
    spark.range(5, 15).withColumn("v", F.col("id") * 2).coalesce(1).write.mode("append").parquet(source)
    out = run()
    assert out.count() == 15 and out.select("id").distinct().count() == 15 and out.where("w <> v + 1").count() == 0
    assert run().count() == 15


@pytest.mark.parametrize("order", [["v"], None])
def test_ten_batches(spark, tmp_path, order):
    """Ten files, one a batch, each with keys of the batches before: these are known by the state alone."""
    import os
    import shutil
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "id bigint, v bigint, note string"
    for b in range(10):
        ids = spark.range(max(0, 5 * b - 7), 5 * b + 5)
        rows = ids.selectExpr("id", f"CASE WHEN id % 4 = 0 THEN NULL ELSE {'1000 - id' if not order else '100 * ' + str(b) + ' + id'} END AS v", "concat('n', id) AS note")
        twice = rows.unionAll(rows.selectExpr("id", "v + 1", "note")) if order else rows.unionAll(rows)
        twice.coalesce(1).write.mode("append").parquet(source)
        name = max((f for f in os.listdir(source) if f.endswith(".parquet")), key=lambda f: os.path.getmtime(f"{source}/{f}"))
        os.utime(f"{source}/{name}", (1_700_000_000 + 10 * b,) * 2)  # files come in this order
    asked = []

    def enrich(batch):
        asked.append(batch.inputFiles())
        if len(asked) == 10:  # what nine batches have written is out of reach
            for k in range(9):
                shutil.rmtree(f"{target}/batch_id={k}")
        return batch.withColumn("w", F.coalesce("v", F.lit(0)) + 1)

    L.run_once(L.read_new_files(spark, source, schema, max_files=1), enrich, target, mark, ["id"], order)
    assert len(asked) == 10 and not any(target in f for files in asked for f in files)
    last = sorted((r.id, r.v, r.w, r.note) for r in L.enriched(spark, target).collect())
    first_v = {i: None if i % 4 == 0 else 900 + i if order else 1000 - i for i in range(45, 50)}
    assert last == [(i, v, (v or 0) + 1, f"n{i}") for i, v in first_v.items()]
    # the commit of the last batch is lost: it runs again, from the state before it
    os.unlink(f"{mark}/commits/9")
    if os.path.exists(f"{mark}/commits/.9.crc"):
        os.unlink(f"{mark}/commits/.9.crc")
    L.run_once(L.read_new_files(spark, source, schema, max_files=1), lambda d: d.withColumn("w", F.coalesce("v", F.lit(0)) + 1), target, mark, ["id"], order)
    assert sorted((r.id, r.v, r.w, r.note) for r in L.enriched(spark, target).collect()) == last
    assert spark.conf.get(L._STORE) != L._ROCKSDB


def test_shared_dir_is_the_clusters(spark):
    from plexus.session import shared_dir
    base = shared_dir(spark, "x").rsplit("/", 1)[0]
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == base


def test_first_of_keys_in_slices(monkeypatch):
    """The smallest row of each key, whatever slice it comes in: NULL first, not-a-number last, ties by the last column."""
    import pyarrow as pa
    monkeypatch.setattr(L, "_SLICE", 3)
    rows = [(i % 5, [None, 1.0, 2.0, float("nan")][(i * 7) % 4] if i % 5 < 3 else [float("nan"), 3.0][i % 2], i * 37 % 101) for i in range(60)]
    rows += [(None, 2.0, 1), (None, 1.0, 2), (9, float("nan"), 1), (9, float("inf"), 2), (9, float("inf"), 1)]
    batches = pa.table({"k": [r[0] for r in rows], "v": pa.array([r[1] for r in rows], pa.float64()), "_t": [r[2] for r in rows], "n": range(len(rows))}).to_batches(2)
    got = sorted((r["n"] for b in L._smallest(["k"], ["v"], "_t")(iter(batches)) for r in b.to_pylist()))
    rank = lambda r: (r[1] is not None, r[1] is not None and r[1] != r[1], r[1] if r[1] is not None and r[1] == r[1] else 0, r[2])
    assert got == sorted(min((i for i, r in enumerate(rows) if r[0] == k), key=lambda i: rank(rows[i])) for k in {r[0] for r in rows})


@pytest.mark.parametrize("nested", [False, True])
def test_stream_takes_the_smallest_of_a_batch(spark, tmp_path, nested):
    """Keys do not go through Python one by one; not-a-number is the largest; only nested keys take the way by key."""
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    nan = float("nan")
    rows = [(1, nan, "a"), (1, 2.0, "b"), (1, 3.0, "c"), (2, 1.0, "d"), (2, None, "e"), (None, 5.0, "f"), (None, 4.0, "g"), (3, 0.5, "h"), (3, 0.5, "h")]
    if nested:
        rows = [r for r in rows if r[1] is None or r[1] == r[1]]
    df = spark.createDataFrame(rows, "id bigint, v double, note string")
    df = df.withColumn("id", F.array("id")) if nested else df
    df.coalesce(1).write.parquet(source)
    stream = L.read_new_files(spark, source, df.schema)
    plan = L.first_of_keys(stream, ["id"], ["v"])._jdf.queryExecution().logical().toString()
    assert ("TransformWithState" in plan) == nested
    L.run_once(L.read_new_files(spark, source, df.schema), lambda d: d, target, mark, ["id"], ["v"])
    assert sorted(r.note for r in L.enriched(spark, target).collect()) == ["b", "e", "g", "h"]
    df.withColumn("v", F.lit(-1.0)).coalesce(1).write.mode("append").parquet(source)
    L.run_once(L.read_new_files(spark, source, df.schema), lambda d: d, target, mark, ["id"], ["v"])
    assert L.enriched(spark, target).count() == 4
