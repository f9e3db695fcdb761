"""Set operations, ordering, statistics, sources and sinks on small fixtures, hot keys included."""

import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plexus.operators import ordering as E
from plexus.operators import skew
from plexus.operators import stats as D
from plexus.operators import upsert as U
from plexus.sources import objects as O
from plexus.sources import sinks


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds a third of the rows."""
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 1000, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    return rows.withColumn("pos", F.when(F.col("k") == -1, 2 * F.col("id")).otherwise(F.lit(5))).repartition(4)


def test_numbering_across_blocks(hot):
    got = {r.pos: r.n for r in skew.row_number_by_block(hot, ["k"], "pos", "n", start=1, block=100).where("k = -1").collect()}
    assert got == {2 * i: i + 1 for i in range(1000)}
    assert skew.row_number_by_block(hot, ["k"], "pos", "n", block=100).where("k <> -1 and n <> 0").count() == 0


def test_dense_index(spark):
    names = [f"{a}{b}{c}" for a in "ab" for b in "xyz" for c in range(20)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert {r.name: r.i for r in skew.dense_index(df, "name", "i").collect()} == {n: i for i, n in enumerate(sorted(names))}


def test_text_joined_across_blocks(spark):
    df = spark.range(500).select(F.lit("a").alias("k"), "id", F.col("id").cast("string").alias("t")).repartition(5)
    assert D.concat_text(df, "k", "id", "t", block=7).first().full_text == " ".join(map(str, range(500)))


def test_first_per_key_is_limited_before_the_shuffle(hot):
    first = U.first_per_key(hot, ["k"], ["id"])
    assert first.count() == 2001 and first.where("k = -1").first().id == 0
    assert first._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_insert_twice_is_insert_once(spark, hot):
    none = spark.createDataFrame([], "k long")
    once = U.insert_if_not_found(hot.select("k", "id"), none, ["k"], ["id"])
    assert once.count() == 2001
    assert U.insert_if_not_found(hot.select("k", "id"), once, ["k"], ["id"]).count() == 0
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a")], "_src string, _dst string").withColumn(
        "wf_sha1_hash", U.edge_key(F.col("_src"), F.col("_dst")))
    new = U.add_edge_if_not_found(edges, edges.limit(0))
    assert new.count() == 2 and U.add_edge_if_not_found(edges, new).count() == 0


def test_dedup_keeps_the_first_of_many_copies(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    kept = U.dedup_content(df, "text", "id")
    assert kept.count() == 601 and kept.where("text = 'copy'").first().id == 0


def test_update_and_clean(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "n int, s string")
    got = {r.n: (r.s, r.f) for r in U.update_properties(df, {"n": [">", 1]}, {"s": "x", "f": True}).collect()}
    assert got == {1: ("a", None), 2: ("x", True), 3: ("x", True)}
    assert {r.n: r.s for r in U.update_properties(df, {"s": ["==", "a"]}, remove=["s"]).collect()} == {1: None, 2: None, 3: "b"}
    assert [r.n for r in U.clean_by_predicate(df, {"s": ["==", "a"]}).orderBy("n").collect()] == [2, 3]


@pytest.mark.parametrize("percent", [0, 0.1, 12.5, 50, 100])
def test_sample_is_exact_and_repeatable(spark, percent):
    df = spark.range(2000)
    a = {r.id for r in E.sample_percent(df, percent, "id").collect()}
    assert len(a) == int(2000 * percent / 100)
    assert a == {r.id for r in E.sample_percent(df.repartition(7), percent, "id").collect()}


def test_pages(spark):
    df = spark.range(25).select(F.format_string("k%02d", "id").alias("_uniqueid"))
    pages = [[r[0] for r in E.page(df, i, 10).collect()] for i in range(4)]
    assert [len(p) for p in pages] == [10, 10, 5, 0]
    assert [r[0] for r in E.page_after(df, pages[0][-1], 10).collect()] == pages[1]


def test_clip_windows(spark):
    v = spark.createDataFrame([(1, 10, 2.5), (2, 0, 30.0), (3, 3, 30.0)], "video int, n_frames int, fps double")
    got = [(r.video, r.clip, r.start, r.stop) for r in E.clip_windows(v).orderBy("video", "clip").collect()]
    assert got == [(1, 0, 0, 3), (1, 1, 3, 6), (1, 2, 6, 9), (1, 3, 9, 10), (3, 0, 0, 3)]
    frames = spark.range(20).withColumnRenamed("id", "frame")
    assert [r.frame for r in E.frame_interval(frames, 3, 12, 4).orderBy("frame").collect()] == [3, 7, 11]


def test_stats(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), ("z",)], "k string")
    assert {tuple(r) for r in D.reconcile_counts(a, b, ["k"]).collect()} == {("x", 2, 1, 1), ("y", 1, 0, 1), ("z", 0, 1, -1)}
    s = spark.createDataFrame([("c", 0.9, 3.0), ("c", None, 5.0), ("d", 0.1, 1.0)], "corpus string, bleu_score double, edit_distance double")
    gates = D.score_gate(s, [("bleu_score", "c", 0.8), ("edit_distance", "c", 4.0), ("bleu_score", "none", 0.1)]).collect()
    assert [g.passed for g in gates] == [True, False, False]
    summary = {(r.corpus, r.metric): (r["mean"], r["std"]) for r in D.score_summary(s, ["bleu_score", "edit_distance"]).collect()}
    assert summary[("c", "bleu_score")] == (0.9, None) and summary[("c", "edit_distance")][0] == 4.0


def test_property_csv(spark, tmp_path):
    good, bad, doc = (str(tmp_path / n) for n in ("people.adb.csv", "wrong.adb.csv", "document.adb.csv"))
    open(good, "w").write("EntityClass,name\nPerson,Ann\nPerson,Bo\n")
    open(bad, "w").write("name\nAnn\n")
    open(doc, "w").write("filename,owner\na.pdf,me\n")
    assert [r.name for r in O.property_csv(spark, good).collect()] == ["Ann", "Bo"]
    assert O.property_csv(spark, doc).first().owner == "me" and O.property_file_class("_Pdf.adb.csv") == "Document"
    with pytest.raises(ValueError, match="EntityClass"):
        O.property_csv(spark, bad)
    with pytest.raises(ValueError, match="cannot be loaded"):
        O.property_file_class("polygon.adb.csv")


def test_scan_objects_and_fetch(spark, tmp_path):
    for name in ("a.png", "b.JPG", "c.txt", "d.mp4"):
        (tmp_path / name).write_bytes(name.encode())
    assert {r.name for r in O.scan_objects(spark, str(tmp_path)).collect()} == {"a.png", "b.JPG"}
    assert O.scan_objects(spark, str(tmp_path), ["video/mp4"], content=True).first().content == bytearray(b"d.mp4")
    urls = spark.createDataFrame([(1, f"file://{tmp_path}/a.png"), (2, f"file://{tmp_path}/none"), (3, None)], "k int, url string")
    got = {r.k: (r.content, r.error) for r in O.fetch_urls(urls, "k", "url").collect()}
    assert got[1] == (bytearray(b"a.png"), None) and got[2][0] is None and "URLError" in got[2][1] and got[3] == (None, "no url")


def test_fetch_retries(spark):
    def flaky(url, seen={}):
        seen[url] = seen.get(url, 0) + 1
        if seen[url] < 3:
            raise OSError("again")
        return b"ok"
    df = spark.createDataFrame([(1, "u")], "k int, url string")
    assert O.fetch_urls(df, "k", "url", retries=3, fetch=flaky).first().content == bytearray(b"ok")


def test_fetches_overlap_and_keep_their_order(spark):
    """A slow host, one that fails twice and one that always fails: several at a time, not too many of one host, rows in order."""
    import json

    def slow(url, state={"now": {}, "most": {}, "seen": {}, "all": 0, "peak": 0}):
        import threading
        import time
        lock = state.setdefault("lock", threading.Lock())
        host = url.split("@")[1].split(":")[0]
        with lock:
            state["now"][host] = state["now"].get(host, 0) + 1
            state["all"] += 1
            state["peak"] = max(state["peak"], state["all"])
            state["most"][host] = max(state["most"].get(host, 0), state["now"][host])
            state["seen"][url] = state["seen"].get(url, 0) + 1
        time.sleep(0.02)
        with lock:
            state["now"][host] -= 1
            state["all"] -= 1
            if host == "bad" or host == "late" and state["seen"][url] < 3:
                raise OSError(f"try {state['seen'][url]}")
            return json.dumps([state["most"][host], state["peak"]]).encode()

    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        hosts = ["a", "b", "c", "late", "bad"]
        urls = spark.createDataFrame([(k, f"http://u:p@{hosts[k % 5]}:80/{k}") for k in range(100)] + [(100, None)], "k int, url string").coalesce(1)
        rows = O.fetch_urls(urls, "k", "url", retries=3, fetch=slow, per_host=2, pause=0.001, batch_bytes=100).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r.k for r in rows] == list(range(101))
    assert [(r.k, r.error) for r in rows if (r.content is None) != (r.k % 5 == 4 or r.k == 100)] == []
    assert {r.error for r in rows if r.k % 5 == 4} == {"OSError: try 3"} and rows[100].error == "no url"
    seen = [json.loads(bytes(r.content)) for r in rows if r.content]
    assert max(m for m, _ in seen) == 2 and max(p for _, p in seen) >= 6


def test_deep_pages_sort_one_range(spark):
    from plexus.operators.ordering import page
    df = spark.range(50_000).selectExpr("concat('k', lpad(id, 6, '0')) AS _uniqueid", "id AS v").repartition(6, "v")
    for at in (0, 1, 37, 499, 500):
        assert [r.v for r in page(df, at, 100).collect()] == list(range(100 * at, min(100 * at + 100, 50_000)))
    deep = page(df, 400, 100)
    node = deep._jdf.queryExecution().optimizedPlan().toString()
    skipped = int(node.split("Offset ")[1].split()[0])
    assert skipped < 25_000  # of 40,000 rows before the page
    assert page(df.where("false"), 3).count() == 0


def test_annotation_files(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "a.jpg", "height": 10, "width": 20, "license": 1, "coco_url": "c", "flickr_url": "http://f/9_x.jpg",
                       "date_captured": "2013-11-14 17:02:52"}],
           "annotations": [{"id": 5, "image_id": 1, "category_id": 2, "bbox": [-1.5, 2.9, 3.0, 0.2], "area": 50.0, "iscrowd": 0,
                            "segmentation": [[1, 2, 3, 4, 5, 6]]},
                           {"id": 6, "image_id": 1, "category_id": 2, "bbox": [1, 1, 1, 1], "area": 1.0, "iscrowd": 1,
                            "segmentation": {"counts": [1], "size": [1, 1]}},
                           {"id": 918, "image_id": 1, "category_id": 2, "bbox": [1, 1, 1, 1], "area": 1.0, "iscrowd": 0, "segmentation": []}],
           "categories": [{"id": 2, "name": "cat"}]}
    path = tmp_path / "instances_val2017.json"
    path.write_text(json.dumps(doc, indent=1))
    from plexus.plans import datasets as J
    t = O.annotations_json(spark, str(path))
    image = J.image_table(t, "img/").first()
    assert (image.corpus, image.aspect_ratio, image.yfcc_id, image.filename) == ("val", 2.0, "9", "img/a.jpg")
    boxes = {r.bbox_id: r for r in J.box_table(t).collect()}
    assert len(boxes) == 3 and (boxes[5].x_pos, boxes[5].y_pos, boxes[5].box_width, boxes[5].box_height) == (1, 2, 3, 1)
    assert boxes[5].area_perc == 0.25 and boxes[5]["_label"] == "cat"
    polygons = J.polygon_table(t).collect()
    assert [p.ann_id for p in polygons] == [5] and polygons[0].polygons == [[[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]]
    masks, edges = J.mask_edges(t, "seg")
    assert masks.first().filename == "seg/a.png" and edges.first()["class"] == "segmentation"


def test_packed_vector_file(spark, tmp_path):
    data = np.zeros(5, dtype=[("id", "<i8"), ("v", "<f4", (3,))])
    data["id"], data["v"] = np.arange(5) - 2, np.arange(15).reshape(5, 3)
    path = tmp_path / "v.bin"
    data.tofile(path)
    ids = spark.createDataFrame([(-2,), (2,)], "id long")
    got = {r.id: r.vector for r in O.packed_vector_file(spark, str(path), 3, ids).collect()}
    assert got == {-2: [0.0, 1.0, 2.0], 2: [12.0, 13.0, 14.0]}


def test_whitespace_table(spark, tmp_path):
    path = tmp_path / "attr.txt"
    path.write_text("2\nimage_id a b\n1.jpg  1 -1\n2.jpg -1   1\n")
    t = O.whitespace_table(spark, [str(path)], ["image_id", "a", "b"], skip=["image_id"])
    assert [tuple(r) for r in t.orderBy("image_id").collect()] == [("1.jpg", "1", "-1"), ("2.jpg", "-1", "1")]


def test_record_sets(spark):
    df = spark.createDataFrame([("1", '{"a": 1}'), ("2", None)], "id string, body string")
    sets = O.record_sets("urn:x", {"r": df}, flatten={"r": ("body", "a int")})
    assert sets.record_sets.first().n_records == 2 and [r.a for r in sets.records["r"].orderBy("id").collect()] == [1, None]
    assert O.record_sets("urn:x", {"r": df}, sample_count=1).records["r"].count() == 1


def test_export_rows(spark):
    df = spark.sql("select 1 as n, unhex('00FF') as b, timestamp'2020-01-02 03:04:05' as t, timestamp_ntz'2020-01-02 03:04:05.25' as u, true as f")
    rows, meta = sinks.export_rows(df, as_json=True)
    assert json.loads(rows.first().row) == {"n": 1, "b": base64.b64encode(b"\x00\xff").decode(), "t": "2020-01-02T03:04:05+00:00", "u": "2020-01-02T03:04:05.250000", "f": True}
    assert meta == [{"name": "n", "type": "number"}, {"name": "b", "type": "blob"}, {"name": "t", "type": "datetime"},
                    {"name": "u", "type": "datetime"}, {"name": "f", "type": "boolean"}]


def test_csv_round_trip(spark, tmp_path):
    texts = ['a "quoted", text', 'say "hi", ok', "two\nlines, \"both\"", "", None, "  blanks  ", ",", '"', "é"]
    path = str(tmp_path / "notes.adb.csv")
    sinks.write_property_csv(spark.createDataFrame([("Note", i, t) for i, t in enumerate(texts)], "EntityClass string, n int, s string"), path)
    assert [r.s for r in O.property_csv(spark, path).orderBy("n").collect()] == texts


def test_gates_of_hosts_go_with_their_urls(spark):
    """Urls without a host have a gate each; a task keeps those of the urls at hand only."""
    def fetch(url):
        import gc
        import threading
        if int(url.rsplit(",", 1)[1]) % 500 < 499:
            return b"0"
        return str(sum(isinstance(o, threading.Semaphore) for o in gc.get_objects())).encode()

    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        df = spark.range(4000).select("id", F.concat(F.lit("data:,"), "id").alias("url"))
        got = O.fetch_urls(df, "id", "url", fetch=fetch).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert len({r.id for r in got}) == 4000 and not any(r.error for r in got)
    assert 0 < max(int(r.content) for r in got) < 100


def test_packed_vectors_come_in_slices(spark):
    """One value may hold any number of records: few are rows at a time; a NULL holds none, a part of a record is an error."""
    import pyarrow as pa
    layout = np.dtype([("id", "<i8"), ("vector", "<f4", (3,))])
    data = np.zeros(5000, layout)
    data["id"], data["vector"] = np.arange(5000), np.arange(15000).reshape(5000, 3)
    values = [data[:3000].tobytes(), None, b"", *(r.tobytes() for r in data[3000:])]
    batches = list(O._unpacked(layout)(iter([pa.record_batch({"record": pa.array(values, pa.binary())})])))
    assert max(b.num_rows for b in batches) <= 1024
    want = {r["id"]: r["vector"].tolist() for r in data}
    assert {i: v for b in batches for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())} == want
    df = spark.createDataFrame([(v,) for v in values], "record binary")
    assert {r.id: r.vector for r in O.packed_vectors(df, 3).collect()} == want
    with pytest.raises(Exception, match="records of 20 bytes"):
        O.packed_vectors(spark.createDataFrame([(values[0][:-1],)], df.schema), 3).collect()
