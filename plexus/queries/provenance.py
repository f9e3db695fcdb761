"""Specs, runs, links, deletes and done flags (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.plans import provenance as K
from plexus.queries.registry import query, table
from plexus.session import shared_dir
from plexus.sources import parts as P

# users as runs of specs, events as objects of the runs
_SPEC = "user_id % 7"


def _day(c):
    return F.date_format(c, "yyyy-MM-dd")


def _runs(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id").agg(_day(F.min("ts")).alias("run_start"))
    none = F.lit(None)
    return e.select(F.col("user_id").cast("string").alias("run_id"), (F.col("user_id") % 7).cast("string").alias("spec_id"), "run_start",
                    none.cast("string").alias("run_end"), none.cast("array<string>").alias("linked_types"))


def _specs(runs):
    return runs.select("spec_id").distinct().select("spec_id", F.when(F.col("spec_id") < "4", "crawl").otherwise("ocr").alias("workflow_name"))


def _objects(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("Event:"), "event_id").alias("_uniqueid"), F.col("user_id").cast("string").alias("run_id"),
        (F.col("user_id") % 7).cast("string").alias("spec_id"), "event_type", F.col("value").alias("size"))


@query("k01_create_spec", f"""
  SELECT DISTINCT ({_SPEC})::VARCHAR AS spec_id, CASE WHEN {_SPEC} = 3 THEN 'again' WHEN {_SPEC} < 4 THEN 'crawl' ELSE 'ocr' END AS workflow_name FROM events
  UNION ALL SELECT 'new', 'embed'""")
def k01(spark, sf):
    specs = K.create_spec(_specs(_runs(spark, sf)), "new", {"workflow_name": "embed"})
    return K.create_spec(specs, "3", {"workflow_name": "again"}, clean=True)


@query("k02_add_finish_run", f"""
  SELECT user_id::VARCHAR AS run_id, ({_SPEC})::VARCHAR AS spec_id, strftime(min(ts), '%Y-%m-%d') AS run_start, NULL AS run_end, NULL AS linked_types FROM events GROUP BY user_id
  UNION ALL SELECT 'r-new', '2', '2024-05-01', '2024-05-02', 'Image,Blob'""")
def k02(spark, sf):
    runs = K.add_run(_runs(spark, sf), "2", "r-new", F.lit("2024-05-01"))
    return K.finish_run(runs, "r-new", F.lit("2024-05-02"), ["Image", "Blob"]).withColumn("linked_types", F.concat_ws(",", "linked_types")).withColumn(
        "linked_types", F.nullif("linked_types", F.lit("")))


@query("k03_link_objects", "SELECT user_id::VARCHAR AS _src, 'Event:' || event_id AS _dst, 'WorkflowAdded' AS class FROM events")
def k03(spark, sf):
    return K.link_objects(_objects(spark, sf))


def _workflow(spark, sf):
    """Objects with spec ids, and one blob per click that hangs on its object by an edge."""
    runs, objects = _runs(spark, sf), _objects(spark, sf)
    clicks = table(spark, sf, "events").where("event_type = 'click'")
    blob, obj = F.concat(F.lit("Blob:"), "event_id"), F.concat(F.lit("Event:"), "event_id")
    blobs = clicks.select(blob.alias("_uniqueid"), F.col("value").alias("size"))
    edges = K.link_objects(objects).unionByName(clicks.select(obj.alias("_src"), blob.alias("_dst"), F.lit("hasBlob").alias("class")))
    return K.Workflow(_specs(runs), runs, {"Event": objects, "Blob": blobs}, edges)


def _counts(work):
    n = F.count(F.lit(1)).alias("n_rows")
    parts = {"specs": work.specs, "runs": work.runs, **work.objects}
    out = work.edges.groupBy(F.concat(F.lit("edges "), F.col("class")).alias("what")).agg(n)
    for name, df in parts.items():
        out = out.unionByName(df.agg(n).select(F.lit(name).alias("what"), "n_rows"))
    return out


def _counts_sql(stay):
    return f"""SELECT 'specs' AS what, count(DISTINCT {_SPEC}) AS n_rows FROM events WHERE {stay} UNION ALL
  SELECT 'runs', count(DISTINCT user_id) FROM events WHERE {stay} UNION ALL SELECT 'Event', count(*) FROM events WHERE {stay} UNION ALL
  SELECT 'Blob', count(*) FROM events WHERE {stay} AND event_type = 'click' UNION ALL
  SELECT 'edges WorkflowAdded', count(*) FROM events WHERE {stay} UNION ALL SELECT 'edges hasBlob', count(*) FROM events WHERE {stay} AND event_type = 'click'"""


@query("k04_delete_spec", _counts_sql(f"{_SPEC} <> 2"))
def k04(spark, sf):
    work = _workflow(spark, sf)
    return _counts(K.delete_specs(work, work.specs.where("spec_id = '2'").select("spec_id"), owned=["Blob"]))


def _stored(spark, sf):
    """The workflow in tables that change in place."""
    work = _workflow(spark, sf)
    folder = shared_dir(spark, "workflow")
    write = lambda name, df, key: P.PartTable.write(df, f"{folder}/{name}", key, parts=16)
    objects = {name: write(name, df, "_uniqueid") for name, df in work.objects.items()}
    return P.StoredWorkflow(write("specs", work.specs, "spec_id"), write("runs", work.runs, "run_id"), objects, write("edges", work.edges, "_src"))


def _stored_counts(stored):
    return _counts(K.Workflow(stored.specs.rows(), stored.runs.rows(), {name: t.rows() for name, t in stored.objects.items()}, stored.edges.rows()))


@query("k04_delete_in_place", _counts_sql(f"{_SPEC} <> 2"))
def k04_in_place(spark, sf):
    """The same delete on stored tables: only parts that hold rows of the spec are written anew."""
    stored = _stored(spark, sf)
    stored.delete_specs(stored.specs.rows().where("spec_id = '2'").select("spec_id"), owned=["Blob"])
    return _stored_counts(stored)


@query("k05_delete_shared_set", """
  SELECT 'set_' || label AS name, count(*) FILTER (NOT (label < 4 OR vec_id % 2 = 0)) AS n_left FROM embeddings WHERE label >= 4 GROUP BY label""")
def k05(spark, sf):
    v = table(spark, sf, "embeddings")
    mine = (F.col("label") < 4) | (F.col("vec_id") % 2 == 0)
    vectors = v.select("vec_id", F.concat(F.lit("set_"), "label").alias("set"), F.when(mine, "s1").otherwise("s2").alias("spec_id"))
    left, registry = K.delete_shared_sets(vectors, vectors.select(F.col("set").alias("name")).distinct(), "s1")
    counts = left.groupBy(F.col("set").alias("name")).agg(F.count(F.lit(1)).alias("n_left"))
    return registry.join(counts, "name", "left").select("name", F.coalesce("n_left", F.lit(0).cast("bigint")).alias("n_left"))


@query("k06_delete_all", _counts_sql(f"{_SPEC} >= 4"))
def k06(spark, sf):
    return _counts(K.delete_all(_workflow(spark, sf), "crawl", owned=["Blob"]))


@query("k07_delete_by_creator", """
  SELECT 'Document' AS class, doc_id AS id FROM documents WHERE source <> 'src5'
  UNION ALL SELECT 'Label', doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE source = 'src5')""")
def k07(spark, sf):
    d = table(spark, sf, "documents").select(F.concat(F.lit("D:"), "doc_id").alias("_uniqueid"), F.col("doc_id").alias("id"),
                                             F.sha1(F.concat(F.lit("s3:/"), "source")).alias("wf_creator_key"))
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("id")).join(d.drop("_uniqueid"), "id", "left").select(
        F.concat(F.lit("L:"), "id").alias("_uniqueid"), "id", "wf_creator_key")
    key = "s3:/src5"
    import hashlib
    stay, _ = K.delete_by_creator({"Document": d, "Label": lab}, creator_key=hashlib.sha1(key.encode()).hexdigest())
    return stay["Document"].select(F.lit("Document").alias("class"), "id").unionByName(
        stay["Label"].select(F.lit("Label").alias("class"), "id"))


@query("k08_delete_lineage", """
  SELECT 'Region:' || r_regionkey AS _uniqueid FROM region WHERE r_regionkey NOT IN (1, 3) UNION ALL
  SELECT 'Nation:' || n_nationkey FROM nation WHERE n_regionkey NOT IN (1, 3) UNION ALL
  SELECT 'Customer:' || c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey NOT IN (1, 3)) UNION ALL
  SELECT 'Orders:' || o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey IN (1, 3))""")
def k08(spark, sf):
    from plexus.queries.views import edge, node
    flip = lambda e: e.select("_uniqueid", F.col("_dst").alias("_src"), F.col("_src").alias("_dst"), "class")
    edges = flip(edge(spark, sf, "InRegion")).unionByName(flip(edge(spark, sf, "CustomerIn"))).unionByName(
        edge(spark, sf, "Placed").select("_uniqueid", "_src", "_dst", "class"))
    nodes = None
    for name in ("Region", "Nation", "Customer", "Orders"):
        part = node(spark, sf, name).select("_uniqueid")
        nodes = part if nodes is None else nodes.unionByName(part)
    nodes = nodes.withColumn("url", F.concat(F.lit("urn:"), "_uniqueid"))
    urls = nodes.where("_uniqueid in ('Region:1', 'Region:3')").select("url")
    left, _ = K.delete_lineage(nodes, edges, urls)
    return left.select("_uniqueid")


@query("k09_pending", """
  SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL OR l.quality <> 1""")
def k09(spark, sf):
    flagged = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", (F.col("quality") == 1).alias("done"))
    return K.pending(flagged, "done").select("doc_id")


@query("k10_mark_done", """
  SELECT c_custkey AS object_id, 'orders' AS job, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_derived, 'run-9' AS run_id FROM customer""")
def k10(spark, sf):
    objects = table(spark, sf, "customer").select(F.col("c_custkey").alias("_uniqueid"))
    return K.mark_done(objects, table(spark, sf, "orders"), "orders", "run-9", source="o_custkey")


@query("k11_annotation_provenance", """
  SELECT 'run-5' AS _src, event_id::VARCHAR AS _dst, sha1('run-5_' || event_id) AS wf_sha1_hash FROM events WHERE event_type <> 'view'""")
def k11(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("_uniqueid"), "event_type")
    existing = e.where("event_type = 'view'").select(F.sha1(F.concat_ws("_", F.lit("run-5"), "_uniqueid")).alias("wf_sha1_hash"))
    return K.annotation_provenance(e.unionByName(e), existing, "run-5")


@query("k12_sql_ingest", """
  SELECT sha1('postgres://db/shop/documents/' || doc_id) AS wf_sha1_hash, 'Document' AS "EntityClass",
    '{"doc_id":' || doc_id || CASE WHEN lang <> 'en' THEN ',"lang":"' || lang || '"' ELSE '' END || ',"wf_creator":"sql_ingestor","wf_creator_key":"' ||
    sha1('sql://db/shop/documents') || '","wf_workflow_id":"run-7","wf_table_source":"documents"}' AS properties, strlen(text) AS n_bytes, 'application/octet-stream' AS mime
  FROM documents""")
def k12(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
                                             F.encode("text", "UTF-8").alias("body"))
    nodes, blobs = K.sql_ingest(d, host="db", database="shop", table="documents", key="doc_id", entity_class="Document",
                                run_id="run-7", binary="body")
    return nodes.join(blobs, "wf_sha1_hash").select("wf_sha1_hash", "EntityClass", "properties",
                                                    F.octet_length("data").cast("bigint").alias("n_bytes"), F.col("adb_mime_type").alias("mime"))
