"""Scans, profiles, object stores and sinks (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.queries.registry import query, table
from plexus.queries.views import edge, graph, node
from plexus.sources import classes, objects, profile, sinks


@query("a01_entity_table", """
  SELECT 'Customer:' || c_custkey AS _uniqueid, c_custkey AS custkey, c_name AS name, c_acctbal AS acctbal,
         c_mktsegment AS mktsegment FROM customer""")
def a01(spark, sf):
    return node(spark, sf, "Customer")


@query("a02_connection_table", """
  SELECT 'Placed:' || o_orderkey AS _uniqueid, 'Customer:' || o_custkey AS _src, 'Orders:' || o_orderkey AS _dst,
         'Placed' AS class, 'Customer' AS src_class, 'Orders' AS dst_class, o_totalprice AS totalprice FROM orders""")
def a02(spark, sf):
    return edge(spark, sf, "Placed")


@query("a03_system_entity", """
  SELECT 'Customer:' || c_custkey AS _uniqueid, 'Customer' AS class, c_name AS name, c_custkey::DOUBLE AS custkey,
         c_acctbal AS acctbal, c_mktsegment AS mktsegment, NULL::DOUBLE AS suppkey, NULL::DOUBLE AS partkey,
         NULL::VARCHAR AS brand, NULL::DOUBLE AS size, NULL::DOUBLE AS vec_id FROM customer
  UNION ALL SELECT 'Supplier:' || s_suppkey, 'Supplier', s_name, NULL, s_acctbal, NULL, s_suppkey, NULL, NULL, NULL, NULL FROM supplier
  UNION ALL SELECT 'Part:' || p_partkey, 'Part', p_name, NULL, NULL, NULL, NULL, p_partkey, p_brand, p_size, NULL FROM part
  UNION ALL SELECT 'Vector:' || vec_id, 'Vector', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, vec_id FROM embeddings""")
def a03(spark, sf):
    # label is text in Part and a number in Vector: dropped
    return graph(spark, sf, ["Customer", "Supplier", "Part", "Vector"], []).entity()


@query("a04_system_connection", """
  SELECT 'InRegion:' || n_nationkey AS _uniqueid, 'Nation:' || n_nationkey AS _src, 'Region:' || n_regionkey AS _dst,
         'InRegion' AS class, 'Nation' AS src_class, 'Region' AS dst_class, NULL::DOUBLE AS totalprice FROM nation
  UNION ALL SELECT 'CustomerIn:' || c_custkey, 'Customer:' || c_custkey, 'Nation:' || c_nationkey, 'CustomerIn', 'Customer', 'Nation', NULL FROM customer
  UNION ALL SELECT 'Placed:' || o_orderkey, 'Customer:' || o_custkey, 'Orders:' || o_orderkey, 'Placed', 'Customer', 'Orders', o_totalprice FROM orders""")
def a04(spark, sf):
    return graph(spark, sf, [], ["InRegion", "CustomerIn", "Placed"]).connection()


@query("a05_descriptor_table", """
  SELECT vec_id, 'set_' || label AS set, len(embedding) AS dimensions, round(embedding[1]::DOUBLE, 6) AS first_value,
         NULL::DOUBLE AS _distance, NULL::VARCHAR AS _find_similar FROM embeddings WHERE label = 3""")
def a05(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumn("set", F.concat(F.lit("set_"), "label"))
    return classes.descriptor_table(vectors, "set_3").select(
        "vec_id", "set", F.size("embedding").cast("bigint").alias("dimensions"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"), "_distance", "_find_similar")


def _profile_sql(cls: str, source: str, cols: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{cls}' AS class, count(*) AS matched, '{p}' AS property, count({expr}) AS n_values, "
        f"'{kind}' AS type, false AS indexed FROM {source}" for p, expr, kind in cols)


_EVENTS = "CASE WHEN event_type = 'error' THEN NULL ELSE value END"


@query("a06_schema_profile", _profile_sql("Orders", "orders", [
    ("orderkey", "o_orderkey", "number"), ("status", "o_orderstatus", "string"),
    ("totalprice", "o_totalprice", "number"), ("orderdate", "o_orderdate", "datetime"),
    ("priority", "o_orderpriority", "string")]) + " UNION ALL " + _profile_sql("Event", "events", [
        ("ts", "ts", "datetime"), ("event_type", "event_type", "string"), ("value", _EVENTS, "number"),
        ("failed", "nullif(event_type = 'error', false)", "boolean")])
    + " UNION ALL " + _profile_sql("Document", "documents", [
        ("text", "text", "string"), ("lang", "nullif(lang, 'en')", "string"), ("n_chars", "n_chars", "number")]))
def a06(spark, sf):
    error = F.col("event_type") == "error"
    events = table(spark, sf, "events").select(
        "ts", "event_type", F.when(~error, F.col("value")).alias("value"), F.when(error, error).alias("failed"))
    documents = table(spark, sf, "documents").select(
        "text", F.nullif("lang", F.lit("en")).alias("lang"), "n_chars")
    return profile.schema_profile({"Orders": node(spark, sf, "Orders"), "Event": events, "Document": documents})


@query("a07_describe_connections", """
  SELECT 'LocatedIn' AS class, 'Customer' AS src_class, 'Nation' AS dst_class, count(*) AS matched FROM customer
  UNION ALL SELECT 'LocatedIn', 'Supplier', 'Nation', count(*) FROM supplier
  UNION ALL SELECT 'Placed', 'Customer', 'Orders', count(*) FROM orders""")
def a07(spark, sf):
    shape = ["_uniqueid", "_src", "_dst", "class", "src_class", "dst_class"]
    edges = classes.connection_table(
        table(spark, sf, "customer"), "LocatedIn", "c_custkey", ("Customer", "c_custkey"), ("Nation", "c_nationkey")
    ).unionByName(classes.connection_table(
        table(spark, sf, "supplier"), "LocatedIn", "s_suppkey", ("Supplier", "s_suppkey"), ("Nation", "s_nationkey"))
    ).unionByName(edge(spark, sf, "Placed").select(*shape))
    return profile.describe_connections(edges)


@query("a09_scan_objects", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS name, NULL::VARCHAR AS mime_type, true AS has_bytes FROM (SELECT count(*) FROM {t})" for t in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()))
def a09(spark, sf):
    """The folder of the tables as an object store, a table in parts being one object; parquet files carry no known media type."""
    return objects.scan_objects(spark, sf, mime_types=None, glob="*.parquet", folder_suffix=".parquet").select(
        "name", "mime_type", (F.col("length") > 0).alias("has_bytes"))


_FILES_SQL = """SELECT *, CASE ext WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' WHEN 'pdf' THEN 'application/pdf'
  WHEN 'mp4' THEN 'video/mp4' END AS mime FROM (SELECT doc_id, source || '/' || lang || '/doc_' || doc_id || '.' || ext AS path, ext
  FROM (SELECT *, CASE WHEN lang = 'en' THEN 'pdf' WHEN lang = 'fr' THEN 'png' WHEN lang = 'de' THEN 'jpg' ELSE 'mp4' END AS ext FROM documents))"""


def _files(spark, sf):
    d = table(spark, sf, "documents")
    ext = (F.when(F.col("lang") == "en", "pdf").when(F.col("lang") == "fr", "png")
           .when(F.col("lang") == "de", "jpg").otherwise("mp4"))
    return d.select("doc_id", F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/doc_"), F.col("doc_id"),
                                       F.lit("."), ext).alias("path"))


@query("a10_object_manifest", f"""
  SELECT 's3://bucket/' || path AS url, sha1('s3://bucket/' || path) AS wf_sha1_hash, '2024-01-01T00:00:00' AS wf_ingest_date,
    'bucket_ingestor' AS wf_creator, sha1('s3:/bucket') AS wf_creator_key, mime AS adb_mime_type,
    'bucket/' || path AS wf_object_path, 'wf-1' AS wf_workflow_id, split_part(path, '/', -1) AS filename
  FROM ({_FILES_SQL})""")
def a10(spark, sf):
    return objects.object_manifest(
        _files(spark, sf).select("path"), scheme="s3:", bucket="bucket", ingest_date="2024-01-01T00:00:00",
        add_object_paths=True, workflow_id="wf-1").withColumn("filename", F.substring_index("filename", "/", -1))


@query("a11_property_csv", """
  SELECT doc_id::VARCHAR AS doc_id, quality::VARCHAR AS quality, toxic::VARCHAR AS toxic, 'Label' AS "EntityClass",
         'labels.adb.csv' AS file_name FROM labels""")
def a11(spark, sf):
    from plexus.session import shared_dir
    path = f"{shared_dir(spark, 'property-csv')}/labels.adb.csv"
    sinks.write_property_csv(table(spark, sf, "labels").select(
        F.lit("Label").alias("EntityClass"), "doc_id", "quality", "toxic"), path)
    return objects.property_csv(spark, path, name="labels.adb.csv")


@query("a12_jdbc_table", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def a12(spark, sf):
    return classes.jdbc_table(spark, "customer", ["c_custkey", "c_name", "c_nationkey"],
                              path=f"{sf}/customer.parquet")


def _classify_sql(table_name, entity, role, key, columns):
    return " UNION ALL ".join(
        f"SELECT '{table_name}' AS table_name, '{entity}' AS entity_name, '{role}' AS table_role, count(*) AS n_rows, "
        f"count(*) = count(DISTINCT {key}) AS key_ok, '{c}' AS column_name, '{r}' AS column_role, "
        f"count({c}) AS n_values FROM {table_name}" for c, r in columns)


@query("a13_classify_tables", " UNION ALL ".join([
    _classify_sql("customer", "Customer", "entity", "c_custkey", [
        ("c_custkey", "key"), ("c_name", "property"), ("c_nationkey", "foreign_key"), ("c_mktsegment", "property")]),
    _classify_sql("orders", "orders", "entity", "o_custkey", [
        ("o_orderkey", "property"), ("o_custkey", "foreign_key"), ("o_orderstatus", "property"),
        ("o_totalprice", "property"), ("o_orderdate", "property"), ("o_orderpriority", "property")]),
    _classify_sql("pages", "pages", "image", "page_id", [
        ("page_id", "key"), ("url", "url"), ("html", "property")])]))
def a13(spark, sf):
    names = ("customer", "orders", "pages", "lineitem")
    return profile.classify_tables(
        {n: table(spark, sf, n) for n in names},
        {"customer": "c_custkey", "orders": "o_custkey", "pages": "page_id"},  # o_custkey is no key: key_ok is false
        image_tables=["pages"], ignore_tables=["line*"], ignore_columns=["*.c_acct*"], url_columns=["pages.ur?"],
        foreign_keys=["customer.c_nationkey", "orders.o_custkey"], entity_names={"customer": "Customer"})


@query("a14_discover_fks", """
  SELECT 'orders.o_custkey' AS source, 'customer.c_custkey' AS target,
    count(*) FILTER (o_custkey IN (SELECT c_custkey FROM customer)) AS n_matched,
    count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) AS n_unmatched,
    count(*) FILTER (o_custkey IS NULL) AS n_null FROM orders
  UNION ALL SELECT 'labels.doc_id', 'documents.doc_id', count(*) FILTER (doc_id IN (SELECT doc_id FROM documents)),
    count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM documents)), 0 FROM labels
  UNION ALL SELECT 'items.fk_part_p_partkey', 'part.p_partkey',
    count(*) FILTER (k IN (SELECT p_partkey FROM part)),
    count(*) FILTER (k IS NOT NULL AND k NOT IN (SELECT p_partkey FROM part)), count(*) FILTER (k IS NULL)
  FROM (SELECT CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN -l_partkey ELSE l_partkey END AS k FROM lineitem)""")
def a14(spark, sf):
    flag, part = F.col("l_returnflag"), F.col("l_partkey")
    items = table(spark, sf, "lineitem").select("l_orderkey", F.when(flag == "A", -part).when(
        flag != "R", part).alias("fk_part_p_partkey"))
    tables = {"orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer"),
              "labels": table(spark, sf, "labels"), "documents": table(spark, sf, "documents"),
              "items": items, "part": table(spark, sf, "part")}
    return profile.discover_fks(
        tables, {"customer": "c_custkey", "documents": "doc_id", "part": "p_partkey"},
        {"orders.o_custkey": "customer.c_custkey", "labels.doc_id": "documents.doc_id"})


@query("a15_fetch_urls", """
  SELECT doc_id, strlen(text) AS n_bytes, sha1(text) AS sha1, NULL::VARCHAR AS error FROM documents""")
def a15(spark, sf):
    """Every document behind a url that carries it (data scheme: nothing leaves the machine)."""
    urls = table(spark, sf, "documents").select("doc_id", F.concat(
        F.lit("data:application/octet-stream;base64,"), F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")
    ).alias("url"))
    return objects.fetch_urls(urls, "doc_id", "url").select(
        "doc_id", F.octet_length("content").cast("bigint").alias("n_bytes"), F.sha1("content").alias("sha1"), "error")


@query("a16_whitespace_table", """
  SELECT c_custkey::VARCHAR AS image_id, c_nationkey::INTEGER AS smiling, round(c_acctbal, 2) AS x_1 FROM customer""")
def a16(spark, sf):
    from plexus.session import shared_dir
    c = table(spark, sf, "customer")
    n, path = c.agg(F.count(F.lit(1)).cast("string").alias("value")), shared_dir(spark, "whitespace")
    header = n.withColumn("_o", F.lit(0)).unionByName(spark.range(1).select(
        F.lit("image_id smiling").alias("value"), F.lit(1).alias("_o"))).coalesce(1).sortWithinPartitions("_o")
    body = c.select(F.concat_ws("   ", "c_custkey", "c_nationkey").alias("value"))
    header.select("value").write.text(f"{path}/attr/a_header")
    body.write.text(f"{path}/attr/b_rows")
    c.select(F.concat_ws(" ", F.col("c_custkey"), F.col("c_acctbal")).alias("value")).write.text(f"{path}/box")
    attr = objects.whitespace_table(spark, [f"{path}/attr/a_header", f"{path}/attr/b_rows"],
                                    ["image_id", "smiling"], skip=["image_id"])
    box = objects.whitespace_table(spark, [f"{path}/box"], ["image_id", "x_1"])
    return attr.join(box, "image_id").select("image_id", F.col("smiling").cast("int").alias("smiling"),
                                             F.round(F.col("x_1").cast("double"), 2).alias("x_1"))


@query("a18_packed_vectors", """
  SELECT vec_id AS id, len(embedding) AS dimensions, round(list_sum(embedding::DOUBLE[]), 4) AS total
  FROM embeddings WHERE label < 5""")
def a18(spark, sf):
    from plexus.operators.vectors import pack_vector
    e = table(spark, sf, "embeddings")
    digits = F.lpad(F.hex("vec_id"), 16, "0")  # big-endian; the record starts with the lowest byte
    head = F.concat(*[F.unhex(F.substring(digits, 15 - 2 * i, 2)) for i in range(8)])
    records = e.select(F.concat(head, pack_vector("embedding")).alias("record"))
    ids = e.where("label < 5").select(F.col("vec_id").alias("id"))
    out = objects.packed_vectors(records, 64, ids)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return out.select("id", F.size("vector").cast("bigint").alias("dimensions"), F.round(total, 4).alias("total"))


@query("a19_record_sets", """
  SELECT 'dataset' AS level, 'urn:orders' AS parent, NULL AS record_id, NULL AS status, NULL::DOUBLE AS price, NULL::BIGINT AS n_records
  UNION ALL SELECT 'record_set', 'urn:orders', 'orders', NULL, NULL, count(*) FROM orders
  UNION ALL SELECT 'record', 'orders', o_orderkey::VARCHAR, o_orderstatus, o_totalprice, NULL FROM orders""")
def a19(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("record_id"),
        F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))).alias("body"))
    sets = objects.record_sets("urn:orders", {"orders": o}, sample_count=-1,
                               flatten={"orders": ("body", "status string, price double")})
    levels = (sets.datasets.select(F.lit("dataset").alias("level"), F.col("dataset").alias("parent")),
              sets.record_sets.select(F.lit("record_set").alias("level"), F.col("dataset").alias("parent"),
                                      F.col("record_set").alias("record_id"), "n_records"),
              sets.records["orders"].select(F.lit("record").alias("level"), F.col("record_set").alias("parent"), "record_id", "status", "price"))
    return levels[2].unionByName(levels[1], allowMissingColumns=True).unionByName(levels[0], allowMissingColumns=True)


_NOTES_SQL = """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'say "hi", ' || lang || chr(10) || '"' WHEN 3 THEN '  padded, '
  ELSE text END AS note, source FROM documents"""


def _notes(spark, sf):
    """NULLs, empty texts, quotes, commas, blanks and line breaks."""
    d = table(spark, sf, "documents")
    turn = F.col("doc_id") % 5
    note = (F.when(turn == 1, "").when(turn == 2, F.concat(F.lit('say "hi", '), "lang", F.lit('\n"'))).when(turn == 3, "  padded, ")
            .when(turn == 4, F.col("text")))
    return d.select("doc_id", note.alias("note"), "source")


@query("a20_property_csv_texts", f"""
  SELECT 'Note' AS "EntityClass", doc_id::VARCHAR AS doc_id, note, source, 'notes.adb.csv' AS file_name FROM ({_NOTES_SQL})""")
def a20_texts(spark, sf):
    from plexus.session import shared_dir
    path = f"{shared_dir(spark, 'property-csv')}/notes.adb.csv"
    sinks.write_property_csv(_notes(spark, sf).select(F.lit("Note").alias("EntityClass"), "doc_id", "note", "source"), path)
    return objects.property_csv(spark, path, name="notes.adb.csv")


@query("a20_write_property_csv", """
  SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_size::VARCHAR AS p_size FROM part""")
def a20(spark, sf):
    from plexus.session import shared_dir
    path = shared_dir(spark, "csv")
    sinks.write_property_csv(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), path)
    return spark.read.option("header", True).csv(path)


@query("a21_export_rows", """
  SELECT doc_id, to_base64(encode(text)) AS body, strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id), '%Y-%m-%dT%H:%M:%S')
           || CASE WHEN doc_id % 3 > 0 THEN '.' || lpad((doc_id % 3 * 123456)::VARCHAR, 6, '0') ELSE '' END || '+00:00' AS made,
         lang FROM documents""")
def a21(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("body"),
        F.timestamp_micros((F.lit(1704067200) + F.col("doc_id")) * 1_000_000 + F.col("doc_id") % 3 * 123_456).alias("made"), "lang")
    rows, _ = sinks.export_rows(d)
    return rows
