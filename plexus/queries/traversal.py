"""Joins and graph traversal (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.operators import graph as C
from plexus.operators import ordering as E
from plexus.queries.registry import query, table
from plexus.queries.views import all_edges, edge, node


@query("c01_edge_join", """
  SELECT c_name AS customer, c_acctbal AS acctbal, o_orderkey AS orderkey, o_totalprice AS totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS orderdate
  FROM customer JOIN orders ON c_custkey = o_custkey
  WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 1000 AND o_orderstatus = 'O' ORDER BY o_orderdate""")
def c01(spark, sf):
    customers = node(spark, sf, "Customer").where("mktsegment = 'BUILDING' and acctbal > 1000")
    orders = node(spark, sf, "Orders").where("status = 'O'")
    joined = C.edge_join(customers, edge(spark, sf, "Placed"), orders)
    return E.order_by(joined, "dst.orderdate").select(
        F.col("src.name").alias("customer"), F.col("src.acctbal").alias("acctbal"),
        F.col("dst.orderkey").alias("orderkey"), F.col("dst.totalprice").alias("totalprice"),
        F.date_format("dst.orderdate", "yyyy-MM-dd").alias("orderdate"))


@query("c02_edges_by_endpoints", """
  SELECT 'Placed:' || o_orderkey AS _uniqueid, o_totalprice AS totalprice FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
    AND o_orderpriority = '1-URGENT' AND o_totalprice > 20000""")
def c02(spark, sf):
    src = node(spark, sf, "Customer").where("mktsegment = 'MACHINERY'").select("_uniqueid")
    dst = node(spark, sf, "Orders").where("priority = '1-URGENT'").select("_uniqueid")
    return C.edges_by_endpoints(edge(spark, sf, "Placed"), src, dst, F.col("totalprice") > 20000).select("_uniqueid", "totalprice")


@query("c03_is_connected_to", """
  SELECT 'Customer:' || c_custkey AS _uniqueid, c_mktsegment AS mktsegment FROM customer
  WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def c03(spark, sf):
    big = node(spark, sf, "Orders").where("totalprice > 300000")
    return C.is_connected_to(node(spark, sf, "Customer"), big, edge(spark, sf, "Placed"), "in", "Placed").select(
        "_uniqueid", "mktsegment")


@query("c04_group_by_source", """
  SELECT 'Nation:' || n_nationkey AS _src, 0 AS part, count(*) AS n_items, string_agg(c_name, '|' ORDER BY c_name) AS names
  FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey = 1 GROUP BY n_nationkey""")
def c04(spark, sf):
    nations = node(spark, sf, "Nation").join(
        edge(spark, sf, "InRegion").where("_dst = 'Region:1'").select(F.col("_src").alias("_uniqueid")), "_uniqueid", "left_semi")
    grouped = C.group_by_source(nations, edge(spark, sf, "CustomerIn"), node(spark, sf, "Customer"),
                                direction="in", columns=("name", "_uniqueid"))
    return grouped.select("_src", "part", F.size("items").cast("bigint").alias("n_items"),
                          F.array_join(F.transform("items", lambda i: i["name"]), "|").alias("names"))


@query("c04_group_in_parts", """
  SELECT _src, part, count(*) AS n_items, string_agg(c_name, '|' ORDER BY c_name) AS names FROM (
    SELECT 'Nation:' || c_nationkey AS _src, c_name, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) - 1) // 7 AS part FROM customer)
  GROUP BY _src, part""")
def c04_parts(spark, sf):
    """Lists longer than a part come in parts, in order."""
    grouped = C.group_by_source(node(spark, sf, "Nation"), edge(spark, sf, "CustomerIn"), node(spark, sf, "Customer"),
                                direction="in", columns=("name", "_uniqueid"), max_items=7)
    return grouped.select("_src", "part", F.size("items").cast("bigint").alias("n_items"),
                          F.array_join(F.transform("items", lambda i: i["name"]), "|").alias("names"))


@query("c05_k_hop", """
  SELECT DISTINCT 'Orders:' || o_orderkey AS _uniqueid FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2""")
def c05(spark, sf):
    start = node(spark, sf, "Region").where("_uniqueid = 'Region:2'")
    edges = all_edges(spark, sf, "InRegion", "CustomerIn", "Placed")
    return C.k_hop(start, [{"direction": "in", "edge_class": "InRegion"}, {"direction": "in", "edge_class": "CustomerIn"},
                           {"direction": "out", "edge_class": "Placed"}], edges)


_FK = "sha1('postgres://db/shop/orders/' || o_orderkey)", "sha1('postgres://db/shop/customer/' || o_custkey)"


def _orders_with_gaps(spark, sf):
    """Orders whose large ones point to customers that do not exist."""
    o = table(spark, sf, "orders")
    return o.withColumn("o_custkey", F.when(F.col("o_totalprice") > 400000, -F.col("o_custkey") - 1)
                        .when(F.col("o_orderstatus") != "P", F.col("o_custkey")))


_GAPS_SQL = """(SELECT o_orderkey, o_orderpriority, CASE WHEN o_totalprice > 400000 THEN -o_custkey - 1
    WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders)"""


@query("c07_fk_edges", f"""
  SELECT {_FK[0]} AS _src, {_FK[1]} AS _dst, 'OrdersToCustomer' AS class, sha1({_FK[0]} || {_FK[1]}) AS wf_sha1_hash
  FROM {_GAPS_SQL} WHERE o_custkey IN (SELECT c_custkey FROM customer)""".replace("OrdersTo", "Ordersto"))
def c07(spark, sf):
    return C.fk_edges(_orders_with_gaps(spark, sf), table(spark, sf, "customer"), prefix="postgres://db/shop",
                      source_table="orders", target_table="customer", source_key="o_orderkey",
                      fk_column="o_custkey", target_key="c_custkey")


@query("c08_dangling_edges", f"""
  SELECT o_orderkey, o_custkey FROM {_GAPS_SQL} WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def c08(spark, sf):
    return C.dangling_edges(_orders_with_gaps(spark, sf), table(spark, sf, "customer"), "o_custkey", "c_custkey").select(
        "o_orderkey", "o_custkey")


@query("c09_merge_properties", """
  SELECT 'doc_' || d.doc_id || '.pdf' AS filename, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)""")
def c09(spark, sf):
    name = F.concat(F.lit("doc_"), "doc_id", F.lit(".pdf")).alias("filename")
    return C.merge_properties(table(spark, sf, "documents").select(name, "lang"),
                              table(spark, sf, "labels").select(name, "quality", "toxic"))


@query("c10_not_yet_loaded", """
  SELECT doc_id, sha1('doc/' || doc_id) AS wf_sha1_hash FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def c10(spark, sf):
    key = F.sha1(F.concat(F.lit("doc/"), "doc_id")).alias("wf_sha1_hash")
    return C.not_yet_loaded(table(spark, sf, "documents").select("doc_id", key), table(spark, sf, "labels").select(key))


@query("c11_record_set_join", """
  SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)""")
def c11(spark, sf):
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "label_doc")
    return C.record_set_join(table(spark, sf, "documents"), labels, "doc_id", "label_doc").select("doc_id", "lang", "quality")


@query("c12_link_by_url", """
  SELECT 'Block:' || page_id AS _src, 'Image:' || page_id AS _dst, 'blockHasImage' AS class FROM pages WHERE url LIKE 'https:%'""")
def c12(spark, sf):
    p = table(spark, sf, "pages")
    blocks = p.select(F.concat(F.lit("Block:"), "page_id").alias("_uniqueid"), F.concat(F.col("url"), F.lit("!"), "page_id").alias("image_url"))
    images = p.where("url like 'https:%'").select(F.concat(F.lit("Image:"), "page_id").alias("_uniqueid"),
                                                  F.concat(F.col("url"), F.lit("!"), "page_id").alias("url"))
    return C.link_by_url(blocks, images, "blockHasImage")


@query("c13_coverage_check", """
  SELECT doc_id::VARCHAR AS _uniqueid, 'missing' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION ALL SELECT (-doc_id - 1)::VARCHAR, 'extra' FROM labels WHERE toxic = 1""")
def c13(spark, sf):
    labels = table(spark, sf, "labels")
    derived = labels.select(F.col("doc_id").cast("string").alias("source")).unionByName(
        labels.where("toxic = 1").select((-F.col("doc_id") - 1).cast("string").alias("source")))
    sources = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("_uniqueid"))
    return C.coverage_check(sources, derived, "source")


@query("c14_cardinality_check", """
  SELECT c_custkey AS _uniqueid, count(o_orderkey) AS n_derived FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey HAVING count(o_orderkey) <> 10""")
def c14(spark, sf):
    sources = table(spark, sf, "customer").select(F.col("c_custkey").alias("_uniqueid"))
    return C.cardinality_check(sources, table(spark, sf, "orders"), "o_custkey", 10)


@query("c15_vector_to_object", """
  WITH q AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM (
      SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) t(i) GROUP BY label, i) GROUP BY label),
  s AS (SELECT query_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS distance FROM embeddings, q),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance DESC, vec_id) AS rank FROM s)
  SELECT query_id, vec_id, distance, doc_id, lang FROM r JOIN documents ON doc_id = vec_id WHERE rank <= 5""")
def c15(spark, sf):
    from plexus.operators.vectors import find_similar
    from plexus.queries.similarity import label_centres
    vectors = table(spark, sf, "embeddings")
    hits = find_similar(label_centres(vectors), vectors, k=5, id_column="vec_id", vector_column="embedding", digits=6)
    edges = vectors.select(F.concat(F.lit("Document:"), "vec_id").alias("_src"), F.col("vec_id").alias("_dst"))
    objects = table(spark, sf, "documents").select(F.concat(F.lit("Document:"), "doc_id").alias("_uniqueid"), "doc_id", "lang")
    return C.vector_to_object(hits, edges, objects, "vec_id").select(
        "query_id", "vec_id", F.col("_distance").alias("distance"), "doc_id", "lang")
