"""Set operations, deduplication, upsert and delete (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.operators import upsert as U
from plexus.queries.registry import query, table
from plexus.session import shared_dir
from plexus.sources.parts import PartTable


@query("f01_union_classes", """
  SELECT c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, NULL::VARCHAR AS brand FROM customer
  UNION ALL SELECT s_name, s_acctbal, NULL, NULL FROM supplier UNION ALL SELECT p_name, NULL, NULL, p_brand FROM part""")
def f01(spark, sf):
    return U.union_classes([
        table(spark, sf, "customer").selectExpr("c_name name", "c_acctbal acctbal", "c_mktsegment segment"),
        table(spark, sf, "supplier").selectExpr("s_name name", "s_acctbal acctbal"),
        table(spark, sf, "part").selectExpr("p_name name", "p_brand brand")])


@query("f02_id_diff", """
  SELECT doc_id AS id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION ALL SELECT DISTINCT page_id, 'right' FROM (SELECT doc_id AS page_id FROM labels UNION ALL SELECT -page_id - 1 FROM pages)
    WHERE page_id NOT IN (SELECT doc_id FROM documents)""")
def f02(spark, sf):
    right = table(spark, sf, "labels").selectExpr("doc_id as id").unionByName(table(spark, sf, "pages").selectExpr("-page_id - 1 as id"))
    return U.id_diff(table(spark, sf, "documents").selectExpr("doc_id as id"), right, "id")


@query("f03_dedup_content", "SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY text")
def f03(spark, sf):
    kept = U.dedup_content(table(spark, sf, "documents"), "text", "doc_id")
    return kept.select("doc_id", F.sha2("text", 256).alias("digest"))


@query("f04_insert_if_not_found", """
  SELECT p_brand, p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS i FROM part)
  WHERE i = 1 AND (p_brand, p_name) NOT IN (SELECT (p_brand, p_name) FROM part WHERE p_size > 45)""")
def f04(spark, sf):
    p = table(spark, sf, "part").select("p_brand", "p_name", "p_partkey", "p_size")
    return U.insert_if_not_found(p.drop("p_size"), p.where("p_size > 45").select("p_brand", "p_name"),
                                 ["p_brand", "p_name"], ["p_partkey"])


@query("f05_add_edge_if_not_found", """
  SELECT DISTINCT 'Customer:' || o_custkey AS _src, 'Priority:' || o_orderpriority AS _dst,
    sha1('Customer:' || o_custkey || 'Priority:' || o_orderpriority) AS wf_sha1_hash FROM orders
  WHERE (o_custkey, o_orderpriority) NOT IN (SELECT (o_custkey, o_orderpriority) FROM orders WHERE o_orderstatus = 'P')""")
def f05(spark, sf):
    src, dst = F.concat(F.lit("Customer:"), "o_custkey"), F.concat(F.lit("Priority:"), "o_orderpriority")
    o = table(spark, sf, "orders")
    edges = o.select(src.alias("_src"), dst.alias("_dst"), U.edge_key(src, dst).alias("wf_sha1_hash"), "o_orderstatus")
    return U.add_edge_if_not_found(edges.drop("o_orderstatus"), edges.where("o_orderstatus = 'P'"))


@query("f06_update_properties", """
  SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment,
    CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS c_nationkey, CASE WHEN c_acctbal < 0 THEN true END AS flagged FROM customer""")
def f06(spark, sf):
    return U.update_properties(table(spark, sf, "customer"), {"c_acctbal": ["<", 0]},
                               {"c_mktsegment": "DEBT", "flagged": True}, ["c_nationkey"]).select(
        "c_custkey", "c_mktsegment", "c_nationkey", "flagged")


@query("f07_clean_by_predicate", """
  SELECT event_id, event_type FROM events WHERE NOT (event_type = 'error' AND value >= 10)""")
def f07(spark, sf):
    return U.clean_by_predicate(table(spark, sf, "events"), {"event_type": ["==", "error"], "value": [">=", 10]}).select(
        "event_id", "event_type")


@query("f06_update_in_place", """
  SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment,
    CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer
  WHERE NOT (c_acctbal > 9000 AND c_mktsegment = 'MACHINERY')""")
def f06_in_place(spark, sf):
    """An update and a delete of a stored table, each rewriting the parts it hits."""
    stored = PartTable.write(table(spark, sf, "customer"), shared_dir(spark, "customer"), "c_custkey", parts=32)
    stored.update({"c_acctbal": ["<", 0], "c_mktsegment": ["==", "BUILDING"]}, {"c_mktsegment": "DEBT"}, ["c_nationkey"])
    stored.delete({"c_acctbal": [">", 9000], "c_mktsegment": ["==", "MACHINERY"]})
    return stored.rows().select("c_custkey", "c_mktsegment", "c_nationkey")
