"""The given tables seen as a property graph, a crawl, a set of media and so on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.queries.registry import table
from plexus.sources.classes import PropertyGraph, connection_table, entity_table

# class -> (table, key, property -> column)
NODE_CLASSES = {
    "Region": ("region", "r_regionkey", {"regionkey": "r_regionkey", "name": "r_name"}),
    "Nation": ("nation", "n_nationkey", {"nationkey": "n_nationkey", "name": "n_name"}),
    "Customer": ("customer", "c_custkey", {"custkey": "c_custkey", "name": "c_name",
                                           "acctbal": "c_acctbal", "mktsegment": "c_mktsegment"}),
    "Supplier": ("supplier", "s_suppkey", {"suppkey": "s_suppkey", "name": "s_name", "acctbal": "s_acctbal"}),
    "Part": ("part", "p_partkey", {"partkey": "p_partkey", "name": "p_name", "brand": "p_brand",
                                   "label": "p_type", "size": "p_size"}),
    "Orders": ("orders", "o_orderkey", {"orderkey": "o_orderkey", "status": "o_orderstatus",
                                        "totalprice": "o_totalprice", "orderdate": "o_orderdate",
                                        "priority": "o_orderpriority"}),
    "Lineitem": ("lineitem", ("l_orderkey", "l_linenumber"),
                 {"linenumber": "l_linenumber", "quantity": "l_quantity"}),
    "Vector": ("embeddings", "vec_id", {"vec_id": "vec_id", "label": "label"}),
}

# edge class -> (table, key, source, target, property -> column)
EDGE_CLASSES = {
    "InRegion": ("nation", "n_nationkey", ("Nation", "n_nationkey"), ("Region", "n_regionkey"), {}),
    "CustomerIn": ("customer", "c_custkey", ("Customer", "c_custkey"), ("Nation", "c_nationkey"), {}),
    "SupplierIn": ("supplier", "s_suppkey", ("Supplier", "s_suppkey"), ("Nation", "s_nationkey"), {}),
    "Placed": ("orders", "o_orderkey", ("Customer", "o_custkey"), ("Orders", "o_orderkey"),
               {"totalprice": "o_totalprice"}),
}


def node(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, key, props = NODE_CLASSES[name]
    return entity_table(table(spark, sf, source), name, key, props)


def edge(spark: SparkSession, sf: str, name: str) -> DataFrame:
    source, key, src, dst, props = EDGE_CLASSES[name]
    return connection_table(table(spark, sf, source), name, key, src, dst, props)


def graph(spark: SparkSession, sf: str, nodes: list[str], edges: list[str]) -> PropertyGraph:
    return PropertyGraph({n: node(spark, sf, n) for n in nodes}, {e: edge(spark, sf, e) for e in edges})


def all_edges(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    out = None
    for name in names:
        part = edge(spark, sf, name).select("_uniqueid", "_src", "_dst", "class", "src_class", "dst_class")
        out = part if out is None else out.unionByName(part)
    return out


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """The pages as crawl responses, with the headers a server might send."""
    p = table(spark, sf, "pages")
    k = F.col("page_id")
    status = F.when(k % 11 == 0, 404).when(k % 13 == 0, 403).when(k % 17 == 0, 500).otherwise(200)
    ctype = (F.when(k % 7 == 0, "text/plain; charset=UTF-8").when(k % 5 == 0, "application/json")
             .when(k % 9 == 0, 'text/html; Charset="utf-8"; boundary=x').otherwise("text/html"))
    cache = (F.when(k % 4 == 0, F.concat(F.lit("public, max-age="), (k % 3) * 600))
             .when(k % 4 == 1, F.lit("no-cache")).when(k % 4 == 2, F.concat(F.lit("max-age="), k)))
    modified = F.when(k % 6 != 0, F.concat(
        F.lit("Mon, "), F.lpad(((k % 28) + 1).cast("string"), 2, "0"), F.lit(" Mar 2024 10:"),
        F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":00 GMT"))).otherwise("not a date")
    return p.select(
        "page_id", "url", "html", status.alias("status"), ctype.alias("content_type"),
        cache.alias("cache_control"), modified.alias("last_modified"),
        F.when(k % 2 == 0, F.concat(F.lit("etag-"), k)).alias("etag"),
        F.when(k > 0, F.concat(F.lit("http://referrer.example/"), F.floor(k / 10).cast("bigint"))).alias("referrer"))


# the same responses for the SQL side
RESPONSES_SQL = """(
  SELECT page_id, url, html,
    CASE WHEN page_id % 11 = 0 THEN 404 WHEN page_id % 13 = 0 THEN 403 WHEN page_id % 17 = 0 THEN 500 ELSE 200 END AS status,
    CASE WHEN page_id % 7 = 0 THEN 'text/plain; charset=UTF-8' WHEN page_id % 5 = 0 THEN 'application/json'
         WHEN page_id % 9 = 0 THEN 'text/html; Charset="utf-8"; boundary=x' ELSE 'text/html' END AS content_type,
    CASE WHEN page_id % 4 = 0 THEN 'public, max-age=' || ((page_id % 3) * 600) WHEN page_id % 4 = 1 THEN 'no-cache'
         WHEN page_id % 4 = 2 THEN 'max-age=' || page_id END AS cache_control,
    CASE WHEN page_id % 6 <> 0 THEN 'Mon, ' || lpad(((page_id % 28) + 1)::VARCHAR, 2, '0') || ' Mar 2024 10:' ||
         lpad((page_id % 60)::VARCHAR, 2, '0') || ':00 GMT' ELSE 'not a date' END AS last_modified,
    CASE WHEN page_id % 2 = 0 THEN 'etag-' || page_id END AS etag,
    CASE WHEN page_id > 0 THEN 'http://referrer.example/' || (page_id // 10) END AS referrer
  FROM pages)"""

DOMAIN_SQL = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
