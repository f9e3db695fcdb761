"""Counts and summaries (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.operators import stats as D
from plexus.operators.constraints import constrain
from plexus.queries.registry import query, table
from plexus.queries.views import DOMAIN_SQL, RESPONSES_SQL, edge, node, responses


@query("d01_count_by_class", """
  SELECT 'Customer' AS class, count(*) AS n_rows FROM customer UNION ALL SELECT 'Orders', count(*) FROM orders WHERE o_totalprice > 100000
  UNION ALL SELECT 'Part', count(*) FROM part UNION ALL SELECT 'Vector', count(*) FROM embeddings""")
def d01(spark, sf):
    return D.count_by_class({
        "Customer": node(spark, sf, "Customer"), "Orders": constrain(node(spark, sf, "Orders"), {"totalprice": [">", 100000]}),
        "Part": node(spark, sf, "Part"), "Vector": node(spark, sf, "Vector")})


@query("d02_count_connected", """
  SELECT count(DISTINCT o_custkey) AS n_connected FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000""")
def d02(spark, sf):
    return D.count_connected(node(spark, sf, "Orders").where("status = 'F' and totalprice > 200000"),
                             edge(spark, sf, "Placed"), "in", "Placed")


@query("d03_reconcile_counts", """
  SELECT source, lang, expected, found, expected - found AS missing FROM (
    SELECT source, lang, count(*) AS expected, count(l.doc_id) AS found FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source, lang)""")
def d03(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    found = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    return D.reconcile_counts(docs, found, ["source", "lang"])


@query("d04_crawl_stats", f"""
  WITH r AS (SELECT status::VARCHAR AS status, {DOMAIN_SQL} AS domain, trim(split_part(content_type, ';', 1)) AS ct FROM {RESPONSES_SQL})
  SELECT 'status' AS measure, status AS value, count(*) AS n_responses FROM r GROUP BY status
  UNION ALL SELECT 'domain', domain, count(*) FROM r GROUP BY domain
  UNION ALL SELECT 'content_type', ct, count(*) FROM r GROUP BY ct UNION ALL SELECT 'total', NULL, count(*) FROM r""")
def d04(spark, sf):
    return D.crawl_stats(responses(spark, sf))


_KIND = """CASE event_type WHEN 'view' THEN 'segment' WHEN 'click' THEN 'image' WHEN 'purchase' THEN 'full_text'
  WHEN 'signup' THEN 'embedding' ELSE event_type END"""


@query("d05_run_summary", f"""
  SELECT user_id AS run_id, count(*) FILTER (k = 'segment') AS n_segment, count(*) FILTER (k = 'image') AS n_image,
    count(*) FILTER (k = 'full_text') AS n_full_text, count(*) FILTER (k = 'embedding') AS n_embedding,
    strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_time,
    epoch(date_trunc('second', max(ts)))::BIGINT - epoch(date_trunc('second', min(ts)))::BIGINT AS duration_seconds
  FROM (SELECT *, {_KIND} AS k FROM events) GROUP BY user_id""")
def d05(spark, sf):
    objects = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.expr(_KIND).alias("kind"), F.col("ts").alias("time"))
    out = D.run_summary(objects)
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return out.select("run_id", "n_segment", "n_image", "n_full_text", "n_embedding", stamp("start_time"),
                      stamp("end_time"), "duration_seconds")


@query("d06_workflow_report", """
  WITH runs AS (SELECT user_id AS run_id, user_id % 7 AS spec_id, strftime(min(ts), '%Y-%m-%d') AS run_start, strftime(max(ts), '%Y-%m-%d') AS run_end
    FROM events GROUP BY user_id)
  SELECT 'workflow_' || spec_id AS workflow_name, spec_id, run_id, object_type, coalesce(n, 0) AS n_objects, run_start, run_end
  FROM runs LEFT JOIN (SELECT user_id AS run_id, event_type AS object_type, count(*) AS n FROM events GROUP BY ALL) USING (run_id)""")
def d06(spark, sf):
    e = table(spark, sf, "events")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    runs = e.groupBy(F.col("user_id").alias("run_id")).agg(day(F.min("ts")).alias("run_start"), day(F.max("ts")).alias("run_end")).withColumn(
        "spec_id", F.col("run_id") % 7)
    specs = runs.select("spec_id").distinct().withColumn("workflow_name", F.concat(F.lit("workflow_"), "spec_id"))
    objects = e.select(F.col("user_id").alias("run_id"), F.col("event_type").alias("object_type"))
    return D.workflow_report(specs, runs, objects)


@query("d07_score_summary", """
  WITH s AS (SELECT l_returnflag AS corpus, l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem),
  u AS (UNPIVOT s ON l_quantity, l_discount, l_tax, l_extendedprice INTO NAME metric VALUE score)
  SELECT corpus, metric, round(avg(score), 4) AS mean, round(stddev_samp(score), 4) AS std, min(score) AS min, max(score) AS max
  FROM u GROUP BY corpus, metric""")
def d07(spark, sf):
    metrics = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    scores = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("corpus"), *metrics)
    return D.score_summary(scores, metrics).withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


@query("d08_score_gate", """
  SELECT 'l_quantity' AS metric, 'A' AS corpus, round(avg(l_quantity), 6) AS mean, 20.0 AS threshold, avg(l_quantity) > 20 AS passed
  FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL SELECT 'price_distance', 'N', round(avg(l_extendedprice), 4), 100.0, avg(l_extendedprice) < 100 FROM lineitem WHERE l_returnflag = 'N'
  UNION ALL SELECT 'l_tax', 'R', round(avg(l_tax), 6), 0.5, avg(l_tax) > 0.5 FROM lineitem WHERE l_returnflag = 'R'""".replace(
      "20.0 AS", "20.0::DOUBLE AS").replace("avg(l_extendedprice), 4)", "avg(l_extendedprice), 6)"))
def d08(spark, sf):
    scores = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("corpus"), "l_quantity", "l_tax",
                                                 F.col("l_extendedprice").alias("price_distance"))
    gates = [("l_quantity", "A", 20.0), ("price_distance", "N", 100.0), ("l_tax", "R", 0.5)]
    return D.score_gate(scores, gates).withColumn("mean", F.round("mean", 6))


@query("d09_distinct_classes", "SELECT DISTINCT upper(event_type) AS \"EntityClass\" FROM events")
def d09(spark, sf):
    return D.distinct_classes(table(spark, sf, "events").select(F.upper("event_type").alias("EntityClass")))


@query("d10_kinds", "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def d10(spark, sf):
    return D.kinds(table(spark, sf, "events"), "user_id", "event_type")


def sets_and_registry(spark, sf):
    """Vector sets by label; sets 0 to 6 name their model completely, set 6 is registered but partial."""
    vectors = table(spark, sf, "embeddings").withColumn("set", F.concat(F.lit("set_"), "label"))
    registry = vectors.select("label").distinct().select(
        F.concat(F.lit("set_"), "label").alias("name"), F.lit("builtin").alias("provider"), F.lit("hash").alias("model"),
        F.when(F.col("label") < 6, "v1").alias("pretrained"), F.lit("CS").alias("metric"))
    return vectors, registry


@query("d11_vector_sets", """
  SELECT 'set_' || label AS name, 'builtin' AS provider, 'hash' AS model, 'v1' AS pretrained, 'CS' AS metric, count(*) AS n_vectors
  FROM embeddings WHERE label < 6 GROUP BY label""")
def d11(spark, sf):
    return D.vector_sets(*sets_and_registry(spark, sf))


@query("d12_vector_set_count", """
  SELECT 'set_' || label AS name, count(*) AS n_vectors FROM embeddings GROUP BY label
  UNION ALL SELECT DISTINCT 'none_' || label, 0 FROM embeddings""")
def d12(spark, sf):
    vectors, registry = sets_and_registry(spark, sf)
    names = registry.select("name").unionByName(registry.select(F.regexp_replace("name", "^set", "none").alias("name")))
    return D.vector_set_count(vectors, names)


@query("d13_feature_index", """
  SELECT p_name, count(*) AS n_rows, row_number() OVER (ORDER BY p_name) - 1 AS feature_index FROM part GROUP BY p_name""")
def d13(spark, sf):
    return D.feature_index(table(spark, sf, "part"), "p_name")


@query("d14_concat_text", """
  SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS full_text FROM conversations GROUP BY conv_id""")
def d14(spark, sf):
    return D.concat_text(table(spark, sf, "conversations"), "conv_id", "turn", "text")
