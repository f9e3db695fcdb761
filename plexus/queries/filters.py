"""Projection, constraints and row filters (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.functions.scalars import typed_value
from plexus.operators import constraints as B
from plexus.queries.registry import query, table
from plexus.queries.views import DOMAIN_SQL, RESPONSES_SQL, node, responses

# the order lines as rows with a boolean, a number and a string, each sometimes NULL
_ROWS_SQL = """(SELECT l_orderkey || '-' || l_linenumber AS _uniqueid,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag = 'A' END AS b,
  CASE WHEN l_quantity > 40 THEN NULL ELSE (l_linenumber % 4)::DOUBLE END AS n,
  CASE WHEN l_tax > 0.06 THEN NULL WHEN l_tax = 0 THEN '' ELSE l_linestatus END AS s FROM lineitem)"""


def _rows(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_uniqueid"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag") == "A").alias("b"),
        F.when(F.col("l_quantity") <= 40, (F.col("l_linenumber") % 4).cast("double")).alias("n"),
        F.when(F.col("l_tax") > 0.06, None).when(F.col("l_tax") == 0, "").otherwise(F.col("l_linestatus")).alias("s"))


def _counts(rows, cases):
    """One pass: how many rows each condition keeps, the NULL-safe way a filter counts."""
    return rows.agg(*[F.count_if(c).alias(n) for n, c in cases.items()])


def _counts_sql(cases):
    return "SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in cases.items()) + f" FROM {_ROWS_SQL}"


@query("b01_project", "SELECT c_custkey AS custkey, c_mktsegment AS mktsegment FROM customer")
def b01(spark, sf):
    return B.project(node(spark, sf, "Customer"), ["custkey", "mktsegment"])


@query("b02_constraints", """
  SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 250000
    AND o_orderstatus IN ('O', 'F') AND o_orderpriority NOT IN ('5-LOW') AND o_orderdate > TIMESTAMP '1995-06-01'""")
def b02(spark, sf):
    return B.constrain(table(spark, sf, "orders"), {
        "o_totalprice": [">=", 100000, "<", 250000], "o_orderstatus": ["in", ["O", "F"]],
        "o_orderpriority": ["not in", ["5-LOW"]], "o_orderdate": [">", {"_date": "1995-06-01T00:00:00"}],
    }).select("o_orderkey", "o_totalprice", "o_orderpriority")


_B03 = {"eq": "n = 1", "eq_list": "n IN (0, 1)", "ne": "n <> 1", "is_null": "n IS NULL", "is_not_null": "n IS NOT NULL",
        "eq_null": "n = NULL", "s_eq": "s = 'F'", "s_ne": "s <> 'F'", "s_empty": "s = ''"}


@query("b03_equality", _counts_sql(_B03))
def b03(spark, sf):
    rows = _rows(spark, sf)
    n, s = F.col("n"), F.col("s")
    c = lambda spec: B.condition(rows, spec)
    return _counts(rows, {
        "eq": c({"n": ["==", 1]}), "eq_list": c({"n": ["in", [0, 1]]}), "ne": c({"n": ["!=", 1]}),
        "is_null": c({"n": ["==", None]}), "is_not_null": c({"n": ["!=", None]}), "eq_null": n == F.lit(None),
        "s_eq": c({"s": ["==", "F"]}), "s_ne": s != "F", "s_empty": c({"s": ["==", ""]})})


_B04 = {"in_plain": "s IN ('F', '')", "in_null": "s IN ('F', NULL)", "not_in": "s NOT IN ('F')",
        "not_in_null": "s NOT IN ('F', NULL)", "n_not_in": "n NOT IN (0, 1)", "b_in_both": "b IN (TRUE, FALSE)",
        "b_not_in_both": "b NOT IN (TRUE, FALSE)"}


@query("b04_in_with_null", _counts_sql(_B04))
def b04(spark, sf):
    rows = _rows(spark, sf)
    c = lambda spec: B.condition(rows, spec)
    return _counts(rows, {
        "in_plain": c({"s": ["in", ["F", ""]]}), "in_null": c({"s": ["in", ["F", None]]}),
        "not_in": c({"s": ["not in", ["F"]]}), "not_in_null": c({"s": ["not in", ["F", None]]}),
        "n_not_in": c({"n": ["not in", [0, 1]]}), "b_in_both": c({"b": ["in", [True, False]]}),
        "b_not_in_both": c({"b": ["not in", [True, False]]})})


_B05 = {"is_true": "b IS TRUE", "is_not_true": "b IS NOT TRUE", "is_false": "b IS FALSE", "is_not_false": "b IS NOT FALSE",
        "lt_true": "b < TRUE", "le_true": "b <= TRUE", "gt_true": "b > TRUE", "ge_true": "b >= TRUE",
        "lt_false": "b < FALSE", "le_false": "b <= FALSE", "gt_false": "b > FALSE", "ge_false": "b >= FALSE", "not_b": "NOT b"}


@query("b05_boolean_order", _counts_sql(_B05))
def b05(spark, sf):
    rows, b = _rows(spark, sf), F.col("b")
    cases = {"is_true": b.eqNullSafe(True), "is_not_true": ~b.eqNullSafe(True), "is_false": b.eqNullSafe(False),
             "is_not_false": ~b.eqNullSafe(False), "not_b": ~b}
    for word, op in (("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")):
        for value in (True, False):
            cases[f"{word}_{str(value).lower()}"] = B.condition(rows, {"b": [op, value]})
    return _counts(rows, cases)


@query("b06_range", """
  SELECT o_orderkey FROM orders WHERE o_totalprice > 50000.5 AND o_totalprice <= 300000 AND o_orderpriority >= '2-HIGH'
    AND o_orderpriority < '5' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def b06(spark, sf):
    return B.constrain(table(spark, sf, "orders"), {
        "o_totalprice": [">", 50000.5, "<=", 300000], "o_orderpriority": [">=", "2-HIGH", "<", "5"],
        "o_orderdate": [">=", {"_date": "1996-01-01"}, "<", {"_date": "1999-01-01"}]}).select("o_orderkey")


@query("b07_uniqueid_rules", """
  SELECT count(*) FILTER (_uniqueid = 'Customer:7') AS eq, count(*) FILTER (_uniqueid <> 'Customer:7') AS ne,
    count(*) FILTER (_uniqueid IN ('Customer:7', 'Customer:11')) AS in_set,
    count(*) FILTER (_uniqueid NOT IN ('Customer:7', 'Customer:11')) AS not_in_set,
    count(*) FILTER (_uniqueid >= 'Customer:5') AS ge, count(*) FILTER (_uniqueid < 'Customer:5') AS lt,
    count(*) FILTER (_uniqueid LIKE 'Customer:1%') AS like_one, count(*) FILTER (_uniqueid IS NULL) AS is_null
  FROM (SELECT 'Customer:' || c_custkey AS _uniqueid FROM customer)""")
def b07(spark, sf):
    rows = node(spark, sf, "Customer")
    c = lambda *spec: B.condition(rows, {"_uniqueid": list(spec)})
    two = ["Customer:7", "Customer:11"]
    return _counts(rows, {"eq": c("==", two[0]), "ne": c("!=", two[0]), "in_set": c("in", two), "not_in_set": c("not in", two),
                          "ge": c(">=", "Customer:5"), "lt": c("<", "Customer:5"),
                          "like_one": F.col("_uniqueid").like("Customer:1%"), "is_null": c("==", None)})


@query("b08_pattern_match", """
  SELECT p_partkey, p_name LIKE '%red%' AS is_like, p_name ILIKE 'SMALL%' AS is_ilike,
    regexp_full_match(p_name, '(red|blue).*') AS is_similar, regexp_matches(p_name, 'g$') AS is_regex,
    regexp_full_match(p_brand, 'Brand#1.') AS is_similar_one
  FROM part WHERE p_name LIKE '%e%'""")
def b08(spark, sf):
    name = F.col("p_name")
    return B.pattern_match(table(spark, sf, "part"), "p_name", "like", "%e%").select(
        "p_partkey", name.like("%red%").alias("is_like"), name.ilike("SMALL%").alias("is_ilike"),
        B.similar_to("p_name", "(red|blue)%").alias("is_similar"), name.rlike("g$").alias("is_regex"),
        B.similar_to("p_brand", "Brand#1_").alias("is_similar_one"))


_B09 = {"b_or_n": "b = TRUE OR n > 1", "b_or_s": "b IS TRUE OR s = 'F'", "not_b_or_n": "b IS NOT TRUE OR n < 1",
        "null_or_not": "b IS NULL OR s IS NOT NULL", "mixed": "(b AND n > 1) OR (s = 'F' AND NOT b)"}


@query("b09_or_mixed", _counts_sql(_B09))
def b09(spark, sf):
    b, n, s = F.col("b"), F.col("n"), F.col("s")
    return _counts(_rows(spark, sf), {
        "b_or_n": b | (n > 1), "b_or_s": b.eqNullSafe(True) | (s == "F"), "not_b_or_n": ~b.eqNullSafe(True) | (n < 1),
        "null_or_not": b.isNull() | s.isNotNull(), "mixed": (b & (n > 1)) | ((s == "F") & ~b)})


@query("b10_typed_values", """
  SELECT event_id, try_cast(t AS DOUBLE) AS as_number, try_cast(e AS BOOLEAN) AS as_boolean,
    strftime(try_cast(d AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS as_datetime, CASE WHEN json_valid(j) THEN j END AS as_json
  FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE value::DECIMAL(18, 2)::VARCHAR END AS t,
    CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN 'false' ELSE event_type END AS e,
    CASE WHEN event_type = 'signup' THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS d,
    CASE WHEN event_type = 'view' THEN props || '}' ELSE props END AS j FROM events)""")
def b10(spark, sf):
    kind = F.col("event_type")
    raw = table(spark, sf, "events").select(
        "event_id", F.when(kind == "error", "n/a").otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("t"),
        F.when(kind == "click", "true").when(kind == "view", "false").otherwise(kind).alias("e"),
        F.when(kind == "signup", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("d"),
        F.when(kind == "view", F.concat("props", F.lit("}"))).otherwise(F.col("props")).alias("j"))
    return raw.select("event_id", typed_value("t", "number").alias("as_number"), typed_value("e", "boolean").alias("as_boolean"),
                      F.date_format(typed_value("d", "datetime"), "yyyy-MM-dd HH:mm:ss").alias("as_datetime"),
                      typed_value("j", "json").alias("as_json"))


@query("b12_with_blobs", """
  SELECT doc_id, true AS asked, strlen(text) AS n_bytes FROM documents
  UNION ALL SELECT doc_id, false, NULL FROM documents""")
def b12(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("blob"))
    size = F.octet_length("blob").cast("bigint").alias("n_bytes")
    return (B.with_blobs(d, "blob", True).select("doc_id", F.lit(True).alias("asked"), size)
            .unionByName(B.with_blobs(d, "blob", False).select("doc_id", F.lit(False).alias("asked"), size)))


@query("b13_with_label", """
  SELECT 'Document:' || doc_id AS _uniqueid, lang FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) ORDER BY 'Document:' || doc_id LIMIT 50""")
def b13(spark, sf):
    uid = F.concat(F.lit("Document:"), "doc_id")
    images = table(spark, sf, "documents").select(uid.alias("_uniqueid"), "lang")
    boxes = table(spark, sf, "labels").select(uid.alias("image"), F.when(F.col("toxic") == 1, "toxic").otherwise("fine").alias("label"))
    return B.with_label(boxes, "toxic", images, "image", limit=50)


@query("b14_confidence_filter", "SELECT event_id, value / 100 AS score FROM events WHERE value / 100 >= 0.7")
def b14(spark, sf):
    return B.confidence_filter(table(spark, sf, "events").select("event_id", (F.col("value") / 100).alias("score")))


@query("b15_content_type_allow", f"""
  SELECT page_id, content_type FROM {RESPONSES_SQL} WHERE trim(split_part(content_type, ';', 1)) IN ('text/plain', 'text/html', 'application/pdf')""")
def b15(spark, sf):
    return B.content_type_allow(responses(spark, sf)).select("page_id", "content_type")


@query("b16_allowed_domains", f"""
  SELECT page_id, {DOMAIN_SQL} AS domain FROM pages WHERE {DOMAIN_SQL} LIKE '%.example.org' OR {DOMAIN_SQL} = 'example.org'
     OR {DOMAIN_SQL} IN (SELECT {DOMAIN_SQL} FROM {RESPONSES_SQL} WHERE status = 404)
     OR EXISTS (SELECT 1 FROM {RESPONSES_SQL} r WHERE status = 404
                AND {DOMAIN_SQL.replace('url', 'pages.url')} LIKE '%.' || {DOMAIN_SQL.replace('url', 'r.url')})""")
def b16(spark, sf):
    start = responses(spark, sf).where("status = 404").select("url")
    kept = B.allowed_domains(table(spark, sf, "pages"), start, extra=["example.org"])
    return kept.select("page_id", F.expr("try_parse_url(url, 'AUTHORITY')").alias("domain"))


_HOST_SQL = "lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1))"


@query("b16_allowed_hosts", f"""
  SELECT page_id FROM pages WHERE {_HOST_SQL} LIKE '%.example.org' OR {_HOST_SQL} = 'example.org'""")
def b16_hosts(spark, sf):
    """Ports and capitals in urls and domains make no difference."""
    odd = F.when(F.col("page_id") % 3 == 1, F.regexp_replace("url", r"^([a-z]+://[^/:?#]*)", "$1:8080"))
    odd = odd.when(F.col("page_id") % 3 == 2, F.concat(F.regexp_extract("url", "^[a-z]+://", 0), F.upper(F.regexp_extract("url", "^[a-z]+://([^/:?#]*)", 1)),
                                                       F.regexp_replace("url", "^[a-z]+://[^/:?#]*", ""))).otherwise(F.col("url"))
    pages = table(spark, sf, "pages").select("page_id", odd.alias("url"))
    none = pages.where("page_id IS NULL").select("url")
    return B.allowed_domains(pages, none, extra=["Example.org"]).select("page_id")


@query("b17_drop_null_properties", """
  SELECT 'Event:' || event_id AS _uniqueid, '{' || '"event_type":"' || event_type || '"' ||
    CASE WHEN event_type <> 'error' THEN ',"user_id":' || user_id ELSE '' END ||
    CASE WHEN user_id > 20 THEN ',"note":"u' || user_id || '"' ELSE '' END || '}' AS properties FROM events""")
def b17(spark, sf):
    e = table(spark, sf, "events").select(
        F.concat(F.lit("Event:"), "event_id").alias("_uniqueid"), "event_type",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.when(F.col("user_id") > 20, F.concat(F.lit("u"), "user_id")).alias("note"))
    return B.drop_null_properties(e)
