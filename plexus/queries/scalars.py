"""String, hash, date, geometry and quality functions (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.functions import scalars as G
from plexus.functions import text as X
from plexus.queries.registry import query, table
from plexus.queries.views import RESPONSES_SQL, responses
from plexus.session import spread


@query("g01_content_type_parts", f"""
  SELECT page_id, trim(split_part(content_type, ';', 1)) AS main_type,
    CASE WHEN content_type LIKE '%harset%' THEN lower(trim(split_part(split_part(split_part(content_type, ';', 2), '=', 2), '"',
      CASE WHEN content_type LIKE '%"%' THEN 2 ELSE 1 END))) END AS charset,
    CASE WHEN content_type LIKE '%boundary%' THEN 'x' END AS boundary FROM {RESPONSES_SQL}""")
def g01(spark, sf):
    p = G.content_type_params("content_type")
    return responses(spark, sf).select(
        "page_id", G.content_type_main("content_type").alias("main_type"),
        F.lower(F.try_element_at(p, F.lit("charset"))).alias("charset"), F.try_element_at(p, F.lit("boundary")).alias("boundary"))


@query("g02_mime_from_path", """
  SELECT doc_id, CASE source WHEN 'src0' THEN 'image/png' WHEN 'src1' THEN 'image/jpeg' WHEN 'src2' THEN 'application/pdf'
    WHEN 'src3' THEN 'video/mp4' END AS mime FROM documents""")
def g02(spark, sf):
    ext = (F.when(F.col("source") == "src0", ".PNG").when(F.col("source") == "src1", ".v2.jpg").when(F.col("source") == "src2", ".pdf")
           .when(F.col("source") == "src3", ".mp4").when(F.col("source") == "src4", ".unknown").otherwise(""))
    return table(spark, sf, "documents").select(
        "doc_id", G.mime_from_path(F.concat(F.lit("a.b/dir.d/doc"), "doc_id", ext)).alias("mime"))


@query("g03_mime_from_bytes", """
  SELECT doc_id, CASE source WHEN 'src0' THEN 'image/png' WHEN 'src1' THEN 'image/jpeg' WHEN 'src2' THEN 'application/pdf'
    WHEN 'src3' THEN 'video/mp4' WHEN 'src4' THEN 'image/gif' ELSE 'application/octet-stream' END AS mime FROM documents""")
def g03(spark, sf):
    head = (F.when(F.col("source") == "src0", "89504E470D0A1A0A").when(F.col("source") == "src1", "FFD8FFE0")
            .when(F.col("source") == "src2", "255044462D312E37").when(F.col("source") == "src3", "000000206674797069736F6D")
            .when(F.col("source") == "src4", "474946383961").otherwise("00"))
    return table(spark, sf, "documents").select(
        "doc_id", G.mime_from_bytes(F.concat(F.unhex(head), F.encode("text", "UTF-8"))).alias("mime"))


@query("g04_url_domain", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || ':8080' AS domain FROM pages")
def g04(spark, sf):
    with_port = F.regexp_replace("url", r"^([a-z]+://[^/?#]*)", "$1:8080")
    return table(spark, sf, "pages").select("page_id", G.url_domain(with_port).alias("domain"))


@query("g05_max_age", f"""
  SELECT page_id, nullif(try_cast(nullif(regexp_extract(cache_control, 'max-age=([0-9]+)', 1), '') AS BIGINT), 0) AS max_age FROM {RESPONSES_SQL}""")
def g05(spark, sf):
    return responses(spark, sf).select("page_id", G.max_age("cache_control").alias("max_age"))


@query("g06_http_date", f"""
  SELECT page_id, CASE WHEN last_modified <> 'not a date' THEN strftime(strptime(last_modified[6:-5], '%d %b %Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') END AS modified
  FROM {RESPONSES_SQL}""")
def g06(spark, sf):
    return responses(spark, sf).select(
        "page_id", F.date_format(G.http_date("last_modified"), "yyyy-MM-dd HH:mm:ss").alias("modified"))


_DATES_SQL = """(SELECT page_id, TIMESTAMP '2024-03-05 10:01:02' + to_hours(page_id) AS t FROM pages)"""


@query("g06_http_date_forms", f"""
  SELECT page_id, CASE WHEN page_id % 5 = 4 THEN NULL WHEN page_id % 5 = 3 THEN strftime(date_trunc('minute', t), '%Y-%m-%d %H:%M:%S')
    ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS modified FROM {_DATES_SQL}""")
def g06_forms(spark, sf):
    """All legal forms of a date header, one without seconds, and none."""
    t = F.timestamp_seconds(F.lit(1709632862) + F.col("page_id") * 3600)
    turn = F.col("page_id") % 5
    form = (F.when(turn == 0, F.date_format(t, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(turn == 1, F.date_format(t, "EEEE, dd-MMM-yy HH:mm:ss 'GMT'"))
            .when(turn == 2, F.concat(F.date_format(t, "EEE MMM "), F.lpad(F.date_format(t, "d"), 2, " "), F.date_format(t, " HH:mm:ss yyyy")))
            .when(turn == 3, F.date_format(t, "EEE, d MMM yyyy HH:mm 'GMT'")).otherwise(F.lit("5 of March")))
    return table(spark, sf, "pages").select("page_id", F.date_format(G.http_date(form), "yyyy-MM-dd HH:mm:ss").alias("modified"))


@query("g07_resource_key", "SELECT o_orderkey, sha1('postgres://db/shop/orders/' || o_orderkey) AS resource_key FROM orders")
def g07(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", G.resource_key("postgres://db/shop", "orders", F.col("o_orderkey")).alias("resource_key"))


@query("g08_creator_key", """
  SELECT source, sha1('sql://db/shop/' || source) AS sql_key, sha1('s3:/' || source) AS bucket_key, count(*) AS n_rows FROM documents GROUP BY source""")
def g08(spark, sf):
    return table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "source", G.sql_creator_key("db", "shop", F.col("source")).alias("sql_key"),
        G.bucket_creator_key("s3:", F.col("source")).alias("bucket_key"), "n_rows")


@query("g09_glob_match", """
  SELECT doc_id, (source || '.' || lang) GLOB 'src1*.en' AS a, (source || '.' || lang) GLOB 'src?.[ef]*' AS b,
    (source || '.' || lang) GLOB '*.[!e]?' AS c FROM documents""")
def g09(spark, sf):
    name = F.concat(F.col("source"), F.lit("."), F.col("lang"))
    return table(spark, sf, "documents").select(
        "doc_id", G.glob_match(name, "src1*.en").alias("a"), G.glob_match(name, "src?.[ef]*").alias("b"),
        G.glob_match(name, "*.[!e]?").alias("c"))


@query("g10_capitalize", """
  SELECT p_partkey, upper(left(n, 1)) || lower(substr(n, 2)) AS name FROM (SELECT p_partkey, p_type || ' ' || p_name AS n FROM part)""")
def g10(spark, sf):
    return table(spark, sf, "part").select("p_partkey", G.capitalize(F.concat_ws(" ", "p_type", "p_name")).alias("name"))


@query("g11_iso_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso FROM orders")
def g11(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", G.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("iso"))


@query("g12_url_tail_id", "SELECT page_id, split_part(split_part(url, '/', -1), '_', 1) AS tail FROM pages")
def g12(spark, sf):
    return table(spark, sf, "pages").select("page_id", G.url_tail_id("url").alias("tail"))


@query("g13_box_clamp", """
  SELECT c_custkey, CASE WHEN trunc(c_acctbal / 100) > 0 THEN trunc(c_acctbal / 100)::INT ELSE 1 END AS clamped,
    greatest(trunc(c_acctbal / 100)::INT, 0) AS floored FROM customer""")
def g13(spark, sf):
    v = F.col("c_acctbal") / 100
    return table(spark, sf, "customer").select("c_custkey", G.box_clamp(v).alias("clamped"), G.box_floor(v).alias("floored"))


@query("g14_box_rescale", """
  SELECT l_orderkey, l_linenumber, trunc(l_quantity / 0.5)::INT AS x, trunc(l_tax / 0.5)::INT AS y,
    trunc((l_extendedprice - l_quantity) / 0.5)::INT AS width, trunc((l_extendedprice - l_tax) / 0.5)::INT AS height FROM lineitem""")
def g14(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", G.box_rescale("l_quantity", "l_tax", "l_extendedprice", "l_extendedprice").alias("r")).select(
        "l_orderkey", "l_linenumber", "r.*")


@query("g15_aspect_and_area", """
  SELECT l_orderkey, l_linenumber, round(p_size / (l_linenumber * 1.0::DOUBLE), 6) AS aspect,
    round(l_quantity / (p_size::DOUBLE * l_linenumber), 6) AS area_share FROM lineitem JOIN part ON p_partkey = l_partkey""")
def g15(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return joined.select("l_orderkey", "l_linenumber", F.round(G.aspect_ratio("p_size", "l_linenumber"), 6).alias("aspect"),
                         F.round(G.area_share("l_quantity", "p_size", "l_linenumber"), 6).alias("area_share"))


@query("g16_polygon_pairs", """
  WITH p AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
  r AS (SELECT vec_id, unnest([e[1:2 * label], e[1:8]]) AS ring FROM p)
  SELECT vec_id, count(*) FILTER (len(ring) >= 6) AS n_rings,
    coalesce(sum(len(ring) // 2) FILTER (len(ring) >= 6), 0)::BIGINT AS n_points,
    round(sum(CASE WHEN len(ring) >= 6 THEN 2 * ring[2] + 1.5 ELSE 0 END), 5) AS y_of_first FROM r GROUP BY vec_id""")
def g16(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    pairs = lambda ring: G.polygon_pairs(ring, dx=0.5, dy=1.5, scale=2.0)
    rings = G.polygon_rings(F.array(pairs(F.slice("e", F.lit(1), F.col("label") * 2)), pairs(F.slice("e", 1, 8))))
    zero = F.lit(0).cast("bigint")
    return e.select("vec_id", rings.alias("r")).select(
        "vec_id", F.size("r").cast("bigint").alias("n_rings"),
        F.aggregate("r", zero, lambda a, x: a + F.size(x)).alias("n_points"),
        F.round(F.aggregate("r", F.lit(0.0), lambda a, x: a + F.get(F.get(x, F.lit(0)), F.lit(1))), 5).alias("y_of_first"))


@query("g17_feature_id", "SELECT l_orderkey, l_linenumber, (l_orderkey << 6) + l_linenumber AS feature_id FROM lineitem")
def g17(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", G.feature_id("l_orderkey", "l_linenumber").alias("feature_id"))


@query("g18_decode_json_or_text", """
  SELECT event_id, event_type <> 'error' AS is_json, CASE WHEN event_type = 'error' THEN 'x' || props || chr(65533) ELSE props END AS text FROM events""")
def g18(spark, sf):
    bad = F.concat(F.encode(F.concat(F.lit("x"), "props"), "UTF-8"), F.unhex(F.lit("FF")))
    raw = F.when(F.col("event_type") == "error", bad).otherwise(F.encode("props", "UTF-8"))
    return table(spark, sf, "events").select("event_id", G.decode_json_or_text(raw).alias("d")).select("event_id", "d.*")


# consecutive turns of a conversation as (reference, hypothesis) pairs
_PAIRS_SQL = """(SELECT b.conv_id, b.turn, a.text AS reference, b.text AS hypothesis FROM conversations a JOIN conversations b
  ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def pairs(spark, sf):
    c = spread(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "conv_id")
    before = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    return c.select("conv_id", "turn", F.col("text").alias("hypothesis")).join(before, ["conv_id", "turn"])


def _bleu_sql(tokens: str, separator: str) -> str:
    return f"""WITH p AS (SELECT conv_id, turn, {tokens.format('hypothesis')} AS c, {tokens.format('reference')} AS r FROM {_PAIRS_SQL}),
    q AS (SELECT *, unnest(range(1, 5)) AS n FROM p),
    g AS (SELECT conv_id, turn, n, side, gram, count(*) AS k FROM (
        SELECT conv_id, turn, n, 'c' AS side, array_to_string(c[i:i + n - 1], '{separator}') AS gram FROM (SELECT *, unnest(range(1, len(c) - n + 2)) AS i FROM q)
        UNION ALL SELECT conv_id, turn, n, 'r', array_to_string(r[i:i + n - 1], '{separator}') FROM (SELECT *, unnest(range(1, len(r) - n + 2)) AS i FROM q))
      GROUP BY ALL),
    m AS (SELECT a.conv_id, a.turn, a.n, sum(least(a.k, b.k))::DOUBLE AS hits FROM g a JOIN g b USING (conv_id, turn, n, gram)
      WHERE a.side = 'c' AND b.side = 'r' GROUP BY ALL),
    s AS (SELECT q.conv_id, q.turn, q.n, coalesce(hits, 0) AS hits, greatest(1, len(c) - q.n + 1) AS total, len(c)::DOUBLE AS lc, len(r)::DOUBLE AS lr,
      count(*) FILTER (coalesce(hits, 0) = 0) OVER (PARTITION BY q.conv_id, q.turn ORDER BY q.n) AS z FROM q LEFT JOIN m USING (conv_id, turn, n)),
    t AS (SELECT conv_id, turn, lc, lr, max(hits) FILTER (n = 1) AS h1,
      sum(CASE WHEN hits > 0 THEN ln(hits / total) WHEN lc > 1 THEN ln(ln(lc) / (2 ** z * 5) / total) ELSE 0 END) / 4 AS l FROM s GROUP BY conv_id, turn, lc, lr)
    SELECT conv_id, turn, round(CASE WHEN lc = 0 OR lr = 0 OR h1 = 0 THEN 0.0 ELSE exp(l) * CASE WHEN lc < lr THEN exp(1 - lr / lc) ELSE 1 END END, 8) AS score FROM t"""


_WORDS = "list_filter(regexp_split_to_array(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}\\s]', '', 'g'), '\\s+'), lambda x: x <> '')"
_CHARS = "list_filter(string_split(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]', '', 'g'), ''), lambda x: x <> '')"


@query("g21_word_bleu", _bleu_sql(_WORDS, " "))
def g21(spark, sf):
    return pairs(spark, sf).select("conv_id", "turn", F.round(X.word_bleu("hypothesis", "reference"), 8).alias("score"))


@query("g22_char_bleu", _bleu_sql(_CHARS, ""))
def g22(spark, sf):
    return pairs(spark, sf).select("conv_id", "turn", F.round(X.char_bleu("hypothesis", "reference"), 8).alias("score"))


# the SQL side counts bytes, so both sides see letters beyond ASCII as "?"
_ASCII = "regexp_replace({0}, '[^ -~\\n]', '?', 'g')"


@query("g23_levenshtein", f"""
  SELECT conv_id, turn, levenshtein({_ASCII.format('hypothesis')}, {_ASCII.format('reference')}) AS distance FROM {_PAIRS_SQL}""")
def g23(spark, sf):
    plain = lambda c: F.regexp_replace(c, "[^ -~\\n]", "?")
    return pairs(spark, sf).select("conv_id", "turn", F.levenshtein(plain("hypothesis"), plain("reference")).cast("bigint").alias("distance"))


@query("g24_jaccard_chars", f"""
  SELECT conv_id, turn, round(1 - len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))), 8) AS distance
  FROM (SELECT conv_id, turn, list_distinct(string_split(reference, '')) AS a, list_distinct(string_split(hypothesis, '')) AS b FROM {_PAIRS_SQL})""")
def g24(spark, sf):
    return pairs(spark, sf).select("conv_id", "turn", F.round(G.jaccard_chars("hypothesis", "reference"), 8).alias("distance"))


@query("g25_anchor_url", """
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '#a' || page_id WHEN page_id % 3 = 1 THEN url || '#page=' || (page_id + 1) ELSE url END AS block_url FROM pages""")
def g25(spark, sf):
    k = F.col("page_id")
    return table(spark, sf, "pages").select("page_id", G.anchor_url(
        "url", F.when(k % 3 == 0, F.concat(F.lit("a"), k)).when(k % 3 == 1, ""), F.when(k % 3 != 2, k + 1)).alias("block_url"))
