"""One query per operator and the pipeline, with the SQL that states the result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.llm.decontaminate import contamination
from plexus.llm.embeddings import embedding_dedup
from plexus.llm.exact_dedup import exact_dedup
from plexus.llm.hard_negatives import hard_negatives
from plexus.llm.html_extract import extract_text
from plexus.llm.license_scan import license_scan
from plexus.llm.mixing import taken_words
from plexus.llm.periodic_runs import periodic_runs, with_repeats
from plexus.llm.sentencepiece import encode, load_vocabulary
from plexus.llm.simhash import simhash_dedup
from plexus.llm.substring_dedup import substring_dedup
from plexus.llm.suffix_dedup import suffix_dedup
from plexus.llm.toxicity import fitted, is_held_out, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op2_exact_dedup", """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)""")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(table(spark, sf, "documents"), keep="max").withColumnRenamed("digest", "text_sha256")


@query("op3_simhash_dedup")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_dedup(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op10_mix_sources", r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
                 row_number() OVER (ORDER BY source NULLS LAST) AS no, 2 * source_size AS cap FROM s),
    l AS (SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE
                     - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
    t AS (SELECT *, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM l),
    q AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t),
    p AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.quota,
                 coalesce(sum(d.size) OVER (PARTITION BY q.no ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
          FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, size, source_size, target,
           (greatest(0, least(size, quota - start)) + greatest(0, least(size, quota - source_size - start)))::BIGINT AS taken
    FROM p""")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return taken_words(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_toxicity")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = toxicity(docs, fitted(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    encoded = encode(table(spark, sf, "documents").select("doc_id", "text"), load_vocabulary(), proof="round_trip")
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), "round_trip")


def _removed():
    spans = F.zip_with("starts", "ends", lambda a, b: b - a)
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_removed")


@query("op5_suffix_dedup")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", _removed(), F.size("starts").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_substring_dedup", r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 12)) AS i, w FROM d WHERE len(w) >= 13),
    g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM p),
    r AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS hit FROM g),
    c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM r WHERE hit),
    x AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM d WHERE len(w) > 0),
    k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM x ANTI JOIN c USING (doc_id, i) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_removed FROM c GROUP BY doc_id)
    SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)""")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup(table(spark, sf, "documents")).select("doc_id", "n_words", _removed(), F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_embedding_dedup")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup(table(spark, sf, "embeddings"))


@query("op8_html_extract")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op9_license_scan")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan(table(spark, sf, "documents"))


@query("op11_decontaminate", r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    n AS (SELECT item_id, least(10, len(w)) AS n, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0),
    g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM n),
    p AS (SELECT doc_id, w, s.n, unnest(generate_series(1, len(w) - s.n + 1)) AS i FROM d JOIN (SELECT DISTINCT n FROM g) s ON len(w) >= s.n),
    h AS (SELECT p.doc_id, p.n, p.i, g.item_id FROM p JOIN g ON p.n = g.n AND array_to_string(p.w[p.i:p.i + p.n - 1], ' ') = g.g),
    c AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS i FROM (SELECT DISTINCT doc_id, n, i FROM h)) GROUP BY doc_id),
    t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY doc_id)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    n_hit = _removed()
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"))


@query("op12_hard_negatives", """
    WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
               FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.x, r.x)::BIGINT AS score
          FROM e a JOIN e r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf, "embeddings").withColumn("label", moved))


@query("op13_periodic_runs", r"""
    WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                      xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda b: [ascii(b)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                                      lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) AS h FROM documents),
    g AS (SELECT doc_id, w, h, h // 10 AS g, len(w) AS n FROM c),
    a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    d AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END) ELSE w END AS w FROM p),
    x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM d WHERE n > 0),
    m AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM x u JOIN x v ON u.doc_id = v.doc_id AND u.word = v.word AND v.i > u.i AND 3 * (v.i - u.i) <= u.n WHERE u.n >= 24),
    k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
    s AS (SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM k GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
    r AS (SELECT doc_id, start, length, min(q) AS period FROM s GROUP BY doc_id, start, length),
    b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
    t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
    o AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    l AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM x ANTI JOIN o USING (doc_id, i) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
           (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN b USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN l USING (doc_id)""")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, sf, "documents")).select("doc_id", "text"))
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda b, r: F.when(b["start"].isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start"), F.col("best.length"), F.col("best.period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
