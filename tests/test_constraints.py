"""The constraint matrix: 3 x 4 x 5 rows with NULLs, every case counted in Spark and in DuckDB."""

import itertools

import pytest
from pyspark.sql import functions as F

from plexus.operators import constraints as B

ROWS = [(f"r{i}", b, n, s) for i, (b, n, s) in enumerate(itertools.product(
    (None, False, True), (None, 0.0, 1.0, 2.0), (None, "", "a", "b", "c")))]


@pytest.fixture(scope="module")
def rows(spark, duck):
    duck.execute("CREATE OR REPLACE TABLE t (_uniqueid VARCHAR, b BOOLEAN, n DOUBLE, s VARCHAR)")
    duck.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", ROWS)
    df = spark.createDataFrame(ROWS, "_uniqueid string, b boolean, n double, s string")
    df.createOrReplaceTempView("t")
    return df.cache()


SQL_CASES = [
    "b", "b = TRUE", "b <> TRUE", "b IS TRUE", "b IS NOT TRUE", "NOT b", "b = FALSE", "b <> FALSE", "b IS FALSE", "b IS NOT FALSE",
    "b IS NULL", "b IS NOT NULL", "b IN (TRUE)", "b NOT IN (TRUE)", "b IN (TRUE, FALSE)", "b NOT IN (TRUE, FALSE)", "b = NULL",
    "b <> NULL", "b < TRUE", "b <= TRUE", "b > TRUE", "b >= TRUE", "b < FALSE", "b <= FALSE", "b > FALSE", "b >= FALSE", "n = 1",
    "n > 1", "n >= 1", "n < 1", "n <= 1", "n <> 1", "n IS NULL", "n IN (0, 1)", "n NOT IN (0, 1)", "s = 'b'", "s <> 'b'", "s > 'b'",
    "s <= 'b'", "s IN ('a', 'b')", "s NOT IN ('a', 'b')", "s NOT IN ('a', NULL)", "b = TRUE AND n > 1", "b IS NOT TRUE AND n < 1",
    "b IS NULL AND s IS NOT NULL", "b = TRUE OR n > 1", "b IS NOT TRUE OR n < 1", "b IS NULL OR s IS NOT NULL", "s LIKE 'b%'",
    "s ILIKE 'B%'", "_uniqueid = 'r7'", "_uniqueid <> 'r7'", "_uniqueid IN ('r7', 'r8')", "_uniqueid >= 'r5'", "_uniqueid IS NULL"]


@pytest.mark.parametrize("case", SQL_CASES)
def test_sql_matrix(spark, duck, rows, case):
    want = duck.execute(f"SELECT count(*) FROM t WHERE {case}").fetchall()[0][0]
    assert spark.sql(f"SELECT count(*) FROM t WHERE {case}").first()[0] == want


DICT_CASES = [
    ({"b": ["==", True]}, "b = TRUE"), ({"b": ["<", True]}, "b < TRUE"), ({"b": [">=", False, "!=", True]}, "b >= FALSE AND b <> TRUE"),
    ({"n": [">=", 1, "<", 2]}, "n >= 1 AND n < 2"), ({"n": ["==", None]}, "n IS NULL"), ({"n": ["!=", None]}, "n IS NOT NULL"),
    ({"s": ["in", ["a", "b"]], "n": ["not in", [0]]}, "s IN ('a', 'b') AND n NOT IN (0)"), ({"s": ["in", []]}, "FALSE"),
    ({"s": ["not in", ["a", None]]}, "s NOT IN ('a', NULL)"), ({}, "TRUE"), ({"_uniqueid": ["in", ["r1", "r2"]]}, "_uniqueid IN ('r1', 'r2')")]


@pytest.mark.parametrize("spec,sql", DICT_CASES)
def test_dict_form(duck, rows, spec, sql):
    want = duck.execute(f"SELECT count(*) FROM t WHERE {sql}").fetchall()[0][0]
    assert B.constrain(rows, spec).count() == want


def test_bad_constraints(rows):
    for spec in ({"n": ["=", 1]}, {"n": ["==", 1, "<"]}, {"n": ["<", None]}):
        with pytest.raises(ValueError):
            B.condition(rows, spec)


def test_similar_to(rows):
    got = {s: rows.where(B.similar_to("s", s)).count() for s in ("b%", "_", "(a|b)", "[a-b]", "%")}
    assert got == {"b%": 12, "_": 36, "(a|b)": 24, "[a-b]": 24, "%": 48}


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "cast(id as string) s", "id * 2 as n").write.parquet(path)
    df = B.constrain(spark.read.parquet(path), {"n": [">", 4]}).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(n,4)" in plan and "ReadSchema: struct<id:bigint,n:bigint>" in plan


def test_blobs_are_not_read_unless_asked(spark, tmp_path):
    path = str(tmp_path / "b")
    spark.range(3).select("id", F.encode(F.lit("x"), "UTF-8").alias("blob")).write.parquet(path)
    df = B.with_blobs(spark.read.parquet(path), "blob", False)
    assert "ReadSchema: struct<id:bigint>" in df._jdf.queryExecution().executedPlan().toString()
    assert [r.blob for r in df.collect()] == [None] * 3


def test_drop_null_properties(spark):
    df = spark.createDataFrame([("a", None, 1)], "_uniqueid string, x string, y int")
    assert B.drop_null_properties(df).first().properties == '{"y":1}'


def test_allowed_domains_with_subdomains_and_bad_urls(spark):
    urls = ["http://a.com/x", "http://www.a.com/", "http://b.org:80/", "http://nota.com/", "::bad::", None, "http://x.c.net/q"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    start = spark.createDataFrame([("http://a.com/start",), ("http://b.org:80/",)], "url string")
    got = {r.url for r in B.allowed_domains(df, start, ["c.net"]).collect()}
    assert got == {urls[0], urls[1], urls[2], urls[6]}
