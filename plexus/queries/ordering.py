"""Paging, sampling, numbering and frame windows (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.operators import ordering as E
from plexus.queries.registry import query, table
from plexus.queries.views import node

# parts as videos: the size is the frame rate, the price the frame count, some videos are empty
_VIDEOS_SQL = """(SELECT p_partkey AS video, p_size + 0.5 AS fps,
  CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE p_retailprice::BIGINT END AS n_frames FROM part)"""


def videos(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("video"), (F.col("p_size") + 0.5).alias("fps"),
        F.when(F.col("p_type") == "ECONOMY", 0).otherwise(F.floor(F.col("p_retailprice") + 0.5)).cast("bigint").alias("n_frames"))


_VIDEOS_SQL = _VIDEOS_SQL.replace("p_retailprice::BIGINT", "floor(p_retailprice + 0.5)::BIGINT")


@query("e01_page", """
  SELECT 'Orders:' || o_orderkey AS _uniqueid, o_totalprice AS totalprice FROM orders ORDER BY 'Orders:' || o_orderkey LIMIT 100 OFFSET 200""")
def e01(spark, sf):
    return E.page(node(spark, sf, "Orders"), batch_id=2, batch_size=100).select("_uniqueid", "totalprice")


@query("e02_head_n", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def e02(spark, sf):
    return E.head_n(table(spark, sf, "documents").select("doc_id", "lang"), 100, "doc_id")


@query("e03_order_by", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def e03(spark, sf):
    return E.order_by(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), F.desc("c_acctbal"), key="c_custkey")


@query("e04_sample_percent", """
  SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT, o_orderkey) AS i,
    count(*) OVER () AS n FROM orders) WHERE i <= floor(n * 12.5 / 100)""")
def e04(spark, sf):
    return E.sample_percent(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 12.5, "o_orderkey")


@query("e05_segment_number", """
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS segment_number
  FROM conversations""")
def e05(spark, sf):
    return E.segment_number(table(spark, sf, "conversations").select("conv_id", "turn"),
                            "conv_id", "turn", start=1)


@query("e06_clip_windows", f"""
  WITH v AS (SELECT *, ceil(fps / 1.0)::BIGINT AS step FROM {_VIDEOS_SQL} WHERE n_frames > 0)
  SELECT video, n_frames, s // step AS clip, s AS start, least(s + step, n_frames) AS stop
  FROM (SELECT *, unnest(range(0, n_frames, step)) AS s FROM v)""")
def e06(spark, sf):
    return E.clip_windows(videos(spark, sf), rate=1.0).select("video", "n_frames", "clip", "start", "stop")


@query("e07_frame_interval", """
  SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey >= 10 AND l_orderkey < 1000000000 AND (l_orderkey - 10) % 3 = 0""")
def e07(spark, sf):
    return E.frame_interval(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), 10, 1_000_000_000, 3, "l_orderkey")
