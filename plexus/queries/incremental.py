"""Incremental enrichment (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexus.queries.registry import query, table
from plexus.session import shared_dir
from plexus.streaming import incremental as L

_ENRICHED_SQL = """
  SELECT event_id, event_type, CASE WHEN value >= 20 THEN 'high' ELSE 'low' END AS band FROM events"""


def _enrich(rows):
    return rows.select("event_id", "event_type", F.when(F.col("value") >= 20, "high").otherwise("low").alias("band"))


@query("l01_incremental_enrich", _ENRICHED_SQL)
def l01(spark, sf):
    """Events that arrive in several files, some of them twice, one file per batch."""
    incoming = shared_dir(spark, "incoming")
    events = table(spark, sf, "events")
    events.repartitionByRange("ts").write.parquet(incoming)
    events.where("event_type = 'click'").write.mode("append").parquet(incoming)
    target, checkpoint = shared_dir(spark, "enriched"), shared_dir(spark, "checkpoint")
    query_ = L.incremental_enrich(L.read_new_files(spark, incoming, events.schema, max_files=2), _enrich, target, checkpoint,
                                  ["event_id"], ["ts"], interval="0 seconds")
    try:
        query_.processAllAvailable()
    finally:
        query_.stop()
    return L.enriched(spark, target).drop("batch_id")


@query("l02_run_once", _ENRICHED_SQL)
def l02(spark, sf):
    """The table as a stream, drained twice: the second run finds nothing new."""
    events = table(spark, sf, "events")
    target, checkpoint = shared_dir(spark, "enriched"), shared_dir(spark, "checkpoint")
    for _ in range(2):
        L.run_once(L.read_new_files(spark, sf, events.schema, glob="events.parquet"), _enrich, target, checkpoint, ["event_id"])
    return L.enriched(spark, target).drop("batch_id")
