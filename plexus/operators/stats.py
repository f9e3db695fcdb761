"""Counts, reconciliations and score summaries. Every group-by combines on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.functions.scalars import content_type_main, url_domain
from plexus.operators.graph import neighbour_ids
from plexus.operators.skew import dense_index


def count_by_class(classes: Mapping[str, DataFrame]) -> DataFrame:
    """D01. Rows per class."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("class"), "n_rows")
        for name, df in classes.items()])


def count_connected(reference: DataFrame, edges: DataFrame, direction: str = "out",
                    edge_class: str | None = None) -> DataFrame:
    """D02. Number of distinct nodes reached from a reference set."""
    return neighbour_ids(reference, edges, direction, edge_class).agg(F.count(F.lit(1)).alias("n_connected"))


def reconcile_counts(expected: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D03. Expected and found rows per key, and the difference."""
    a = expected.groupBy(*keys).agg(F.count(F.lit(1)).alias("expected"))
    b = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("found"))
    zero = F.lit(0).cast("bigint")
    return (a.join(b, list(keys), "full_outer")
            .select(*keys, F.coalesce("expected", zero).alias("expected"), F.coalesce("found", zero).alias("found"))
            .withColumn("missing", F.col("expected") - F.col("found")))


def crawl_stats(responses: DataFrame) -> DataFrame:
    """D04. Responses by status, by domain and by content type, and in total, from one pass."""
    rows = responses.select(F.col("status").cast("string").alias("status"), url_domain("url").alias("domain"),
                            content_type_main("content_type").alias("content_type"))
    grouped = rows.groupingSets([["status"], ["domain"], ["content_type"], []],
                                "status", "domain", "content_type").agg(
        F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n_responses"))
    kind = (F.when(F.col("_g") == 3, "status").when(F.col("_g") == 5, "domain")
            .when(F.col("_g") == 6, "content_type").otherwise("total"))
    return grouped.select(kind.alias("measure"),
                          F.coalesce("status", "domain", "content_type").alias("value"), "n_responses")


def run_summary(objects: DataFrame, run: str = "run_id", kind: str = "kind", time: str = "time") -> DataFrame:
    """D05. Per run: number of segments, images, full texts, embeddings; start, end, duration."""
    def n(value: str):
        return F.count_if(F.col(kind) == value).alias(f"n_{value}")

    return (objects.groupBy(run)
            .agg(n("segment"), n("image"), n("full_text"), n("embedding"),
                 F.min(time).alias("start_time"), F.max(time).alias("end_time"))
            .withColumn("duration_seconds", F.unix_timestamp("end_time") - F.unix_timestamp("start_time")))


def workflow_report(specs: DataFrame, runs: DataFrame, objects: DataFrame) -> DataFrame:
    """D06. Workflow, spec, run and object type with counts, start and end.

    Objects are counted per run before the join, so the join sees one row per run and type.
    """
    counts = objects.groupBy("run_id", "object_type").agg(F.count(F.lit(1)).alias("n_objects"))
    return (specs.join(runs, "spec_id").join(counts, "run_id", "left")
            .select("workflow_name", "spec_id", "run_id", "object_type",
                    F.coalesce("n_objects", F.lit(0).cast("bigint")).alias("n_objects"),
                    "run_start", "run_end"))


def score_summary(scores: DataFrame, metrics: Sequence[str], corpus: str = "corpus") -> DataFrame:
    """D07. Mean, standard deviation, minimum and maximum by corpus and metric."""
    flat = scores.select(corpus, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [corpus], list(metrics), "metric", "score")
    return flat.groupBy(corpus, "metric").agg(
        F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"),
        F.min("score").alias("min"), F.max("score").alias("max"))


def score_gate(scores: DataFrame, gates: Sequence[tuple[str, str, float]], corpus: str = "corpus") -> DataFrame:
    """D08. Mean of a metric in a corpus against a threshold: ``(metric, corpus, threshold)`` each.

    Higher is better unless the metric is a distance. One aggregate has the means of all corpora; a gate takes its own from it.
    """
    metrics = list(dict.fromkeys(m for m, _, _ in gates))
    means = scores.where(F.col(corpus).isin(*{c for _, c, _ in gates})).groupBy(F.col(corpus).alias("corpus")).agg(
        F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[F.avg(m).cast("double") for m in metrics])).alias("means"))
    asked = scores.sparkSession.createDataFrame([(m, c, float(t)) for m, c, t in gates], "metric string, corpus string, threshold double")
    rows = asked.join(means, "corpus", "left").withColumn("mean", F.try_element_at("means", F.col("metric")))
    good = F.when(F.contains("metric", F.lit("distance")), F.col("mean") < F.col("threshold")).otherwise(F.col("mean") > F.col("threshold"))
    return rows.select("metric", "corpus", "mean", "threshold", F.coalesce(good, F.lit(False)).alias("passed"))


def distinct_classes(rows: DataFrame, column: str = "EntityClass") -> DataFrame:
    """D09. Distinct class names."""
    return rows.select(column).distinct()


def kinds(blocks: DataFrame, key: str, kind: str = "kind") -> DataFrame:
    """D10. Sorted distinct block kinds per key, joined by commas."""
    return (blocks.select(key, kind).distinct().groupBy(key)
            .agg(F.array_join(F.array_sort(F.collect_set(kind)), ",").alias("kinds")))


# Properties that make a vector set searchable by text or image.
MODEL_PROPERTIES = ("provider", "model", "pretrained")


def vector_sets(vectors: DataFrame, registry: DataFrame) -> DataFrame:
    """D11. Vector sets that hold vectors and name their model completely, with the count."""
    counts = vectors.groupBy("set").agg(F.count(F.lit(1)).alias("n_vectors"))
    complete = reduce(lambda a, b: a & b, [F.col(p).isNotNull() for p in MODEL_PROPERTIES])
    return registry.where(complete).join(counts, registry["name"] == counts["set"]).drop("set")


def vector_set_count(vectors: DataFrame, names: DataFrame) -> DataFrame:
    """D12. Number of vectors of each named set; 0 for a set that does not exist."""
    counts = vectors.groupBy(F.col("set").alias("name")).agg(F.count(F.lit(1)).alias("_n"))
    return (names.select("name").distinct().join(counts, "name", "left")
            .select("name", F.coalesce("_n", F.lit(0).cast("bigint")).alias("n_vectors")))


def feature_index(rows: DataFrame, feature: str) -> DataFrame:
    """D13. Feature names with counts and a dense index in alphabetical order."""
    counts = rows.groupBy(feature).agg(F.count(F.lit(1)).alias("n_rows"))
    return dense_index(counts, feature, "feature_index")


def concat_text(rows: DataFrame, key: str, position: str, text: str, separator: str = " ",
                block: int = 10_000) -> DataFrame:
    """D14. All texts of a source joined in order of position.

    Texts are first joined inside blocks of positions, so the sort is spread out; the last step
    joins one string per block. The result of a source is one string and so limited to 2 GB.
    """
    def joined(order: str, value: str):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))),
                                        lambda e: e[value]), separator)

    cut = F.floor(F.col(position) / F.lit(block)).cast("bigint").alias("_block")
    inner = (rows.where(F.col(text).isNotNull())
             .groupBy(key, cut).agg(joined(position, text).alias("_text")))
    return inner.groupBy(key).agg(joined("_block", "_text").alias("full_text"))
