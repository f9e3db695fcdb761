"""Exact deduplication: sorted digest runs merged in rounds, with functions of Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import save

RUN_BITS = 8   # 256 runs at the leaves of the tree
FAN_BITS = 4   # 16 runs meet in a round


def digest_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", run_bits: int = RUN_BITS) -> DataFrame:
    """``(key, digest, proof, run)``: the SHA-256 of the text, a second hash and length as proof, and a run."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("key"), F.sha2(whole, 256).alias("digest"),
        F.struct(F.xxhash64(whole).alias("h"), F.octet_length(whole).alias("n")).alias("proof"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(1 << run_bits)).cast("int").alias("run"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "min",
                run_bits: int = RUN_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """Op 2. One row per document: ``key, keep_id, group_size, kept, digest``.

    Rows are dealt into runs by a hash of the id; a run holds one row per digest. In each round
    ``2 ** fan_bits`` neighbouring runs are merged digest by digest, which keeps the smallest id
    (``keep="max"``: the largest) and adds up the sizes, until one run is left. Rows merge only if
    digest, second hash and length agree, so every level checks what it merges. The answers go down
    the same tree: a digest meets at most ``2 ** fan_bits`` rows in a step, and a text that a third of all
    rows hold is spread over all runs at both ends.

    Null texts count as empty; a null id is returned with its group and never stays unless all ids
    of the group are null. Rows that repeat an id and text are each counted and get the same flags.
    An empty table gives no rows.
    """
    best = F.min if keep == "min" else F.max
    docs_runs = save(digest_runs(docs, key, text, run_bits).sortWithinPartitions("run", "digest"), "digests")
    levels = [docs_runs.groupBy("digest", "proof", "run").agg(best("key").alias("keep_id"), F.count(F.lit(1)).alias("size"))]
    bits = run_bits
    while bits > 0:
        step = min(fan_bits, bits)
        bits -= step
        levels.append(levels[-1].groupBy("digest", "proof", F.shiftright("run", step).alias("run"))
                      .agg(best("keep_id").alias("keep_id"), F.sum("size").alias("size")))
    answer = levels[-1].select("digest", "proof", F.col("run").alias("up"), "keep_id", F.col("size").alias("group_size"))
    bits = run_bits
    steps = []
    while bits > 0:
        steps.append(min(fan_bits, bits))
        bits -= steps[-1]
    for level, step in zip(levels[-2::-1], steps[::-1], strict=True):
        answer = (level.select("digest", "proof", "run", F.shiftright("run", step).alias("up"))
                  .join(answer, ["digest", "proof", "up"])
                  .select("digest", "proof", F.col("run").alias("up"), "keep_id", "group_size"))
    return (docs_runs.withColumnRenamed("run", "up").join(answer, ["digest", "proof", "up"])
            .select(F.col("key").alias(key), "keep_id", "group_size",
                    F.col("key").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "min", **options) -> DataFrame:
    """Op 2. The rows of ``docs`` that stay. Only rows that go are joined; rows that repeat an id and text stay together."""
    gone = (exact_dedup(docs, key, text, keep, **options).where(~F.col("kept"))
            .select(F.col(key).alias("key"), "digest").distinct())
    digest = F.sha2(F.coalesce(F.col(f"d.`{text}`"), F.lit("")), 256)
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.`{key}`").eqNullSafe(F.col("g.key")) & (digest == F.col("g.digest")), "left_anti")
