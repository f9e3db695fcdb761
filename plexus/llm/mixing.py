"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.llm.common import n_words, save
from plexus.operators.skew import row_number_by_block

WEIGHTS = (5, 2, 1)
BLOCK_TOKENS = 1024
CELLS = 1024          # cells of [0, 1) in which slots and sources meet
SLOT_BLOCK = 4_096    # slots that are ranked together
_LOW_BITS = 20        # a slot number is split so that its product with the ratio keeps its fraction


def golden(n: int = 1) -> float:
    """Fractional part of ``n`` times the golden ratio, from exact integers."""
    scale = 10**60
    return (n * ((isqrt(5 * scale * scale) + scale) // 2) % scale) / scale


def golden_point(slot: Column) -> Column:
    """The slot's point of the golden-ratio sequence in [0, 1)."""
    high, low = F.shiftright(slot, _LOW_BITS), slot.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    x = high * F.lit(golden(1 << _LOW_BITS)) + low * F.lit(golden())
    return x - F.floor(x)


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", share: float = 1.5,
                   most: int = 2, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``source, no, source_size, target, quota`` of each source.

    Sources in order of code points, null last, take the weights in turn and share ``share`` times all
    words; a target stops at ``most`` times its source's size and the excess is shared again by
    weight until none is above. With sources in order of size per weight the common level is the
    largest of the levels that remain after each capped prefix, so no loop is needed. One row per
    source goes through a window without keys, and nothing else.
    """
    per = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    order = Window.orderBy(F.col(source).asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("no") % len(weights)) + 1).cast("int"))
    ranked = (per.withColumn("no", F.row_number().over(order) - 1).withColumn("weight", turn)
              .withColumn("cap", F.col("source_size") * most))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "no")
    every = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    return (ranked.withColumn("level", level).withColumn("level", F.max("level").over(every))
            .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
            .withColumn("quota", F.floor(F.col("target") + 0.5).cast("bigint"))
            .select(source, "no", "source_size", "target", "quota"))


def layout(docs: DataFrame, sources: DataFrame, key: str, source: str, size: str) -> DataFrame:
    """Documents of each source in shuffled order with the place ``start`` of their first word.

    The order is that of a hash of the id. Running sums are taken inside 4,096 ranges of the hash,
    then over the ranges, so that a source with a third of all rows is never sorted in one task.
    """
    spot = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = (docs.join(sources.select(F.col(source).alias("_s"), "no", "source_size", "target", "quota"),
                      F.col(source).eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("_h", spot).withColumn("_range", F.substring("_h", 1, 3)))
    sums = rows.groupBy("no", "_range").agg(F.sum(size).alias("_n"))
    before = Window.partitionBy("no").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("no", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy("no", "_range").orderBy("_h", key, size)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("_at", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(offsets, ["no", "_range"])
            .withColumn("start", (F.col("_at") + F.col("_offset")).cast("bigint"))
            .drop("_h", "_range", "_at", "_offset"))


def schedule(sources: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``slot, no, block, first, n``: which words ``[first, first + n)`` of its source a slot takes.

    Slot i stands at the i-th golden-ratio point, which the cumulated targets map to a source; the
    rank of the slot inside its source is the block it takes, again from the first block after the
    last. A source stops at its quota, inside a block if need be; the few blocks by which the
    sequence misses a quota follow at the end.
    """
    spark = sources.sparkSession
    b = F.lit(block_tokens)
    size, quota = F.col("source_size"), F.col("quota")
    blocks = F.floor((size + b - 1) / b).cast("bigint")
    needs = (F.floor(quota / size).cast("bigint") * F.col("blocks") + F.floor((quota % size + b - 1) / b)).cast("bigint")
    live = (sources.where("source_size > 0 AND quota > 0").withColumn("blocks", blocks).withColumn("needs", needs))
    upto = Window.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    live = live.withColumn("_to", F.sum("quota").over(upto)).withColumn("_all", F.sum("quota").over(Window.partitionBy()))
    live = live.withColumn("high", F.col("_to") / F.col("_all")).withColumn("low", (F.col("_to") - quota) / F.col("_all"))
    n_slots = live.agg(F.sum("needs")).first()[0] or 0
    cells = live.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))))
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("point"))
    mapped = (slots.withColumn("cell", F.floor(F.col("point") * CELLS))
              .join(cells.select("cell", "no", "low", "high"), "cell").where("point >= low AND point < high")
              .select("slot", "no"))
    ranked = row_number_by_block(mapped, ["no"], "slot", "rank", start=0, block=SLOT_BLOCK)
    have = mapped.groupBy("no").agg(F.count(F.lit(1)).alias("have"))
    late = (live.join(have, "no", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < needs")
            .select("no", F.explode(F.sequence("have", F.col("needs") - 1)).alias("rank"))
            .select((F.col("rank") + F.lit(n_slots)).alias("slot"), "no", "rank"))
    start = F.floor(F.col("rank") / F.col("blocks")).cast("bigint") * size + (F.col("rank") % F.col("blocks")) * b
    first = (F.col("rank") % F.col("blocks")) * b
    return (ranked.select("slot", "no", "rank").union(late)
            .join(live.select("no", "blocks", "needs", "source_size", "quota"), "no").where("rank < needs")
            .select("slot", "no", (F.col("rank") % F.col("blocks")).alias("block"), first.alias("first"),
                    F.least(b, size - first, quota - start).alias("n")))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", share: float = 1.5,
        most: int = 2, weights: Sequence[int] = WEIGHTS, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Op 10. The mix, and the documents it is made of.

    ``docs`` has one row per document with its size in words. The first frame has one row per piece:
    ``slot, no, start, first_word, n_words`` (words of the document laid at ``start`` of source ``no``); the
    second the documents with ``no, start, source_size, target, quota``. Pieces of one source add up
    to its target rounded to a word, and no document is taken more than ``most`` times. A document
    without words lies in no block. Repeated rows are documents of their own; null ids and sources
    count as values, and the null source comes last. An empty table gives two empty frames.
    """
    narrow = docs.select(key, source, size)
    sources = save(source_targets(narrow, source, size, share, most, weights), "sources")
    laid = save(layout(narrow, sources, key, source, size), "layout")
    b = F.lit(block_tokens)
    parts = (laid.where(F.col(size) > 0)
             .select("no", "start", F.col(size).alias("_size"),
                     F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col(size) - 1) / b))).alias("block")))
    pieces = (parts.join(schedule(sources, block_tokens), ["no", "block"])
              .withColumn("_from", F.greatest("start", "first"))
              .withColumn("n_words", F.least(F.col("start") + F.col("_size"), F.col("first") + F.col("n")) - F.col("_from"))
              .where("n_words > 0")
              .select("slot", "no", "start", (F.col("_from") - F.col("start")).alias("first_word"), "n_words"))
    return pieces, laid


def taken_words(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``key, source, size, source_size, target, taken`` of each document, from the pieces of the mix."""
    sized = save(docs.select(key, source, n_words(text).alias("size")), "sizes")
    pieces, laid = mix(sized, key, source, "size", **options)
    sums = pieces.groupBy("no", "start").agg(F.sum("n_words").alias("taken"))
    return (laid.withColumn("_spot", F.when(F.col("size") > 0, F.col("start")))
            .join(sums.select(F.col("no").alias("_no"), F.col("start").alias("_start"), "taken"),
                  (F.col("no") == F.col("_no")) & (F.col("_spot") == F.col("_start")), "left")
            .select(key, source, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Op 10. The columns of ``docs``, a row for each time that a document is taken, in no certain order.

    Texts stay whole: where a source's quota ends inside a document, it is taken once more if the mix takes half of its words or more
    there, else not. So a source misses its quota by half a document at most. One without words or not taken gives no row. Rows
    that repeat id, source and size are taken alike.
    """
    taken = (taken_words(docs, key, text, source, **options).groupBy(key, source, "size").agg(F.max("taken").alias("taken"))
             .select(F.col(key).alias("k"), F.col(source).alias("s"), F.col("size").alias("n"), F.floor(F.try_divide("taken", "size") + 0.5).cast("int").alias("times"))
             .where("times > 0"))
    d, t = docs.alias("d"), taken.alias("t")
    same = (F.col(f"d.`{key}`").eqNullSafe(F.col("t.k")) & F.col(f"d.`{source}`").eqNullSafe(F.col("t.s")) & (n_words(f"d.`{text}`") == F.col("t.n")))
    spare = "_" + "_".join(docs.columns)  # no column of docs
    return d.join(t, same).select(*[F.col(f"d.`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("t.times"))).alias(spare)).drop(spare)
