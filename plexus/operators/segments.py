"""Blocks to segments, and the records and edges made of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import anchor_url
from plexus.functions.text import TOKEN_PATTERN, is_clean
from plexus.operators.vectors import slices, to_arrow
from plexus.types import DST, ID, SRC

Counter = Callable[[str], int]

# Separators of the splitter, from coarse to fine; the last one is every character.
SEPARATORS = ("\n\n", "\n", " ", "")

BLOCK_FIELDS = ("text", "kind", "anchor", "page_number", "title")

SEGMENT_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("text", T.StringType()), T.StructField("kinds", T.StringType()),
    T.StructField("n_tokens", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("anchor", T.StringType()), T.StructField("page_number", T.IntegerType()),
    T.StructField("first_page", T.IntegerType())]))


def count_tokens() -> Counter:
    """The token counter of the tasks; the same pattern as the column function."""
    import regex
    find = regex.compile(TOKEN_PATTERN).findall
    return lambda text: len(find(text))


def split_long(text: str, limit: int, count: Counter, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """I12. Cut a text into chunks within ``limit`` tokens at the coarsest separator that it holds.

    A piece keeps the separator before it; pieces are packed greedily; a piece as large as the
    limit is cut at the next finer separator.
    """
    level = next(i for i, s in enumerate(separators) if s == "" or s in text)
    separator, finer = separators[level], separators[level + 1:]
    if separator:
        head, *tail = text.split(separator)
        pieces = [p for p in (head, *(separator + t for t in tail)) if p]
    else:
        pieces = list(text)
    chunks: list[str] = []
    held: list[str] = []
    held_tokens = 0

    def flush() -> None:
        nonlocal held, held_tokens
        chunk = "".join(held).strip()
        if chunk:
            chunks.append(chunk)
        held, held_tokens = [], 0

    for piece in pieces:
        size = count(piece)
        if size >= limit and finer:
            flush()
            chunks.extend(split_long(piece, limit, count, finer))
            continue
        if size >= limit:
            flush()
            chunks.append(piece)
            continue
        if held and held_tokens + size > limit:
            flush()
        held.append(piece)
        held_tokens += size
    flush()
    return chunks


def pack_blocks(texts: list[str], kinds: list[str], anchors: list, pages: list, titles: list, max_tokens: int,
                overlap_tokens: int, count: Counter) -> Iterator[dict]:
    """I13. Greedy segments of one document, from the columns of its blocks.

    A segment ends when the next piece would not fit; the last pieces within the overlap start
    the next one. After that the next piece is taken even when it no longer fits.
    """
    window: list[tuple[int, str, int]] = []  # block, text, tokens
    tokens, title = 0, None

    def emit() -> dict:
        blocks = [b for b, _, _ in window]
        link = next((b for b in blocks if anchors[b] or pages[b]), None)
        return {"text": "\n\n".join(t for _, t, _ in window), "kinds": ",".join(sorted({kinds[b] for b in blocks})),
                "n_tokens": tokens, "title": title or None, "anchor": None if link is None else anchors[link],
                "page_number": None if link is None else pages[link],
                "first_page": next((pages[b] for b in blocks if pages[b] is not None), None)}

    for block, whole in enumerate(texts):
        title = title or titles[block]
        size = count(whole)
        pieces = ([(whole, size)] if size <= max_tokens
                  else [(t, count(t)) for t in split_long(whole, max_tokens, count)])
        for text, size in pieces:
            if window and tokens + size > max_tokens:
                yield emit()
                kept, room = len(window), overlap_tokens
                while kept and window[kept - 1][2] <= room:
                    kept -= 1
                    room -= window[kept][2]
                window = window[kept:]
                tokens = overlap_tokens - room
            window.append((block, text, size))
            tokens += size
    if window:
        yield emit()


def segment(documents: DataFrame, key: str, *, max_tokens: int = 300, overlap_tokens: int = 50, min_chars: int = 20,
            clean_only: bool = True, url: str | None = None, start: int = 0) -> DataFrame:
    """I13, I14. Segments of documents with ``blocks``: one row each, numbered in the document.

    A document is one row, so this is a map: no shuffle, and a task holds one Arrow batch and the objects of a slice of it.
    """
    extra = [url] if url else []
    schema = T.StructType([documents.schema[key], *[documents.schema[u] for u in extra],
                           T.StructField("segments", SEGMENT_SCHEMA)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, target = count_tokens(), to_arrow(schema)
        for batch in slices(batches):
            lists = batch.column(batch.num_columns - 1)
            flat, ends = lists.flatten(), lists.offsets.to_pylist()
            fields = [flat.field(n).to_pylist() for n in BLOCK_FIELDS]
            made = [[*pack_blocks(*[f[a - ends[0]:b - ends[0]] for f in fields], max_tokens, overlap_tokens, count)]
                    for a, b in zip(ends, ends[1:])]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(made, type=target.field("segments").type)], schema=target)

    text_blocks = F.transform(
        F.filter("blocks", lambda b: (b["type"] == "text") & b["text"].isNotNull()),
        lambda b: F.struct(*[b[n].alias(n) for n in BLOCK_FIELDS]))
    packed = documents.select(key, *extra, F.coalesce(text_blocks, F.array()).alias("blocks")).mapInArrow(run, schema)
    segments = F.filter("segments", lambda s: is_clean(s["text"], min_chars)) if clean_only else F.col("segments")
    rows = packed.select(key, *extra, F.posexplode(segments).alias("_i", "s")).select(
        key, *extra, (F.col("_i") + start).alias("segment_number"), "s.*")
    if url:
        rows = rows.withColumn("segment_url", anchor_url(url, "anchor", "page_number"))
    return rows


def segment_rows(segments: DataFrame, key: str, run_id: str, spec_id: str) -> DataFrame:
    """I15. Segment records. The id comes from run, document and number, so recomputation repeats it."""
    return segments.select(
        F.sha1(F.concat_ws("/", F.lit(run_id), F.col(key), F.col("segment_number"))).alias(ID), key, "text", "kinds",
        F.col("segment_url").alias("url"), F.lit(spec_id).alias("spec_id"), F.lit(run_id).alias("run_id"),
        "n_tokens", F.char_length("text").alias("n_characters"), "title")


def derived_edges(rows: DataFrame, source: str, edge_class: str) -> DataFrame:
    """Edges from the source id column to the rows."""
    return rows.select(F.col(source).cast("string").alias(SRC), F.col(ID).alias(DST), F.lit(edge_class).alias("class"))


def segment_edges(rows: DataFrame, key: str) -> DataFrame:
    """I15. Edges document to segment, spec to segment and run to segment."""
    return (derived_edges(rows, key, "documentHasSegment")
            .unionByName(derived_edges(rows, "spec_id", "specHasSegment"))
            .unionByName(derived_edges(rows, "run_id", "runHasSegment")))


def image_text_rows(documents: DataFrame, key: str, run_id: str, spec_id: str, url: str) -> DataFrame:
    """I16. One record per image block: image url, the best text (caption, else alt), page url with anchor."""
    blocks = documents.select(key, url, F.posexplode(F.filter("blocks", lambda b: b["type"] == "image")).alias("i", "b"))
    return blocks.select(
        F.sha1(F.concat_ws("/", F.lit(run_id), F.col(key), F.lit("image"), F.col("i"))).alias(ID), key,
        F.col("b.image_url").alias("image_url"), F.col("b.alt").alias("alt"), F.col("b.caption").alias("caption"),
        F.coalesce(F.nullif(F.col("b.caption"), F.lit("")), F.col("b.alt")).alias("text"),
        anchor_url(url, "b.anchor", F.lit(None).cast("int")).alias("url"), F.col("b.title").alias("title"),
        F.lit(spec_id).alias("spec_id"), F.lit(run_id).alias("run_id"))


def full_text_rows(full: DataFrame, key: str, run_id: str, spec_id: str) -> DataFrame:
    """I16. One record per document with its full text."""
    return full.select(F.sha1(F.concat_ws("/", F.lit(run_id), F.col(key), F.lit("full"))).alias(ID), key, "text", "title",
                       F.lit(spec_id).alias("spec_id"), F.lit(run_id).alias("run_id"))
