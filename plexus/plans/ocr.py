"""Recognised text of page images to records, segments and vectors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import strip
from plexus.operators.block_rows import segment_block_rows
from plexus.operators.models import Model, batch_infer, embed_texts
from plexus.operators.segments import derived_edges
from plexus.session import materialise
from plexus.types import ID


@dataclass
class OcrTables:
    texts: DataFrame
    embeddings: DataFrame
    edges: DataFrame


def ocr_rows(pages: DataFrame, key: str, reader: Callable[[], Model], embedder: Callable[[], Model], *, run_id: str,
             spec_id: str, page: str = "page_number", image: str = "image", clean_only: bool = True) -> OcrTables:
    """I18. One text record per page with text, segments numbered from 1, one vector per segment.

    Pages are rows from start to end: the model reads them where they lie, its output is written
    once (records and segments both need it), and a book of any length is segmented in stretches.
    A segment carries the page of its first block. For single pictures use ``clean_only=False``.
    """
    read = materialise(batch_infer(pages.select(key, page, image), image, reader, {"text": T.StringType()}).drop(image), "ocr")
    texts = read.where(strip("text") != "").select(
        F.sha1(F.concat_ws("/", F.lit(run_id), F.col(key), F.lit("page"), F.col(page))).alias(ID), key, page,
        strip("text").alias("text"), F.lit(spec_id).alias("spec_id"), F.lit(run_id).alias("run_id"))
    null = F.lit(None).cast("string")
    blocks = texts.select(key, F.col(page).cast("bigint").alias("position"), "text", F.lit("body").alias("kind"), null.alias("anchor"),
                          F.col(page).cast("int").alias("page_number"), null.alias("title"))
    segments = segment_block_rows(blocks, key, clean_only=clean_only, start=1).withColumn(
        ID, F.sha1(F.concat_ws("/", F.lit(run_id), F.col(key), F.col("segment_number"))))
    rows = embed_texts(segments, "text", embedder).withColumns({"spec_id": F.lit(spec_id), "run_id": F.lit(run_id)})
    edges = (derived_edges(texts, key, "documentHasText").unionByName(derived_edges(rows, key, "documentHasEmbedding"))
             .unionByName(derived_edges(rows, "run_id", "runHasEmbedding")))
    return OcrTables(texts, rows, edges)
