"""Retrieval context, answers and retrieval quality."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.functions.scalars import strip
from plexus.operators.stats import MODEL_PROPERTIES
from plexus.operators.vectors import COSINE, check_search, find_similar

# The line between answer and new summary.
SEPARATOR = "===SUMMARY==="

INSTRUCTIONS = ("Answer the question from the retrieved knowledge only. "
                f"Then write the line {SEPARATOR} and below it an updated summary of the conversation.")


def find_similar_to(vectors: DataFrame, *, text: str | None = None, image: Any = None, vector: Sequence[float] | None = None,
                    load: Callable[[], Callable[[list], list]] | None = None, k: int = 10, metric: str = COSINE,
                    registry: DataFrame | None = None, set_name: str | None = None, **search: Any) -> DataFrame:
    """H01. Search with exactly one of a text, an image or a vector; the first two go through the set's model.

    A05. With ``registry`` and ``set_name`` only that set is searched, and a text or an image is refused for a set
    that does not name its model completely.
    """
    check_search(k, metric, text=text, image=image, vector=vector)
    if set_name is not None:
        vectors = vectors.where(F.col("set") == set_name)
    if vector is None:
        if registry is not None:
            row = registry.where(F.col("name") == set_name).select(*MODEL_PROPERTIES).first()
            missing = [p for p in MODEL_PROPERTIES if row is None or row[p] is None]
            if missing:
                raise ValueError(f"set {set_name} cannot be searched by text or image: no {', '.join(missing)}")
        if load is None:
            raise ValueError("a text or image search needs the model of the vector set")
        vector = load()([text if text is not None else image])[0]
    values = [float(x) for x in np.asarray(vector).tolist()]
    query = vectors.sparkSession.createDataFrame([(0, values)], "query_id int, query_vector array<double>")
    return find_similar(query, vectors, k, metric, **search).drop("query_id")


def assemble_context(retrieved: DataFrame, queries: DataFrame, instructions: str = INSTRUCTIONS) -> DataFrame:
    """H15. Prompt per query: instructions, retrieved texts joined by blank lines, history, question.

    ``retrieved`` has query_id, rank and text: at most k rows per query, the search's bound.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "text")))
    texts = retrieved.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda e: F.coalesce(e["text"], F.lit(""))), "\n\n").alias("_context"))
    parts = [F.lit(f"# Instructions\n{instructions}\n\n# Retrieved knowledge\n"), F.coalesce("_context", F.lit("")),
             F.lit("\n\n# Conversation so far\n"), F.coalesce("history", F.lit("")),
             F.lit("\n\n# Question\n"), F.col("query"), F.lit("\n\n# Answer")]
    return queries.join(texts, "query_id", "left").select("query_id", F.concat(*parts).alias("prompt"))


def split_answer(response: str | Column, history: str | Column, separator: str = SEPARATOR) -> tuple[Column, Column]:
    """H16. Answer and new history, cut at the first separator; without one the history stays."""
    r = F.col(response) if isinstance(response, str) else response
    h = F.col(history) if isinstance(history, str) else history
    at = F.instr(r, separator)
    answer = F.when(at > 0, F.substring(r, F.lit(1), at - 1)).otherwise(r)
    tail = F.substring(r, at + len(separator), F.length(r))
    return strip(answer), strip(F.when(at > 0, tail).otherwise(h))


def retrieval_overlap(expected: DataFrame, retrieved: DataFrame) -> DataFrame:
    """H17. Per question: expected pages, how many of them were retrieved, and the share."""
    want = expected.select("question", "url").distinct()
    got = retrieved.select("question", "url").distinct().withColumn("_hit", F.lit(1))
    return (want.join(got, ["question", "url"], "left").groupBy("question")
            .agg(F.count(F.lit(1)).alias("n_expected"), F.count("_hit").alias("n_found"))
            .withColumn("overlap", F.col("n_found") / F.col("n_expected")))
