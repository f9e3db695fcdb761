"""From raw documents to tokens: the stages of a training corpus, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.llm.common import save
from plexus.llm.exact_dedup import drop_copies
from plexus.llm.mixing import mixed_documents
from plexus.llm.near_copies import drop_shingle_copies
from plexus.llm.sentencepiece import encode, load_vocabulary
from plexus.llm.toxicity import fitted, toxicity

TOXIC = 0.7


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC`` by a model of the labelled ones among them."""
    model = fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity(docs, model, docs.columns, score="_toxicity", passages="_passages")
    return scored.where(F.col("_toxicity") < TOXIC).drop("_toxicity", "_passages")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the largest id."""
    return drop_copies(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the smallest id: linked by SimHash or by bands, and by their shingles 0.8 similar or more."""
    return drop_shingle_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document comes, whole, as often as it is taken."""
    return mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and whether they decode to it."""
    rows = encode(docs.select("doc_id", "lang", "source", "text"), load_vocabulary(), proof="round_trip")
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", token_stage),
]

#: SQL can state neither a fitted model nor XXH64 fingerprints nor a lattice's best path; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(docs, name.split()[0].lower())
    return docs
