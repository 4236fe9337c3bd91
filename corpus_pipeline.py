"""The corpus pipeline: from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written to
shared storage and read again as the next stage's documents, so a lost
executor costs one stage at most.  All but the last keep the columns of
documents.

Null texts count as empty: they are scored by the bias alone, are equal to each
other, link with nothing, hold no secret and pack as one end id.  Null ids are
the smallest for exact copies and name no group of near ones.  Of rows that
are repeated, id included, one stays.  Empty tables give empty results, and
texts of any length are handled whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from zoneday.llm import certified_packing, extendible_index, ftrl_toxicity, ownership, trie_join
from zoneday.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labels that are not held out."""
    return ftrl_toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return extendible_index.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similar shingle sets the one with the smallest id stays."""
    return trie_join.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out; the documents stay."""
    return ownership.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return certified_packing.best_fit_sequences(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json")
    )


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

# Learned scores, components and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
