"""Bounded samples of labelled rows, the same at every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def labelled_sample(docs: DataFrame, labelled: DataFrame, rows: int) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents, chosen by a hash of their ids.

    ``labelled`` has (doc_id, label) without null labels.  The choice reads no
    texts; its at most ``rows`` rows are small enough to broadcast.  Of rows
    that share an id the one with the smallest hash of its text is taken, and
    of labels the smallest, so repeated ids don't exceed the bound either.
    """
    chosen = (
        labelled.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = texts.join(F.broadcast(chosen), "doc_id")
    one = met.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "label", "text")).alias("r"))
    return one.select("doc_id", "r.label", "r.text")
