"""Exact de-duplication over an extendible-hash index on shared files.

A key is a 64-bit hash of the text.  A bucket is a prefix of the key's bits,
so it owns a contiguous key range.  Starting from one bucket, every bucket
with more than ``capacity`` different keys is split by doubling the directory,
down to ``max_depth`` bits; a bucket that is still overfull keeps its overflow
in one chain.  The directory has at most 2**max_depth rows.

Rows of one text are first gathered into at most ``SHARES`` rows where they
are read, so a text that a third of all rows share is a few rows of each task.
Owner tasks then take the key ranges of the buckets: they order the texts of
one key, chain those that differ byte by byte, and settle there which row of
a text stays and how many there are.  The chains are the index, written to
the session's shared folder; two texts with one key are two of its links.

Null text counts as empty.  Of equal texts the row with the largest doc_id
stays; a null doc_id is smaller than any other, and rows that share the
largest doc_id are all marked as kept (``drop_duplicates`` keeps one of them).  Column names of the input do not matter, as
rows travel in one struct.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneday.session import materialize

CAPACITY = 4096
MAX_DEPTH = 16
SHARES = 8


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def prefix(key: Column, bits: int) -> Column:
    """The leading ``bits`` bits (1 to 63) of a key as a number."""
    return F.shiftrightunsigned(key, 64 - bits)


def directory(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """For each cell of ``max_depth`` bits: the depth at which its bucket stopped splitting, and the bucket.

    ``keys`` has one row per different key.  The cells in use are at most
    2**max_depth, whatever the number of keys.
    """
    cells = keys.groupBy(prefix(F.col("key"), max_depth).alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")).withColumn(
        "part", F.expr(f"shiftrightunsigned(cell, {max_depth} - depth)")
    )
    fits = levels.groupBy("depth", "part").agg(F.sum("n").alias("held")).filter((F.col("held") <= capacity) | (F.col("depth") == max_depth))
    # a bucket per depth and prefix: at most 2**(max_depth + 1) rows
    reached = levels.join(F.broadcast(fits), ["depth", "part"]).groupBy("cell").agg(F.min("depth").alias("depth"))
    return reached.select(
        "cell",
        "depth",
        # the first cell of its range names the bucket
        F.expr(f"shiftleft(shiftrightunsigned(cell, {max_depth} - depth), {max_depth} - depth)").alias("bucket"),
    )


def build_index(
    rows: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, key: Callable[[Column], Column] = text_key
) -> DataFrame:
    """The index over ``rows`` (id, text): bucket, key, link of the chain, sha, n, keep_id; written to shared files."""
    keyed = rows.select("id", "text", key(F.col("text")).alias("key"))
    cells = F.broadcast(directory(keyed.select("key").distinct(), capacity, max_depth))  # at most 2**max_depth rows
    share = F.pmod(F.xxhash64("id"), F.lit(SHARES)).alias("share")
    gathered = keyed.groupBy("key", "text", share).agg(F.count("*").alias("n"), F.max("id").alias("keep_id"))
    placed = gathered.withColumn("cell", prefix(F.col("key"), max_depth)).join(cells, "cell")
    owned = placed.select("bucket", "depth", "key", "text", "n", "keep_id").repartitionByRange("bucket", "key")
    # an owner holds all rows of its keys: the chain grows by a link where a text's bytes differ from those before it
    chain = Window.partitionBy("bucket", "key").orderBy("text")
    differs = owned.withColumn("fresh", F.when(F.col("text").eqNullSafe(F.lag("text").over(chain)), 0).otherwise(1))
    linked = differs.withColumn("link", F.sum("fresh").over(chain))
    links = linked.groupBy("bucket", "depth", "key", "link", "text").agg(F.sum("n").alias("n"), F.max("keep_id").alias("keep_id"))
    return materialize(links.select("bucket", "depth", "key", "link", F.sha2("text", 256).alias("sha"), "n", "keep_id"), "index")


def mark_duplicates(
    docs: DataFrame,
    text: Column,
    doc_id: Column,
    capacity: int = CAPACITY,
    max_depth: int = MAX_DEPTH,
    key: Callable[[Column], Column] = text_key,
    carry: Column | None = None,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, sha, bucket and ``carry`` (a struct of what else is wanted)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    rows = docs.select(doc_id.cast("bigint").alias("id"), text.alias("text"), (F.lit(None) if carry is None else carry).alias("carry"))
    index = build_index(rows.select("id", "text"), capacity, max_depth, key)
    # adaptive execution splits the rows of a hot key
    probe = rows.select("id", "carry", key(F.col("text")).alias("key"), F.sha2("text", 256).alias("sha"))
    return probe.join(index, ["key", "sha"]).select(
        "id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "sha",
        "bucket",
        "carry",
    )


def exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return mark_duplicates(docs, F.col("text"), F.col("doc_id"), **options).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns: one row of each text, rows that share its largest id included."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    kept = mark_duplicates(docs, F.col("text"), F.col("doc_id"), carry=whole).filter("kept")
    # texts are equal within a bucket where key and digest are; the rank is cut in the reading tasks already
    return first_rows(kept.select("carry", F.struct("bucket", "sha").alias("same"))).select("carry.*")


def first_rows(rows: DataFrame) -> DataFrame:
    """One row for each ``same``, whichever comes first."""
    order = Window.partitionBy("same").orderBy(F.lit(1))
    return rows.withColumn("_turn", F.row_number().over(order)).filter("_turn = 1").drop("_turn")
