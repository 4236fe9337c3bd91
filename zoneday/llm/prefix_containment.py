"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item is cut into windows of ``window`` consecutive words; an item of fewer
words, but not none, is one window.  A window occurs in a document where the
same words follow each other there.  As a join of sets:

1.  A window is a set of shingles of ``shingle`` words (a shorter window is one
    shingle).  Its occurrence asks for all of them, so of the shingles ordered
    by rarity a prefix of one is necessary: the rarest.
2.  Documents keep the places of shingles that benchmark windows have.  Their
    numbers are the order of rarity, over all documents; a window with a
    shingle that no document has is dropped.
3.  The places are joined with the windows' prefix shingles.  The shingle's
    place within the window gives the only possible start, and windows that
    would begin before the document (position) or end behind it (length) go.
4.  What is left is verified: the document's words from that start on, as many
    as the window has, are compared with the window's words.

Shingles meet by 64-bit hashes, which can only add candidates: words decide.
Equal texts are verified once, by their SHA-256.  The benchmark's shingles are
written before they are joined, so that Spark knows their bytes: few are
broadcast, many are shuffled and hot ones split.

Null and empty texts have no words.  Repeated items and windows count once;
an item without an id can be hit but isn't listed.  Repeated documents get
equal rows.  A text of any length is handled whole.  Other columns of the
tables are not read.  Empty tables give no hits, or no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneday.session import materialize

WINDOW = 10
SHINGLE = 5
# What separates words once A-Z are lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text in order; none where it is null."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, BREAK, -1), "")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, however often they are used."""
    names = df.columns
    made = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select(*names, F.explode(F.array(made)).alias("_made")).select(*names, "_made.*")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(words, at + k) for k in range(size)))


def _placed(size: int) -> Callable[[Column], Column]:
    return lambda i: F.struct(i.alias("place"), _shingle(F.col("words"), i, size).alias("h"))


def _from_word(size: int) -> Callable[[Column, Column], Column]:
    return lambda _, i: _shingle(F.col("words"), i, size)


def benchmark_windows(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The different windows (win, words) and which items have them (win, item); both written."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    rows = _once(rows, whole=words_of(F.col("text"))).filter(F.size("whole") > 0)
    last = F.greatest(F.size("whole") - window, F.lit(0))
    cut = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.slice(F.col("whole"), i, F.lit(window)))
    # words have no blanks, so the joined words name the window
    held = rows.select("item", F.explode(F.array_distinct(cut)).alias("words")).withColumn("win", F.unhex(F.sha2(F.array_join("words", " "), 256)))
    held = materialize(held, "benchmark-windows")
    return held.select("win", "words").distinct(), held.filter("item is not null").select("win", "item").distinct()


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(win, len, size, place, h): the shingles of each window with their places in it; written."""
    sized = windows.withColumns({"len": F.size("words"), "size": F.least(F.size("words"), F.lit(shingle))})
    parts = []
    for size in range(1, shingle + 1):
        spans = F.transform(F.sequence(F.lit(0), F.col("len") - size), _placed(size))
        part = sized.filter(F.col("size") == size).select("win", "len", "size", F.explode(spans).alias("s"))
        parts.append(part.select("win", "len", "size", "s.place", "s.h"))
    return materialize(reduce(DataFrame.union, parts), "window-shingles")


def shingle_places(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """(sha, n, at, h): where each different text has one of the ``wanted`` shingles; written."""
    # written: a table that is grouped where it is joined would keep hot shingles in one task
    hashes = materialize(wanted.select("h", "size").distinct(), "wanted-shingles")
    sizes = sorted(r["size"] for r in hashes.select("size").distinct().collect()) or [SHINGLE]  # one to SHINGLE numbers
    rows = _once(docs.select(F.col(text).alias("text")), sha=_digest(F.col("text")), words=words_of(F.col("text")))
    rows = rows.select("sha", "words", F.size("words").alias("n"))
    by_size = [F.transform("words", _from_word(size)) for size in sizes]
    spread = rows.select("sha", "n", F.posexplode(F.concat(*by_size)).alias("k", "h"))
    # a shingle that runs over the end has fewer words and is cut here
    size = F.element_at(F.array(*map(F.lit, sizes)), F.floor(F.col("k") / F.col("n")).cast("int") + 1)
    place = spread.join(hashes.select("h"), "h").withColumns({"at": F.col("k") % F.col("n"), "size": size}).filter(F.col("at") + F.col("size") <= F.col("n"))
    return materialize(place.select("sha", "n", "at", "h").distinct(), "shingle-places")


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Where windows occur: (sha, start, len, win) for each different text, and the items of each window (win, item)."""
    windows, members = benchmark_windows(items, window)
    spans = window_shingles(windows, shingle)
    places = shingle_places(docs, spans)
    rarity = places.groupBy("h").agg(F.count("*").alias("held"))
    ranked = spans.join(materialize(rarity, "shingle-rarity"), "h", "left").groupBy("win", "len").agg(
        F.min(F.struct("held", "place", "h")).alias("rarest"), F.count_if(F.col("held").isNull()).alias("absent")
    )
    prefix = materialize(ranked.filter("absent = 0").select("win", "len", "rarest.place", "rarest.h"), "prefix-shingles")
    met = places.join(prefix, "h").select("sha", "n", (F.col("at") - F.col("place")).alias("start"), "len", "win")
    bounded = materialize(met.filter("start >= 0 and start + len <= n").select("sha", "start", "len", "win"), "candidates")
    asked = materialize(bounded.select("sha").distinct(), "candidate-texts")
    texts = docs.select(_digest(F.col("text")).alias("sha"), F.col("text").cast("string").alias("text"))
    texts = texts.join(asked, "sha", "left_semi").distinct()
    texts = _once(texts, held=words_of(F.col("text"))).select("sha", "held")
    checked = bounded.join(texts, "sha").join(windows, "win").filter(F.slice("held", F.col("start") + 1, F.col("len")) == F.col("words"))
    return materialize(checked.select("sha", "start", "len", "win"), "occurrences"), members


def summary(found: DataFrame, members: DataFrame) -> DataFrame:
    """For each text with occurrences: n_hit (words inside any), and the sorted ids of the items."""
    before = Window.partitionBy("sha").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("sha", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    reached = spans.withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))
    hit = reached.groupBy("sha").agg(F.sum(fresh).cast("bigint").alias("n_hit"))
    listed = found.select("sha", "win").distinct().join(members, "win").select("sha", "item").distinct()
    listed = listed.groupBy("sha").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return hit.join(listed, "sha", "left")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids)."""
    found, members = occurrences(docs, items, window, shingle)
    hits = materialize(summary(found, members), "contaminated-texts")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _digest(F.col("text")).alias("sha"), F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    # written before the join: few texts are broadcast, and the rows of a hot text are split otherwise
    return rows.join(hits, "sha", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.size(items).cast("bigint").alias("n_items"), items.alias("items")
    )


def decontamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
