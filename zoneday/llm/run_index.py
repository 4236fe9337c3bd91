"""Removal of repeated byte strings with run-length indexes.

Every byte that lies in a ``least``-byte string which also starts elsewhere,
in any document, is removed.

Finding what belongs together.  In each window of ``least`` bytes the anchor
string of ``ANCHOR`` bytes with the smallest hash is chosen by the window's
content alone, so equal windows choose equal anchors.  The windows that chose
one anchor are one context; every window lies in exactly one.  Contexts whose
anchor occurs once in the corpus cannot repeat and are left.

Indexing.  The different contexts of anchors are dealt out by anchor.  Tasks
join them to texts of a few megabytes, a context that occurs more than once
standing for two, and build a run-length index over each: the Burrows-Wheeler transform
in runs, with a sample of the text position at each run's head and of the one
before it in suffix order, and the length of their common prefix.  Along the
text the matching statistic (the longest match with any other place) falls by
one a step except at these samples, so one pass over them streams all of it.
Stretches where it reaches ``least`` are marked.

An anchor with more than ``crowd`` different contexts would fill one task.
Its contexts are taken apart into their windows, which are counted by hash.

Null text counts as empty.  Strings that cross documents don't exist.  A
document that is there twice is removed whole if it has ``least`` bytes.
Repeated rows get equal results; columns of other names are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneday.llm import flat
from zoneday.llm.joins import split_join
from zoneday.session import materialize

LEAST = 200
ANCHOR = 64
CROWD = 1024
INDEX_BYTES = 2 << 20
STRETCH = 4 << 20


def choose_anchors(hashes: flat.SpanHashes, bounds: np.ndarray, least: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts of the texts between ``bounds``: text, first window, last window, and anchor position."""
    n = len(hashes.sums) - 1
    none = np.zeros(0, np.int64)
    if n < least:
        return none, none, none, none
    key = (hashes.windows(size) & ~np.uint64(0xFFFFFFFF)) | np.arange(n - size + 1, dtype=np.uint64)
    span = least - size + 1  # anchors in a window
    low, width = key, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: n - least + 1], low[span - width : span - width + n - least + 1])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(n - least + 1)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: n - least + 1]
    whole = start + least <= bounds[text + 1]
    start, at, text = start[whole], at[whole], text[whole]
    if not len(start):
        return none, none, none, none
    fresh = np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(start)] - 1
    return text[first], start[first], start[last], at[first]


def contexts(rows: DataFrame, least: int, size: int, stretch: int = STRETCH) -> DataFrame:
    """(k1, k2, start, length, anchor, context) for each context of ``rows`` (k1, k2, text); the last two are hashes."""

    def parts(batches):
        """Chunks, and of longer texts stretches that share least - 1 bytes."""
        for batch, data, bounds in flat.byte_chunks(batches, "text"):
            if len(data) <= stretch or len(bounds) > 2:
                yield batch, data, bounds, 0
            else:
                for a in range(0, len(data) - least + 1, stretch):
                    part = data[a : a + stretch + least - 1]
                    yield batch, part, np.array([0, len(part)]), a

    def run(batches):
        for batch, data, bounds, offset in parts(batches):
            hashes = flat.SpanHashes(data)
            text, first, last, at = choose_anchors(hashes, bounds, least, size)
            end = last + least
            # where in the context its anchor lies is part of what makes contexts equal
            context = hashes.of(first, end) ^ flat.mix((at - first).astype(np.uint64))
            k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
            anchor = hashes.of(at, at + size)
            columns = (k1[text], k2[text], first - bounds[text] + offset, end - first, anchor.view(np.int64), context.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["k1", "k2", "start", "length", "anchor", "context"])

    return rows.mapInArrow(run, "k1 bigint, k2 bigint, start bigint, length bigint, anchor bigint, context bigint")


class RunIndex:
    """A run-compressed Burrows-Wheeler transform of several strings, with sampled run heads.

    For each run its byte (-1 before a string's first byte) and its length;
    for each run's head its text position, that of the suffix before it in
    suffix order, and the length of their common prefix.  Samples whose common
    prefix is sure to be below ``least`` are left out.
    """

    def __init__(self, strings: list[bytes], least: int = 1):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.text = np.frombuffer(b"".join(strings), dtype=np.uint8)
        n = len(self.text)
        self.starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        self.ends = np.repeat(np.cumsum(sizes), sizes)
        order, levels = self._sort()
        before = self.text[order - 1].astype(np.int16)
        first = np.zeros(n, dtype=bool)
        first[self.starts] = True
        before[first[order]] = -1
        at = np.flatnonzero(np.r_[True, (before[1:] != before[:-1]) | (before[1:] < 0)])
        self.run_byte, self.run_size = before[at], np.diff(np.r_[at, n])
        at = at[at > 0]
        head, above = order[at], order[at - 1]
        short = [rank for h, rank in levels if h <= least]
        if short:
            close = short[-1][head] == short[-1][above]
            head, above = head[close], above[close]
        self.head, self.above = head, above
        self.common = self._common(head, above, levels)

    def _sort(self) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Suffix order by doubling; a string's end sorts first, equal suffixes by position.

        A rank is the place of the first suffix that is equal so far.  Only
        suffixes whose rank is not yet theirs alone are sorted again.
        """
        n = len(self.text)
        left = self.ends - np.arange(n)
        # seven bytes as one number, each one up so that an end is zero
        byte = np.zeros(n + 7, dtype=np.uint64)
        byte[:n] = self.text
        byte[:n] += np.uint64(1)
        two = byte[:-1] * np.uint64(257) + byte[1:]
        four = two[:-2] * np.uint64(257**2) + two[2:]
        word = (four[:n] * np.uint64(257**2) + two[4 : n + 4]) * np.uint64(257) + byte[6 : n + 6]
        tail = np.flatnonzero(left < 7)
        word[tail] = 0
        for j in range(7):
            word[tail] = word[tail] * np.uint64(257) + np.where(left[tail] > j, byte[tail + j], np.uint64(0))
        order = np.argsort(word)
        fresh = np.r_[True, np.diff(word[order]) != 0][:n]
        rank = np.empty(n, dtype=np.int32)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        levels, h, longest = [(7, rank)], 7, int(left.max(initial=0))
        # members of groups of two and more, in order
        open_ = order[~(fresh & np.r_[fresh[1:], True])]
        while h < longest and len(open_):
            old = rank[open_].astype(np.int64)
            there = left[open_] > h
            second = np.where(there, rank[np.minimum(open_ + h, n - 1)].astype(np.int64) + 1, 0)
            key = old * (n + 1) + second
            by = np.argsort(key)
            open_, old, key = open_[by], old[by], key[by]
            place = np.arange(len(open_))
            group = np.maximum.accumulate(np.where(np.r_[True, np.diff(old) != 0], place, 0))
            fresh = np.r_[True, np.diff(key) != 0]
            same = np.maximum.accumulate(np.where(fresh, place, 0))
            rank = rank.copy()
            rank[open_] = old + same - group
            h *= 2
            levels.append((h, rank))
            open_ = open_[~(fresh & np.r_[fresh[1:], True])]
        # what is left open are equal suffixes
        place = rank.copy()
        by = np.lexsort((open_, rank[open_]))
        open_ = open_[by]
        at = np.arange(len(open_))
        place[open_] += (at - np.maximum.accumulate(np.where(np.r_[True, np.diff(rank[open_]) != 0][: len(at)], at, 0))).astype(np.int32)
        order = np.empty(n, dtype=np.int64)
        order[place] = np.arange(n)
        return order, levels

    def _common(self, i: np.ndarray, j: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Lengths of common prefixes of suffixes, within their strings."""
        most = np.minimum(self.ends[i] - i, self.ends[j] - j)
        got = np.zeros(len(i), dtype=np.int64)
        top = len(self.text) - 1
        for h, rank in reversed(levels):
            same = (got < most) & (rank[np.minimum(i + got, top)] == rank[np.minimum(j + got, top)])
            got[same] += h
        got = np.minimum(got, most)
        for _ in range(levels[0][0]):
            same = (got < most) & (self.text[np.minimum(i + got, top)] == self.text[np.minimum(j + got, top)])
            got[same] += 1
        return got

    def matching_statistics(self, twice: np.ndarray | None = None) -> np.ndarray:
        """For each position the longest string from there, within its string, that also starts elsewhere.

        Strings marked ``twice`` stand for two equal ones; a second copy would
        add no run, and matches the first to its end.
        """
        reach = np.arange(len(self.text))
        np.maximum.at(reach, self.head, self.head + self.common)
        np.maximum.at(reach, self.above, self.above + self.common)
        if twice is not None:
            both = self.starts[twice]
            reach[both] = self.ends[both]
        return np.maximum.accumulate(reach) - np.arange(len(self.text))


def marks(strings: list[bytes], twice: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of non-empty strings that lie in a repeated ``least``-byte string: string, start and end."""
    index = RunIndex(strings, least)
    statistic = index.matching_statistics(twice.astype(bool))
    cover = np.zeros(len(index.text) + 1, dtype=np.int64)
    hit = np.flatnonzero(statistic >= least)
    cover[hit] += 1
    np.add.at(cover, hit + statistic[hit], -1)
    bounds = np.r_[0, np.cumsum([len(s) for s in strings])]
    start, end = flat.runs(np.cumsum(cover[:-1]) > 0, bounds)
    which = flat.owner(start, bounds)
    return which, start - bounds[which], end - bounds[which]


MARKS = "anchor bigint, context bigint, start bigint, end bigint"


def index_marks(found: DataFrame, least: int) -> DataFrame:
    """Marks of contexts (anchor, context, twice, bytes), indexed by anchor in texts of about INDEX_BYTES."""

    def emit(rows):
        anchor = np.array([r[0] for r in rows], dtype=np.int64)
        context = np.array([r[1] for r in rows], dtype=np.int64)
        twice = np.array([r[2] for r in rows])
        other = np.r_[True, anchor[1:] != anchor[:-1]]
        # the only context of its anchor stands for two: it has no other partner, and its copy matches it to the end
        lone = np.flatnonzero(other & np.r_[other[1:], True] & twice)
        rest = np.setdiff1d(np.arange(len(rows)), lone)
        which, start, end = marks([rows[i][3] for i in rest], twice[rest], least) if len(rest) else (rest, rest, rest)
        which = np.r_[lone, rest[which]]
        start, end = np.r_[0 * lone, start], np.r_[[len(rows[i][3]) for i in lone], end].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor[which], context[which], start, end)], ["anchor", "context", "start", "end"])

    def run(batches):
        held, size = [], 0
        for batch in (b.slice(at, 2048) for b in batches for at in range(0, b.num_rows, 2048)):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and size > INDEX_BYTES and row[0] != held[-1][0]:
                    yield emit(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield emit(held)

    return found.repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(run, MARKS)


def crowd_marks(found: DataFrame, least: int) -> DataFrame:
    """Marks of contexts of crowded anchors: their windows, counted by hash."""

    def run(batches):
        for batch in batches:
            for anchor, context, twice, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                window = flat.SpanHashes(np.frombuffer(data, dtype=np.uint8)).windows(least).view(np.int64)
                n = len(window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, anchor)), pa.array(np.full(n, context)), pa.array(np.full(n, 1 + bool(twice))), pa.array(np.arange(n)), pa.array(window)],
                    ["anchor", "context", "n", "start", "window"],
                )

    windows = found.mapInArrow(run, "anchor bigint, context bigint, n bigint, start bigint, window bigint")
    windows = materialize(windows, "repeat-windows")
    often = windows.groupBy("anchor", "window").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    hit = windows.join(often, ["anchor", "window"], "left_semi")
    # the windows of one context overlap, so what they cover is one stretch
    return hit.groupBy("anchor", "context").agg(F.min("start").alias("start"), (F.max("start") + least).alias("end"))


def _cut(texts: DataFrame) -> DataFrame:
    """The bytes of the wanted contexts of each text (text, wanted)."""

    def run(batches):
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode()
                out += [(w["anchor"], w["context"], w["twice"], w["crowded"], raw[w["start"] : w["start"] + w["length"]]) for w in wanted]
                if len(out) > 4096:
                    yield table(out)
                    out = []
            if out:
                yield table(out)

    def table(rows):
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["anchor", "context", "twice", "crowded", "bytes"])

    return texts.mapInArrow(run, "anchor bigint, context bigint, twice boolean, crowded boolean, bytes binary")


def keyed(docs: DataFrame, text: Column) -> DataFrame:
    """The documents with a key of 127 bits of their text."""
    return docs.withColumn("text", F.coalesce(text.cast("string"), F.lit(""))).select(
        "*", F.xxhash64("text").alias("k1"), (F.crc32(F.col("text").cast("binary")) * F.lit(1 << 31) + F.octet_length("text")).alias("k2")
    )


def repeats(rows: DataFrame, least: int = LEAST, size: int = ANCHOR, crowd: int = CROWD, stretch: int = STRETCH) -> DataFrame:
    """(k1, k2, spans): for each text of ``rows`` (k1, k2, text) with repeated strings, the stretches they cover."""
    found = materialize(contexts(rows.select("k1", "k2", "text").filter(F.octet_length("text") >= least), least, size, stretch), "contexts")
    shared = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    # equal documents: one row with their number
    places = split_join(found, shared, "anchor", "left_semi").groupBy("k1", "k2", "start", "length", "anchor", "context").agg(F.count("*").alias("n"))
    places = materialize(places, "shared-contexts")
    kinds = places.groupBy("anchor", "context").agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "start", "length")).alias("at"))
    kinds = materialize(kinds, "context-kinds")
    crowds = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"))
    # an anchor with one kind of context repeats as a whole or not at all: index_marks marks it without the index
    wanted = (
        split_join(kinds, crowds, "anchor")
        .select("at.*", F.struct("anchor", "context", (F.col("n") > 1).alias("twice"), (F.col("kinds") > crowd).alias("crowded"), "at.start", "at.length").alias("w"))
        .groupBy("k1", "k2")
        .agg(F.collect_list("w").alias("wanted"))
    )
    cut = _cut(rows.join(wanted, ["k1", "k2"]).select("text", "wanted"))
    # equal documents give equal contexts: one stays
    bytes_ = materialize(cut.groupBy("anchor", "context", "twice", "crowded").agg(F.min("bytes").alias("bytes")), "context-bytes")
    plain = bytes_.filter("not crowded").select("anchor", "context", "twice", "bytes")
    crowded = bytes_.filter("crowded").select("anchor", "context", "twice", "bytes")
    marked = index_marks(plain, least).unionByName(crowd_marks(crowded, least))
    placed = places.join(marked.withColumnsRenamed({"start": "from", "end": "to"}), ["anchor", "context"])
    span = F.struct((F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end"))
    return placed.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def remove_repeats(docs: DataFrame, keep_text: bool = False, **options) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_text`` the kept bytes."""
    flat.few_rows_per_batch(docs.sparkSession)
    rows = keyed(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")), F.col("text"))
    spans = repeats(rows, **options)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, cover in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw, kept, at, runs, gone = (text or "").encode(), [], 0, 0, 0
                end = -1
                for s in cover or ():
                    if s["start"] > end:  # touching stretches are one run
                        runs += 1
                        kept.append(raw[at : s["start"]])
                        at = end = s["start"]
                    if s["end"] > end:
                        gone += s["end"] - max(end, s["start"])
                        at = end = s["end"]
                kept.append(raw[at:])
                rest = b"".join(kept)
                out.append((doc, len(raw), gone, runs, hashlib.sha256(rest).hexdigest(), rest)[: len(names)])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: len(names)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    joined = rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if keep_text else "")
    return joined.mapInArrow(run, schema)
