"""Packing: ids against the tokenizers library, gapless sequences, and bounds against an exact search."""

from __future__ import annotations

import itertools
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zoneday.llm import certified_packing as cp

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LIBRARY = public_tokenizers.path("byte_bpe_50k.json")


def optimum(lengths, size):
    """The fewest sequences, by trying all ways."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in sorted({r for r in rooms if r >= lengths[i]}):
            k = rooms.index(r)
            go(i + 1, rooms[:k] + [r - lengths[i]] + rooms[k + 1 :])
        go(i + 1, rooms + [size - lengths[i]])

    go(0, [])
    return best


def test_bounds_never_exceed_the_optimum():
    rng = random.Random(2)
    for _ in range(150):
        size = rng.choice([10, 24, 60])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(1, 8))]
        best = optimum(lengths, size)
        assert cp.lower_bound(np.array(lengths), size) <= best
        which, _ = cp.best_fit(np.array(lengths), size)
        assert best <= which.max() + 1


def test_bound_sees_big_pieces():
    assert cp.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert cp.lower_bound(np.array([4, 4, 4]), 10) == 2
    assert cp.lower_bound(np.array([], dtype=int), 10) == 0


def fits(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


@pytest.mark.parametrize("per_group", [7, 2048])
def test_pack(spark, per_group):
    rng = random.Random(3)
    rows = [(i if i % 9 else None, 0, 0, rng.choice([1, 3, 35, 36, 64, 65, 99, 100, 34, 33]), 1, i) for i in range(300)]
    pieces = spark.createDataFrame(rows, cp.PIECES)
    got = cp.pack(pieces, 100, per_group).collect()
    assert sorted(r.deal for r in got) == list(range(300))
    n = fits(got, 100)
    bound = cp.lower_bound(np.array([r[3] for r in rows]), 100)
    assert bound <= n <= bound + (2 if per_group > 300 else -(-300 // per_group))  # a partial sequence for each small group
    assert cp.pack(pieces.limit(0), 100).count() == 0


def test_ids(spark):
    rng = random.Random(4)
    signs = list("abc 's't\n\t.,1½é😀　́ÄΣ") + ["<|endoftext|>", "  ", "the ", "नम"]
    texts = [None, "", "x" * 9000, "word " * 2048, "hello <|endoftext|> world", "a" + " " * 1_000_000 + "b", "\n" * 60_000] + ["".join(rng.choices(signs, k=rng.randint(0, 80))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, deal string")
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = cp.best_fit_sequences(docs, RANKS, PATTERN, LIBRARY).orderBy("doc_id", "piece").collect()
    fits(rows, 2048)
    for doc, group in itertools.groupby(rows, key=lambda r: r.doc_id):
        ids = [*lib.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        at = 0
        group = list(group)
        for k, r in enumerate(group):
            assert (r.piece, r.start) == (k, at)
            part = ids[at : at + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert r.length == 2048 or k == 0
            at += r.length
        assert at == len(ids)
        assert len(group) == -(-len(ids) // 2048)


def test_one_text_in_many_rows(spark):
    docs = spark.range(500).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    got = cp.pack(cp.cut(docs, RANKS, PATTERN, LIBRARY), per_group=50).collect()
    assert len(got) == 500 and fits(got, 2048) <= 12


def test_rounds_go_on_while_they_gain(spark):
    rng = random.Random(4)
    rows = [(i, 0, 0, rng.choice([1, 3, 35, 36, 64, 65, 99, 34, 33, 20, 51]), 1, i) for i in range(1500)]
    got = cp.pack(spark.createDataFrame(rows, cp.PIECES), 100, 20).collect()
    assert sorted(r.deal for r in got) == list(range(1500))
    assert fits(got, 100) <= 660  # 662 where a round without a lower total is thrown away for all groups


def test_given_sequences_stay_unless_fewer_are_needed():
    pieces = dict(doc_id=1, piece=0, start=0, ids_crc32=1)
    given = [(6, 0, 0), (4, 0, 6), (5, 1, 0), (3, 1, 5), (2, 1, 8)]  # length, was, at
    kept = cp._pack(cp.pd.DataFrame([{**pieces, "length": n, "deal": i, "was": w, "at": a} for i, (n, w, a) in enumerate(given)]), 10)
    assert set(kept["made"]) == {2} and sorted(kept.loc[kept["offset"] > 0, "offset"]) == [5, 6, 8]
    wasted = [{**pieces, "length": 5, "deal": i, "was": i, "at": 0} for i in range(4)]
    assert set(cp._pack(cp.pd.DataFrame(wasted), 10)["made"]) == {2}
