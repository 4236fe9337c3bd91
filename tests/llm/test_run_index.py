"""Repeated strings against a count of all windows."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zoneday.llm import queries, run_index


def brute(texts, least):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + least] for r in raw for i in range(len(r) - least + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), dtype=bool)
        for i in range(len(r) - least + 1):
            if seen[r[i : i + least]] > 1:
                gone[i : i + least] = True
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=40), min_size=1, max_size=6))
def test_matching_statistics(strings):
    double = [s.encode() for s in strings[:1]]
    index = run_index.RunIndex(double)
    assert list(index.matching_statistics(np.array([True]))) == list(run_index.RunIndex(double * 2).matching_statistics()[: len(double[0])])
    strings = [s.encode() for s in strings]
    index = run_index.RunIndex(strings)
    got, at = index.matching_statistics(), 0
    assert index.run_size.sum() == len(index.text)
    everywhere = [(k, i) for k, s in enumerate(strings) for i in range(len(s))]
    for k, s in enumerate(strings):
        for i in range(len(s)):
            best = 0
            for k2, j in everywhere:
                if (k2, j) != (k, i):
                    n = 0
                    while i + n < len(s) and j + n < len(strings[k2]) and s[i + n] == strings[k2][j + n]:
                        n += 1
                    best = max(best, n)
            assert got[at] == best
            at += 1


def repetitive(rng, n):
    shared = ["".join(rng.choices("abcdé ", k=rng.randint(15, 90))) for _ in range(8)]
    texts = [None, "", "x", "ab" * 60, "z" * 500]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 6)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s))
            parts.append(s[a:] if rng.random() < 0.5 else "".join(rng.choices("abcdé ", k=rng.randint(1, 60))))
        texts.append("".join(parts))
    return texts + texts[8:12]


@pytest.mark.parametrize("crowd", [1, 1000])
def test_against_all_windows(spark, crowd):
    texts = repetitive(random.Random(1), 120)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, k1 int")
    got = result(run_index.remove_repeats(docs, least=24, size=8, crowd=crowd))
    want = brute(texts, 24)
    for i in range(len(texts)):
        assert got[i] == want[i], (i, texts[i])
    assert sum(w[1] > 0 for w in want) > 50


def test_long_texts_in_stretches(spark):
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdefgh", k=300))
    texts = ["".join(rng.choices("abcdefgh", k=900)) + passage + "".join(rng.choices("abcdefgh", k=700)), passage, passage[50:290]]
    want = brute(texts, 100)
    for i, t in enumerate(texts):  # each row in a partition, so a chunk, of its own
        part = spark.createDataFrame([(i, t)], "doc_id long, text string")
        docs = part if not i else docs.union(part)
    got = result(run_index.remove_repeats(docs, least=100, size=40, stretch=256))
    assert [got[i] for i in range(3)] == want


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = result(queries.QUERIES["op3_run_index"](spark, sf_dir))
    assert [got[r.doc_id] for r in docs] == brute([r.text for r in docs], 200)


def test_repeated_rows_and_nulls(spark):
    text = "".join(random.Random(7).choices("abcdefgh", k=300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, None)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in run_index.remove_repeats(docs).collect())
    assert rows == [(0, 300, 1), (1, 300, 1), (1, 300, 1), (2, 0, 0)]
    assert run_index.remove_repeats(docs.limit(0)).count() == 0
