"""Every stage against a plain version, over what its predecessor kept."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
from test_ownership import base
from test_trie_join import brute

from zoneday.llm import certified_packing, ftrl_toxicity


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "exact_dedup", "near_dedup", "secret_scan", "packing"]

    kept = stage["toxicity"](spark, docs, sf_dir)
    score = {r.doc_id: r.predicted for r in ftrl_toxicity.toxicity(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, p in score.items() if not p}

    docs = docs.cache()  # the next stages see all documents, so that each has work to do
    unique = stage["exact_dedup"](spark, docs, sf_dir)
    want = {}
    for r in docs.collect():
        want[r.text] = max(want.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(want.values())
    assert unique.schema == docs.schema and unique.count() < docs.count()

    near = stage["near_dedup"](spark, docs, sf_dir)
    want = sorted(d for d, _, c in brute([(r.doc_id, r.text) for r in docs.collect()]) if d == c)
    assert sorted(r.doc_id for r in near.collect()) == want
    assert near.schema == docs.schema and near.count() < docs.count()

    clean = stage["secret_scan"](spark, docs, sf_dir)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = clean.collect()
    assert clean.columns == docs.columns and len(rows) == len(texts)
    for r in rows:
        assert not base(r.text)
        if not base(texts[r.doc_id]) and "[REDACTED]" not in r.text:
            assert r.text == texts[r.doc_id]
        assert r.n_chars == len(r.text)
    assert any(base(t) for t in texts.values())


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= certified_packing.lower_bound(np.array([r.length for r in rows])) + 1
    assert 0 < len({r.doc_id for r in rows}) < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_odd_documents(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words in a text here", None, "s", 3), (3, "x" * 50_000, "en", None, 50_000), (3, "x" * 50_000, "en", None, 50_000)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == schema.names
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 2, 3]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
