"""Exact duplicates: against SQL, with forced collisions, and the directory's buckets."""

from __future__ import annotations

import hashlib
import random

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from zoneday.llm import extendible_index, queries


def brute(rows):
    by = {}
    for d, t in rows:
        by.setdefault(t or "", []).append(d)
    out = []
    for d, t in rows:
        same = by[t or ""]
        ids = [x for x in same if x is not None]
        keep = max(ids) if ids else None
        out.append((d, keep, len(same), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def make(spark, n=400):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, "", "hot", "hot", "hot", "hot ", f"text {rng.randrange(60)}", "é", "É"])) for i in range(n)]
    rows += [(7, "hot"), (None, "hot"), (None, "alone"), (None, None)]
    return rows, spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, bucket int")


@pytest.mark.parametrize("collide", [False, True])
def test_against_plain_grouping(spark, collide):
    rows, docs = make(spark)
    options = {"key": lambda t: F.pmod(F.length(t), F.lit(3)).cast("bigint")} if collide else {}
    got = extendible_index.exact_duplicates(docs, capacity=4, max_depth=6, **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_stage_keeps_columns(spark):
    rows, docs = make(spark)
    kept = extendible_index.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t in rows})  # one of each text, equal rows included
    assert extendible_index.drop_duplicates(docs.limit(0)).count() == 0


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    cells = extendible_index.directory(keys, capacity=100, max_depth=8)
    sizes = keys.withColumn("cell", extendible_index.prefix(F.col("key"), 8)).join(cells, "cell").groupBy("bucket", "depth").count().collect()
    assert sum(r["count"] for r in sizes) == 3000
    assert all(r["count"] <= 100 for r in sizes) and all(4 <= r.depth <= 8 for r in sizes)
    one = spark.range(50).select(F.lit(5).cast("bigint").alias("key"))
    assert extendible_index.directory(one, capacity=10, max_depth=4).first().depth == 4  # the rest is one chain


def test_chains_are_settled_by_owner_tasks(spark):
    # all texts on three keys: every key is one chain, its links are the different texts, counted whole
    rows = [(i, "hot" if i % 3 else f"t{i % 60:03d}") for i in range(900)]
    docs = spark.createDataFrame(rows, "id long, text string")
    index = extendible_index.build_index(docs, capacity=4, max_depth=6, key=lambda t: F.pmod(F.length(t), F.lit(3)).cast("bigint"))
    by = {}
    for i, t in rows:
        by.setdefault(t, []).append(i)
    got = index.collect()
    assert {r.sha: (r.n, r.keep_id) for r in got} == {hashlib.sha256(t.encode()).hexdigest(): (len(v), max(v)) for t, v in by.items()}
    for k in {r.key for r in got}:
        assert sorted(r.link for r in got if r.key == k) == list(range(1, 1 + sum(r.key == k for r in got)))
    assert len(got) == len(by)


def test_query_against_sql(spark, sf_dir):
    name = "op6_extendible_index"
    _, ok, note = compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert ok, note


def test_no_python_in_native_plans(spark, sf_dir):
    for name in ("op6_extendible_index", "op7_ownership"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
