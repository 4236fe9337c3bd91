"""Benchmark decontamination against a plain scan of every window."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from zoneday.llm import prefix_containment, queries


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in {len(k) for k in wins}:
                if tuple(w[i : i + n]) in wins and i + n <= len(w):
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i : i + n])]
        found = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def passage(rng, n, many=40):
    return [rng.choice(["ALPHA", "beta", "Größe", "naïve", "x9", "ÉTÉ", *(f"w{k}" for k in range(many))]) for _ in range(n)]


def case(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(passage(rng, rng.choice([1, 3, 4, 5, 9, 10, 11, 30])))) for i in range(30)]
    items += [(7, items[3][1]), (100, items[29][1]), (None, items[11][1]), (101, None), (102, "..!"), (103, "the the the the the the the the the the the the")]
    docs = []
    for d in range(120):
        w = passage(rng, rng.choice([0, 2, 12, 60]), 4)
        for _ in range(rng.randrange(3)):
            cut = words(rng.choice(items)[1])
            a = rng.randrange(len(cut) + 1)
            w[len(w) // 2 : len(w) // 2] = [t.upper() if t.isascii() else t for t in cut[a // 2 : len(cut) - a // 3]]
        docs.append((d, "  ".join(w) + rng.choice(["", ".", "\x00;"])))
    docs += [(5, docs[9][1]), (None, docs[9][1]), (500, None), (501, ""), (502, "the " * 25), (503, "-- " + items[29][1].replace(" ", ",\n"))]
    docs += [(600 + k, "copied " + items[28][1]) for k in range(40)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_every_window(spark, seed):
    docs, items = case(seed)
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, sha string, words string").repartition(5)
    b = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, win string")
    got = sorted((tuple(r) for r in prefix_containment.decontamination(d, b).collect()), key=str)
    assert got == brute(docs, items)
    assert sum(r[5] for r in got) > 40 and sum(not r[5] for r in got) > 5


def test_other_window_and_shingle(spark):
    docs, items = case(4)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = prefix_containment.contamination(d, b, window=6, shingle=2).select("doc_id", "n_words", "n_hit", "n_items").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((r[:4] for r in brute(docs, items, 6)), key=str)


def test_empty_tables_and_long_text(spark):
    d = spark.createDataFrame([(1, "a b c"), (2, "lead " + "common word " * 30_000 + " one two three four five six seven eight nine ten")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id int, text string")
    run = prefix_containment.decontamination
    assert run(d.limit(0), b).count() == 0
    assert [(r.n_hit, r.contaminated) for r in run(d, b.limit(0)).collect()] == [(0, False)] * 2
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in run(d, b).collect()) == [(1, 3, 0), (2, 60011, 10)]


def test_prefix_is_the_rarest_shingle_and_few_are_broadcast(spark):
    docs = spark.createDataFrame([(i, "a b c d e f") for i in range(5)] + [(9, "a b c d e f g h i j")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    windows, _ = prefix_containment.benchmark_windows(items)
    spans = prefix_containment.window_shingles(windows)
    places = prefix_containment.shingle_places(docs, spans)
    held = {r.h: r["count"] for r in places.groupBy("h").count().collect()}
    assert sorted(held.values()) == [1, 1, 1, 1, 2, 2]  # equal texts count once
    found, _ = prefix_containment.occurrences(docs, items)
    assert [(r.start, r.len) for r in found.collect()] == [(0, 10)]
    rows = docs.select(F.explode(F.array(F.lit(1).cast("bigint"))).alias("h"))
    plan = rows.join(spans.select("h").distinct(), "h")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_query_against_sql(spark, sf_dir):
    name = "op13_prefix_containment"
    _, ok, note = compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert ok, note
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
