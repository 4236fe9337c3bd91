"""Jaccard components against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from zoneday.llm import flat, graph, queries, trie_join


def shingles(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(docs, k=5):
    sets = [shingles(t, k) for _, t in docs]
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            label[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted((d if d is not None else -1, len(sets[i]), least.get(find(i), -1)) for i, (d, _) in enumerate(docs))


def result(df):
    return sorted(tuple(-1 if x is None else x for x in (r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def near(rng, n):
    vocab = [f"w{i}" for i in range(60)]
    docs = [None, "", " \t\n", "One two", "one TWO", "one two three four five", "é\xa0x y", "É\xa0x y"]
    base = rng.choices(vocab, k=80)
    for _ in range(n):
        if rng.random() < 0.3:
            base = rng.choices(vocab, k=rng.randint(3, 90))
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        docs.append(" ".join(words))
    rows = [(i + 1, t) for i, t in enumerate(docs)]
    return rows + [(None, docs[-1]), (None, None), (5, docs[9]), (5, docs[9])]


@pytest.mark.parametrize(("block", "few"), [(4, 2), (4, 5), (256, 32)])
def test_against_all_pairs(spark, block, few):
    docs = near(random.Random(block + few), 150)
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, node string")
    assert result(trie_join.near_duplicates(df, block=block, few=few)) == brute(docs)


def test_large_group_in_blocks(spark):
    rng = random.Random(8)
    base = [f"v{i}" for i in range(120)]
    docs = []
    for i in range(90):  # some near the base, some at the edge, some linked over others only
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"u{rng.randrange(40)}"
        docs.append((i + 1, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(trie_join.near_duplicates(df, block=8, few=4)) == brute(docs)


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(queries.QUERIES["op9_trie_join"](spark, sf_dir)) == brute(docs)


def test_words_that_meet_modulo_a_power_of_two(spark):
    a, b = ("".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(1024)) for swap in (0, 1))
    rows = [(1, f"one two {a} four five"), (2, f"one two {b} four five"), (3, f"one two {a.upper()}\tfour five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(trie_join.near_duplicates(docs)) == [(1, 1, 1), (2, 1, 2), (3, 1, 1)]


def test_keep_one_of_equal_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, text + " more"), (2, text), (1, "other words that link with none of these"), (None, ""), (None, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text[:5]) for r in trie_join.keep_one(docs).collect()), key=str)
    assert got == [(1, "other"), (1, "w0 w1"), (4, ""), (None, "")]


def test_no_rows(spark):
    assert trie_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_trie_pairs():
    rng = random.Random(3)
    rows = [np.array(sorted(rng.sample(range(30), rng.randint(1, 20)))) for _ in range(60)]
    got = set(trie_join.Trie(rows).pairs(rows, 30, 50))
    want = set()
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            n = len(set(a) & set(b))
            if 100 * n >= 50 * (len(a) + len(b) - n):
                want.add((i, j))
    assert got == want


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_sets_of_many_texts_need_little_memory(monkeypatch):
    """Texts are hashed a few at a time: the same sets, by short tables of powers; one long text is hashed whole."""
    monkeypatch.setattr(flat, "_field", {})
    texts = [b"", b"one two", *(b" ".join(b"w%d" % (i * j % 97) for j in range(40 + i)) for i in range(900)), b"", b"last one of all these texts"]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    assert len(data) > 4 * trie_join.PIECE
    h, t = trie_join.shingle_sets(data, bounds)
    assert sum(p.nbytes for p in flat._field.values()) < 1 << 24
    edge = np.searchsorted(t, np.arange(len(texts) + 1))
    assert (np.diff(t) >= 0).all() and edge[-1] == len(h)
    for i in (0, 1, 2, 300, 700, 901, 902, len(texts) - 1):
        alone, _ = trie_join.shingle_sets(np.frombuffer(texts[i], dtype=np.uint8), np.array([0, len(texts[i])]))
        assert alone.tolist() == h[edge[i] : edge[i + 1]].tolist()
    long = np.frombuffer(b"a b c d e f g " * 100_000, dtype=np.uint8)
    assert len(trie_join.shingle_sets(long, np.array([0, len(long)]))[0]) == 7
