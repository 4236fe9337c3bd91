"""Word BPE against the tokenizers library, ids and decoded text."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from zoneday.llm import merge_rounds, queries

PATH = public_tokenizers.path("word_bpe_49k.json")

EDGE = [
    None, "", "a", "'s", "it's 'twas we'll you're I'd 'REAL'm", "''s don''t", " <|endoftext|>x<|startoftext|><|endoftext|", "ΑΣ ΟΔΟΣ İstanbul ǅ",
    "é Å ﬁ", "\x1c\x85 a　b", "123 4½٣", "=====aaaaaaaaa", "a" * 5000, "😀👨‍👩‍👧 नमस्ते", "'", " '", "\n's", "abc " * 20_000,
]


def want(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))


def test_edges_and_random_texts(spark):
    rng = random.Random(1)
    alphabet = [*"ab'slret vmd1½́éΣσ \n😀", "<|endoftext|>", "ing", "the"]
    texts = EDGE + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(2000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    lib = Tokenizer.from_file(PATH)
    for r in merge_rounds.encode_documents(docs, PATH).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(lib, texts[r.doc_id]), texts[r.doc_id]
    assert merge_rounds.encode_documents(docs.limit(0), PATH).count() == 0


def test_whole_table(spark, sf_dir):
    lib = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.QUERIES["op5_merge_rounds"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(lib, texts[r.doc_id])


def thue_morse(n, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


def test_words_that_meet_by_hash(spark):
    # such words have equal polynomial hashes modulo a power of two, whatever the base
    a, b = thue_morse(1024), thue_morse(1024, True)
    docs = spark.createDataFrame([(0, a), (1, b), (2, f"{a} {b}, {a}"), (3, f"{b} x")], "doc_id long, text string").coalesce(1)
    lib = Tokenizer.from_file(PATH)
    for r in merge_rounds.encode_documents(docs, PATH).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(lib, docs.filter(f"doc_id = {r.doc_id}").first().text)


def test_cache_is_forgotten_when_full(monkeypatch):
    monkeypatch.setattr(merge_rounds, "CACHED_WORDS", 3)
    bpe, lib = merge_rounds.WordBpe(PATH), Tokenizer.from_file(PATH)
    for text in ("one two three four", "five six", "one two seven", "eight"):
        assert [i for _, i, _ in bpe.encode([text])] == [" ".join(map(str, lib.encode(text, add_special_tokens=False).ids))]
        assert len(bpe.cache) <= 8
