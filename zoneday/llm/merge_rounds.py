"""BPE encoding and decoding by batched merge rounds.

The different words of many texts lie side by side in one flat array of
symbols.  A round finds the rank of each adjacent pair by binary search over
the sorted pair keys, takes the lowest rank of each word and merges it there;
words without a pair that can merge leave the array.  Rounds go on until the
array is empty.  Which words are equal is decided by their letters.

Null text counts as empty; an empty text has no ids and decodes to nothing.
Repeated rows give repeated results, other columns are not read.  A text of
any length is handled whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.llm import flat

CACHED_WORDS = 200_000
NONE = np.int64(1 << 40)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in keep}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return [out[b] for b in range(256)]


class WordBpe:
    """A word-end BPE vocabulary file: lower-cased words, digits one by one, runs of signs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, model = spec["model"]["vocab"], spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.names = np.full(self.size, "", dtype=object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = token
        end = model["end_of_word_suffix"]
        chars = byte_symbols()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + end] for c in chars], dtype=np.int64)
        left = np.array([vocab[a] for a, _ in model["merges"]], dtype=np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int64)
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        # A merge whose product also takes part in an earlier merge is applied one place at a time.
        lowest = np.full(self.size, NONE)
        np.minimum.at(lowest, left, np.arange(len(left)))
        np.minimum.at(lowest, right, np.arange(len(left)))
        self.alone = lowest[made] < np.arange(len(made))
        self.splitter = re.compile("|".join(f"({re.escape(s)})" for s in self.special)) if self.special else None
        self.cache: dict[bytes, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.cache.clear()
        self.counts: list[int] = []
        self.ids: list[str] = []
        self.tokens: list[str] = []

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, NONE where they never merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each non-empty word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(sizes)
        sym = self.inner[data]
        sym[ends - 1] = self.final[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        pair = np.full(len(sym), NONE)
        same = word[:-1] == word[1:]
        pair[:-1][same] = self.rank(sym[:-1][same], sym[1:][same])
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(pair, starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            live = np.repeat(lowest < NONE, sizes)
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                sym, word, pair = sym[live], word[live], pair[live]
                sizes, lowest = sizes[lowest < NONE], lowest[lowest < NONE]
                if not len(sym):
                    break
            hit = np.flatnonzero(pair == np.repeat(lowest, sizes))
            w = word[hit]
            # leftmost first: of touching hits every second one, of delicate merges the first of the word
            fresh = np.r_[True, (np.diff(hit) > 1) | (w[1:] != w[:-1])]
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            keep = (np.arange(len(hit)) - run_start) % 2 == 0
            keep &= ~self.alone[pair[hit]] | np.r_[True, w[1:] != w[:-1]]
            hit = hit[keep]
            sym[hit] = self.made[pair[hit]]
            stay = np.ones(len(sym), dtype=bool)
            stay[hit + 1] = False
            at = (np.cumsum(stay) - 1)[hit]
            sym, word, pair = sym[stay], word[stay], pair[stay]
            touched = np.unique(np.r_[at, at[at > 0] - 1])
            nxt = np.minimum(touched + 1, len(sym) - 1)
            fits = (nxt > touched) & (word[nxt] == word[touched])
            pair[touched] = NONE
            t = touched[fits]
            pair[t] = self.rank(sym[t], sym[t + 1])
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym = sym[order]
        cuts = np.cumsum(np.bincount(word, minlength=len(words)))[:-1]
        return np.split(sym, cuts)

    def segments(self, text: str) -> list[str | int]:
        """The text cut at the vocabulary's own special strings; those as ids, the rest normalised."""
        parts = self.splitter.split(text) if self.splitter and "<" in text else [text]
        out: list[str | int] = []
        for p in parts:
            if p in self.special:
                out.append(self.special[p])
            elif p:
                if not p.isascii():
                    p = unicodedata.normalize("NFC", p).replace("Σ", "σ")
                out.append(p.lower())
        return out

    def words(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word spans: letter runs, single numbers, runs of other signs, and English clitics."""
        kind = flat.classes()[points]
        solid = kind != flat.SPACE
        first = solid.copy()
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == flat.NUMBER)
        edge = bounds[1:-1]
        first[edge[edge < len(kind)]] = solid[edge[edge < len(kind)]]
        starts = np.flatnonzero(first)
        brk = np.r_[np.flatnonzero(first | ~solid), len(kind)]
        ends = brk[np.searchsorted(brk, starts, side="right")]
        text = flat.owner(starts, bounds)
        tick = np.flatnonzero((points[starts] == 39) & (ends - starts == 1))
        tick = tick[tick + 1 < len(starts)]
        tick = tick[(starts[tick + 1] == ends[tick]) & (text[tick + 1] == text[tick])]
        a = points[starts[tick] + 1]
        long = ends[tick + 1] - starts[tick + 1] > 1
        b = np.where(long, points[np.minimum(starts[tick] + 2, len(points) - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
        take = np.where(one, 1, np.where(two, 2, 0))
        ends[tick] += take
        starts[tick + 1] += take
        keep = starts < ends
        return starts[keep], ends[keep]

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """For each text: number of ids, the ids and the decoded text."""
        plain: list[str] = []
        layout: list[list[tuple[int, int]]] = []  # per text: (segment, -1) or (-1, special id)
        for t in texts:
            row = []
            for s in self.segments(t):
                if isinstance(s, int):
                    row.append((-1, s))
                else:
                    row.append((len(plain), -1))
                    plain.append(s)
            layout.append(row)
        points, bounds = flat.code_points(plain)
        if len(points):
            starts, ends = self.words(points, bounds)
            first, inverse = self._different(points, starts, ends)
            where = self._known(points, starts[first], ends[first])
            counts = np.array([self.counts[i] for i in where], dtype=np.int64)
            ids = np.array([self.ids[i] for i in where], dtype=object)
            tokens = np.array([self.tokens[i] for i in where], dtype=object)
            cuts = np.searchsorted(starts, bounds)
        for row in layout:
            n, id_parts, token_parts = 0, [], []
            for segment, special in row:
                if segment < 0:
                    n += 1
                    id_parts.append(str(special))
                    token_parts.append(self.names[special])
                else:
                    at = inverse[cuts[segment] : cuts[segment + 1]]
                    n += int(counts[at].sum())
                    id_parts.extend(ids[at].tolist())
                    token_parts.extend(tokens[at].tolist())
            yield n, " ".join(id_parts), " ".join(token_parts)

    def _different(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of each kind of word, and the kind of each; words that meet by hash are compared letter by letter."""
        _, first, inverse = np.unique(flat.spans_hash(points, starts, ends), return_index=True, return_inverse=True)
        if not flat.equal_spans(points, starts, ends, first[inverse]).all():
            kinds: dict[bytes, int] = {}
            inverse = np.array([kinds.setdefault(points[a:b].tobytes(), len(kinds)) for a, b in zip(starts, ends, strict=True)])
            first = np.unique(inverse, return_index=True)[1]
        return first, inverse

    def _known(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[int]:
        if len(self.cache) > CACHED_WORDS:
            self._forget()
        whole = points.tobytes()
        keys = [whole[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        new = [k for k in keys if k not in self.cache]
        if new:
            words = [k.decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass") for k in new]
            for k, got in zip(new, self.merge(words), strict=True):
                self.cache[k] = len(self.counts)
                self.counts.append(len(got))
                self.ids.append(" ".join(map(str, got.tolist())))
                self.tokens.append(" ".join(self.names[got].tolist()))
        return [self.cache[k] for k in keys]


@cache
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: n_tokens, ids (decimal, joined by blanks) hashed, and the decoded text hashed.

    ``vocabulary`` is the file's path on every executor.  Each row is worked
    on where it is read; nothing is shuffled.
    """

    def run(batches):
        bpe = load(vocabulary)
        for batch, texts, _ in flat.text_rows(batches, "text"):
            rows = [
                (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                for n, ids, back in bpe.encode(texts)
            ]
            n, ids, back = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
