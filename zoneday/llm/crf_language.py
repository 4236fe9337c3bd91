"""Language of documents: a linear-chain conditional random field over words.

Words are runs of letters.  Their features are affixes, character n-grams and
a lexicon of whole words, hashed into a fixed table; transitions between the
labels of adjacent words are learned with the weights.  Forward-backward over
a whole text gives each word's label probabilities; their mean over the words
is the document's distribution over languages.

Texts of any length are handled whole: forward-backward runs over blocks of
words in parallel, with one transfer matrix per block to chain the blocks of
a text.  Learning uses a bounded sample: at most ``SAMPLE_ROWS`` labelled rows
and of each at most ``SAMPLE_WINDOWS`` windows of words spread over its text.
Windows of two documents are joined into one training sequence, so the
transitions have seen switches of language.

Null texts and texts without a letter get ``und`` and score 0; ties go to the
label that sorts first; without any usable label all is ``und``.  Repeated
rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.llm import flat
from zoneday.llm.samples import labelled_sample, remainder

BITS = 18
BLOCK = 64
SAMPLE_ROWS, SAMPLE_WINDOWS, WINDOW = 2_000, 4, 32
UNKNOWN = "und"


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, word starts and ends, and the text of each word."""
    points, bounds = flat.code_points([t.lower() for t in texts])
    starts, ends = flat.runs(flat.classes()[points] == flat.LETTER, bounds)
    return points, starts, ends, flat.owner(starts, bounds)


def features(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of words, and the word of each: bigrams and trigrams with word edges, affixes of three letters, the word."""
    size = ends - starts + 2
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    inner = np.arange(len(word)) - first[word]
    edge = (inner == 0) | (inner == size[word] - 1)
    c = np.where(edge, 1 + (inner == 0), points[np.clip(starts[word] + inner - 1, 0, max(len(points) - 1, 0))] + 3).astype(np.uint64)
    c = flat.mix(c)
    room = size[word] - inner
    shift = np.uint64(64 - BITS)
    k = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]
    h2 = c[:-1] * k[0] + c[1:]
    h3 = h2[:-1] * k[1] + c[2:]
    h4 = h3[:-1] * k[2] + c[3:]
    ok2, ok3 = room[:-1] >= 2, room[:-2] >= 3
    ok4 = (room[:-3] >= 4) & ((inner[:-3] == 0) | (room[:-3] == 4))
    places = [(flat.mix(h) >> shift)[ok] for h, ok in ((h2, ok2), (h3, ok3), (h4, ok4))]
    owners = [word[: len(ok)][ok] for ok in (ok2, ok3, ok4)]
    places.append(flat.spans_hash(points, starts, ends) >> shift)
    owners.append(np.arange(len(size)))
    return np.concatenate(places).astype(np.int64), np.concatenate(owners)


def emissions(weights: np.ndarray, place: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """Summed weights of each word's features, by label."""
    return np.stack([np.bincount(word, weights=w[place], minlength=n) for w in weights.T], axis=1)


def potentials(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=1, keepdims=True))


def forward_backward(e: np.ndarray, sizes: np.ndarray, a: np.ndarray, pairs: bool = False):
    """Label probabilities of the words of many sequences laid end to end.

    ``e``: word potentials; ``sizes``: words of each sequence, at least one;
    ``a``: transition potentials.  With ``pairs`` also the expected transitions.
    """
    labels = e.shape[1]
    n_blocks = -(-sizes // BLOCK)
    seq = np.repeat(np.arange(len(sizes)), n_blocks)
    first_block = np.cumsum(n_blocks) - n_blocks
    k = np.arange(len(seq)) - first_block[seq]
    start = (np.cumsum(sizes) - sizes)[seq] + k * BLOCK
    size = np.minimum(BLOCK, sizes[seq] - k * BLOCK)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(int(size.max()))]  # blocks longer than t
    into, out = np.full((len(seq), labels), 1.0 / labels), np.ones((len(seq), labels))
    if n_blocks.max() > 1:
        carry = np.tile(np.eye(labels), (len(seq), 1, 1))
        for t, n in enumerate(live):
            carry[:n] = (carry[:n].reshape(n * labels, labels) @ a).reshape(n, labels, labels) * e[start[:n] + t][:, None, :]
            carry[:n] /= carry[:n].max(axis=(1, 2), keepdims=True)
        moved = np.empty_like(carry)
        moved[order] = carry
        long = np.argsort(-n_blocks, kind="stable")
        counts = n_blocks[long]
        for j in range(1, int(counts[0])):
            at = first_block[long[: np.searchsorted(-counts, -j, side="left")]] + j
            v = np.einsum("bi,bij->bj", into[at - 1], moved[at - 1])
            into[at] = v / v.sum(axis=1, keepdims=True)
        for j in range(int(counts[0]) - 1, 0, -1):
            at = first_block[long[: np.searchsorted(-counts, -j, side="left")]] + j
            v = np.einsum("bij,bj->bi", moved[at], out[at])
            out[at - 1] = v / v.sum(axis=1, keepdims=True)
    alpha, beta = np.empty_like(e), np.empty_like(e)
    v = into[order]
    for t, n in enumerate(live):
        at = start[:n] + t
        v[:n] = (v[:n] @ a) * e[at]
        v[:n] /= v[:n].sum(axis=1, keepdims=True)
        alpha[at] = v[:n]
    v = out[order]
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = start[:n] + t
        beta[at] = v[:n]
        v[:n] = (e[at] * v[:n]) @ a.T
        v[:n] /= v[:n].sum(axis=1, keepdims=True)
    post = alpha * beta
    post /= post.sum(axis=1, keepdims=True)
    if not pairs:
        return post
    inner = np.ones(len(e), dtype=bool)
    inner[np.cumsum(sizes) - sizes] = False
    at = np.flatnonzero(inner)
    right = e[at] * beta[at]
    right /= ((alpha[at - 1] @ a) * right).sum(axis=1, keepdims=True)
    return post, a * (alpha[at - 1].T @ right)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, 0), np.float32))
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Label, score, number of words and of switches between words' likeliest labels, for each text."""
        n_words = np.zeros(len(texts), dtype=np.int64)
        switches, score = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
        names = [UNKNOWN] * len(texts)
        points, starts, ends, text = words(texts)
        if not len(starts):
            return names, score, n_words, switches
        n_words = np.bincount(text, minlength=len(texts))
        if not self.labels:
            return names, score, n_words, switches
        _, first, inverse = np.unique(flat.spans_hash(points, starts, ends), return_index=True, return_inverse=True)
        place, word = features(points, starts[first], ends[first])
        e = potentials(emissions(self.weights, place, word, len(first)))[inverse]
        sizes = n_words[n_words > 0]
        post = forward_backward(e, sizes, np.exp(self.transitions))
        mean = np.stack([np.bincount(text, weights=p, minlength=len(texts)) for p in post.T], axis=1) / np.maximum(n_words, 1)[:, None]
        best = mean.argmax(axis=1)
        score = np.clip(mean.max(axis=1), 0, 1)
        top = post.argmax(axis=1)
        change = np.r_[False, (top[1:] != top[:-1]) & (text[1:] == text[:-1])]
        switches = np.bincount(text[change], minlength=len(texts))
        names = [self.labels[b] if n else UNKNOWN for b, n in zip(best, n_words, strict=True)]
        return names, score, n_words, switches


def train(windows: list[str], label: list[str], rounds: int = 30, rate: float = 0.3, decay: float = 1e-3, seed: int = 11) -> Model:
    """``windows``: texts of a few words, each wholly of its label."""
    if not windows:
        return Model([])
    labels = sorted(set(label))
    order = np.random.default_rng(seed).permutation(len(windows))
    points, starts, ends, text = words([windows[i] for i in order])
    target = np.array([labels.index(label[i]) for i in order])[text]
    n_words = np.bincount(text, minlength=len(order))
    joined = np.add.reduceat(n_words, np.arange(0, len(order), 2))  # two windows make one sequence
    sizes = joined[joined > 0]
    if not len(starts):
        return Model([])
    _, first, inverse = np.unique(flat.spans_hash(points, starts, ends), return_index=True, return_inverse=True)
    place, word = features(points, starts[first], ends[first])
    used, place = np.unique(place, return_inverse=True)
    w, a = np.zeros((len(used), len(labels))), np.zeros((len(labels), len(labels)))
    gw, ga = np.full_like(w, 1e-6), np.full_like(a, 1e-6)
    inner = np.ones(len(target), dtype=bool)
    inner[np.cumsum(sizes) - sizes] = False
    at = np.flatnonzero(inner)
    seen = np.zeros_like(a)
    np.add.at(seen, (target[at - 1], target[at]), 1)
    for _ in range(rounds):
        e = potentials(emissions(w, place, word, len(first)))[inverse]
        post, moved = forward_backward(e, sizes, np.exp(a), pairs=True)
        miss = -post
        miss[np.arange(len(target)), target] += 1
        by_word = np.stack([np.bincount(inverse, weights=m, minlength=len(first)) for m in miss.T], axis=1)
        g = np.stack([np.bincount(place, weights=b[word], minlength=len(used)) for b in by_word.T], axis=1) - decay * w * len(target) / len(used)
        gw += g * g
        w += rate * g / np.sqrt(gw)
        g = seen - moved
        ga += g * g
        a += rate * g / np.sqrt(ga)
    full = np.zeros((1 << BITS, len(labels)), np.float32)
    full[used] = w
    return Model(labels, full, a)


def fit(docs: DataFrame, labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most ``rows`` of ``labelled`` (doc_id, label)."""

    def run(batches):
        for batch, texts, _ in flat.text_rows(batches, "text"):
            points, starts, ends, text = words(texts)
            edge = np.searchsorted(text, np.arange(len(texts) + 1))
            whole, out = points.tobytes(), []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                last = max(b - WINDOW, a)
                pick = np.unique(np.linspace(a, last, min(SAMPLE_WINDOWS, max(1, (b - a) // WINDOW))).astype(int)) if b > a else []
                out.append([whole[4 * starts[i] : 4 * ends[min(i + WINDOW, b) - 1]].decode("utf-32-le", "replace") for i in pick])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.string()))], ["doc_id", "label", "windows"])

    sample = labelled_sample(docs, labelled.select("doc_id", F.col("label").cast("string").alias("label")), rows)
    got = sample.mapInArrow(run, "doc_id bigint, label string, windows array<string>").toPandas().sort_values("doc_id", kind="stable")
    pairs = [(w, y) for y, ws in zip(got["label"], got["windows"], strict=True) for w in ws]
    return train([w for w, _ in pairs], [y for _, y in pairs])


def language(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, n_words, n_switches."""
    labelled = docs.filter(remainder(F.col("doc_id"), 3) != 1).select("doc_id", F.col("lang").alias("label"))
    model = fit(docs, labelled, rows)

    def run(batches):
        for batch, texts, _ in flat.text_rows(batches, "text"):
            names, score, n_words, switches = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(n_words, pa.int64()), pa.array(switches, pa.int64())],
                ["doc_id", "lang_pred", "score", "n_words", "n_switches"],
            )

    schema = "doc_id bigint, lang_pred string, score double, n_words bigint, n_switches bigint"
    got = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    return got.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
