"""Quality scores: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks of ``CHUNK`` bytes that
share WIDTH - 1 bytes, so that each window of WIDTH bytes of the whole text
lies in exactly one chunk.  Bytes are embedded, learned filters run over each
chunk and are max-pooled within it; the mean over all chunks of a text goes
through one logistic unit.

Learning uses a bounded sample: at most ``SAMPLE_ROWS`` labelled rows, and of
each of these at most ``SAMPLE_CHUNKS`` chunks spread over its whole text.
Scoring reads every chunk of every text where it lies and shuffles nothing.
Null and empty texts are one chunk of padding.  Null labels teach nothing;
without any usable label every score is 0.5.  Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.llm import flat
from zoneday.llm.samples import labelled_sample, remainder

CHUNK, WIDTH, DIM, FILTERS = 256, 8, 6, 16
STEP = CHUNK - WIDTH + 1
SAMPLE_ROWS, SAMPLE_CHUNKS = 4_000, 8
THRESHOLD = 0.3
AT_ONCE = 2048


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in a row (with padding behind), and for each chunk its start, its end and its text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw) + bytes(CHUNK), dtype=np.uint8)
    first = np.cumsum(sizes) - sizes
    n = np.maximum(1, -(-(sizes - WIDTH + 1) // STEP))
    text = np.repeat(np.arange(len(texts)), n)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = first[text] + k * STEP
    return data, np.stack([start, (first + sizes)[text]], axis=1), text


def gather(data: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """The bytes of chunks as rows; 0 beyond a text's end."""
    at = spans[:, :1] + np.arange(CHUNK)
    return np.where(at < spans[:, 1:], data[np.minimum(at, len(data) - 1)], 0)


@dataclass
class Net:
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # WIDTH * DIM x FILTERS
    shift: np.ndarray  # FILTERS
    out: np.ndarray  # FILTERS
    bias: np.ndarray  # 1

    @classmethod
    def fresh(cls, seed: int = 5) -> Net:
        r = np.random.default_rng(seed)
        f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        return cls(f(256, DIM, scale=0.5), f(WIDTH * DIM, FILTERS, scale=0.25), f(FILTERS, scale=0.01), f(FILTERS, scale=0.1), np.zeros(1, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.out, self.bias]

    def convolve(self, x: np.ndarray) -> np.ndarray:
        """Filter values of chunks (n x CHUNK bytes): n x STEP x FILTERS."""
        e = self.embed[x].reshape(len(x), CHUNK * DIM)
        s = e.strides
        windows = np.lib.stride_tricks.as_strided(e, (len(x), STEP, WIDTH * DIM), (s[0], DIM * s[1], s[1]))
        return (np.ascontiguousarray(windows).reshape(-1, WIDTH * DIM) @ self.filters).reshape(len(x), STEP, FILTERS)

    def pooled(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self.convolve(x).max(axis=1) + self.shift, 0)

    def score(self, texts: list[str]) -> np.ndarray:
        data, spans, text = cut(texts)
        sums = np.zeros((len(texts), FILTERS))
        for i in range(0, len(spans), AT_ONCE):
            got = self.pooled(gather(data, spans[i : i + AT_ONCE]))
            np.add.at(sums, text[i : i + AT_ONCE], got)
        mean = sums / np.bincount(text, minlength=len(texts))[:, None]
        return sigmoid(mean @ self.out + self.bias[0])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def gradients(net: Net, x: np.ndarray, doc: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the log loss summed over documents; ``doc`` is the document of each chunk of ``x``."""
    conv = net.convolve(x)
    top = conv.argmax(axis=1)
    raw = np.take_along_axis(conv, top[:, None, :], axis=1)[:, 0, :] + net.shift
    pooled = np.maximum(raw, 0)
    n = np.bincount(doc, minlength=len(y))
    mean = np.zeros((len(y), FILTERS), np.float32)
    np.add.at(mean, doc, pooled)
    mean /= n[:, None]
    d = (sigmoid(mean @ net.out + net.bias[0]) - y).astype(np.float32)
    g = (d / n)[doc][:, None] * net.out * (raw > 0)  # chunk x filter
    bytes_at = x[np.arange(len(x))[:, None, None], top[:, :, None] + np.arange(WIDTH)]  # chunk x filter x WIDTH
    vectors = net.embed[bytes_at].reshape(len(x), FILTERS, WIDTH * DIM)
    d_filters = np.einsum("cf,cfi->if", g, vectors)
    back = (g[:, :, None] * net.filters.T[None]).reshape(-1, DIM)
    d_embed = np.stack([np.bincount(bytes_at.ravel(), weights=back[:, j], minlength=256) for j in range(DIM)], axis=1)
    return [d_embed, d_filters, g.sum(axis=0), d @ mean, d.sum(keepdims=True)]


def train(chunks: np.ndarray, doc: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 48, rate: float = 0.01, seed: int = 3) -> Net:
    """Adam over whole documents; ``doc`` ascends."""
    net = Net.fresh()
    if not len(y):
        net.out[:] = 0
        return net
    rng = np.random.default_rng(seed)
    m = [np.zeros_like(p) for p in net.parts()]
    v = [np.zeros_like(p) for p in net.parts()]
    first = np.searchsorted(doc, np.arange(len(y) + 1))
    step = 0
    net.bias[0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    steps = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            sizes = first[pick + 1] - first[pick]
            rows = np.repeat(first[pick] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            step += 1
            pace = rate * (1 - 0.9 * step / steps)
            for p, g, a, b in zip(net.parts(), gradients(net, chunks[rows], np.repeat(np.arange(len(pick)), sizes), y[pick]), m, v, strict=True):
                g = g / len(pick)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= (pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Net:
    """Learns from at most ``rows`` of ``labelled`` (doc_id, label 0/1)."""

    def run(batches):
        for batch, texts, _ in flat.text_rows(batches, "text"):
            data, spans, text = cut(texts)
            edge = np.searchsorted(text, np.arange(len(texts) + 1))
            out = []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                pick = np.unique(np.linspace(a, b - 1, min(SAMPLE_CHUNKS, b - a)).astype(int))
                out.append(gather(data, spans[pick]).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "label", "chunks"])

    sample = labelled_sample(docs, labelled.select("doc_id", F.col("label").cast("int").alias("label")), rows)
    got = sample.mapInArrow(run, "doc_id bigint, label int, chunks binary").toPandas().sort_values("doc_id", kind="stable")
    parts = [np.frombuffer(c, dtype=np.uint8).reshape(-1, CHUNK) for c in got["chunks"]]
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts]) if parts else np.zeros(0, int)
    return train(np.concatenate(parts) if parts else np.zeros((0, CHUNK), np.uint8), doc, got["label"].to_numpy(dtype=np.float32))


def quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    usable = labels.filter(remainder(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    net = fit(docs, usable, rows)

    def run(batches):
        for batch, texts, _ in flat.text_rows(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.score(texts), pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, score double"
    )
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
