"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the presence of its lower-case words, word pairs, and
pairs with one word skipped, hashed into 2**20 places.  FTRL-proximal learns
one weight per place with a rate of its own; its L1 term leaves most at zero,
so what reaches the tasks is a short list of places and weights.

Learning uses a bounded sample of labelled rows (``SAMPLE_ROWS``); as it goes
row by row, one task does it, and only the weights reach the driver.  Scoring
reads every whole text where it lies and shuffles nothing.  Null and empty
texts get the score of the bias alone.  Null labels teach nothing; where a
document has several labels the smallest counts; without any usable label
every score is 0.  Repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.llm import flat
from zoneday.llm.samples import labelled_sample, remainder

BITS = 20
SAMPLE_ROWS = 8_000
THRESHOLD = 0.3


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of all texts, and the text of each; a place may repeat."""
    points, bounds = flat.code_points([t.lower() for t in texts])
    kind = flat.classes()[points]
    starts, ends = flat.runs((kind == flat.LETTER) | (kind == flat.NUMBER), bounds)
    word = flat.spans_hash(points, starts, ends)
    text = flat.owner(starts, bounds)
    shift = np.uint64(64 - BITS)
    places, owners = [word >> shift], [text]
    for gap, salt in ((1, 0xA0761D6478BD642F), (2, 0xE7037ED1A0B428DB)):
        if len(word) > gap:
            same = text[:-gap] == text[gap:]
            pair = flat.mix(word[:-gap] * np.uint64(salt) + word[gap:])
            places.append((pair >> shift)[same])
            owners.append(text[gap:][same])
    return np.concatenate(places).astype(np.int64), np.concatenate(owners)


@dataclass
class Ftrl:
    """Per-coordinate FTRL-proximal for binary features."""

    size: int
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.1

    def __post_init__(self) -> None:
        self.z = np.zeros(self.size)
        self.n = np.zeros(self.size)

    def weights(self, at: np.ndarray, free: bool = False) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = 0.0 if free else self.l1
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: float) -> None:
        """One example; its last place is the bias, which has no L1 term."""
        w = self.weights(at)
        w[-1] = self.weights(at[-1:], free=True)[0]
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    bias: float
    places: np.ndarray
    values: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.places):
            return np.full(len(texts), sigmoid(self.bias))
        table = np.zeros(1 << BITS, dtype=bool)
        table[self.places] = True
        place, text = features(texts)
        live = table[place]
        pair = np.unique(text[live] * (1 << BITS) + place[live])
        got = np.searchsorted(self.places, pair % (1 << BITS))
        return sigmoid(self.bias + np.bincount(pair >> BITS, weights=self.values[got], minlength=len(texts)))


def train(examples: list[tuple[int, np.ndarray]], epochs: int = 6, seed: int = 7) -> Model:
    """``examples``: (label, sorted places).  Places met in one example only can't generalise and are left out."""
    if not examples:
        return Model(-40.0, np.zeros(0, np.int64), np.zeros(0))
    counts = np.zeros(1 << BITS, dtype=np.int32)
    for _, places in examples:
        counts[places] += 1
    used = np.flatnonzero(counts > 1)
    number = np.full(1 << BITS, -1, dtype=np.int32)
    number[used] = np.arange(len(used))
    ends = np.cumsum([np.count_nonzero(counts[places] > 1) + 1 for _, places in examples])
    local = np.full(ends[-1], len(used), dtype=np.int32)  # all examples in one array; the last place of each is the bias
    starts = np.append(0, ends[:-1])
    for (_, places), a, b in zip(examples, starts, ends, strict=True):
        local[a : b - 1] = number[places[counts[places] > 1]]
    ftrl, rng = Ftrl(len(used) + 1), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            ftrl.learn(local[starts[i] : ends[i]], float(examples[i][0]))
    w = ftrl.weights(np.arange(len(used)))
    live = np.flatnonzero(w)
    return Model(float(ftrl.weights(np.array([len(used)]), free=True)[0]), used[live], w[live])


def fit(docs: DataFrame, labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most ``rows`` of ``labelled`` (doc_id, label 0/1).

    Tasks extract the features, one task learns from them; the driver gets a
    row with the model, whatever the size of the sample.
    """

    def run(batches):
        for batch, texts, _ in flat.text_rows(batches, "text"):
            place, text = features(texts)
            pair = np.unique(text * (1 << BITS) + place)
            cuts = np.searchsorted(pair >> BITS, np.arange(len(texts) + 1))
            place = (pair % (1 << BITS)).astype(np.uint32)
            sets = [place[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["doc_id", "label", "places"])

    def learn(batches):
        examples = [(y, np.frombuffer(p.as_buffer(), dtype=np.uint32)) for b in batches for y, p in zip(b.column(1).to_pylist(), b.column(2), strict=True)]
        model = train(examples)
        parts = [model.places.astype(np.int64).tobytes(), model.values.astype(np.float64).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([model.bias], pa.float64()), *(pa.array([x], pa.binary()) for x in parts)], ["bias", "places", "values"])

    sample = labelled_sample(docs, labelled.select("doc_id", F.col("label").cast("int").alias("label")), rows)
    sets = sample.mapInArrow(run, "doc_id bigint, label int, places binary").repartition(1).sortWithinPartitions("doc_id")
    made = sets.mapInArrow(learn, "bias double, places binary, values binary").collect()
    if not made:  # a plan without rows may run no task
        return train([])
    return Model(made[0].bias, np.frombuffer(made[0].places, dtype=np.int64), np.frombuffer(made[0].values, dtype=np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id and score."""

    def run(batches):
        for batch, texts, _ in flat.text_rows(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(texts), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, score double"
    )


def usable(labels: DataFrame, column: str, parts: int, out: int) -> DataFrame:
    """(doc_id, label) of the rows that are not held out."""
    return labels.filter(remainder(F.col("doc_id"), parts) != out).select("doc_id", F.col(column).alias("label"))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(docs, usable(labels, "toxic", 4, 2), rows)
    return score(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with their own columns."""
    model = fit(docs, usable(labels, "toxic", 4, 2), rows)

    def run(batches):
        for batch, texts, _ in flat.text_rows(batches, "text"):
            yield batch.filter(pa.array(model.score(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
