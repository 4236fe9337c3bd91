"""Vector codes: codebooks per part of a vector, nearest entries found with LAESA pivots.

Components become integers, floor(256 x), and a vector is cut into equal parts.
Each part position has a codebook, which starts as that part of the first
vectors by id and is refined in rounds.

LAESA: a few pivots per position are chosen once, far from each other, among
the first codebook's entries.  The distance of every part to its pivots is
computed once and written beside the integers.  A round only computes the
distances between pivots and entries.  By the triangle inequality the
difference of two distances to one pivot is a lower bound on the distance of
part and entry; the largest over the pivots is used.  Entries are taken in the
order of their bounds, their exact integer distance is computed, and a part is
done as soon as the next bound lies above its best distance.  Bounds are
floating point and get a margin; distances, ties and means are integers.

Rows whose vector is null or holds null or non-finite components are dropped.
Ids that are null come last among the first vectors, equal ids by their
vectors.  Repeated rows are coded once each; null labels are added together.
An empty table gives an empty result; a table of fewer vectors than entries
has as many entries as vectors.  Vectors of different lengths or of a length
that the parts don't divide, and components of 2**19 and more, are errors.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.llm import vectors
from zoneday.llm.joins import split_join
from zoneday.session import materialize

TIMES = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 6
LIMIT = 1 << 27
MARGIN = 1e-9


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to the rows of ``b``."""
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def choose_pivots(entries: np.ndarray, many: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: each the farthest from those chosen before it, the first one the first entry."""
    chosen = [0]
    near = squared(entries, entries[:1])[:, 0]
    while len(chosen) < min(many, len(entries)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(entries, entries[chosen[-1:]])[:, 0])
    picked = entries[chosen]
    # fewer different entries than pivots: the first one again
    return np.concatenate([picked, np.repeat(entries[:1], many - len(picked), axis=0)])


def nearest(parts: np.ndarray, far: np.ndarray, entries: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each part (ties: the lower index), its squared distance, and how many distances were computed.

    ``far`` are the parts' distances to the pivots, ``gap`` those of the entries.
    """
    n = len(parts)
    bound = np.zeros((n, len(entries)))
    for p in range(far.shape[1]):
        np.maximum(bound, np.abs(far[:, p, None] - gap[None, :, p]), out=bound)
    bound -= MARGIN * (1 + bound)
    best = np.full(n, np.iinfo(np.int64).max)
    index = np.full(n, len(entries))
    live = np.arange(n)
    computed = 0
    while len(live):
        at = bound.argmin(axis=1)
        rows = np.arange(len(live))
        go = bound[rows, at] <= np.sqrt(best[live])
        live, bound, at, rows = live[go], bound[go], at[go], rows[: int(go.sum())]
        bound[rows, at] = np.inf
        computed += len(live)
        d = ((parts[live] - entries[at]) ** 2).sum(axis=1)
        better = (d < best[live]) | ((d == best[live]) & (at < index[live]))
        best[live[better]], index[live[better]] = d[better], at[better]
        left = np.isfinite(bound.min(axis=1, initial=np.inf))
        live, bound = live[left], bound[left]
    return index, best, computed


def _distances(z: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances of every part of every row to its position's pivots, by part and pivot."""
    parts, _, width = pivots.shape
    return np.concatenate([squared(z[:, p * width : (p + 1) * width], pivots[p]) for p in range(parts)], axis=1)


def _assign(z: np.ndarray, far: np.ndarray, books: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and part: index and squared distance of the nearest entry."""
    parts, _, width = books.shape
    many = pivots.shape[1]
    index, dist = np.zeros((len(z), parts), dtype=np.int64), np.zeros((len(z), parts), dtype=np.int64)
    for p in range(parts):
        gap = np.sqrt(squared(books[p], pivots[p]))
        index[:, p], dist[:, p], _ = nearest(z[:, p * width : (p + 1) * width], np.sqrt(far[:, p * many : (p + 1) * many]), books[p], gap)
    return index, dist


def first_books(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """Codebooks (part, entry, position) of the first vectors by id."""
    rows = whole.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
    if not rows:
        return None
    dim = len(rows[0].x)
    if not dim or dim % parts:
        raise ValueError(f"{dim} components can't be cut into {parts} equal parts")
    if any(len(r.x) != dim for r in rows):
        raise ValueError(f"vectors differ in length: {dim} and others")
    z = vectors.whole_numbers(np.array([r.x for r in rows]), TIMES, 0, LIMIT)
    return z.reshape(len(z), parts, dim // parts).transpose(1, 0, 2).copy()


def pivot_table(whole: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, label, z, far): integers and squared distances to the pivots; written."""
    dim = pivots.shape[0] * pivots.shape[2]

    def run(batches):
        for batch in batches:
            z = vectors.whole_numbers(vectors.matrix(batch.column(2), dim), TIMES, 0, LIMIT)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), vectors.lists(z), vectors.lists(_distances(z, pivots))], ["vec_id", "label", "z", "far"])

    rows = whole.select("vec_id", "label", "x").mapInArrow(run, "vec_id bigint, label string, z array<bigint>, far array<bigint>")
    return materialize(rows, "pivot-distances")


def _read(batch: pa.RecordBatch, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts, many, width = pivots.shape
    z = vectors.matrix(batch.column(batch.schema.get_field_index("z")), parts * width)
    return z, vectors.matrix(batch.column(batch.schema.get_field_index("far")), parts * many)


def refine(table: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the whole-number mean of the parts nearest to it; unused ones stay."""
    parts, entries, width = books.shape

    def run(batches):
        total = np.zeros((parts * entries, width), dtype=np.int64)
        count = np.zeros(parts * entries, dtype=np.int64)
        for batch in batches:
            z, far = _read(batch, pivots)
            index, _ = _assign(z, far, books, pivots)
            cell = (index + np.arange(parts) * entries).ravel()
            np.add.at(total, cell, z.reshape(-1, width))
            count += np.bincount(cell, minlength=len(count))
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))), pa.array(total[used].ravel()), pa.array(np.repeat(count[used], width))],
                ["cell", "at", "total", "n"],
            )

    sums = table.select("z", "far").mapInArrow(run, "cell bigint, at bigint, total bigint, n bigint")
    new = books.copy()
    # as many rows as the codebooks have components
    for r in sums.groupBy("cell", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        new[r.cell // entries, r.cell % entries, r["at"]] = r.total // r.n
    return new


def codes(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, many: int = PIVOTS, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per remaining row: vec_id, code, error, label_error, codebooks_sha256."""
    whole = vectors.whole_vectors(rows, vector, vec_id=F.col(vec_id).cast("bigint"), label=F.col(label).cast("string"))
    books = first_books(whole, parts, entries)
    if books is None:
        return rows.sparkSession.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    pivots = np.stack([choose_pivots(b, many) for b in books])
    table = pivot_table(whole, pivots)
    for _ in range(rounds):
        books = refine(table, books, pivots)

    def run(batches):
        for batch in batches:
            index, dist = _assign(*_read(batch, pivots), books, pivots)
            code = [bytes(r).hex() for r in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(dist.sum(axis=1))], ["vec_id", "label", "code", "error"])

    coded = materialize(table.mapInArrow(run, "vec_id bigint, label string, code string, error bigint"), "codes")
    key = F.struct(F.col("label").isNull(), F.coalesce("label", F.lit("")))
    by_label = coded.groupBy(key.alias("of")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return split_join(coded.withColumn("of", key), by_label, "of").select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
