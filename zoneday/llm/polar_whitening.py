"""Embedding whitening; the covariance comes from variances alone, by polarisation.

Entries become integers, floor(1024 c) + 100000, so that every sum is exact.

1.  Sums of every dimension over the fit list (all whole vectors).
2.  Each entry is centred by the whole number below its mean.  Of every
    dimension, and of the sum of every pair of dimensions, the squares of the
    centred values are added up.  The rest of the centring, less than one, is
    made good in whole numbers, so the variances are exact fractions with
    divisor n.
3.  Var(a + b) - Var(a) - Var(b) is twice the covariance of a and b.  The
    matrix, as many rows as dimensions, goes to ``eigh`` on the driver.
4.  Rows are centred, projected and scaled where they are read.  The
    covariance of the result is measured over all rows against the identity.

Each task sends one row per dimension or pair, added up by Spark; the driver
gets dims * (dims + 1) / 2 numbers whatever the table's size.

Rows whose vector is null or holds null or non-finite entries are dropped.
Repeated rows and null ids count and are returned like others; other columns
are not read.  An empty table gives an empty result.  A component without
variance (below 1e-12 of the largest) has null ``whitened`` and stays out of
``identity_error``.  Vectors of different lengths, entries of 2**40 and more,
and a deviation that no long holds are errors.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneday.llm import vectors

TIMES, PLUS = 1024, 100_000
COMPONENTS = 8
LIMIT = 1 << 50
FLAT = 1e-12
BLOCK = 4096
_WIDE = "decimal(38,0)"


def integers(column: pa.Array, dim: int) -> np.ndarray:
    return vectors.whole_numbers(vectors.matrix(column, dim), TIMES, PLUS, LIMIT)


def exact_sums(values: np.ndarray) -> list[int]:
    """Column sums of squares as whole numbers of any size."""
    high = int(np.abs(values).max(initial=0))
    rows = ((1 << 62) // max(1, high * high)) if high < (1 << 31) else 0
    if not rows:
        return [int(s) for s in (values.astype(object) ** 2).sum(axis=0)]
    total = [0] * values.shape[1]
    for a in range(0, len(values), rows):
        part = values[a : a + rows]
        total = [t + s for t, s in zip(total, np.einsum("ij,ij->j", part, part).tolist(), strict=True)]
    return total


def _added(rows: DataFrame) -> list[tuple[int, Decimal]]:
    """Sums of (k, s) by k."""
    return sorted((r.k, int(r.s)) for r in rows.groupBy("k").agg(F.sum(F.col("s").cast(_WIDE)).cast("string").alias("s")).collect())


def _batch(k: list[int], s: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array([str(v) for v in s], pa.string())], ["k", "s"])


def sums(whole: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of every dimension."""

    def run(batches):
        n, total = 0, [0] * dim
        for batch in batches:
            x = integers(batch.column(0), dim)
            n += len(x)
            # entries are below 2**50: halves of 25 bits can be added without overflow
            high, low = x >> 25, x & ((1 << 25) - 1)
            total = [t + (h << 25) + v for t, h, v in zip(total, high.sum(axis=0).tolist(), low.sum(axis=0).tolist(), strict=True)]
        if n:
            yield _batch([-1, *range(dim)], [n, *total])

    got = dict(_added(whole.select("x").mapInArrow(run, "k bigint, s string")))
    return got.get(-1, 0), [got.get(k, 0) for k in range(dim)]


def pair_squares(whole: DataFrame, dim: int, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """For a <= b, the sum of squares of the centred sum of dimensions a and b (a = b: of the dimension itself)."""

    def run(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                z = integers(batch.column(0).slice(at, BLOCK), dim) - centre
                part = [exact_sums(np.concatenate([z[:, a : a + 1], z[:, a : a + 1] + z[:, a + 1 :]], axis=1)) for a in range(dim)]
                total = part if total is None else [[x + y for x, y in zip(p, q, strict=True)] for p, q in zip(total, part, strict=True)]
        for a, row in enumerate(total or []):
            yield _batch([a * dim + b for b in range(a, dim)], row)

    return {divmod(k, dim): s for k, s in _added(whole.select("x").mapInArrow(run, "k bigint, s string"))}


def covariance(n: int, total: list[int], squares: dict[tuple[int, int], int], centre: np.ndarray) -> np.ndarray:
    """The covariance matrix, every entry rounded once from an exact fraction."""
    dim = len(total)
    rest = [t - n * int(c) for t, c in zip(total, centre, strict=True)]  # sums of the centred values
    # n * n times each variance
    one = [n * squares[a, a] - rest[a] ** 2 for a in range(dim)]
    out = np.zeros((dim, dim))
    for a in range(dim):
        out[a, a] = one[a] / (n * n)
        for b in range(a + 1, dim):
            both = n * squares[a, b] - (rest[a] + rest[b]) ** 2
            out[a, b] = out[b, a] = (both - one[a] - one[b]) / (2 * n * n)
    return out


def _deviation(d: np.ndarray) -> np.ndarray:
    """Sums of squares along each row, exact."""
    high = int(np.abs(d).max(initial=0))
    if high * high * d.shape[1] < 1 << 63:
        return (d * d).sum(axis=1)
    wide = (d.astype(object) ** 2).sum(axis=1)
    if max(wide) >= 1 << 63:
        raise ValueError("a deviation exceeds a long")
    return wide.astype(np.int64)


def _scaled(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """n * x - S in whole numbers."""
    high = int(np.abs(x).max(initial=0))
    if n * high < 1 << 62:
        return n * x - total
    wide = n * x.astype(object) - total.astype(object)
    if np.abs(wide).max() >= 1 << 63:
        raise ValueError("a deviation exceeds a long")
    return wide.astype(np.int64)


def fit(whole: DataFrame, components: int = COMPONENTS) -> dict:
    """n, sums, eigenvalues, eigenvectors (columns) and shares of the trace; plain numbers of the size of the matrix."""
    first = whole.select(F.size("x").alias("dim")).first()
    if first is None or not first.dim:
        return {"n": 0}
    dim = first.dim
    n, total = sums(whole, dim)
    centre = np.array([t // n for t in total], dtype=np.int64)
    v = covariance(n, total, pair_squares(whole, dim, centre), centre)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    # either sign would do; the largest entry is made positive
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    trace = float(np.trace(v))
    top = values[0] if len(values) else 0.0
    return {
        "n": n,
        "dim": dim,
        "total": np.array(total, dtype=object),
        "values": values,
        "axes": axes,
        "flat": ~(values > max(top, 0.0) * FLAT),
        "explained": values / trace if trace > 0 else np.zeros(len(values)),
    }


def _project(d: np.ndarray, model: dict) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        w = (d / model["n"]) @ model["axes"] / np.sqrt(np.maximum(model["values"], 0.0))
    w[:, model["flat"]] = np.nan
    return w


def identity_error(whole: DataFrame, model: dict) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    live = np.flatnonzero(~model["flat"])
    if not len(live):
        return 0.0
    total = model["total"].astype(np.int64)
    size = len(live)

    def run(batches):
        one, two = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            w = _project(_scaled(integers(batch.column(0), model["dim"]), model["n"], total), model)[:, live]
            one += w.sum(axis=0)
            two += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size + size)), pa.array(np.r_[one, two.ravel()])], ["k", "s"])

    rows = whole.select("x").mapInArrow(run, "k bigint, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    got = np.array([r.s for r in sorted(rows)]) / model["n"]
    one, two = got[:size], got[size:].reshape(size, size)
    return float(np.abs(two - np.outer(one, one) - np.eye(size)).max())


OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    whole = vectors.whole_vectors(rows, vector, vec_id=F.col(vec_id).cast("bigint"))
    model = fit(whole, components)
    if not model["n"]:
        return rows.sparkSession.createDataFrame([], OUT)
    error = identity_error(whole, model)
    total = model["total"].astype(np.int64)
    k = len(model["values"])

    def run(batches):
        for batch in batches:
            d = _scaled(integers(batch.column(1), model["dim"]), model["n"], total)
            w = _project(d, model).ravel()
            size = len(d)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * k, model["n"], dtype=np.int64)),
                    pa.array(np.repeat(_deviation(d), k)),
                    pa.array(w, mask=np.isnan(w)),
                    pa.array(np.tile(model["explained"], size)),
                    pa.array(np.full(size * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return whole.select("vec_id", "x").mapInArrow(run, OUT)
