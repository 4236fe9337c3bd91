"""Whitening and vector codes against plain numpy and SQL."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from compare import compare, duck

from zoneday.llm import laesa_codes, polar_whitening, queries

SCHEMA = "vec_id long, embedding array<float>, label int, x string, z int"
NAN, INF = float("nan"), float("inf")
BROKEN = [(900, None, 1, "q", 0), (901, [1.0, None] + [0.0] * 30, 1, "q", 0), (902, [NAN] * 32, None, "q", 0), (903, [INF] + [0.0] * 31, 2, "q", 0)]


def table(spark, n, dim=32, seed=1):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim)) * 0.2).astype(np.float32)
    rows = [(i, [float(v) for v in r], None if i % 7 == 0 else i % 3, "q", 0) for i, r in enumerate(x)]
    rows += rows[:3]  # repeated rows
    rows.append((None, [0.5] * dim, 1, "q", 0))
    return rows, spark.createDataFrame(rows + [r for r in BROKEN if dim == 32], SCHEMA).repartition(3)


def integers(rows, times, plus=0):
    return np.array([[math.floor(times * v) + plus for v in r[1]] for r in rows], dtype=np.int64)


def check_whitening(rows, got, components=8):
    x = integers(rows, 1024, 100_000)
    n, total = len(x), x.sum(axis=0)
    c = x - total / n
    v = c.T @ c / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    w = c @ axes / np.sqrt(values)
    want = {}
    for i, r in enumerate(rows):
        want.setdefault(r[0], (int(sum(int(t) ** 2 for t in n * x[i] - total)), w[i]))
    assert len(got) == n * components
    for k in range(1, components + 1):
        part = [r for r in got if r.component == k]
        sign = np.sign(sum(r.whitened * want[r.vec_id][1][k - 1] for r in part))
        assert all(abs(r.whitened * sign - want[r.vec_id][1][k - 1]) < 1e-7 for r in part)
        assert all(r.deviation == want[r.vec_id][0] and r.n == n for r in part)
        assert all(r.explained == pytest.approx(values[k - 1] / np.trace(v), rel=1e-9) for r in part)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-6


@pytest.mark.parametrize("n", [40, 700])
def test_whitening(spark, n):
    rows, df = table(spark, n)
    check_whitening(rows, polar_whitening.whiten(df).collect())


def test_whitening_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitening(rows, queries.QUERIES["op11_polar_whitening"](spark, sf_dir).collect())


def test_covariance_is_exact_for_large_entries(spark):
    # a mean far from nought and a tiny spread: centring first keeps every digit
    rows = [(i, [1e6 + i / 64, 1e6 - i / 32, float(i % 3)], 0, "q", 0) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, x string, z int")
    model = polar_whitening.fit(polar_whitening.vectors.whole_vectors(df, vec_id=df.vec_id))
    x = integers(rows, 1024, 100_000).astype(object)
    c = [[len(x) * int(v) - int(s) for v, s in zip(r, x.sum(axis=0), strict=True)] for r in x]
    v = np.array([[sum(r[a] * r[b] for r in c) / len(x) ** 3 for b in range(3)] for a in range(3)])
    assert model["values"] == pytest.approx(np.linalg.eigvalsh(v)[::-1], rel=1e-12, abs=1e-9)


def test_sums_of_squares_do_not_overflow():
    values = np.array([[3_000_000_000, 5], [-2_999_999_999, 7]], dtype=np.int64)
    assert polar_whitening.exact_sums(values) == [3_000_000_000**2 + 2_999_999_999**2, 74]
    many = np.full((5000, 1), 2_000_000_000, dtype=np.int64)
    assert polar_whitening.exact_sums(many) == [5000 * 2_000_000_000**2]


def test_whitening_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert polar_whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert polar_whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [NAN], 1)], schema)).count() == 0
    same = polar_whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], schema)).collect()
    assert len(same) == 4 and all(r.whitened is None and r.deviation == 0 and r.identity_error == 0 for r in same)
    line = polar_whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1)], schema)).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)} and line[0].identity_error < 1e-9
    with pytest.raises(Exception, match="differ in length"):
        polar_whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [2.0], 1)], schema)).collect()


def plain_codes(rows, parts=16, entries=64, rounds=2):
    z = integers(rows, 256)
    z = z.reshape(len(z), parts, -1)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = z[first].transpose(1, 0, 2).copy()

    def assign():
        d = np.stack([((z[:, p, None, :] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)], axis=1)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(rounds):
        index, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = z[index[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(axis=0) // len(mine)
    index, dist = assign()
    digest = hashlib.sha256(",".join(str(v) for v in books.ravel()).encode()).hexdigest()
    error = dist.sum(axis=1)
    by = {}
    for r, e in zip(rows, error, strict=True):
        by[r[2]] = by.get(r[2], 0) + int(e)
    return sorted(((r[0], bytes(i.tolist()).hex(), int(e), by[r[2]], digest) for r, i, e in zip(rows, index, error, strict=True)), key=str)


@pytest.mark.parametrize("n", [5, 64, 900])
def test_codes(spark, n):
    rows, df = table(spark, n, seed=n)
    assert sorted((tuple(r) for r in laesa_codes.codes(df).collect()), key=str) == plain_codes(rows)


def test_codes_of_repeated_parts(spark):
    # few different parts: many entries are equal, so ties decide
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(0, 2, 32)], None, "q", 0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted((tuple(r) for r in laesa_codes.codes(df).collect()), key=str) == plain_codes(rows)


def test_bounds_prune_and_keep_the_nearest():
    rng = np.random.default_rng(8)
    parts, entries = rng.integers(-90, 90, (3000, 4)), rng.integers(-90, 90, (64, 4))
    pivots = laesa_codes.choose_pivots(entries)
    gap, far = (np.sqrt(laesa_codes.squared(a, pivots)) for a in (entries, parts))
    index, dist, computed = laesa_codes.nearest(parts, far, entries, gap)
    d = laesa_codes.squared(parts, entries)
    assert (index == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
    assert computed < 0.25 * d.size


def test_codes_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert laesa_codes.codes(spark.createDataFrame([], schema)).count() == 0
    for bad in ([1.0] * 15, [], [1e6] * 16):
        with pytest.raises(Exception, match="equal parts|too large"):
            laesa_codes.codes(spark.createDataFrame([(1, bad, 1)], schema)).collect()


def test_codes_against_sql(spark, sf_dir):
    name = "op12_laesa_codes"
    _, ok, note = compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert ok, note
