"""Links of embeddings against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneday.llm import nn_descent, queries


def brute(rows, threshold=0.93):
    """(vec_id, n_links, component_id) by position."""
    n = len(rows)
    unit = []
    for _, label, x in rows:
        ok = label is not None and x and None not in x and np.isfinite(x).all() and np.any(x)
        unit.append(np.array(x) / np.linalg.norm(x) if ok else None)
    links = [
        [j for j in range(n) if j != i and rows[i][1] == rows[j][1] and unit[i] is not None and unit[j] is not None
         and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]
        for i in range(n)
    ]
    label = [-1] * n
    for i in range(n):
        if label[i] < 0:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            for j in seen:
                label[j] = i
    least = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            least[label[i]] = min(least.get(label[i], v), v)
    return [(v, len(links[i]), least.get(label[i])) for i, (v, _, _) in enumerate(rows)]


def make(rng, n, dim, groups):
    rows = []
    for i in range(n):
        rows.append((len(rows) + 1, int(rng.integers(4)), rng.standard_normal(dim)))
    for size, noise in groups:
        base, label = rng.standard_normal(dim), int(rng.integers(4))
        for _ in range(size):
            rows.append((len(rows) + 1, label, base + noise * rng.standard_normal(dim)))
    return [(v, lab, [float(np.float32(y)) for y in x]) for v, lab, x in rows]


SCHEMA = "vec_id long, label int, embedding array<float>, node long"


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = make(rng, 250, 24, [(2, 0.05)] * 25 + [(3, 0.2)] * 6 + [(120, 0.1), (40, 0.22)])
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nn_descent.near_duplicates(df, block=32).collect()}
    want = brute(rows)
    true, found = sum(w[1] for w in want), sum(g[0] for g in got.values())
    assert all(got[v][0] <= n for v, n, _ in want)
    assert found >= 0.97 * true > 14_000
    assert np.mean([got[v][1] == c for v, _, c in want]) >= 0.99
    assert all(g[2] == (v == g[1]) for v, g in got.items())


def test_odd_rows(spark):
    x = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, 0, x), (1, 0, x), (2, 0, [2.0, 4.0, 6.0, 8.0]), (3, 1, x), (4, None, x), (5, 0, None), (6, 0, []), (7, 0, [0.0] * 4),
        (8, 0, [1.0, None, 3.0, 4.0]), (9, 0, [float("nan"), 2.0, 3.0, 4.0]), (10, 0, [float("inf"), 2.0, 3.0, 4.0]), (None, 0, x), (11, 0, [1.0, 2.0, 3.0]),
        (None, 2, x),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = sorted([(r.vec_id, r.n_links, r.component_id) for r in nn_descent.near_duplicates(df).collect()], key=key)
    assert got == sorted(brute(rows), key=key)
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op10_nn_descent"])
def test_whole_table(spark, sf_dir, name):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted([(r.vec_id, r.n_links, r.component_id) for r in queries.QUERIES[name](spark, sf_dir).collect()], key=key)
    want = sorted(brute(rows), key=key)
    assert len(got) == len(want)
    assert np.mean([a == b for a, b in zip(got, want, strict=True)]) > 0.98


def skewed(spark, n=900, pairs=150, group=450, dim=24):
    """One label: a dense group and single rows, with pairs of cosine 0.94 spread among them."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    dense = unit(unit(rng.standard_normal(dim)) + 0.02 * rng.standard_normal((group, dim)))
    single = unit(rng.standard_normal((n, dim)))
    base = single[:pairs]
    side = rng.standard_normal((pairs, dim))
    side = unit(side - (side * base).sum(1, keepdims=True) * base)
    x = np.concatenate([single, 0.94 * base + np.sqrt(1 - 0.94**2) * side, dense])
    rows = [(i, 0, [float(np.float32(y)) for y in v]) for i, v in enumerate(x)]
    return rows, spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)


def test_audit_sees_missed_pairs_beside_a_dense_group(spark):
    rows, df = skewed(spark)
    keyed = nn_descent.units(df).filter("unit is not null").withColumn("weight", F.lit(1)).withColumn("node", F.col("vec_id"))
    nodes = nn_descent.materialize(keyed, "nodes")
    true = {v: n for v, n, _ in brute(rows)}
    # the dense group found whole, of the pairs every second
    found = [(v, n if v >= 1050 else int(v % 150 % 2)) for v, n in true.items() if n and (v >= 1050 or v % 150 % 2)]
    counts = spark.createDataFrame(found, "node long, links long").withColumn("other", F.lit(None).cast("bigint"))
    wide = nodes.filter("node >= 1050").select("node")
    got = nn_descent.audit(nodes, counts, wide, nn_descent.THRESHOLD, block=100).collect()
    want = np.mean([dict(found).get(v, 0) / n for v, n in true.items() if n and v < 1050])
    assert len(got) == 1 and abs(got[0].recall - want) < 0.05 and want < 0.6
    whole = spark.createDataFrame([(v, n) for v, n in true.items() if n], "node long, links long").withColumn("other", F.lit(None).cast("bigint"))
    assert nn_descent.audit(nodes, whole, wide, nn_descent.THRESHOLD, block=100).first().recall == 1


def test_labels_below_the_bound_are_compared_exactly(spark):
    rows, df = skewed(spark)
    other = [(5000 + v, 1, x) for v, _, x in rows if v >= 1400]  # a label that needs no more
    df = df.union(spark.createDataFrame([(*r, 0) for r in other], SCHEMA))
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(df, block=8, most_seeds=2).collect()}
    assert got == {v: (n, c) for v, n, c in brute(rows + other)}
