"""Learned operators: held-out accuracy, odd rows, gradients and exact inference."""

from __future__ import annotations

import itertools
import os

import numpy as np
import pytest

from zoneday.llm import byte_cnn, crf_language, ftrl_toxicity, queries

SF = "/root/testdata/sf0.1"


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable")) + 1
    up = label == 1
    return (rank[up].sum() - up.sum() * (up.sum() + 1) / 2) / (up.sum() * (~up).sum())


def scored(spark, name, column):
    got = queries.QUERIES[name](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    p = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", column).toPandas()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert p.score.between(0, 1).all() and ((p.score >= 0.3) == (p.predicted == 1)).all()
    return p.score.to_numpy(), p.predicted.to_numpy(), p[column].to_numpy()


def test_toxicity_held_out(spark):
    score, predicted, toxic = scored(spark, "op2_ftrl_toxicity", "toxic")
    assert auc(score, toxic) > 0.93
    assert predicted[toxic == 1].mean() > 0.75 and predicted[toxic == 0].mean() < 0.01


def test_quality_held_out(spark):
    score, predicted, good = scored(spark, "op4_byte_cnn", "quality")
    assert auc(score, good) > 0.98 and predicted[good == 1].mean() > 0.98


def test_language_held_out(spark):
    got = queries.QUERIES["op1_crf_language"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang is not null").select("doc_id", "lang")
    held = got.filter("held_out").join(docs, "doc_id")
    assert held.filter("lang = lang_pred").count() / held.count() > 0.99


ODD = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "123 !?", None, None), (None, "the and of", "en", None), (4, "the " * 50_000, "en", "s"), (4, "the " * 50_000, "en", "s"),
       (5, "der und die", "de", "s"), (6, "\x00😀 und", "de", "s")]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, source string, score double")


def test_odd_rows(spark):
    labels = spark.createDataFrame([(2, 0, 1), (4, 1, 0), (4, 0, None), (5, None, 1), (None, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    for docs, n in ((odd(spark), len(ODD)), (odd(spark).limit(0), 0)):
        for table in (labels, labels.limit(0)):
            for made in (ftrl_toxicity.toxicity(docs, table), byte_cnn.quality(docs, table), crf_language.language(docs)):
                rows = made.collect()
                assert len(rows) == n and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    got = [(r.doc_id, r.lang_pred) for r in crf_language.language(odd(spark)).collect()]
    assert {(1, "und"), (2, "und"), (3, "und")} < set(got) and len({p for d, p in got if d == 4}) == 1
    assert {r.lang_pred for r in crf_language.language(odd(spark, [(9, "abc", None, None)])).collect()} == {"und"}


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    a = rng.random((3, 3)) + 0.1
    sizes = np.array([1, 4, 3, 1])
    e = rng.random((sizes.sum(), 3)) + 0.1
    post, pairs = crf_language.forward_backward(e, sizes, a, pairs=True)
    at, total = 0, np.zeros((3, 3))
    for n in sizes:
        p, q, z = np.zeros((n, 3)), np.zeros((3, 3)), 0
        for path in itertools.product(range(3), repeat=int(n)):
            w = a[:, path[0]].sum() / 3 * e[at, path[0]]
            for t in range(1, n):
                w *= a[path[t - 1], path[t]] * e[at + t, path[t]]
            z += w
            for t, y in enumerate(path):
                p[t, y] += w
                if t:
                    q[path[t - 1], y] += w
        assert post[at : at + n] == pytest.approx(p / z)
        total += q / z
        at += n
    assert pairs == pytest.approx(total)


def test_blocks_of_long_texts_are_chained(monkeypatch):
    rng = np.random.default_rng(2)
    a, sizes = rng.random((4, 4)) + 0.05, np.array([200, 3, 64, 65, 129])
    e = rng.random((sizes.sum(), 4)) + 0.05
    short = crf_language.forward_backward(e, sizes, a)
    monkeypatch.setattr(crf_language, "BLOCK", 1000)
    assert crf_language.forward_backward(e, sizes, a) == pytest.approx(short)


def test_gradients_of_the_network():
    rng = np.random.default_rng(3)
    net = byte_cnn.Net.fresh()
    for f in ("embed", "filters", "shift", "out", "bias"):
        setattr(net, f, getattr(net, f).astype(np.float64))
    x, doc, y = rng.integers(1, 255, (5, byte_cnn.CHUNK)), np.array([0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0])

    def loss():
        pooled = net.pooled(x)
        mean = np.stack([pooled[doc == d].mean(axis=0) for d in range(3)])
        p = byte_cnn.sigmoid(mean @ net.out + net.bias[0])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    for part, g in zip(net.parts(), byte_cnn.gradients(net, x, doc, y), strict=True):
        flat, wide = part.reshape(-1), np.asarray(g).reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            keep = flat[i]
            flat[i] = keep + 1e-5
            up = loss()
            flat[i] = keep - 1e-5
            down = loss()
            flat[i] = keep
            assert (up - down) / 2e-5 == pytest.approx(wide[i], rel=1e-3, abs=1e-4)


def test_chunks_hold_each_window_once():
    for n in (0, 1, 7, 8, 249, 256, 257, 505, 506, 1000):
        data, spans, text = byte_cnn.cut(["a" * n])
        rows = byte_cnn.gather(data, spans)
        windows = sum(max(0, min(byte_cnn.CHUNK, n - s) - byte_cnn.WIDTH + 1) for s in spans[:, 0])
        assert windows == max(0, n - byte_cnn.WIDTH + 1) and (rows > 0).any(axis=1).sum() >= (n > 0) and len(text) == len(spans)


def test_sparse_weights():
    rng = np.random.default_rng(4)
    examples = []
    for i in range(400):
        bad = i % 4 == 0
        examples.append((int(bad), np.unique(np.r_[rng.integers(0, 5000, 40), 7777 if bad else 8888])))
    model = ftrl_toxicity.train(examples)
    assert len(model.places) < 100 and model.values[list(model.places).index(7777)] > 0


def test_toxicity_learns_in_a_task(spark, monkeypatch):
    """Only the weights reach the driver, and they are those that learning over the rows in order of their ids gives."""
    rows = [(i, f"plain words number {i % 7} {'vile slur' if i % 3 == 0 else 'kind talk'} here {i % 5}", int(i % 3 == 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5)
    model = ftrl_toxicity.fit(docs.drop("label"), docs.select("doc_id", "label"))
    place, text = ftrl_toxicity.features([t for _, t, _ in rows])
    want = ftrl_toxicity.train([(y, np.unique(place[text == i])) for i, _, y in rows])
    assert len(model.places) and model.bias == want.bias
    assert model.places.tolist() == want.places.tolist() and model.values.tolist() == want.values.tolist()

    monkeypatch.setattr(ftrl_toxicity, "train", lambda examples: ftrl_toxicity.Model(float(os.getpid()), np.zeros(0, np.int64), np.zeros(0)))
    assert ftrl_toxicity.fit(docs.drop("label"), docs.select("doc_id", "label")).bias != os.getpid()


def test_sample_is_bounded_for_repeated_ids(spark):
    from zoneday.llm.samples import labelled_sample

    docs = spark.range(20_000).selectExpr("7L as doc_id", "concat('text ', id) as text").unionByName(spark.range(30).selectExpr("id + 100 as doc_id", "'t' as text"))
    labels = spark.createDataFrame([(7, 1), (7, 0), *((100 + i, 1) for i in range(30))], "doc_id long, label int")
    for cap in (8, 40):
        got = labelled_sample(docs, labels, cap).collect()
        assert len(got) == min(cap, 31) and len({r.doc_id for r in got}) == len(got)
    assert [r.label for r in got if r.doc_id == 7] == [0]
    again = labelled_sample(docs.repartition(7), labels, 40).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_words_pairs_and_skip_pairs_against_plain_lists():
    texts = ["", "One two, THREE two", "é 1x", "a", "a a a"]
    place, text = ftrl_toxicity.features(texts)
    names: dict[tuple, int] = {}
    for i, t in enumerate(texts):
        w = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        want = [(x,) for x in w] + [(1, x, y) for x, y in zip(w, w[1:], strict=False)] + [(2, x, y) for x, y in zip(w, w[2:], strict=False)]
        mine = sorted(place[text == i].tolist())
        assert len(mine) == len(want)
        # the same grams have the same places, other grams others
        kinds = sorted(want.count(k) for k in set(want))
        assert kinds == sorted(mine.count(p) for p in set(mine))
        for k in want:
            names.setdefault(k, len(names))
    assert len(set(place.tolist())) == len(names)


def test_ftrl_against_a_plain_one():
    rng = np.random.default_rng(2)
    fast = ftrl_toxicity.Ftrl(12, l1=2.0)
    z, n = [0.0] * 12, [0.0] * 12

    def weight(i, free):
        if not free and abs(z[i]) <= 2.0:
            return 0.0
        sign = float(np.sign(z[i]))
        return -(z[i] - (0.0 if free else sign * 2.0)) / ((1.0 + n[i] ** 0.5) / 1.0 + 0.1)

    for _ in range(300):
        at = [*sorted(rng.choice(11, rng.integers(1, 6), replace=False).tolist()), 11]
        label = float(at[0] < 3)
        fast.learn(np.array(at), label)
        w = {i: weight(i, i == 11) for i in at}
        g = 1 / (1 + np.exp(-sum(w.values()))) - label
        for i in at:
            step = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 1.0
            z[i] += g - step * w[i]
            n[i] += g * g
    assert fast.z == pytest.approx(z, rel=1e-9) and fast.n == pytest.approx(n, rel=1e-9)
    got = fast.weights(np.arange(11))
    assert got == pytest.approx([weight(i, False) for i in range(11)], rel=1e-9) and (got == 0).any()


def test_score_against_a_plain_convolution():
    net = byte_cnn.Net.fresh(9)
    rng = np.random.default_rng(4)
    texts = ["", "short", "é" * 300, "".join(chr(97 + c) for c in rng.integers(0, 26, 1500)), "x" * 255 + "y", "z" * 256]
    got = net.score(texts)
    for t, s in zip(texts, got, strict=True):
        raw = t.encode()
        windows = max(1, len(raw) - byte_cnn.WIDTH + 1)
        tops = []
        for first in range(0, windows, byte_cnn.STEP):  # each chunk holds STEP windows
            best = [-np.inf] * byte_cnn.FILTERS
            for at in range(first, first + byte_cnn.STEP):
                part = [raw[i] if i < len(raw) else 0 for i in range(at, at + byte_cnn.WIDTH)]
                v = np.concatenate([net.embed[b] for b in part])
                best = np.maximum(best, v @ net.filters)
            tops.append(np.maximum(best + net.shift, 0))
        assert s == pytest.approx(1 / (1 + np.exp(-(np.mean(tops, axis=0) @ net.out + net.bias[0]))), rel=1e-5)
