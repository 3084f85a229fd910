"""The registered queries on the smallest given tables, and the classifiers against plain recomputation."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pitchlake.llm import arrays, lang_id, quality, queries, simhash

SF = "/root/testdata/sf0.001"


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_ftrl_equals_plain_updates():
    """Per coordinate: sums z and n, weights from them as they stand, over the same order of rows."""
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(12):
        at = np.sort(rng.choice(40, 6, replace=False)).astype(np.int32)
        rows.append((int(rng.integers(0, 2)), at, rng.random(6).astype(np.float32)))
    model = quality.fit(rows)
    z, n, bias, seen = {}, {}, 0.0, 0.0
    a, b, l1, l2 = quality.ALPHA, quality.BETA, quality.L1, quality.L2

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((b + math.sqrt(n.get(i, 0.0))) / a + l2)

    order = np.random.default_rng(11)
    for _ in range(quality.EPOCHS):
        for k in order.permutation(len(rows)):
            label, at, x = rows[k]
            w = {int(i): weight(int(i)) for i in at}
            err = 1 / (1 + math.exp(-(sum(w[int(i)] * float(v) for i, v in zip(at, x)) + bias))) - label
            for i, v in zip(at.tolist(), x.tolist()):
                g = err * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / a * w[i]
                n[i] = n.get(i, 0.0) + g * g
            seen += err * err
            bias -= a / (b + math.sqrt(seen)) * err
    want = np.array([weight(i) for i in range(40)])
    assert np.abs(model.weights[:40] - want).max() < 1e-5 and abs(model.bias - bias) < 1e-6
    assert not model.weights[40:].any()


def test_quality_scores_are_sparse_dot_products():
    model = quality.Model(np.random.default_rng(1).normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    column = pa.array(["one two, two!", None, "", "x " * 50])
    text, at, x = quality.features(*arrays.flat(column))
    want = [1 / (1 + math.exp(-(0.3 + sum(float(model.weights[b]) * v for t, b, v in zip(text, at, x) if t == k)))) for k in range(4)]
    assert np.abs(quality.scores(model, column) - want).max() < 1e-6


def test_language_scores_are_means_through_a_softmax():
    rng = np.random.default_rng(1)
    table = rng.normal(size=(lang_id.BUCKETS, 3)).astype(np.float32)
    model = lang_id.Model(["a", "b", "c"], table, rng.normal(size=3), np.ones(lang_id.BUCKETS, bool), 0.0, 0.0)
    given = ["some words of a text", None, "", "12 34", "Ünïcode wörds"]
    lang, best, rejected = lang_id.score(model, given)
    for k, (at, n) in enumerate(lang_id.features(given)):
        if not len(at):
            assert (lang[k], best[k], rejected[k]) == (-1, 0, True)
            continue
        z = sum(c * table[b].astype(float) for b, c in zip(at, n)) / n.sum() + model.bias
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert lang[k] == p.argmax() and abs(best[k] - p.max()) < 1e-6 and not rejected[k]


def test_op1_and_op2(spark, texts):
    got = queries.QUERIES["op1_language_id"](spark, SF).collect()
    learned = {r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang").distinct().collect()} - {None}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (remainder(r.doc_id, 4) == 2) and r.lang_pred in learned | {"und"} and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
    got = queries.QUERIES["op2_quality"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_op5(spark, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op5_simhash"](spark, SF).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert got[i].fingerprint == f"{simhash.fingerprint((t or '').encode()):016x}"
    assert all(got[r.component_id].component_id == r.component_id <= i for i, r in got.items())
