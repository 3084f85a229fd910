"""Whitening and top-k search against plain computations."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import queries, topk_search, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(900, None, 1), (901, [0.5, None, 0.1], 1), (902, [0.5, float("nan"), 0.1], 1),
       (903, [float("inf"), 0.0, 0.1], 1), (None, [0.1, 0.2, 0.3], 1)]


def some(n, dim=3, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(v) for v in rng.normal(size=dim).astype(np.float32)], i % 3) for i in range(n)]


def clashing(df):
    return df.select("*", *[F.lit(1).alias(c) for c in ("x", "n", "shard", "role", "dim", "score", "rank", "component", "i", "v")])


# --- matrices ----------------------------------------------------------------------------
def test_product_is_exact_at_every_size():
    for top in (10, 1 << 40, 1 << 60):
        x = np.array([[top, -3], [7, top]], np.int64)
        want = [[int(x[i, 0]) * int(x[0, j]) + int(x[i, 1]) * int(x[1, j]) for j in range(2)] for i in range(2)]
        assert vectors.product(x, x).tolist() == want


# --- eigenvectors ------------------------------------------------------------------------
@pytest.mark.parametrize("values", [
    np.linspace(1, 40, 40), np.ones(40), 1 + 1e-13 * np.arange(40), 10.0 ** -np.linspace(0, 8, 40),
    np.concatenate([np.full(15, 5.0), 5 + 1e-9 * np.arange(10), np.linspace(1, 2, 15)]),
    np.concatenate([np.zeros(8), np.linspace(1, 2, 32)]),
])
def test_refined_eigenvectors_reach_double_precision(values):
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(40, 40)))[0].astype(np.longdouble)
    q = q @ (1.5 * np.eye(40) - q.T @ q / 2)
    v = (q * values) @ q.T
    e, x = whitening.eigen((v + v.T) / 2)
    assert np.abs(np.sort(e) - np.sort(values)).max() < 1e-15 * values.max()
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-14
    assert np.abs(v @ x - x * e).max() < 1e-14 * values.max()


def test_float32_eigenvectors_alone_would_not():
    values = np.linspace(1, 40, 40)
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(40, 40)))[0]
    v = (q * values) @ q.T
    rough = np.linalg.eigh(v.astype(np.float32))[1]
    assert np.abs(v @ rough - rough * (rough * (v @ rough)).sum(axis=0)).max() > 1e-7


# --- whitening ---------------------------------------------------------------------------
def plain_whitening(rows):
    """vec_id -> (n, deviation) and the covariance, by whole numbers and fractions."""
    x = {i: [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for i, v, _ in rows}
    n, dim = len(x), len(next(iter(x.values())))
    s = [sum(v[d] for v in x.values()) for d in range(dim)]
    dev = {i: sum((n * a - b) ** 2 for a, b in zip(v, s)) for i, v in x.items()}
    cov = [[float(sum((Fraction(n * v[a] - s[a], n)) * Fraction(n * v[b] - s[b], n) for v in x.values()) / n)
            for b in range(dim)] for a in range(dim)]
    return x, n, s, dev, np.array(cov)


def test_whitening_equals_plain_computation(spark, docs):
    rows = some(60, dim=5)
    table = clashing(spark.createDataFrame(rows + ODD, SCHEMA).repartition(4))
    got = whitening.whitened(table).collect()
    x, n, s, dev, cov = plain_whitening(rows)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    assert len(got) == 60 * 5
    signs = {}
    for r in got:
        k = r["component"] - 1
        centred = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x[r["vec_id"]], s)])
        want = centred @ v[:, k] / np.sqrt(e[k])
        sign = signs.setdefault(k, np.sign(want * r["whitened"]))
        assert r["whitened"] == pytest.approx(sign * want, abs=1e-9)
        assert (r["n"], r["deviation"]) == (n, dev[r["vec_id"]])
        assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-12)
        assert 0 <= r["identity_error"] < 1e-12


def test_whitening_is_the_same_under_any_partitioning(spark, docs):
    df = spark.createDataFrame(some(40, dim=4) * 3, SCHEMA)  # repeated rows count each
    one, many = (sorted(map(tuple, whitening.whitened(df.repartition(n)).drop("identity_error").collect())) for n in (1, 7))
    assert one == many and one[0][2] == 120


def test_whitening_without_variance_or_rows(spark, docs):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame(ODD, SCHEMA)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [0.1, 0.2], 0), (2, [0.1, 0.2], 0)], SCHEMA)).collect() == []
    # One dimension varies: one component; another length is whitened on its own.
    rows = [(i, [float(i), 2.0], 0) for i in range(4)] + [(10 + i, [float(i)], 0) for i in range(2)] + [(20, [], 0)]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in got) == [(i, 1, 4) for i in range(4)] + [(10, 1, 2), (11, 1, 2)]


def test_whitening_of_large_entries_is_exact(spark, docs):
    rows = [(i, [float(2 ** 40 * i), float(i * i)], 0) for i in range(6)]
    got = {r["vec_id"]: r for r in whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect() if r["component"] == 1}
    x, n, s, dev, _ = plain_whitening(rows)
    assert {i: r["deviation"] for i, r in got.items()} == {i: d if d < 1 << 63 else None for i, d in dev.items()}


# --- top-k -------------------------------------------------------------------------------
def plain_topk(rows, every, k=5):
    x = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, _ in rows]
    out = set()
    for i, q in {(i, tuple(v)) for i, v in x if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in x if j != i and len(v) == len(q))
        out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


def found(df, every, k=5):
    return [tuple(r) for r in topk_search.search(df, F.col("vec_id") % every == 0, k).collect()]


@pytest.mark.parametrize("dim,n", [(3, 300), (16, 400)])
def test_topk_equals_brute_force(spark, docs, dim, n, monkeypatch):
    monkeypatch.setattr(topk_search, "LEAST", 60)  # several shards
    rows = some(n, dim)
    rows += [(1000 + i, rows[7][1], 0) for i in range(30)]  # ties
    got = found(clashing(spark.createDataFrame(rows + ODD, SCHEMA)), 5)
    assert set(got) == plain_topk(rows, 5) and len(got) == len(set(got))


def test_index_stops_early_and_only_on_proof():
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, size=(3000, 12))
    x[:40] = rng.integers(150, 200, size=(40, 12))  # a far group: others are proven out early
    index = topk_search.Index(np.arange(3000), x)
    shares = []
    for q in [x[3], -x[3], x[500], np.zeros(12, np.int64), rng.integers(-9, 9, size=12)]:
        ids, scores, posted = index.search(3, q, 5)
        every = x @ q
        every[3] = -(10 ** 12)
        want = np.lexsort((np.arange(3000), -every))[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == every[want].tolist()
        shares.append(posted / x.size)
    assert shares[0] < 0.5


def test_topk_edges(spark, docs):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty, 5) == [] and found(spark.createDataFrame(ODD, SCHEMA), 5) == []
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [0.5, 0.5], 0), (1, [0.5, 0.5], 0), (2, [0.0, 0.0], 0),
            (5, [1.0], 0), (10, [], 0), (11, [], 0)]
    got = found(spark.createDataFrame(rows, SCHEMA), 5)
    # A repeated query row counts once, each different vector on its own; the query's own rows never match.
    assert sorted(got) == sorted(2 * [(0, 1, 1, 32768), (0, 2, 1, 32768), (0, 3, 2, 0)] + [(10, 1, 11, 0)])


def test_topk_of_huge_entries(spark, docs):
    rows = [(0, [2.0 ** 40, 1.0], 0), (1, [2.0 ** 40, 0.0], 0), (2, [1.0, 2.0 ** 20], 0), (3, [3e38, 0.0], 0)]
    got = sorted(found(spark.createDataFrame(rows, SCHEMA), 5))
    assert got == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, 256 * 2 ** 48 + 256 * 2 ** 28)]


def test_registered_queries(spark, docs):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert {tuple(r) for r in queries.QUERIES["op13_topk_search"](spark, sf).collect()} == plain_topk(rows, 50)
    got = queries.QUERIES["op11_embedding_whitening"](spark, sf)
    w = np.zeros((len(rows), 32))
    for r in got.collect():
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == len(rows) and r["identity_error"] < 1e-4
    assert np.abs(w.T @ w / len(rows) - np.eye(32)).max() < 1e-10
