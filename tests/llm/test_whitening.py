"""Whitening against a dense eigensolver on the same integers."""

import math

import numpy as np
import pytest

from webtide.llm import queries, whitening


def brute(rows):
    """{vec_id: (n, deviation, whitened)}, shares of variance."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in good), default=0)
    x = {k: tuple(math.floor(256 * float(c)) for c in v) + (0,) * (d - len(v)) for k, (_, v) in enumerate(good)}
    listed = sorted(set(x.values()))
    n, sums = len(listed), [sum(c) for c in zip(*listed)]
    centred = np.array(listed, float).reshape(n, d) - np.array(sums) / max(n, 1)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for k, (i, _) in enumerate(good):
        dev = sum((n * c - s) ** 2 for c, s in zip(x[k], sums))
        out.append((i, n, dev, (np.array(x[k], float) - np.array(sums) / n) @ vectors / np.sqrt(np.maximum(values, 1e-300))))
    return out, values / values.sum()


def check(spark, rows, k=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "2 AS n", "'a' AS whitened", "0 AS _row")
    got = {}
    for r in whitening.components_of(df, "vec_id", "embedding", k).collect():
        got.setdefault(r.vec_id, []).append(r)
    want, share = brute(rows)
    signs = None
    for i, n, dev, white in want:
        mine = sorted(got[i], key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, len(mine) + 1))
        assert all(r.n == n and r.deviation == dev and r.identity_error < 1e-9 for r in mine)
        z = np.array([r.whitened for r in mine])
        if signs is None and np.abs(z).min() > 1e-3:
            signs = np.sign(z * white[: len(z)])
        if signs is not None:
            assert np.allclose(z, signs * white[: len(z)], atol=1e-7)
        assert np.allclose([r.explained for r in mine], share[: len(mine)], rtol=1e-9)
    assert set(got) == {w[0] for w in want}
    return got


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    spread = np.array([0.9, 0.7, 0.5, 0.35, 0.2, 0.1, 0.1, 0.1])
    vectors = (rng.standard_normal((300, 8)) * spread).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0]) for i in range(200)]  # copies count once
    rows += [(2000, None), (2001, [float("nan")] * 8), (2002, [float("inf")] * 8), (2003, [None] * 8), (2004, [-0.0] * 8)]
    got = check(spark, rows)
    assert all(len(v) == 4 for v in got.values())


def test_the_query_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {(r.vec_id, r.component): r for r in queries.queries()["op12_whitening"](spark, sf_dir).collect()}
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    want, share = brute(rows)
    assert len(got) == 4 * len(want)
    for c in range(4):
        z = np.array([got[w[0], c + 1].whitened for w in want])
        y = np.array([w[3][c] for w in want])
        assert np.allclose(z, np.sign(z @ y) * y, atol=1e-8)
        assert np.isclose(got[want[0][0], c + 1].explained, share[c], rtol=1e-9)
    assert all(got[w[0], 1].deviation == w[2] for w in want)


def test_few_empty_and_uneven(spark):
    assert whitening.components_of(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding").collect() == []
    same = spark.createDataFrame([(1, [0.5, 0.5]), (None, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert whitening.components_of(same, "vec_id", "embedding").collect() == []  # no variance, no component
    assert whitening.components_of(spark.createDataFrame([(1, [])], "vec_id long, embedding array<float>"), "vec_id", "embedding").collect() == []
    got = check(spark, [(1, [0.25, 1.0]), (2, [0.25]), (3, []), (4, [1.0, 0.5, 0.25])])
    assert all(len(v) == 3 for v in got.values())  # a rank below four


def test_large_entries_are_exact_or_null(spark):
    rows = [(1, [1e6, 0.0]), (2, [0.0, 1e6]), (3, [1e15, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.components_of(df, "vec_id", "embedding", 1).collect()}
    assert got == {1: None, 2: None, 3: None}
    small = spark.createDataFrame(rows[:2], "vec_id long, embedding array<double>")
    x = 256 * 10**6
    assert {r.deviation for r in whitening.components_of(small, "vec_id", "embedding", 1).collect()} == {2 * x * x}


@pytest.mark.parametrize("seed", range(6))
def test_eigenvectors_of_hard_matrices(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 40))
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    values = [rng.random(d), np.ones(d), np.repeat([3.0, 1.0], [d // 2, d - d // 2]), 10.0 ** -np.arange(d), np.r_[5.0, np.zeros(d - 1)], 1 + 1e-9 * rng.random(d)][seed]
    v = (q * np.sort(values)[::-1]) @ q.T
    v = (v + v.T) / 2
    e, c = whitening.leading_components(v, 4)
    assert np.allclose(c.T @ c, np.eye(len(e)), atol=1e-12)
    assert np.abs(v @ c - c * e).max() < 1e-13 * max(1, np.abs(v).max()) * d
    assert np.allclose(e, np.sort(values)[::-1][: len(e)], atol=1e-12)
