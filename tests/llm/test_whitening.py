import math
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF01
from panelforge.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, x string, whitened int"


def hold(rows, vectors, components=16):
    """All contract columns against numpy's dense eigenproblem; returns the number of components."""
    x = {k: np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000 for k, v in vectors}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum())) if values[0] > 0 else 0
    by_id = defaultdict(dict)
    for r in rows:
        by_id[r.vec_id][r.component] = r
    assert (sorted(by_id) == sorted(x) and all(sorted(own) == list(range(1, k + 1)) for own in by_id.values())) if k else not rows
    ids = sorted(x)
    got = np.array([[by_id[i][c].whitened for c in range(1, k + 1)] for i in ids]).reshape(len(ids), k)
    for i in ids:
        for c, r in by_id[i].items():
            assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
            assert math.isclose(r.explained, values[c - 1] / values.sum(), rel_tol=1e-9) and r.identity_error <= 1e-9
    # whitened = centred @ direction / sqrt(value): recover the directions and test them as eigenvectors
    every = np.array([x[i] for i in ids]) - s / n
    dirs = np.linalg.lstsq(every, got * np.sqrt(values[:k]), rcond=1e-9)[0]
    assert np.abs(cov @ dirs - dirs * values[:k]).max(initial=0) <= 1e-9 * max(values[0], 1e-300)
    distinct = {tuple(x[i]): got[j] for j, i in enumerate(ids)}
    w = np.array(list(distinct.values()))
    assert np.abs(w.T @ w / n - np.eye(k)).max(initial=0) <= 1e-9
    return k


def test_query_equals_dense_eigenvectors(spark):
    from __spark_entry__ import queries

    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    assert hold(queries()["op11_embedding_whitening"](spark, SF01).collect(), vectors) == 16


@pytest.mark.parametrize("shape", ["odd", "few", "one", "copies", "narrow"])
def test_odd_tables(spark, shape):
    rng = np.random.default_rng(3)
    good = {"odd": rng.normal(size=(50, 20)), "few": rng.normal(size=(5, 20)), "one": rng.normal(size=(1, 4)), "copies": np.ones((7, 3)), "narrow": rng.normal(size=(40, 3))}[shape]
    vectors = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(good)] + [(100, good[0].astype(np.float32).tolist())]
    bad = [(None, None), (201, [None] * len(good[0])), (202, [math.nan] * len(good[0])), (203, [math.inf] * len(good[0])), (204, []), (205, [1.0] * 50)]
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in vectors + bad], SCHEMA).repartition(6)
    k = hold(W.digest(df).collect(), vectors)
    assert k == {"odd": 16, "few": 4, "one": 0, "copies": 0, "narrow": 3}[shape]
    if k:
        out = W.transform(df, W.fit(df))
        assert out.columns == [*df.columns, "whitened_"]
        assert {r.vec_id for r in out.collect() if r.whitened_ is None} == {b[0] for b in bad} and out.count() == len(vectors) + len(bad)
        assert all(len(r.whitened_) == k for r in out.collect() if r.whitened_ is not None)


def test_empty_and_repeated_ids(spark):
    assert W.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(None, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [2.0, 5.0])], "vec_id long, embedding array<double>")
    rows = W.digest(df).collect()
    assert len(rows) == 6 and {r.n for r in rows} == {3}


def check(a):
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])
    main, upper, right = W.bidiagonal(r)
    b = np.diag(main) + np.diag(upper, 1)
    true = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(np.abs(right @ (b.T @ b) @ right.T - r.T @ r).max() / true[0] ** 2, 0, atol=1e-13)
    assert np.abs(np.sqrt(np.maximum(W.dqds(main, upper), 0)) - true).max() <= 1e-13 * true[0]
    values, dirs = W.directions(r, 16)
    assert np.abs(r.T @ r @ dirs - dirs * values).max() <= 1e-13 * true[0] ** 2
    assert np.abs(dirs.T @ dirs - np.eye(len(values))).max() <= 1e-6


def test_solver_on_hard_spectra():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    tall = np.linalg.qr(rng.standard_normal((90, 40)))[0]
    for spectrum in (np.ones(40), 10.0 ** np.linspace(0, -8, 40), 10.0 ** np.linspace(-8, 0, 40), np.repeat([5.0, 4.0], 20), 5 + 1e-7 * np.arange(40), np.append(np.arange(1, 21), np.zeros(20))):
        check(tall * spectrum @ q)
    check(np.eye(8))
    check(np.kron(np.eye(4), rng.standard_normal((9, 5))))
    check(rng.standard_normal((3, 9)))
    graded = W.dqds(10.0 ** -np.arange(12.0), 10.0 ** -np.arange(11.0) / 3)
    assert (graded > 0).all()  # small values keep their relative accuracy
    product = np.prod(graded)  # the determinant of B'B is the product of its squared diagonal
    assert math.isclose(product, np.prod(10.0 ** (-2 * np.arange(12.0))), rel_tol=1e-12)


def test_deviation_beyond_a_long_is_null():
    x = np.array([[2**40, 0], [0, 0]])
    assert W._deviation(x, 2, [2**40, 0]) == [None, None] and W._deviation(x // 2**38, 2, [4, 0]) == [16, 16]
