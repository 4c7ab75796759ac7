"""Whitening: against numpy's eigendecomposition; spectrum slicing on hard matrices; odd rows."""

import math

import numpy as np
import pytest

from weftline.llm import whitening as wh


def brute(rows, scale=256):
    """Kept rows, and the fit list, as integers."""
    x = [(i, tuple(math.floor(scale * c) for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return x, np.array(sorted({v for _, v in x}))


def check(df, components=4):
    got = wh.whiten(df, components).collect()
    rows, fit = brute([(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()])
    n, sums = len(fit), fit.sum(0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    assert len(got) == len(rows) * len(values)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    signs = {}
    for i, x in rows:
        far = [n * a - int(s) for a, s in zip(x, sums)]
        for k, (value, v) in enumerate(zip(values, vectors), 1):
            r = by_id[i][k]
            assert r.deviation == sum(f * f for f in far)
            assert r.explained == pytest.approx(value / np.cov(fit.T, bias=True).trace(), rel=1e-9)
            want = (np.array(far) / n) @ v / math.sqrt(value)
            signs.setdefault(k, np.sign(want * r.whitened) or 1)
            assert r.whitened * signs[k] == pytest.approx(want, abs=1e-7)


def test_real_rows(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").repartition(5))


def test_odd_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(k, [float(v) for v in draw.normal(size=5)]) for k in range(40)]
    rows += [(40, None), (41, [1.0, None, 0.0, 0.0, 0.0]), (42, [1.0, float("nan"), 0.0, 0.0, 0.0]), (43, [float("inf")] + [0.0] * 4), (44, rows[0][1]), (45, rows[0][1]), (None, rows[1][1]), (3, [-0.001, -0.0, 0.0, 9.0, -9.0])]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<double>, n int, component string").repartition(3)
    got = wh.whiten(df).collect()
    assert len(got) == 4 * 44 and {r.n for r in got} == {41}
    check(df.filter("vec_id != 3 AND vec_id IS NOT NULL"))
    mixed = df.unionByName(spark.createDataFrame([(99, [1.0, 2.0], 7, "x"), (98, [], 7, "x")], df.schema))
    assert wh.whiten(mixed).count() == 4 * 44  # another length is left out
    assert wh.whiten(df.filter("vec_id > 1000")).count() == 0
    assert wh.whiten(df.filter("vec_id = 40")).count() == 0


def test_fewer_dimensions_and_no_spread(spark):
    flat = spark.createDataFrame([(1, [2.0, 2.0]), (2, [2.0, 2.0])], "vec_id long, embedding array<float>")
    got = wh.whiten(flat).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, None)] * 4
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 5.0]) for k in range(9)], "vec_id long, embedding array<float>")
    got = wh.whiten(line).collect()
    assert len(got) == 27 and all((r.whitened is None) == (r.component > 1) for r in got) and got[0].identity_error < 1e-9


def test_large_entries(spark):
    rows = [(k, [1e12 * (k + 1) ** 2, -1e9 * k, 1e30]) for k in range(6)]
    got = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 1).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got)  # beyond 64 bits
    assert got[0].identity_error < 1e-9


def random_symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1], [9, 9, 9, 1, 0], [7, 7 - 1e-9, 7 - 2e-9, 1, 1, 1], [1e6, 1, 1e-6, 0, 0], [3, 3, 3, 3], [2.0], list(np.linspace(1, 1.01, 40)), [0, 0, -1, -2], [4, 1, 1, 1, 1, 1],
    ],
)
def test_spectrum_slicing(values):
    for seed in range(3):
        a = random_symmetric(values, seed)
        a = (a + a.T) / 2
        got, vectors = wh.leading(a, 4)
        want = np.sort(values)[::-1][:4]
        size = np.abs(a).max()
        assert np.allclose(got, want, atol=1e-13 * size * len(a)) and (np.diff(got) <= 1e-13 * size).all()
        assert np.abs(vectors @ vectors.T - np.eye(len(got))).max() < 1e-6 and np.abs(vectors @ a - got[:, None] * vectors).max() < 1e-12 * size * len(a)


def test_inertia():
    for seed in range(20):
        values = np.random.default_rng(seed).integers(-3, 4, 12) + 0.25
        a = random_symmetric(values, seed)
        for shift in (-2.5, 0.0, 1.0, 2.0):
            assert wh.inertia((a + a.T) / 2, shift) == (values > shift).sum()
    assert wh.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
