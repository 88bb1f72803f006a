"""Whitening against numpy's eigenvalues and plain integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from millrace.llm import whitening
from tests.llm.cases import empty


def integers(rows):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    return [i for i, _ in kept], [[math.floor(1024 * float(c)) + 100_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in kept]


def plainly(rows, most=8):
    ids, x = integers(rows)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    y = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    return ids, n, deviation, y @ vectors / np.sqrt(np.maximum(values, 1e-300)), values / np.trace(y.T @ y / n)


def rows_of(seed, count=300, width=12, mean=50.0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((count, width)) * (1.5 ** -np.arange(width)) + mean
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    return rows + [(500, None), (501, [float("nan"), *rows[0][1][1:]]), (502, [None, *rows[0][1][1:]]),
                   (503, [float("inf"), *rows[0][1][1:]]), (None, rows[3][1]), (4, rows[4][1]), (4, rows[4][1])]


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, white string, n int")


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_is_right(spark, kind):
    rows = rows_of(1)
    got = whitening.whiten(frame(spark, rows, kind)).collect()
    ids, n, deviation, white, share = plainly(rows)
    assert len(got) == 8 * len(ids) and {r.n for r in got} == {n} and all(r.certified for r in got)
    assert max(r.identity_error for r in got) < 1e-9
    for c in range(8):
        mine = sorted(((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == c + 1), key=lambda r: r[:3])
        want = sorted(((i is None, i or 0, d, w) for i, d, w in zip(ids, deviation, white[:, c])), key=lambda r: r[:3])
        assert [m[:3] for m in mine] == [w[:3] for w in want]
        a, b = np.array([m[3] for m in mine]), np.array([w[3] for w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert abs(next(r.explained for r in got if r.component == c + 1) / share[c] - 1) < 1e-10


def test_few_dimensions_equal_vectors_and_empty_tables(spark):
    flat = [(i, [float(i % 5), 2.0, float(i % 5)]) for i in range(20)]  # one direction
    got = whitening.whiten(frame(spark, flat)).collect()
    assert {r.component for r in got} == {1} and len(got) == 20 and got[0].explained == pytest.approx(1)
    assert np.std([r.whitened for r in got]) == pytest.approx(1)
    for rows in ([(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, [])], []):
        df = whitening.whiten(frame(spark, rows))
        assert df.collect() == [] and df.columns[:2] == ["vec_id", "component"]


def test_short_and_far_vectors(spark):
    rows = rows_of(2, 50, 4) + [(700, [1.0]), (701, [1e9, -1e9, 3.0, 0.0]), (702, [1e30, 0.0, 0.0, 0.0])]
    ids, x = integers(rows[:-1])
    got = whitening.whiten(frame(spark, rows[:-1], "double")).collect()
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in zip(ids, x)}
    assert all(r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 2 ** 63 else None) for r in got)
    assert {r.vec_id for r in whitening.whiten(frame(spark, rows, "double")).collect()} == {*ids, 702}


@pytest.mark.parametrize("seed", range(4))
def test_spectrum_slicing(seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    values = np.array({0: np.linspace(1, 9, 30), 1: [5.0] * 4 + [3.0] * 5 + [1.0] * 21, 2: [1 + 1e-9, 1.0, 1 - 1e-9] + [0.1] * 27,
                       3: 10.0 ** -np.arange(30)}[seed])
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got = whitening.leading(a, 8)
    want = np.sort(values)[::-1][:8]
    assert np.abs(np.array(got.values) - want).max() < 1e-12 * want[0] and all(got.certified)
    assert np.abs(got.vectors @ got.vectors.T - np.eye(8)).max() < 1e-12
    assert np.abs(a @ got.vectors.T - got.vectors.T * got.values).max() < 1e-12 * want[0]


def test_counts_and_factors():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17):
        a = rng.standard_normal((n, n))
        a = a + a.T
        a[0, 0] = 0.0
        values = np.linalg.eigvalsh(a)
        for s in [*np.linspace(values[0] - 1, values[-1] + 1, 9), 0.0]:
            assert whitening.above(a, s) == (values > s).sum()
        b = rng.standard_normal(n)
        if abs(values).min() > 1e-9:
            assert np.allclose(a @ whitening.solve(whitening.factor(a), b, 1e-300), b)


def test_the_covariance_keeps_its_digits_far_from_zero(spark):
    rows = [(i, [1e6 + (i % 7) / 1024, 1e6 - (i % 3) / 1024]) for i in range(40)]
    _, x = integers(rows)
    vectors = frame(spark, rows, "double").select("embedding")
    n, sums, spread = whitening._totals(vectors)
    assert (n, sums) == (40, [sum(c) for c in zip(*x)])
    assert np.allclose(whitening._covariance(vectors, n, sums, spread), np.cov(np.array(x).T, bias=True), rtol=1e-13, atol=0)


def test_other_tables(spark):
    assert whitening.whiten(empty(spark).selectExpr("doc_id vec_id", "array(score) embedding")).collect() == []
