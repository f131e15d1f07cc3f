"""Whitening beside an eigendecomposition, clustering beside plain Lloyd."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import centroids, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"
ODD = [(None, [0.5] * 64, 1), (1001, None, 1), (1002, [], 1), (1003, [None] + [0.0] * 63, 1), (1004, [float("nan")] * 64, 1), (1005, [float("inf")] + [0.0] * 63, 1), (1006, [0.25] * 63, 1), (1007, [0.5] * 64, 2)]


def vectors(seed, n, width=64):
    rng = np.random.default_rng(seed)
    turned = np.linalg.qr(rng.normal(size=(width, width)))[0]
    x = (rng.normal(size=(n, width)) * np.geomspace(2, 0.3, width)) @ turned + rng.normal(size=width)
    return [(k, [float(np.float32(c)) for c in row], k % 3) for k, row in enumerate(x)]


def whitened(rows, width=64):
    """By the covariance and LAPACK."""
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v, _ in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, sums = len(fit), fit.sum(0)
    y = fit - sums / n
    values, parts = np.linalg.eigh(y.T @ y / n)
    return x, n, sums, values[::-1], parts[:, ::-1]


@pytest.mark.parametrize("n", [300, 40])
def test_whitening(spark, n):
    rows = vectors(n, n) + ODD
    rows += rows[:5]
    x, n, sums, values, parts = whitened(rows)
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 16 * len(x) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    deviations = {(i, sum((n * c - int(s)) ** 2 for c, s in zip(v, sums))) for i, v in x}
    assert {(r.vec_id, r.deviation) for r in got} == deviations
    by: dict = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), set()).add(round(r.whitened, 9))
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    for k in range(16):
        want = {i: (np.array(v) - sums / n) @ parts[:, k] / math.sqrt(values[k]) for i, v in x}
        sign = np.sign(sum(want[i] * min(by[i, k + 1]) for i in want))
        assert max(abs(sign * want[i] - w) for i in want for w in by[i, k + 1]) < 1e-7


def test_reduction_of_triangles(spark):
    rows = vectors(9, 500, 8)
    frame = spark.createDataFrame(rows, SCHEMA)
    x = frame.repartition(40).selectExpr("transform(embedding, c -> cast(floor(64 * c) as bigint)) as x")
    plain = np.array([r.x for r in x.collect()])
    for fan in (2, 32):
        r = whitening.tsqr(x, len(plain), plain.sum(0), fan)
        y = plain - plain.mean(0)
        assert r.shape == (8, 8) and np.allclose(r.T @ r, y.T @ y)


@pytest.mark.parametrize("width", [1, 2, 7, 64])
def test_jacobi(width):
    a = np.random.default_rng(width).normal(size=(width + 3, width)) * np.geomspace(1e6, 1e-6, width)
    sigma, v = whitening.one_sided_jacobi(a)
    assert np.allclose(sigma, np.linalg.svd(a)[1], rtol=1e-9) and np.allclose(v.T @ v, np.eye(width), atol=1e-13)
    assert np.allclose(np.linalg.norm(a @ v, axis=0), sigma, rtol=1e-9)


def test_flat_directions(spark):
    """Entries that never change, one vector alone, narrow vectors."""
    rows = [(k, [k / 64, 0.0, 1.0], 0) for k in range(10)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 30 and {r.component for r in got} == {1, 2, 3}
    assert all((r.whitened == 0) == (r.component > 1) for r in got) and got[0].identity_error == pytest.approx(1)
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened) for r in one] == [(1, 0, 0.0)] * 6


def test_huge_deviation():
    x, sums = np.array([[1 << 38, 0], [0, 0]]), np.array([1 << 38, 0])
    with pytest.raises(OverflowError):
        whitening._exact_deviations(x, 4, sums)


def lloyd(rows):
    """Row by row, in whole numbers of any size."""
    x = [(i, [math.floor(1024 * c) for c in v]) for i, v, _ in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    mid = [v for _, v in sorted(x, key=key)[:8]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(mid))
    for _ in range(10):
        own = [near(v)[1] for _, v in x]
        mid = [[sum(c) // len(c) for c in zip(*(v for (_, v), o in zip(x, own) if o == k))] if k in own else m for k, m in enumerate(mid)]
    last = [near(v) for _, v in x]
    total = [sum(d for d, o in last if o == k) for k in range(len(mid))]
    return sorted(((i, k, d, total[k], sum(total), hashlib.sha256(",".join(map(str, mid[k])).encode()).hexdigest()) for (i, _), (d, k) in zip(x, last)), key=str)


@pytest.mark.parametrize("rows", [vectors(3, 200) + ODD + vectors(3, 4), vectors(4, 5), [(k, [0.1] * 64, 0) for k in range(50)] + vectors(5, 20), [(1, [-3.7] * 64, 0), (1, [2.2] * 64, 0), (None, [9.0] * 64, 0)]])
def test_clusters(spark, rows):
    got = centroids.cluster(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == lloyd(rows)


def test_ties_and_floors():
    x = np.array([[0, 0], [2, 0], [1, 0]])
    assert centroids.nearest(x, np.array([[2, 0], [0, 0]]))[0].tolist() == [1, 0, 0]


def test_a_hot_vector_is_one_row(spark):
    """Rounds read distinct vectors, however many rows share one."""
    rows = [(k, [1.0] * 64, 0) for k in range(3000)] + vectors(6, 30)
    got = centroids.cluster(spark.createDataFrame(rows, SCHEMA))
    assert got.count() == 3030 and sorted(map(tuple, got.collect()), key=str) == lloyd(rows)
