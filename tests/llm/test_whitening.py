import math

import numpy as np
import pytest

from daytally.llm import whitening
from daytally.llm.bidiagonal import bidiagonalised, dqds, singular
from daytally.llm.whitening import whitened

SCHEMA = "vec_id long, embedding array<double>"
RNG = np.random.default_rng(11)


def orthogonal(n):
    return np.linalg.qr(RNG.normal(size=(n, n)))[0]


MATRICES = {
    "one": np.array([[3.0]]),
    "random": np.triu(RNG.normal(size=(24, 24))),
    "identity": np.eye(9),
    "tied": np.linalg.qr(np.diag(np.r_[np.full(10, 3.0), np.full(14, 1.0)]) @ orthogonal(24))[1],
    "nearly tied": np.linalg.qr(np.diag(1 + 1e-9 * np.arange(20)) @ orthogonal(20))[1],
    "rank 5": np.vstack([np.linalg.qr(RNG.normal(size=(5, 20)))[1], np.zeros((15, 20))]),
    "graded": np.linalg.qr(np.diag(10.0 ** (-np.arange(20) / 2)) @ orthogonal(20))[1],
    "large": 1e150 * np.triu(RNG.normal(size=(8, 8))),
    "zero": np.zeros((4, 4)),
}


@pytest.mark.parametrize("name", list(MATRICES))
def test_singular_values_and_vectors(name):
    m = MATRICES[name]
    squares, vectors = singular(m)
    true = np.linalg.svd(m, compute_uv=False)
    assert np.allclose(np.sqrt(squares), true, rtol=1e-10, atol=1e-13 * true[0])
    real = true > 1e-11 * true[0]
    v = vectors[real]
    assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-9)
    scaled = m / max(true[0], 1e-300)
    assert np.allclose(scaled.T @ (scaled @ v.T), v.T * (true[real] / max(true[0], 1e-300)) ** 2, atol=1e-13)


def test_bidiagonal_form():
    m = RNG.normal(size=(12, 12))
    a, b, q = bidiagonalised(m)
    band = np.diag(a) + np.diag(b, 1)
    assert np.allclose(q.T @ q, np.eye(12))
    assert np.allclose(q @ band.T @ band @ q.T, m.T @ m)


def test_small_values_are_relatively_accurate():
    # The entries of a bidiagonal matrix fix even tiny singular values to full relative precision.
    a = 10.0 ** -np.arange(12)
    b = a[1:] * 0.5
    squares = dqds(a, b)
    assert math.isclose(np.prod(squares / a[::-1][::-1] ** 2), 1.0, rel_tol=1e-12)


def plain(rows, most=16):
    """Rows and components from the eigenvectors of the covariance."""
    held = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in held], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    kept = min(most, int((e > 1e-12 * e[0]).sum()))
    white = ((n * x - sums) / n) @ v[:, :kept] / np.sqrt(e[:kept])
    return [i for i, _ in held], n, ((n * x - sums) ** 2).sum(axis=1), white, e[:kept] / e.sum()


def check(spark, rows, parts=3):
    ids, n, deviation, white, explained = plain(rows)
    got = whitened(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert len(got) == white.size
    assert {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
    sign = {}
    for i, d, row in zip(ids, deviation.tolist(), white, strict=True):
        for c, value in enumerate(row, 1):
            theirs = by[i, d][c]
            if abs(value) > 1e-6:
                sign.setdefault(c, math.copysign(1, theirs[0] * value))
            assert any(abs(t - sign.get(c, 1) * value) < 1e-6 for t in theirs)


def test_agrees_with_eigenvectors(spark):
    check(spark, [(i, (RNG.normal(size=20) * (1 + np.arange(20))).tolist()) for i in range(400)], parts=5)


def test_repeated_rows_count_once(spark):
    base = [(i, (RNG.normal(size=5) * (1 + np.arange(5))).tolist()) for i in range(60)]
    check(spark, base + base[:7] + [(100 + i, base[3][1]) for i in range(40)] + [(None, base[5][1])])


def test_odd_rows(spark):
    rows = [(i, (RNG.normal(size=4) * [5, 3, 2, 1]).tolist()) for i in range(30)]
    odd = [(90, None), (91, [None, 1.0, 1.0, 1.0]), (92, [math.nan] * 4), (93, [math.inf, 0.0, 0.0, 0.0]), (94, [])]
    check(spark, rows + odd)
    short = whitened(spark.createDataFrame([*rows, (95, [1.0, 2.0])], SCHEMA))
    assert short.where("vec_id = 95").isEmpty() and short.count() == 120


def test_fewer_vectors_than_dimensions(spark):
    check(spark, [(i, (RNG.normal(size=9) * (1 + np.arange(9))).tolist()) for i in range(4)])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_without_variance_there_are_no_components(spark, rows):
    assert whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_factors_of_many_tasks_are_merged(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, [(i, (RNG.normal(size=6) * (1 + np.arange(6))).tolist()) for i in range(300)], parts=11)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_deviations_beyond_64_bits_are_null():
    rows = np.array([[2**31, 2**31], [3, 4], [2**32, 2**33]], np.int64)
    assert whitening._deviation(rows) == [None, 25, None]


def test_other_columns_may_have_any_name(spark):
    rows = [(i, RNG.normal(size=3).tolist()) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as x", "2 as n", "3 as component", "4 as sums")
    assert whitened(df).count() == 60
