"""The solver against numpy's, and whitening against plain numbers."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemart.llm import bidiagonal, whitening


def check(a, most=None):
    squares, v = bidiagonal.right_vectors(a, most or len(a))
    want = np.linalg.svd(a, compute_uv=False)[:len(squares)]
    assert np.allclose(np.sqrt(squares), want, rtol=1e-9, atol=1e-13 * (want[0] if len(want) else 1))
    assert np.allclose(v.T @ v, np.eye(len(squares)), atol=1e-10)
    if len(squares):
        assert np.abs(a.T @ (a @ v) - v * squares).max() <= 1e-12 * squares[0]
    return squares


def random_orthogonal(rng, d):
    return np.linalg.qr(rng.normal(size=(d, d)))[0]


@pytest.mark.parametrize("values", [
    np.ones(6), np.r_[np.ones(20), 2 * np.ones(20)], np.logspace(0, -6, 30), np.r_[1, 1 + 1e-9, 1 + 1e-6, np.linspace(.2, .9, 20)],
    np.r_[3.0, 2.0, np.zeros(10)], np.zeros(4), np.ones(1), np.r_[5.0, 5.0], np.linspace(1, 2, 64)])
def test_solver_on_given_values(values):
    rng = np.random.default_rng(len(values))
    a = random_orthogonal(rng, len(values)) @ np.diag(values) @ random_orthogonal(rng, len(values))
    squares = check(a)
    assert len(squares) == np.count_nonzero(values)


def test_solver_on_diagonal_and_sparse():
    check(np.diag([1.0, 1, 1, 2, 2, 3, 0]))
    check(np.triu(np.ones((9, 9))))
    check(np.eye(5, k=1))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7).flatmap(lambda d: st.lists(st.lists(st.integers(-3, 3), min_size=d, max_size=d), min_size=d, max_size=d)))
def test_solver_on_small_whole_numbers(rows):
    check(np.array(rows, float))


VECTORS = [(i, [math.sin(i * j + j) for j in range(1, 6)]) for i in range(60)]
VECTORS += [(100, VECTORS[3][1]), (101, VECTORS[3][1]), (None, VECTORS[4][1]), (102, None), (103, [1.0, None, 1.0, 1.0, 1.0]),
            (104, [math.nan] * 5), (105, [1.0, math.inf, 0.0, 0.0, 0.0]), (106, []), (107, [0.5])]


def whitened(spark, rows, kind="float", parts=7):
    table = spark.createDataFrame([(*r, "mark", "mark") for r in rows],
                                  f"vec_id long, embedding array<{kind}>, n string, whitened string").repartition(parts)
    steps = whitening.with_steps(table).drop("embedding")
    return whitening.whiten(steps, whitening.fit(steps)).collect()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_same_as_plain_numbers(spark, kind):
    got = whitened(spark, VECTORS, kind)
    kept = VECTORS[:63]
    x = np.array([[math.floor(256 * (np.float32(c) if kind == "float" else c)) for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, u = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    want = (x - s / n) @ u[:, :4] / np.sqrt(e[:4])
    assert len(got) == 4 * len(kept)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = [np.sign(by[0][k + 1]["whitened"] * want[0][k]) for k in range(4)]
    for (key, _), row, steps in zip(kept, want, x):
        for k in range(4):
            r = by[key][k + 1]
            assert r["whitened"] == pytest.approx(signs[k] * row[k], abs=1e-9)
            assert r["deviation"] == int(((n * steps - s) ** 2).sum()) and r["n"] == n
            assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9
    assert list(got[0].asDict()) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_triangles_of_many_blocks(spark, monkeypatch):
    one = {(r["vec_id"], r["component"]): r for r in whitened(spark, VECTORS[:60])}
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        many = whitened(spark, VECTORS[:60])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for r in many:
        assert r["whitened"] == pytest.approx(one[r["vec_id"], r["component"]]["whitened"], abs=1e-9)


def test_few_distinct_vectors_have_few_components(spark):
    rows = [(i, [float(i % 3), 1.0, 2.0 * (i % 3)]) for i in range(30)]
    got = whitened(spark, rows)
    assert {r["component"] for r in got} == {1} and len(got) == 30
    assert whitened(spark, [(i, [1.0, 2.0]) for i in range(5)]) == []
    assert whitened(spark, []) == [] and whitened(spark, [(1, None), (2, [])]) == []


def test_huge_entries_stay_exact(spark):
    rows = [(0, [0.0, 1.0]), (1, [1e15, 2.0]), (2, [-1e15, 0.0]), (3, [2e15, 5.0])]
    got = whitened(spark, rows, "double")
    assert {r["component"] for r in got} >= {1} and all(r["deviation"] is None for r in got)
    assert got[0]["identity_error"] < 1e-4
