import math
import random

import numpy as np
import pytest

from fleetpulse.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string"


def brute(vectors, k=4):
    """n, deviations, components, variances, trace by plain arithmetic over the distinct grid vectors."""
    grid = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors]
    fit = sorted(set(grid))
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    x = np.array(fit, float) - np.array([t / n for t in total])
    values, vectors = np.linalg.eigh(x.T @ x / n)
    order = np.argsort(-values)[:k]
    deviations = [sum((n * c - t) ** 2 for c, t in zip(g, total, strict=True)) for g in grid]
    projected = (np.array(grid, float) - np.array([t / n for t in total])) @ vectors[:, order]
    return n, deviations, projected, values[order], values.sum()


def run(spark, rows, **kw):
    return W.whiten(spark.createDataFrame(rows, SCHEMA), **kw).collect()


def compare(spark, vectors):
    got = run(spark, [(i, v, 0, "a", "b") for i, v in enumerate(vectors)])
    n, deviations, projected, values, trace = brute(vectors)
    k = min(4, len(vectors[0]))
    assert len(got) == k * len(vectors)
    by = {(r.vec_id, r.component): r for r in got}
    for j in range(k):
        own = np.array([by[i, j + 1].whitened for i in range(len(vectors))])
        want = projected[:, j] / math.sqrt(values[j])
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-8
        assert by[0, j + 1].explained == pytest.approx(values[j] / trace, rel=1e-10)
    assert all(r.n == n and r.deviation == deviations[r.vec_id] and r.identity_error < 1e-9 for r in got)


def test_matches_brute_force(spark):
    rnd = np.random.default_rng(1)
    for d, n in ((1, 5), (3, 40), (8, 300), (64, 500)):
        vectors = (rnd.normal(size=(n, d)) * np.linspace(1, 0.1, d)).tolist()
        compare(spark, vectors + vectors[:3] + [[c + 1e-5 for c in vectors[0]]])


def test_fewer_vectors_than_dimensions(spark):
    vectors = np.random.default_rng(2).normal(size=(3, 10)).tolist()
    got = run(spark, [(i, v, 0, "a", "b") for i, v in enumerate(vectors)])
    assert {(r.component, r.whitened is None) for r in got} == {(1, False), (2, False), (3, True), (4, True)}
    assert all(r.identity_error < 1e-9 for r in got)
    assert sum({r.component: r.explained for r in got}.values()) == pytest.approx(1)


def test_equal_variances_stay_orthogonal(spark):
    vectors = [[0.5 * s * (i == j) for i in range(6)] for j in range(6) for s in (1, -1)]
    got = run(spark, [(i, v, 0, "a", "b") for i, v in enumerate(vectors)])
    assert all(r.identity_error < 1e-9 and r.explained == pytest.approx(1 / 6) for r in got)


def test_rows_that_go_and_rows_that_repeat(spark):
    rnd = random.Random(3)
    vectors = [[rnd.uniform(-1, 1) for _ in range(5)] for _ in range(30)]
    rows = [(i, v, 0, "a", "b") for i, v in enumerate(vectors)]
    odd = [(100, None, 0, None, None), (101, [1.0, None, 1.0, 1.0, 1.0], 0, None, None), (102, [math.nan] * 5, 0, None, None), (103, [math.inf] * 5, 0, None, None), (104, [], 0, None, None), (105, [1.0, 2.0], 0, None, None)]
    plain = {(r.vec_id, r.component): tuple(r) for r in run(spark, rows)}
    got = run(spark, rows + odd + [(None, vectors[0], None, None, None), rows[1]])
    assert len(got) == 4 * 32 and {r.n for r in got} == {30}
    for r in got:
        assert tuple(r)[2:] == pytest.approx(plain[r.vec_id if r.vec_id is not None else 0, r.component][2:])
    assert run(spark, []) == run(spark, odd[:5]) == []


def test_nothing_varies(spark):
    got = run(spark, [(i, [0.25, 0.5], 0, "a", "b") for i in range(3)])
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, None, 0.0)] * 6


def test_entries_beyond_a_long(spark):
    got = run(spark, [(0, [3e38, 1.0], 0, "a", "b"), (1, [-3e38, 2.0], 0, "a", "b"), (2, [0.0, 1.5], 0, "a", "b")])
    assert len(got) == 6 and all(r.deviation is None for r in got if r.vec_id < 2)
    assert all(abs(abs(r.whitened) - math.sqrt(1.5)) < 1e-9 for r in got if r.component == 1 and r.vec_id < 2)


@pytest.mark.parametrize("seed", range(6))
def test_bidiagonal_values_and_vectors(seed):
    """Values to high relative accuracy, vectors orthonormal, also for clusters, zeros and wide ranges."""
    rnd = np.random.default_rng(seed)
    for n in (1, 2, 3, 10, 40):
        a, b = rnd.normal(size=n), rnd.normal(size=max(0, n - 1))
        if seed == 1:
            a = a * 10.0 ** np.linspace(0, -12, n)
        if seed == 2:
            b[rnd.random(len(b)) < 0.3] = 0
        if seed == 3:
            a[rnd.random(n) < 0.2] = 0
        if seed == 4:
            a, b = np.ones(n), np.full(len(b), 1e-9)
        if seed == 5:
            a, b = np.abs(a) + 5, b * 1e-4
        m = np.diag(a) + np.diag(b, 1)
        want = np.linalg.svd(m, compute_uv=False) ** 2
        got = W.bidiagonal_vectors(a, b, n)
        assert np.abs(np.array([v for v, _ in got]) - want).max() <= 1e-13 * max(1, want[0])
        z = np.array([v for _, v in got])[:4]
        assert np.abs(z @ z.T - np.eye(len(z))).max() < 1e-9
        for v, x in got[:4]:
            assert np.abs(m.T @ (m @ x) - v * x).max() < 1e-12 * max(1, want[0])


def test_reflections_give_back_the_matrix():
    rnd = np.random.default_rng(7)
    for n in (1, 2, 5, 30):
        r = np.triu(rnd.normal(size=(n, n)))
        a, b, _ = W.bidiagonal(r)
        m = np.diag(a) + np.diag(b, 1)
        assert np.allclose(np.linalg.svd(m, compute_uv=False), np.linalg.svd(r, compute_uv=False), rtol=1e-12)
        values = W.dqds((a * a).tolist(), (b * b).tolist())
        assert np.allclose(np.sqrt(values), np.linalg.svd(r, compute_uv=False), rtol=1e-11)


def test_factors_of_many_tasks_merge_to_one(spark):
    x = np.unique(np.random.default_rng(8).integers(-200, 200, size=(400, 7)), axis=0)
    fit = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>").repartition(40)
    c = W.centre(fit)
    r = W.triangular_factor(fit, c)
    a = x - x.mean(0)
    assert (c.n, c.total) == (len(x), x.sum(0).tolist())
    assert r.shape == (7, 7) and np.allclose(r.T @ r, a.T @ a, rtol=1e-12)
