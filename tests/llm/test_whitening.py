import math
import random

import numpy as np
import pytest

from opinara.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, n string, x array<int>, component int"
RNG = np.random.default_rng(4)
TURN, _ = np.linalg.qr(RNG.standard_normal((30, 30)))


def spread(values):
    k = len(values)
    return TURN[:k, :k] @ np.diag(values) @ TURN[:k, :k].T if k == 30 else np.diag(values)


@pytest.mark.parametrize("matrix", [
    np.zeros((0, 0)), np.array([[2.0]]), np.array([[2.0, 1], [1, 3]]), np.zeros((4, 4)), np.eye(7), np.diag([3.0, 3, 3, 1, 1, 0]),
    spread([1.0] * 10 + [0.5] * 10 + [0.0] * 10), spread(list(np.logspace(0, -14, 30))), spread(list(np.linspace(0, 1, 30))),
    spread([1.0, 1.0 + 1e-9, 1.0 - 1e-9] + [0.25] * 27), np.diag(np.arange(9.0)), np.cov(RNG.standard_normal((64, 500)))])
def test_components_are_those_of_the_library(matrix):
    values, vectors = w.eigenpairs(matrix)
    scale = max(np.linalg.norm(matrix), 1e-300)
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1], rtol=0, atol=1e-13 * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(len(matrix)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max(initial=0) <= 1e-13 * scale
    few, _ = w.eigenpairs(matrix, 3)
    assert np.allclose(few, values[:3], rtol=0, atol=1e-13 * scale)


def test_polar_factor_is_the_sign():
    values = np.linspace(-1, 2, 30)
    sign = w.polar(spread(list(values)))
    assert np.allclose(sign, spread(list(np.sign(values))), atol=1e-13)


def reference(vectors, most=16):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=np.int64)
    n, total = len(fit), [int(s) for s in fit.sum(axis=0)]
    y = (n * fit - np.array(total)) / n
    covariance = y.T @ y / n
    values, vecs = np.linalg.eigh(covariance)
    values, vecs = values[::-1][:most], vecs[:, ::-1][:, :most]
    rows = (n * np.array(x) - np.array(total)) / n @ (vecs / np.sqrt(values))
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, total)) for v in x]
    return n, deviation, rows, values / np.trace(covariance)


def test_rows_are_whitened_by_the_distinct_vectors(spark):
    rnd = random.Random(1)
    vectors = [[rnd.gauss(0, 1 + k) for k in range(20)] for _ in range(300)]
    vectors += [vectors[0]] * 200  # copies count once
    rows = [(i, v, "clash", [1], 9) for i, v in enumerate(vectors)]
    got = w.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    n, deviation, expected, explained = reference(vectors)
    assert len(got) == 500
    signs = np.sign(np.array(next(r.whitened for r in got if r.vec_id == 0)) * expected[0])
    for r in got:
        assert r.n == n == 300 and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-10
        assert np.allclose(np.array(r.whitened) * signs, expected[r.vec_id], atol=1e-9) and np.allclose(r.explained, explained)
    each = w.component_rows(w.whiten(spark.createDataFrame(rows, SCHEMA)))
    assert each.count() == 500 * 16 and each.agg({"component": "max"}).first()[0] == 16


def test_rows_without_a_whole_vector_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [3.0, 5.0]), (None, [2.0, 9.0]),
            (7, [1.0, 2.0, 3.0]), (8, []), (6, [3.0, 5.0])]
    got = w.whiten(spark.createDataFrame([(*r, "", None, None) for r in rows], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n, len(r.whitened)) for r in got) == [(0, 3, 2), (1, 3, 2), (6, 3, 2), (6, 3, 2)]


@pytest.mark.parametrize("vectors, parts", [([[1.0, 2.0]] * 3, 0), ([[1.0, 2.0], [1.0, 4.0]], 1), ([[]], 0)])
def test_flat_directions_have_no_component(spark, vectors, parts):
    got = w.whiten(spark.createDataFrame([(i, v, "", None, None) for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert [len(r.whitened) for r in got] == [parts] * (len(vectors) if vectors[0] else 0)


def test_deviations_beyond_a_long_are_an_error(spark):
    rows = [(i, [float(10.0 ** 9 * i)], "", None, None) for i in range(40)]
    with pytest.raises(Exception, match="do not fit a long"):
        w.whiten(spark.createDataFrame(rows, SCHEMA)).collect()


def test_no_rows(spark):
    assert w.component_rows(w.whiten(spark.createDataFrame([], SCHEMA))).collect() == []
