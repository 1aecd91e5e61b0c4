"""Operator 13 against plain eigenvectors of exact covariances."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from stagecraft.llm import op13_whitening as op13

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """{vec_id: (n, deviation, whitened up to sign, explained)} from fractions and numpy's own eigenvectors."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(d)]
    cov = np.array([[float(Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n ** 3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in kept:
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        out.append((i, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), centred @ vectors[:, :4] / np.sqrt(values[:4]), values[:4] / cov.trace()))
    return out


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], schema)


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.linspace(3, 0.2, d)
    return [(i, [float(np.float32(c)) for c in rng.normal(size=d) @ mix + 5]) for i in range(n)]


@pytest.mark.parametrize("d", [3, 4, 9, 16])
def test_equals_eigenvectors_of_the_exact_covariance(spark, d):
    rows = vectors(d, 120, d)
    rows += [(500, rows[0][1]), (501, None), (502, [None] * d), (503, [float("nan")] * d), (504, [float("inf")] * d), (0, rows[1][1])]
    want = brute(rows)
    got = op13.report(op13.whiten(table(spark, rows))).collect()
    assert len(got) == len(want) * min(4, d)
    flip = None
    found = {}
    for r in got:
        found.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r
    for i, n, deviation, white, explained in want:
        by = found[(i, deviation)]
        mine = np.array([by[k + 1]["whitened"] for k in range(len(white))])
        if flip is None:
            flip = np.sign(mine * white)
        assert np.allclose(mine * flip, white, rtol=1e-8, atol=1e-9)
        assert all(by[k + 1]["n"] == n and by[k + 1]["identity_error"] < 1e-9 for k in range(len(white)))
        assert np.allclose([by[k + 1]["explained"] for k in range(len(white))], explained, rtol=1e-10)


def test_rotations_keep_small_eigenvalues_exact():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    true = np.array([10.0 ** -k for k in range(12)])
    matrix = q @ np.diag(true) @ q.T
    factor = op13.pivoted_cholesky((matrix + matrix.T) / 2)
    values, axes = op13.one_sided_jacobi(factor)
    assert np.allclose(values[:6], true[:6], rtol=1e-8)
    assert np.allclose(axes.T @ axes, np.eye(axes.shape[1]), atol=1e-12)
    assert np.allclose(factor @ factor.T, matrix, atol=1e-13)


def test_rank_ends_the_components(spark):
    rng = random.Random(3)
    rows = [(i, [float(a := rng.randint(-9, 9)), 2.0 * a, 0.0, 7.0]) for i in range(40)]
    got = op13.report(op13.whiten(table(spark, rows))).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 40
    assert abs(got[0]["explained"] - 1) < 1e-12


def test_odd_tables(spark):
    def out(rows, schema=SCHEMA):
        return op13.report(op13.whiten(table(spark, rows, schema))).collect()
    assert out([]) == [] and out([(1, None)]) == [] and out([(1, [1.0, 2.0])] * 3) == [] and out([(1, []), (2, [])]) == []
    short = out([(1, [1.0]), (2, [1.0, 2.0]), (None, [3.0, 5.0]), (None, [3.0, 5.0]), (4, [])])
    assert len(short) == 10 and {r["n"] for r in short} == {4}
    huge = out([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 2.0])], "vec_id long, embedding array<double>, label int")
    assert len(huge) == 6 and {r["deviation"] for r in huge if r["vec_id"] < 3} == {None} and all(math.isfinite(r["whitened"]) for r in huge)
    clash = spark.createDataFrame([(1, [1.0, 2.0], 0, 1, 2), (2, [2.0, 1.0], 0, 1, 2)], "vec_id long, embedding array<float>, id int, x int, n int")
    assert {r["vec_id"] for r in op13.report(op13.whiten(clash)).collect()} == {1, 2}


def test_tasks_do_not_change_the_fit(spark):
    rows = vectors(2, 300, 6)
    one = op13.report(op13.whiten(table(spark, rows).repartition(1))).orderBy("vec_id", "component").collect()
    many = op13.report(op13.whiten(table(spark, rows).repartition(17))).orderBy("vec_id", "component").collect()
    assert [(r["deviation"], r["explained"]) for r in one] == [(r["deviation"], r["explained"]) for r in many]
    assert np.array_equal([r["whitened"] for r in one], [r["whitened"] for r in many])
