"""Bit-sliced whitening against plain integer arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from starbuild.llm import queries, whitening


def integers(vector):
    if vector is None or any(e is None or not math.isfinite(e) for e in vector):
        return None
    return tuple(math.floor(256 * float(e)) for e in vector)


def brute(rows, most=4):
    """n, sums, covariance, eigenvalues and vectors, from sums of Python integers."""
    fit = sorted({x for x in map(integers, rows) if x is not None})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(dims)]
    centred = [[n * x[j] - sums[j] for j in range(dims)] for x in fit]
    c = np.array(centred, object)
    v = np.array([[float(Fraction(int(e), n**3)) for e in row] for row in c.T @ c])
    values, vectors = np.linalg.eigh(v)
    return n, sums, v, values[::-1][:most], vectors[:, ::-1][:, :most]


@pytest.mark.parametrize("reach", [3, 200, 1 << 20, 1 << 40])
def test_cross_products(reach):
    rng = np.random.default_rng(reach)
    x = rng.integers(-reach, reach, (150, 5))
    x[:, 3] = 7  # no plane at all
    sums, products = whitening.cross_products(x)
    exact = x.astype(object)
    assert [int(s) for s in sums] == exact.sum(axis=0).tolist()
    want = exact.T @ exact
    assert all(int(products[j, k]) == want[j, k] for j in range(5) for k in range(j, 5))


def test_whitening_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    source = {r.vec_id: r.embedding for r in table.collect()}
    n, sums, v, values, vectors = brute(source.values())
    got = queries.op11_bit_sliced_whitening(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 4 * sum(integers(e) is not None for e in source.values())
    sign = {}
    for r in got:
        x = integers(source[r.vec_id])
        c = r.component - 1
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        want = sum((n * a - s) / n * vectors[j, c] for j, (a, s) in enumerate(zip(x, sums))) / math.sqrt(values[c])
        if abs(want) > 1e-6:
            assert sign.setdefault(c, want * r.whitened > 0) == (want * r.whitened > 0)
        assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-9, abs=1e-9)
        assert r.explained == pytest.approx(values[c] / np.trace(v), rel=1e-9)
        assert r.identity_error <= 1e-9


def test_whitening_with_a_large_offset(spark):
    """A mean a million times the spread: floating-point sums of products would lose the spread."""
    rng = np.random.default_rng(1)
    rows = [[float(1e6 + a), float(-1e6 + a + b), float(c)] for a, b, c in rng.normal(0, 1, (400, 3))]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    n, sums, v, values, vectors = brute(rows)
    got = whitening.whiten(df.repartition(5)).collect()
    assert {r.component for r in got} == {1, 2, 3}
    for r in got:
        c = r.component - 1
        x = integers(rows[r.id])
        want = sum((n * a - s) / n * vectors[j, c] for j, (a, s) in enumerate(zip(x, sums))) / math.sqrt(values[c])
        assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-6, abs=1e-6)
        assert r.explained == pytest.approx(values[c] / np.trace(v), rel=1e-6) and r.identity_error < 1e-6


def test_whitening_on_hostile_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(e) for e in rng.normal(0, 1, 3)], 1) for i in range(30)]
    odd = [
        (100, None, 1),
        (101, [1.0, None, 2.0], 1),
        (102, [1.0, float("nan"), 2.0], 1),
        (103, [1.0, float("-inf"), 2.0], 1),
        (104, [1.0, 2.0], 1),
        (105, [], 1),
        (None, good[0][1], 1),
        (0, good[0][1], 1),
        (0, [-0.0, 0.0, -0.001], 1),
    ]
    hot = [(1000 + i, good[1][1], 1) for i in range(200)]
    df = spark.createDataFrame(good + odd + hot, "vec_id long, embedding array<double>, n int")
    for c in ("id", "x", "j", "k", "component", "deviation"):
        df = df.withColumn(c, F.lit(c))
    out = whitening.whiten(df).collect()
    assert {r.n for r in out} == {31} and len(out) == 3 * (30 + 3 + 200)
    assert sum(r.id is None for r in out) == 3 and sum(r.id == 0 for r in out) == 9
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 1e18]), (3, [-1e30, 5.0])], "vec_id long, embedding array<double>")
    assert {r.id for r in whitening.integer_vectors(huge).collect()} == {1, 2, 3}
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(flat).collect() == [] and whitening.whiten(flat.limit(0)).collect() == []
