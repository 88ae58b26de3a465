"""Whitening against numpy and whole-number arithmetic on small tables."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import whitening

VECTORS = "vec_id long, embedding array<float>"


def plain(vectors):
    """n, exact deviations, eigenvalues and whitened values up to sign, from fractions."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - s[i] for i in range(d)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    w = (np.array(y, dtype=float) / n) @ axes / np.sqrt(np.maximum(values, 1e-300))
    return n, [sum(v * v for v in r) for r in y], values, w, np.trace(cov)


def check(got, vectors, components=8):
    n, deviation, values, w, trace = plain(vectors)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(vectors) * components and len(by_id) == len(vectors)
    for i, (vec_id, _) in enumerate(vectors):
        mine = by_id[vec_id]
        assert sorted(mine) == list(range(1, components + 1))
        assert all(r.n == n and r.deviation == deviation[i] and r.identity_error < 1e-8 for r in mine.values())
    for c in range(components):
        column = np.array([by_id[v][c + 1].whitened for v, _ in vectors])
        sign = np.sign(column @ w[:, c])
        assert np.abs(column * sign - w[:, c]).max() < 1e-6
        assert abs(by_id[vectors[0][0]][c + 1].explained - values[c] / trace) < 1e-10


def gauss(seed, n, d, scale=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0.3 * j, scale / (j + 1)) for j in range(d)]) for i in range(n)]


def test_equals_plain_arithmetic(spark):
    vectors = gauss(1, 200, 12)
    dropped = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, [-float("inf")] * 12)]
    df = spark.createDataFrame(vectors + dropped, VECTORS).repartition(5)
    df = df.withColumns({"n": F.lit("clash"), "x": F.lit(1), "dims": F.lit("d"), "w": F.lit(0)})
    check(whitening.whiten(df).collect(), vectors)


def test_does_not_depend_on_how_rows_are_dealt(spark):
    df = spark.createDataFrame(gauss(2, 100, 9), VECTORS)
    a, b = (sorted(map(tuple, whitening.whiten(df.repartition(k)).drop("identity_error").collect())) for k in (1, 7))
    assert [r[:4] for r in a] == [r[:4] for r in b]
    assert max(abs(p - q) for r, t in zip(a, b, strict=True) for p, q in zip(r[4:], t[4:], strict=True)) < 1e-12


def test_immense_entries_are_exact(spark):
    """Squares beyond 64 bits go through whole numbers of any size."""
    vectors = [(i, [1e8 * (i % 5) + i, 3e8 * (i % 3), float(i), 2e7]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(vectors, VECTORS).repartition(3)).collect()
    n, deviation, values, _, trace = plain(vectors)
    assert len({r.vec_id for r in got}) == 40
    for r in got:
        assert r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 1 << 63 else None)
        assert abs(r.explained - values[r.component - 1] / trace) <= 1e-4 * r.explained
    assert any(d >= 1 << 63 for d in deviation)


def test_covariance_is_exact_far_from_the_origin(spark):
    """Values near 1e9 with a spread of 1: sums of products would lose it."""
    r = random.Random(5)
    df = spark.createDataFrame([(i, [1e9 + r.randint(0, 3), 2e9 + r.randint(0, 5)]) for i in range(50)], "vec_id long, embedding array<double>")
    x = whitening.whole_numbers(df)
    got = whitening.fit(x)[2]
    plain_x = np.array([row.x for row in x.collect()], dtype=object)
    n = len(plain_x)
    s = plain_x.sum(axis=0)
    y = plain_x * n - s
    want = sum(float(Fraction(int((y[:, i] ** 2).sum()), n**3)) for i in range(2))
    assert abs(got.trace - want) <= 1e-12 * want and len(got.values) == 2


def test_odd_tables(spark):
    def rows(data):
        return sorted((r.vec_id or -1, r.component) for r in whitening.whiten(spark.createDataFrame(data, VECTORS)).collect())

    assert rows([]) == [] and rows([(1, None), (2, [])]) == []
    assert rows([(1, [1.0, 2.0])]) == []  # no variance
    assert rows([(1, [1.0, 2.0]), (2, [3.0, 2.0])]) == [(1, 1), (2, 1)]  # one direction varies
    same = [(1, [1.0]), (1, [1.0]), (None, [2.0]), (2, [4.0])]
    assert rows(same) == [(-1, 1), (1, 1), (1, 1), (2, 1)]
    two = gauss(3, 30, 4) + [(100 + i, v) for i, v in gauss(4, 20, 3)]
    got = whitening.whiten(spark.createDataFrame(two, VECTORS)).collect()
    assert {(r.vec_id >= 100, r.n, r.component) for r in got} == {(False, 30, c) for c in (1, 2, 3, 4)} | {(True, 20, c) for c in (1, 2, 3)}
    check([r for r in got if r.vec_id >= 100], two[30:], 3)


@pytest.mark.parametrize("n,d", [(1, 1), (5, 3), (70, 10)])
def test_polarisation_gives_the_covariance(n, d):
    rng = np.random.default_rng(n)
    x = rng.integers(-1000, 1000, (n, d))
    sums = [int(v) for v in x.sum(axis=0)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    u = x - np.array(centre)
    squares = {(i, i + k): q for i in range(d) for k, q in enumerate(whitening._square_sums(u.copy(), i))}
    want = np.cov(x.T, bias=True).reshape(d, d)
    assert np.allclose(whitening.covariance(n, sums, centre, squares), want, rtol=1e-9, atol=1e-9)
