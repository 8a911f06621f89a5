"""Whitening against numpy on the integer vectors, and its exact steps against known answers."""

import random
import sys
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from tidewatch.llm import whitening as W


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, component string, n int")


def check(result, rows, wanted=8):
    ids = [r[0] for r in rows]
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * 1024) + 100_000
    n, d = x.shape
    s = x.sum(axis=0)
    v = np.cov(x.T, bias=True).reshape(d, d)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    got = {}
    for r in result:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(ids) and all(sorted(g) == list(range(1, min(wanted, d) + 1)) for g in got.values())
    for i, row in zip(ids, x):
        for k in range(min(wanted, d)):
            r = got[i][k + 1]
            assert r.n == n and int(r.deviation) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))
            assert r.explained == pytest.approx(e[k] / e.sum(), rel=1e-9, abs=1e-12)
            assert r.identity_error is None or r.identity_error < 1e-9
    for k in range(min(wanted, d)):
        if e[k] > 1e-6:
            mine = np.array([got[i][k + 1].whitened for i in ids])
            theirs = (x - s / n) @ axes[:, k] / np.sqrt(e[k])
            assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-6
        else:
            assert all(got[i][k + 1].whitened is None for i in ids)


def test_whitening_is_numpys(spark):
    rng = np.random.default_rng(0)
    vectors = (rng.normal(size=(400, 12)) * np.linspace(3, 0.2, 12)).astype(np.float32)
    rows = [(i, [float(c) for c in v], 1, "x", 1) for i, v in enumerate(vectors)]
    junk = [
        (900, None, 1, "x", 1), (901, [1.0, None] * 6, 1, "x", 1), (902, [float("nan")] * 12, 1, "x", 1),
        (903, [float("inf")] * 12, 1, "x", 1), (904, [], 1, "x", 1), (905, [1.0] * 3, 1, "x", 1), (906, [3e38] * 12, 1, "x", 1),
    ]
    check(W.whiten(frame(spark, rows + junk)).collect(), rows)


def test_fewer_dimensions_than_components_and_no_variance(spark):
    rng = random.Random(1)
    rows = [(i, [rng.random(), 0.25, rng.random()], None, None, None) for i in range(50)]
    check(W.whiten(frame(spark, rows)).collect(), rows)
    one = W.whiten(frame(spark, rows[:1])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(0, None, 0.0, None)] * 3
    same = W.whiten(frame(spark, [rows[0], rows[0]])).collect()
    assert len(same) == 6 and {r.n for r in same} == {2}
    assert W.whiten(frame(spark, rows).filter("false")).count() == 0


def test_equal_eigenvalues(spark):
    """A cross in four dimensions: V is a multiple of the identity."""
    unit = [[sign * float(i == k) for i in range(4)] for k in range(4) for sign in (1, -1)]
    rows = [(i, v, 0, "c", 0) for i, v in enumerate(unit)]
    got = W.whiten(frame(spark, rows)).collect()
    assert {r.explained for r in got} == {0.25} and max(r.identity_error for r in got) < 1e-12


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**k * (i + 1)) for k in (0, 30, 38)], 0, "c", 0) for i in range(5)]
    got = W.whiten(frame(spark, rows)).collect()
    x = [[int(c * 1024) for c in r[1]] for r in rows]
    s = [sum(c) for c in zip(*x)]
    for r in got:
        assert int(r.deviation) == sum((5 * a - b) ** 2 for a, b in zip(x[r.vec_id], s))
    assert max(r.identity_error for r in got) < 1e-9


def test_roots_with_multiplicity():
    matrix = np.diag([7, 7, 7, 5, 5, 1, 0, 0]).astype(object)
    poly = [0, 0, 8575, -15680, 9443, -2720, 413, -32, 1]
    primes = W.primes_beyond(10**30)
    for p in primes[:2]:
        assert W.characteristic_mod(matrix.tolist(), p) == [c % p for c in poly]
    roots = W.largest_roots(poly, 8)
    assert [round(float(r), 20) for r in roots] == [7, 7, 7, 5, 5, 1, 0, 0]
    axes = W.components(matrix, roots).astype(float)
    assert np.abs(axes @ axes.T - np.eye(8)).max() < 1e-15


def test_close_roots_are_told_apart():
    a, b = Fraction(10**12), Fraction(10**12) + Fraction(1, 10**6)
    poly = [a * b * 10**6, -(a + b) * 10**6, 10**6]
    first, second = W.largest_roots([int(c) for c in poly], 2)
    assert abs(first - b) < Fraction(1, 10**20) and abs(second - a) < Fraction(1, 10**20)
