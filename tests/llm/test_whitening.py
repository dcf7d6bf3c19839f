"""Whitening against numpy's eigenvectors on whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from seatledger.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, at string, component string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "n", "a", "c") for i, v in vectors], SCHEMA).repartition(3)


def brute(vectors, dim):
    rows = []
    for i, v in vectors:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(256 * float(np.float32(c))) for c in v]
            rows.append((i, tuple(x)))
    fit = sorted({x for _, x in rows})
    pad = lambda x: [*x, *[0] * (dim - len(x))]
    a = np.array([pad(x) for x in fit], float)
    n, s = len(fit), [sum(int(c) for c in col) for col in zip(*map(pad, fit), strict=True)]
    c = a - a.mean(0)
    e, u = np.linalg.eigh(c.T @ c / n)
    return [(i, pad(x)) for i, x in rows], n, s, a.mean(0), e[::-1], u[:, ::-1]


def cases():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 9)) * np.array([3, 2, 1.4, 1, 0.7, 0.5, 0.4, 0.3, 0.2])
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(150)] + [(7, vectors[7][1]), (None, vectors[9][1])]
    vectors += [(2000, None), (2001, [1.0] * 8 + [None]), (2002, [float("nan")] * 9), (2003, [float("inf")] + [0.0] * 8), (2004, [-0.0] * 9), (2005, [0.001] * 9)]
    return vectors


def check(spark, vectors, dim):
    got = W.whiten(table(spark, vectors))
    rows, n, s, mean, e, u = brute(vectors, dim)
    k = min(4, int((e > 1e-9 * e[0]).sum()))
    found = sorted(((str(r["vec_id"]), r["component"], r["deviation"], r["whitened"]) for r in got.collect()))
    assert len(found) == k * len(rows)
    assert {(r["n"], r["identity_error"] < 1e-9) for r in got.collect()} == {(n, True)}
    want = []
    for i, x in rows:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        for j in range(k):
            want.append((str(i), j + 1, deviation, float((np.array(x) - mean) @ u[:, j] / math.sqrt(e[j]))))
    signs = {}
    for a, b in zip(found, sorted(want), strict=True):
        assert a[:3] == b[:3] and abs(abs(a[3]) - abs(b[3])) < 1e-8
        if abs(a[3]) > 1e-6:
            signs.setdefault(a[1], set()).add(a[3] * b[3] > 0)
    assert all(len(x) == 1 for x in signs.values())
    for r in got.collect():
        assert abs(r["explained"] - e[r["component"] - 1] / e.sum()) < 1e-12


def test_against_eigenvectors(spark):
    check(spark, cases(), 9)


def test_short_vectors_and_low_rank(spark):
    check(spark, [*cases(), (3000, [1.0]), (3001, []), (3002, [1.0, 0.0])], 9)
    check(spark, [(i, [float(i), float(2 * i), 1.0]) for i in range(20)], 3)


def test_no_rows(spark):
    assert W.whiten(table(spark, [])).count() == 0
    assert W.whiten(table(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert W.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # one distinct vector has no direction
    assert W.whiten(table(spark, [(1, [])])).count() == 0


def test_large_entries(spark):
    """Deviations are exact in longs and null beyond."""
    big = float(np.float32(2.0**26))
    got = {r["vec_id"]: r["deviation"] for r in W.whiten(table(spark, [(1, [big, 0.0]), (2, [0.0, 1.0]), (3, [3e38, 0.0])])).where("component = 1").collect()}
    assert got[3] is None and len(got) == 3
    small = {r["vec_id"]: r["deviation"] for r in W.whiten(table(spark, [(1, [2.0**20, 0.0]), (2, [0.0, 1.0])])).where("component = 1").collect()}
    assert small[1] == (2 * 2**28 - 2**28) ** 2 + 256**2


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_factor_and_rotations(d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(90, d)) * np.logspace(0, -5, d)
    v = x.T @ x / 90
    factor = W.pivoted_cholesky(v)
    assert np.abs(factor @ factor.T - v).max() < 1e-14
    e, u = W.jacobi(factor)
    assert (np.abs(e / np.linalg.svd(x, compute_uv=False) ** 2 * 90 - 1) < 1e-6).all() and np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12
