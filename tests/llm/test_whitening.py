import math
import random
from fractions import Fraction

import numpy as np
import pytest

from sparkwatch.llm.whitening import (
    characteristic, characteristic_mod, components_of, largest_roots, primes_below, roots_above, whitened,
)

SCHEMA = "vec_id long, embedding array<double>, whitened int, row string"


def exact_polynomial(m):
    """Faddeev-LeVerrier in integers."""
    n = len(m)
    c, b = [0] * n + [1], [[0] * n for _ in range(n)]
    for k in range(1, n + 1):
        b = [[sum(m[i][t] * b[t][j] for t in range(n)) + (c[n - k + 1] if i == j else 0) for j in range(n)] for i in range(n)]
        c[n - k] = -sum(m[i][t] * b[t][i] for i in range(n) for t in range(n)) // k
    return c


def brute(rows, most=8):
    good = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in good), default=0)
    x = [[math.floor(1024 * Fraction(c)) + 100_000 for c in v] + [100_000] * (d - len(v)) for _, v in good]
    n = len(x)
    s = [sum(r[k] for r in x) for k in range(d)]
    away = [[n * r[k] - s[k] for k in range(d)] for r in x]
    deviation = [sum(a * a for a in r) for r in away]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in away), n**3)) for j in range(d)] for i in range(d)])
    return [i for i, _ in good], n, deviation, np.array(away, float) / max(n, 1), cov, min(most, d)


def check(df, rows):
    ids, n, deviation, away, cov, most = brute(rows)
    got = whitened(df).collect()
    assert len(got) == len(ids) * most
    value, vectors = np.linalg.eigh(cov)
    value, vectors = value[::-1], vectors[:, ::-1]
    for k in range(most):
        part = sorted((r for r in got if r.component == k + 1), key=lambda r: (str(r.vec_id), r.deviation))
        order = sorted(range(len(ids)), key=lambda i: (str(ids[i]), deviation[i]))
        assert [(r.vec_id, int(r.deviation), r.n) for r in part] == [(ids[i], deviation[i], n) for i in order]
        assert part[0].explained == pytest.approx(value[k] / np.trace(cov), rel=1e-6, abs=1e-9)
        want = (away @ vectors[:, k] / math.sqrt(value[k]))[order]
        mine = np.array([r.whitened for r in part])
        assert min(abs(mine - want).max(), abs(mine + want).max()) < 1e-6
        assert part[0].identity_error < 1e-9


def test_equals_plain_eigenvectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + k) + (rng.random() if k else 0) for k in range(10)], 1, "x") for i in range(300)]
    rows += [(7, rows[7][1], 2, "again"), (None, rows[9][1], None, None), (400, [1.5] * 10, 1, "")]
    rows += [(500, None, 1, "a"), (501, [1.0, None], 1, "b"), (502, [math.nan] * 10, 1, "c"), (503, [math.inf] + [0.0] * 9, 1, "d")]
    rows += [(504, [0.25, -3.0], 1, "short"), (505, [], 1, "empty")]
    check(spark.createDataFrame(rows, SCHEMA).repartition(5), rows)


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3000, 3000, (40, 7))
    x[:, 3] = x[:, 2]  # a root of 0
    m = (x.T @ x).astype(object).tolist()
    c = exact_polynomial(m)
    p = next(primes_below(1 << 31))
    assert p == 2**31 - 1 and characteristic_mod(m, p) == [v % p for v in c]
    assert characteristic(spark, m) == c
    roots = [Fraction(a, 1 << s) for a, s in largest_roots(c, 7)]
    assert np.allclose([float(r) for r in roots], np.linalg.eigvalsh(np.array(m, float))[::-1], rtol=1e-9, atol=1e-3)
    assert roots[-1] == 0 and roots == sorted(roots, reverse=True)
    twice = [24, -50, 35, -10, 1]  # roots 1 to 4
    assert [roots_above(twice, a) for a in (0, 1, 2, 4)] == [4, 3, 2, 0]
    square = [0, 0, 9, -6, 1]  # 0, 0, 3, 3
    assert [Fraction(a, 1 << s) for a, s in largest_roots(square, 4)][2:] == [0, 0]
    assert [float(Fraction(a, 1 << s)) for a, s in largest_roots(square, 2)] == pytest.approx([3, 3], rel=1e-15)


def test_repeated_roots_have_an_orthogonal_basis():
    m = [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 5, 0], [0, 0, 0, 1]]
    v = np.array(components_of(m, largest_roots(exact_polynomial(m), 4)))
    assert np.allclose(v @ v.T, np.eye(4), atol=1e-15) and np.allclose(abs(v[3]), [0, 0, 0, 1], atol=1e-15)


def test_close_roots_are_told_apart():
    m = [[10**18 + 1, 0, 0], [0, 10**18, 0], [0, 0, 5]]
    v = np.array(components_of(m, largest_roots(exact_polynomial(m), 3)))
    assert np.allclose(abs(v), np.eye(3), atol=1e-15)


def test_small_and_flat_tables(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitened(spark.createDataFrame([(1, None, 1, "")], SCHEMA)).collect() == []
    assert whitened(spark.createDataFrame([(1, [], 1, "")], SCHEMA)).collect() == []
    one = whitened(spark.createDataFrame([(1, [0.5, 2.0], 1, "")], SCHEMA)).collect()
    assert [(r.component, r.whitened, r.deviation, r.n, r.explained, r.identity_error) for r in one] == [
        (1, None, 0, 1, 0.0, None), (2, None, 0, 1, 0.0, None),
    ]
    flat = whitened(spark.createDataFrame([(1, [0.5, 2.0], 1, ""), (2, [0.5, 3.0], 1, "")], SCHEMA)).collect()
    assert [(r.component, r.whitened is None) for r in flat] == [(1, False), (2, True)] * 2
    assert {abs(r.whitened) for r in flat if r.component == 1} == {1.0} and flat[0].identity_error < 1e-12


def test_dimensions_of_zeros_count(spark):
    rows = [(i, [0.0, float(i), 0.0, 0.0], 1, "") for i in range(3)]
    got = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.component, r.whitened is None) for r in got} == {(1, False), (2, True), (3, True), (4, True)} and len(got) == 12


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2 ** (50 + i)), 3.0 * i, -1e300 if i == 2 else 1.0], 1, "") for i in range(4)]
    got = whitened(spark.createDataFrame(rows[:2], SCHEMA)).collect()
    assert {r.deviation for r in got} == {(2**50 * 1024) ** 2 + (3 * 1024) ** 2}
    wide = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.deviation for r in wide} == {None} and len(wide) == 12
