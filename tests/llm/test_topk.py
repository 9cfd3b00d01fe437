import math
import random
from fractions import Fraction

import numpy as np
import pytest

from sparkwatch.llm import topk
from sparkwatch.llm.topk import exact_top_k, scores

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, k, every, scale):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, []).append([math.floor(scale * float(np.float32(x))) for x in v])
    out = []
    for q, own in good.items():
        if q % every == 0:
            found = [
                (-sum(a * b for a, b in zip(own[0], v, strict=False)), i) for i, vs in good.items() if i != q for v in vs[:1]
            ]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def got(df, **more):
    return sorted(tuple(r) for r in exact_top_k(df, **more).collect())


@pytest.mark.parametrize("blocks", [(4096, 4096), (7, 16)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", blocks[1])
    rng = random.Random(5)
    rows = [(i, [round(rng.uniform(-1, 1), 1) * rng.randrange(2) for _ in range(6)], 0) for i in range(200)]
    rows += [(300 + i, rows[7][1], 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute([r[:2] for r in rows], 5, 10, 64)
    assert got(df, k=5, every=10, query_rows=blocks[0]) == want
    assert got(df.unionByName(df), k=5, every=10, query_rows=blocks[0]) == want


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], None), (20, None, 1), (40, [1.0, None], 1), (60, [math.nan, 1.0], 1), (80, [math.inf, 0.0], 1),
        (None, [1.0, 1.0], 1), (100, [0.5], 1), (1, [1.0, 1.0, 9.0], 1), (2, [], 1), (3, [-1.0, 0.25], 1), (4, [1.0, 1.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute([r[:2] for r in rows], 20, 20, 64)
    assert got(df.limit(0)) == [] and got(df.where("vec_id = 3")) == []


def test_large_products_do_not_overflow():
    q, c = np.array([[1 << 25, 3]]), np.array([[1 << 25, -2], [0, 5]])
    assert scores(q, c).tolist() == [[(1 << 50) - 6, 15]]


def test_large_components_take_part(spark):
    sizes = [2.0**20, 2.0**40, 2.0**62, 1e38, -1e38, -(2.0**40)]
    rows = [(i, [sizes[i % 6] * (1 + i // 6), (-1.0) ** i], 1) for i in range(30)] + [(40 + i, [i / 8, 0.5], 1) for i in range(9)]
    wide = "vec_id long, embedding array<double>, score int"
    df = spark.createDataFrame(rows, wide)
    exact = {i: [math.floor(64 * Fraction(x)) for x in v] for i, v, _ in rows}
    want = []
    for q in exact:
        if q % 5 == 0:
            found = sorted((-sum(a * b for a, b in zip(exact[q], v, strict=True)), i) for i, v in exact.items() if i != q)
            want += [(q, r, i, min(max(-s, -(1 << 63)), (1 << 63) - 1)) for r, (s, i) in enumerate(found[:12], 1)]
    assert got(df.repartition(3), k=12, every=5) == sorted(want)


def test_products_beyond_64_bits():
    q, c = np.array([[1 << 40, 1]]), np.array([[1 << 40, 7], [-(1 << 40), 7]])
    assert scores(q, c).tolist() == [[(1 << 80) + 7, 7 - (1 << 80)]]
    marks = [topk._beyond(s) for s in (-(1 << 90), -(1 << 70), -(1 << 63))]
    assert marks == sorted(marks) and topk._beyond(5) == "" and topk._beyond(1 << 70) < topk._beyond(1 << 90)
