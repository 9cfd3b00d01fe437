"""Clusters by fixed rounds against plain loops, with ties, repeats, gaps in the data and other partitions."""

import random

import pytest
from pyspark.sql import functions as F

from sparkwatch.operators.cluster import cluster_outliers, cluster_rounds

COLS = ["x", "y"]


def plain_clusters(rows, k, rounds, scale, grid=1024):
    """Number and place of each key, by loops over all rows."""
    n = len(rows)
    places = {key: [] for key, *_ in rows}
    for j in range(1, len(rows[0])):
        values = [r[j] for r in rows]
        mean = sum(values) / n
        spread = (sum((v - mean) ** 2 for v in values) / (n - 1)) ** 0.5 if n > 1 else 0.0
        for key, *v in rows:
            z = (v[j - 1] - mean) / (spread if scale and spread else 1.0)
            places[key].append(0 if scale and not spread else int((z * grid + 0.5) // 1))
    apart = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    order = sorted(places)
    centres = [places[min(order, key=lambda u: (apart(places[u], [0] * len(places[u])), u))]]
    while len(centres) < k:
        gap = {u: min(apart(places[u], c) for c in centres) for u in order}
        far = min(order, key=lambda u: (-gap[u], u))
        if not gap[far]:
            break
        centres.append(places[far])
    pick = lambda p: min(range(len(centres)), key=lambda i: (apart(p, centres[i]), i))
    for _ in range(rounds):
        members = [[places[u] for u in order if pick(places[u]) == i] for i in range(len(centres))]
        centres = [
            [(2 * sum(c) + len(m)) // (2 * len(m)) for c in zip(*m)] if m else old for m, old in zip(members, centres)
        ]
    return {u: (pick(places[u]), round(apart(places[u], centres[pick(places[u])]) ** 0.5 / grid, 9)) for u in order}


def found(df):
    return {r.u: (r.prediction, round(r.distance, 9)) for r in df.collect()}


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "u string, x double, y double").repartition(parts)


@pytest.mark.parametrize("scale", [True, False])
@pytest.mark.parametrize("k, rounds", [(1, 20), (3, 20), (5, 2), (4, 0)])
def test_against_loops(spark, scale, k, rounds):
    draw = random.Random(k * 10 + rounds)
    rows = [(f"u{i:03}", draw.gauss(10 * (i % 4), 2.0), draw.gauss(-5 * (i % 3), 1.5)) for i in range(150)]
    want = plain_clusters(rows, k, rounds, scale)
    assert found(cluster_rounds(frame(spark, rows), "u", COLS, k, rounds, scale)) == want
    draw.shuffle(rows)
    assert found(cluster_rounds(frame(spark, rows, 7), "u", COLS, k, rounds, scale)) == want


def test_ties_and_repeated_rows(spark):
    """Four corners of a square are equally far; whole numbers and keys decide."""
    rows = [(f"{c}{i}", x, y) for i in range(3) for c, x, y in (("a", 0.0, 0.0), ("b", 0.0, 8.0), ("c", 8.0, 0.0), ("d", 8.0, 8.0))]
    rows.append(("e", 4.0, 4.0))
    for k in (2, 3, 4, 5):
        assert found(cluster_rounds(frame(spark, rows), "u", COLS, k, scale=False)) == plain_clusters(rows, k, 20, False)


def test_fewer_places_than_clusters(spark):
    rows = [(f"u{i}", float(i % 2), 7.0) for i in range(10)]
    got = found(cluster_rounds(frame(spark, rows), "u", COLS, 4))
    assert got == plain_clusters(rows, 4, 20, True)
    assert {i for i, _ in got.values()} == {0, 1}


def test_one_row_and_none(spark):
    assert found(cluster_rounds(frame(spark, [("a", 1.0, 2.0)]), "u", COLS)) == {"a": (0, 0.0)}
    none = cluster_rounds(frame(spark, [("a", 1.0, 2.0)]).limit(0), "u", COLS)
    assert none.columns == ["u", "x", "y", "prediction", "distance"] and none.collect() == []


def test_rows_without_key_or_finite_features_take_no_part(spark):
    good = [(f"u{i}", float(i), float(i * i % 7)) for i in range(12)]
    bad = [("n", None, 1.0), ("m", float("nan"), 1.0), ("i", float("inf"), 1.0), ("j", 1.0, float("-inf")), (None, 1.0, 1.0)]
    assert found(cluster_rounds(frame(spark, good + bad), "u", COLS, 3)) == plain_clusters(good, 3, 20, True)


def test_other_columns_stay(spark):
    rows = [(f"u{i}", float(i), 1.0) for i in range(6)]
    df = frame(spark, rows).withColumns({"d": F.lit(5), "i": F.lit("kept"), "cluster_size": F.lit(9)})
    out = cluster_rounds(df, "u", COLS, 2)
    assert out.columns == ["u", "x", "y", "d", "i", "cluster_size", "prediction", "distance"]
    assert {(r.d, r.i, r.cluster_size) for r in out.collect()} == {(5, "kept", 9)}


def test_the_far_point_is_alone(spark):
    rows = [(f"u{i}", float(i % 3), float(i % 2)) for i in range(40)] + [("odd", 500.0, 900.0)]
    out = cluster_outliers(cluster_rounds(frame(spark, rows), "u", COLS, k=2))
    assert [(r.u, r.cluster_size) for r in out.collect()] == [("odd", 1)]


def test_squares_beyond_a_long_are_an_error(spark):
    rows = [("a", 1e16, 0.0), ("b", 0.0, 0.0), ("c", -1e16, 0.0)]
    with pytest.raises(Exception, match="OVERFLOW"):
        cluster_rounds(frame(spark, rows), "u", COLS, 2, scale=False).collect()
