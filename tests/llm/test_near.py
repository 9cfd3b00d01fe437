import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sparkwatch.llm.components import components
from sparkwatch.llm.near import near_duplicates, shingle_sets, sketches


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))}


def brute(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    low = {i: i for i in sets}
    changed = True
    linked = [
        (a, b) for a in sets for b in sets
        if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[a]
    ]
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return {(i, len(sets[i]), low[i], low[i] == i) for i in sets}


def rows_of(df):
    return {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def corpus(seed=3):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(12):
        base = [rng.choice(pool) for _ in range(rng.choice([1, 2, 5, 30, 80]))]
        for _ in range(rng.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(pool)
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k", [2, 5])
def test_equals_brute_force(spark, k):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_duplicates(df, shingle=k)) == brute(rows, k)


def test_group_around_a_middle_document(spark):
    """Copies that are each near the middle one but not near each other join one component."""
    base = [f"b{i}" for i in range(101)]
    rows = []
    for c in range(12):
        copy = list(base)
        for i in range(6):
            copy[(c * 8 + i * 2) % 100] = f"c{c}x{i}"
        rows.append((c, " ".join(copy)))
    rows.append((99, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(near_duplicates(df, shingle=2)) == brute(rows, 2)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(50_000))
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \n", None), (4, "Alpha", "x"), (5, "alpha", "x"),
        (6, "alpha beta", "x"), (None, "alpha", "x"), (7, long, "x"), (8, long + " end", "x"),
        (4, "Alpha", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string")
    got = sorted(near_duplicates(df, shingle=2).collect(), key=str)
    by_id = {r.doc_id: (r.component_id, r.kept) for r in got}
    assert len(got) == len(rows)
    assert by_id[1] == (1, True) and by_id[2] == (2, True) and by_id[3] == (3, True)
    assert by_id[4] == (4, True) and by_id[5] == (4, False) and by_id[6] == (6, True)
    assert by_id[7] == (7, True) and by_id[8] == (7, False) and by_id[None] == (None, True)
    assert near_duplicates(df.limit(0)).collect() == []


def test_sketches_are_full_and_estimate_similarity():
    column = pa.array(["a", " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(80, 480))])
    owner, values, bounds = shingle_sets(column, 1)
    assert np.diff(bounds).tolist() == [1, 400, 400]
    out = sketches(owner, values, 3, 256)
    assert (out != np.uint64(2**64 - 1)).all()
    assert abs((out[1] == out[2]).mean() - 320 / 480) < 0.12
    assert (out[0] == out[1]).mean() < 0.05


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, n) for n in range(8, 40)] + [(3, 3), (None, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{n: 100 for n in range(100, 161)}, **{n: 7 for n in range(7, 40)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
