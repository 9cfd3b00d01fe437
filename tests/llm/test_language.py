import math
import random
import re
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwatch.llm import language
from sparkwatch.llm.language import places, score_language

SCHEMA = "doc_id long, text string, score string, learns boolean"
LAW = (0.5, 4.0, 1000.0)


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "</s>"]


def brute(rows, order, strengths):
    """Probabilities by their definition, from plain counters."""
    c = Counter()
    for _, text, _, learns in rows:
        if learns:
            seq = ["<s>", *tokens(text)]
            for k in range(1, order + 1):
                c.update(tuple(seq[i : i + k]) for i in range(len(seq) - k + 1))
    words = {g: n for g, n in c.items() if len(g) == 1 and g != ("<s>",)}
    n, v = sum(words.values()), len(words)

    def chance(h, w, m, less=0):
        if not h:
            return max(c[(w,)] + 0.5 - less, 0.5) / (n - less + 0.5 * (v + 1))
        top = max(c[(*h, w)] - less, 0)
        seen = c[h] if h[-1:] != ("</s>",) else 0
        return (top + m * chance(h[1:], w, m, less)) / (max(seen - less, 0) + m)

    def total(text, m, less=0):
        seq = ["<s>", *tokens(text)]
        return sum(math.log10(chance(tuple(seq[max(0, i - order + 1) : i]), seq[i], m, less)) for i in range(1, len(seq)))

    fit = [sum(total(r[1], m, 1) for r in rows if r[3]) for m in strengths]
    best = strengths[max(range(len(fit)), key=lambda k: (fit[k], -strengths[k]))]
    return [
        (
            len(tokens(text)), sum(w in {g for (g,) in words} for w in tokens(text)), n,
            sum(math.log10(chance((), w, 1)) for w in tokens(text)), total(text, best), best,
        )
        for _, text, *_ in rows
    ]


def corpus():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "漢字", "A-Z", "</s>x"]
    chain = {w: rng.sample(vocabulary, 4) for w in vocabulary}
    rows = []
    for i in range(60):
        words, size = [rng.choice(vocabulary)], rng.choice([1, 5, 40, 90])
        while len(words) < size:
            words.append(rng.choice(chain[words[-1]]) if rng.random() < 0.8 else rng.choice(vocabulary))
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words), "x", i % 4 != 1))
    rows += [(60, None, "x", True), (61, "", "x", False), (62, " \n", "x", True), (5, rows[5][1], "x", False)]
    rows += [(63, "W1 w1 W1 unseen w1 unseen words", "x", None), (None, rows[9][1], None, True), (64, "w3 " * 700, "x", False)]
    return rows


def check(df, rows, order, strengths):
    got = {}
    for r in score_language(df, F.col("learns"), order, strengths=strengths).collect():
        got.setdefault((str(r.row.doc_id), r.row.text, str(r.row.learns)), []).append(r)
    for row, want in zip(rows, brute(rows, order, strengths), strict=True):
        r = got[str(row[0]), row[1], str(row[3])].pop()
        assert (r.n_tokens, r.n_known, r.train_tokens, r.strength) == (*want[:3], want[5])
        assert r.base_score == pytest.approx(want[3], rel=1e-10, abs=1e-10)
        assert r.score == pytest.approx(want[4], rel=1e-10, abs=1e-10)
        assert r.learns == bool(row[3])
    assert not any(got.values())


@pytest.mark.parametrize(("order", "law"), [(1, LAW), (2, LAW), (3, LAW), (3, (7.0,))])
def test_equals_the_definition(spark, order, law):
    rows = corpus()
    check(spark.createDataFrame(rows, SCHEMA).repartition(3), rows, order, law)


def test_small_batches_and_places(spark, monkeypatch):
    monkeypatch.setattr(language, "BATCH_BYTES", 300)
    monkeypatch.setattr(language, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(places, "__defaults__", (3,))
    rows = corpus()
    check(spark.createDataFrame(rows, SCHEMA).repartition(5), rows, 3, LAW)


def test_numbers_travel_packed(spark):
    rng = np.random.default_rng(4)
    keys = np.sort(rng.integers(0, 2**64, 50_000, np.uint64))
    for x in (keys, np.diff(keys), np.arange(70_000, dtype=np.int32)[::-1].copy(), np.zeros(0, np.int64), np.array([-1, 2**62])):
        assert (language.unpacked(language.packed(x), x.dtype) == x).all()
    rows = [(i, " ".join(f"w{n}" for n in rng.zipf(1.3, 3000) % 5000), "", i % 2 == 0) for i in range(40)]
    batches = language.token_batches(spark.createDataFrame(rows, SCHEMA).coalesce(1), F.col("learns")).localCheckpoint()
    sent = language.sent_grams(batches, 2, 3).agg(F.sum(F.length("keys") + F.length("counts")), F.min("bucket"), F.max("bucket")).first()
    [held] = batches.select(F.length("tokens"), "n_tokens").collect()
    n_grams = len({p for _, t, *_ in rows for p in [*pairwise(["<s>", *tokens(t)]), *tokens(t)]})
    assert sent[0] < 7.5 * n_grams and sent[1:] == (0, 2)  # 12 bytes each before
    assert held[0] < 2 * held.n_tokens  # 4 bytes each before


def test_without_training_and_without_rows(spark):
    df = spark.createDataFrame([(1, "a b", "x", False), (2, None, "x", None)], SCHEMA)
    got = score_language(df, F.col("learns")).orderBy("row.doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]
    assert score_language(df.limit(0), F.col("learns")).collect() == []


def test_probabilities_add_up_to_one(spark):
    rows = [(i, t, "", True) for i, t in enumerate(["a b a c", "b a", "a a b"])]
    # After "a" each known token, an unknown one and the end; c("a") is known, so the context is the same.
    rows += [(10, "a", "", False)] + [(11 + i, f"a {w}", "", False) for i, w in enumerate(["a", "b", "c", "never"])]
    got = {r.row.doc_id: r for r in score_language(spark.createDataFrame(rows, SCHEMA), F.col("learns"), strengths=(2.0,)).collect()}
    plain = Counter(w for _, t, *_ in rows[:3] for w in tokens(t))
    pairs = Counter(p for _, t, *_ in rows[:3] for p in pairwise(["<s>", *tokens(t)]))
    n, v = sum(plain.values()), len(plain)
    p = lambda h, w: (pairs[h, w] + 2 * (plain[w] + 0.5) / (n + 0.5 * (v + 1))) / ((plain[h] or 3) + 2)
    assert sum(p("a", w) for w in [*plain, "never"]) == pytest.approx(1)
    begin = p("<s>", "a")
    for i, w in enumerate(["a", "b", "c", "never"]):
        last = (0 + 2 * (plain["</s>"] + 0.5) / (n + 0.5 * (v + 1))) / 2 if w == "never" else p(w, "</s>")
        assert 10 ** got[11 + i].score == pytest.approx(begin * p("a", w) * last)
    assert 10 ** got[10].score == pytest.approx(begin * p("a", "</s>"))


def test_held_out_text_is_likelier_than_single_tokens(spark):
    rows = [r for r in corpus() if r[1] and 40 < len(r[1]) < 1000]
    got = score_language(spark.createDataFrame(rows, SCHEMA), F.col("learns")).where("NOT learns").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1] * 0.95
    assert np.isfinite(got[0])
