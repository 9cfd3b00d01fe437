"""The learned operators: held-out accuracy and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwatch.llm.quality import (
    clean_labels, features, fit_ranking, fold, labelled_sample, labelled_texts, learn_quality, match_groups, quantile_between,
    score_quality,
)
from sparkwatch.llm.queries import QUERIES
from sparkwatch.llm.toxicity import learn_toxicity, score_toxicity, sentences

SF = "/root/testdata/sf0.01"


def held_out(spark, name, label):
    scored = QUERIES[name][0](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", "score", label).collect()
    return np.array([(r[0], r[1], r[2]) for r in rows])


@pytest.mark.parametrize(("name", "label", "accuracy"), [("op2_quality", "quality", 0.97), ("op10_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, accuracy):
    got = held_out(spark, name, label)
    assert ((got[:, 1] >= 0.5) == (got[:, 0] == 1)).all()
    assert (got[:, 0] == got[:, 2]).mean() >= accuracy
    assert got[got[:, 2] == 1, 1].mean() > got[got[:, 2] == 0, 1].mean() + 0.4


def test_pairs_order_and_quantile_split():
    rng = np.random.default_rng(0)
    label = (rng.random(600) < 0.8).astype(int)
    x = rng.normal(size=(600, 5)).astype(np.float32)
    x[:, 2] += 2.5 * label
    model = fit_ranking(x, label, 0.2)
    strength = model.strength(x)
    wins = np.mean(strength[label == 1][:, None] > strength[label == 0][None, :])
    assert wins > 0.93 and abs((model.score(x) < 0.5).mean() - (label == 0).mean()) < 0.03


def test_all_labelled_documents_learn(spark):
    """Good texts have capitals, bad ones digits, but for a share of each; the fit of all rows in one group is the measure."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        kind = (i % 3 > 0) if rng.random() < 0.9 else rng.random() < 0.5
        word = (lambda: rng.choice("ABC") + "word") if kind else (lambda: f"w{rng.randrange(90)}")
        rows.append((i, " ".join(word() if rng.random() < 0.2 else "text" for _ in range(30)), int(i % 3 > 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(5)
    labels = df.select("doc_id", "quality")
    table = df.orderBy("doc_id").toArrow()
    x = features(table["text"])
    whole = fit_ranking(x, table["quality"].to_numpy(), 1 / 3)
    one = learn_quality(df, labels, most=900)
    assert np.corrcoef(one.strength(x), whole.strength(x))[0, 1] > 0.99 and np.abs(one.score(x) - whole.score(x)).mean() < 0.05
    many = learn_quality(df, labels, most=20)
    scored = score_quality(df, many).collect()
    assert abs(np.mean([r.score < 0.5 for r in scored]) - 1 / 3) < 9 / 900  # the threshold is that of all rows
    groups = match_groups(df, clean_labels(labels, "quality"), 23).collect()
    assert sum(len(g.labels) for g in groups) == 900 and 15 < len(groups) <= 23


def test_threshold_is_the_exact_quantile(spark):
    rng = random.Random(6)
    values = [(int(i % 4 > 0), rng.choice([rng.gauss(0, 1), 0.5, 1e6])) for i in range(4000)]
    df = spark.createDataFrame(values, "label int, strength double").repartition(3)
    bad, good = 1000, 3000
    for share in (0.1, 0.25, 0.6):
        order = sorted((v, (1 - share) / good if k else share / bad) for k, v in values)
        below, at = 0.0, 0
        while below < share - 1e-12:
            below, at = below + order[at][1], at + 1
        last = order[at - 1][0]
        after = min((v for v, _ in order if v > last), default=last)
        assert quantile_between(df, share, good, bad) == (last + after) / 2
    same = df.select("label", F.lit(0.0).alias("strength"))
    assert quantile_between(same, 0.25, good, bad) == 0


ROWS = [(1, None, 1), (2, "", 1), (3, " \n.", 1), (4, "Plain words here. You moron!", 1), (4, "Plain words here. You moron!", 1), (None, "x", None), (5, "word " * 50_000, 2)]
SCHEMA = "doc_id long, text string, predicted int"


def test_quality_of_odd_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (2, None), (1, 7)], "doc_id long, quality int")
    model = learn_quality(df, labels)
    got = score_quality(df, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.row.predicted for r in got} == {1, 2, None}
    none = learn_quality(df, labels.limit(0))
    assert {(r.score, r.predicted) for r in score_quality(df, none).collect()} == {(0.5, 1)}
    assert score_quality(df.limit(0), model).collect() == []
    assert np.isfinite(features(df.select("text").toArrow()["text"])).all()


def test_toxic_sentences_are_found(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        said = [" ".join(f"w{rng.randrange(300)}" for _ in range(6)) for _ in range(rng.randrange(1, 12))]
        if i % 5 == 0:
            said.insert(rng.randrange(len(said) + 1), f"w{rng.randrange(300)} dolt w1")
        rows.append((i, ". ".join(said) + "."))
        labels.append((i, int(i % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = learn_toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for r in score_toxicity(df, model).collect():
        assert r.predicted == int(r.row.doc_id % 5 == 0)
        if r.predicted:
            data = r.row.text.encode()
            assert b"dolt" in data[r.worst_start : r.worst_end] and b"." not in data[r.worst_start : r.worst_end]
            assert [(s.start, s.end) for s in r.offending] == [(r.worst_start, r.worst_end)]


def test_toxicity_of_odd_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = learn_toxicity(df, labels)
    got = score_toxicity(df, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and r.worst_start is None for r in got if r.row.doc_id in (1, 2, 3))
    assert score_toxicity(df.limit(0), learn_toxicity(df, labels.limit(0))).collect() == []


def test_sentences_end_with_marks_and_are_bounded():
    import pyarrow as pa

    _, sentence, _, text = sentences(pa.array(["a b. c\nd", None, "e " * 200]))
    assert sentence[:4].tolist() == [0, 0, 1, 2] and np.bincount(sentence).max() == 64
    assert text.tolist() == [0, 0, 0, 2, 2, 2, 2]


def test_fold_is_the_checksum_of_the_id(spark):
    import zlib

    got = spark.range(50).select("id", fold("id", 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in got)


def test_one_id_on_most_rows_counts_once(spark):
    good, bad = "Plain words make a sentence here. ", "@@## 12 !!! zz "
    rows = [(1, bad + "x" * i) for i in range(300)] + [(i, good * i) for i in range(2, 7)] + [(i, bad * i) for i in range(7, 10)]
    labels = [(1, 0)] * 300 + [(i, 1) for i in range(2, 7)] + [(i, 0) for i in range(7, 10)] + [(2, 0), (3, 1), (None, 1), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    named = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(1) - F.col("quality"))
    sample, share = labelled_sample(named, "quality", 10)
    assert sorted(map(tuple, sample.collect())) == [(1, 0), (3, 1), (4, 1), (5, 1), (6, 1), (7, 0), (8, 0), (9, 0)] and share == 0.5
    texts = labelled_texts(docs, sample).collect()
    assert len(texts) == 8 and {r.doc_id for r in texts} == {1, *range(3, 10)}
    got = {r.row.text: r.predicted for r in score_quality(docs, learn_quality(docs, named, most=10)).collect()}
    assert got[good * 5] == 1 and got[bad * 8] == 0 and got[rows[7][1]] == 0
    assert {r.predicted for r in score_toxicity(docs, learn_toxicity(docs, named, most=10)).collect()} <= {0, 1}
