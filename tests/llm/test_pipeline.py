"""Stages of the corpus pipeline on small tables, each against its own rule."""

import re

import pytest

import corpus_pipeline
from corpus_pipeline import (
    ORACLE_SQL,
    STAGES,
    contamination_stage,
    near_duplicate_stage,
    packing_stage,
    quality_stage,
    run,
    substring_stage,
)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), None, 1) for i, t in rows], SCHEMA)


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_in_their_order():
    assert [n for n, _ in STAGES] == ["quality", "near_duplicates", "substrings", "contamination", "packing"]
    assert ORACLE_SQL is None


def test_run_keeps_columns_and_places_every_word(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, stage in STAGES:
        before, seen = seen, stage(spark, seen, SF)
        if name != "packing":
            assert seen.dtypes == docs.dtypes
            assert seen.join(before, "doc_id", "left_anti").count() == 0 and 0 < seen.count() <= before.count()
    rows = run(spark, SF).collect()
    kept = before.collect()
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in kept)
    assert {r.doc_id for r in rows} == {r.doc_id for r in kept} and sum(r.n_words for r in rows) == words
    assert all(r.n_chars == len(r.text) for r in kept)


def test_quality_rejects_what_the_query_rejects(spark):
    from sparkwatch.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id for r in QUERIES["op2_quality"][0](spark, SF).collect() if r.predicted}
    assert {r.doc_id for r in quality_stage(spark, docs, SF).collect()} == want


def test_one_document_of_each_group_stays(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(3, base), (1, base + " end"), (1, base + " end"), (2, "other words here"), (None, base), (None, None), (5, None), (6, ""), (7, "")]
    got = texts(near_duplicate_stage(spark, docs_of(spark, rows), SF))
    assert got == sorted([(1, base + " end"), (2, "other words here"), (None, base), (None, None), (5, None), (6, ""), (7, "")], key=str)


def test_each_text_of_an_id_is_judged_by_itself(spark):
    """Against all pairs: every text whose group has a smaller id goes, and no other."""
    words = lambda tag, n=60: [f"{tag}{i}" for i in range(n)]
    near = [*words("x")[:-1], "other"]
    rows = [(2, " ".join(words("x"))), (5, " ".join(words("x"))), (5, " ".join(near)), (5, " ".join(words("y")))]
    rows += [(5, " ".join(words("z"))), (5, " ".join(words("z"))), (7, " ".join(words("y"))), (8, " ".join(words("q"))), (1, None), (1, "")]
    sets = [frozenset(tuple((t or "").split()[i : i + 5]) for i in range(len((t or "").split()) - 4)) for _, t in rows]
    link = lambda a, b: bool(a | b) and len(a & b) >= 0.8 * len(a | b)
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if link(sets[i], sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    want = set()
    for g in set(group):
        least = min(rows[i][0] for i in range(len(rows)) if group[i] == g)
        want.add(frozenset(r for i, r in enumerate(rows) if group[i] == g and r[0] == least))
    got = texts(near_duplicate_stage(spark, docs_of(spark, rows), SF))
    assert len(got) == len(set(got)) == len(want) == 6 and all(len(set(got) & one) == 1 for one in want)


def test_long_passages_are_cut_once_and_short_ones_stay(spark):
    long = " ".join(f"p{i}" for i in range(51))
    short = " ".join(f"q{i}" for i in range(49))
    rows = [(1, f"one {long}\n{short}"), (2, f"two\n\n{long} rest {short}"), (3, None), (4, ""), (None, long)]
    df = substring_stage(spark, docs_of(spark, rows), SF)
    assert texts(df) == sorted([rows[0], (2, f"two\n\nrest {short}"), *rows[2:]], key=str)
    assert {r.doc_id: r.n_chars for r in df.collect()}[2] == len(f"two\n\nrest {short}")


def test_contaminated_documents_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(1, "before " + item), (2, item + " z" * 5000), (3, "clean"), (4, None), (None, item)]
    assert [i for i, _ in texts(contamination_stage(spark, docs_of(spark, rows), SF))] == [2, 3, 4]


@pytest.mark.parametrize("stage", [s for _, s in STAGES], ids=[n for n, _ in STAGES])
def test_empty_tables(spark, stage):
    assert stage(spark, docs_of(spark, [(1, "x")]).limit(0), SF).collect() == []


def test_packing_lists_every_document(spark):
    rows = packing_stage(spark, docs_of(spark, [(1, "a b"), (2, None), (None, "c")]), SF).collect()
    assert sorted(((r.doc_id, r.n_words, r.bin is None) for r in rows), key=str) == [(1, 2, False), (2, 0, True), (None, 1, False)]
    assert corpus_pipeline.STAGES[-1][1] is packing_stage
