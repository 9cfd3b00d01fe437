import hashlib
import random
import re

import pytest

from sparkwatch.llm.substrings import levels, remove_repeats


def brute(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for p in range(len(w) - length + 1):
            if i is not None:
                key = tuple(w[p : p + length])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for p in range(len(w) - length + 1):
            if i is not None and first[tuple(w[p : p + length])] < i:
                gone.update(range(p, p + length))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **more):
    cut = remove_repeats(df, **more)
    return sorted(
        ((r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in cut.collect()), key=str
    )


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [[f"p{k}{i}" for i in range(rng.choice([12, 13, 14, 26, 50, 51, 120]))] for k in range(5)]
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.choice([0, 5, 20, 60]))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        rows.append((i, "".join(w + rng.choice([" ", "\n", "  "]) for w in words)))
    rows += [(n + 1, rows[3][1]), (3, rows[3][1]), (n + 2, rows[5][1] + " more")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("length", [13, 50, 4])
@pytest.mark.parametrize("batch", [7, 512])
def test_equals_brute_force(spark, length, batch):
    rows = corpus(length)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, length=length, batch_rows=batch) == brute(rows, length)


def test_windows_repeated_in_one_document_stay(spark):
    passage = " ".join(f"x{i}" for i in range(20))
    rows = [(1, f"{passage} and {passage}"), (2, "other words")]
    assert all(r[2] == 0 for r in got(spark.createDataFrame(rows, "doc_id long, text string")))


def test_text_keeps_its_form(spark):
    passage = "\n".join(f"x{i}" for i in range(13))
    rows = [(1, passage), (2, f"  a\tb\n{passage}  c \n"), (3, "un\ttouched  ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r.row.doc_id: r.text for r in remove_repeats(df).collect()}
    assert texts == {1: passage, 2: "  a\tb\nc \n", 3: "un\ttouched  "}


def test_odd_rows(spark):
    passage = " ".join(f"x{i}" for i in range(13))
    long = " ".join(f"é{i}" for i in range(60_000))
    rows = [
        (1, None, 1), (2, "", 2), (None, passage, 3), (9, passage, 4), (9, passage, 4), (4, long, 5), (5, long, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    cut = {(r.row.doc_id, r.row.batch): (r.text, r.n_words, r.n_removed) for r in remove_repeats(df).collect()}
    assert cut[1, 1] == (None, 0, 0) and cut[2, 2] == ("", 0, 0)
    assert cut[None, 3] == (passage, 13, 0) and cut[9, 4] == (passage, 13, 0)
    assert cut[4, 5] == (long, 60_000, 0) and cut[5, None] == ("", 60_000, 60_000)
    assert remove_repeats(df).count() == len(rows)
    assert remove_repeats(df.limit(0)).collect() == []


def test_levels_at_most_double():
    assert levels(13) == [7, 13] and levels(50) == [7, 13, 25, 50] and levels(4) == [4]
