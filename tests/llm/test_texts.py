"""Words, hashes and slices against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkwatch.llm.contamination import word_bytes
from sparkwatch.llm.text import SPACES, Words, byte_table, lower_table, rolling, slices, within

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 \n\t\v.é漢\x1c\x7f", max_size=30)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    words = Words(column, byte_table(SPACES))
    for r, text in enumerate(texts):
        got = [words.word(i).decode() for i in range(words.first[r], words.first[r + 1])]
        assert got == re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lowered = Words(column, word_bytes(), lower_table())
    for r, text in enumerate(texts):
        got = [lowered.word(i).decode() for i in range(lowered.first[r], lowered.first[r + 1])]
        plain = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        assert got == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_hashes_follow_the_words(texts):
    words = Words(pa.array(texts, pa.string()), byte_table(SPACES))
    hashes, seen = words.hashes(), {}
    for i in range(len(words)):
        assert seen.setdefault(words.word(i), hashes[i]) == hashes[i]
    assert len(set(seen.values())) == len(seen)
    runs, known = rolling(hashes, 2), {}
    for i in within(words, 2):
        key = words.word(i), words.word(i + 1)
        assert words.text[i] == words.text[i + 1]
        assert known.setdefault(key, runs[i]) == runs[i]
    assert len(set(known.values())) == len(known)


def test_hashes_do_not_depend_on_blocks():
    long = "x" * 3_000_000
    words = Words(pa.array([f"ab {long} cd ab", None, "", "cd " * 700_000 + long]), byte_table(SPACES))
    h = words.hashes()
    assert h[0] == h[3] and h[2] == h[4] and h[1] == h[len(h) - 1] and len({*h[:3].tolist()}) == 3


def test_slices_are_bounded_and_complete():
    texts = ["a" * n for n in (0, 5, 100, 3, 0, 40, 60)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["i", "text"])
    parts = list(slices([batch], "text", 50))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(8))
    for p in parts:
        assert p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 50
    assert np.all([p.num_rows for p in parts])
