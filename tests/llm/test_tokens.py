import random
import re

import pytest

from sparkwatch.llm.tokens import LONGEST, MARK, Trie, Unigram, load_unigram, token_counts


def brute(model, text):
    """Plain forward scores of one pre-token over its whole length."""
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        size = len(text[end - 1].encode())
        options = [(best[end - 1][0] + size * model.byte_score, -(-best[end - 1][1] + size))]
        options += [
            (best[s][0] + model.scores[text[s:end]], best[s][1] - 1)
            for s in range(end)
            if text[s:end] in model.scores
        ]
        best.append(max(options))
    return -best[-1][1]


@pytest.fixture(scope="module")
def model():
    return load_unigram()


def test_trie_equals_plain_forward_scores(model):
    rng = random.Random(2)
    words = ["".join(rng.choice("theandio é漢😀") for _ in range(rng.choice([1, 3, 9, 40]))) for _ in range(300)]
    words += [w + "s" for w in words[:50]] + ["", "x" * 300, "the" * 100]
    trie = Trie(model)
    for w in words:
        assert trie.count(w) == model.count(w) == brute(model, w)
    assert len("the" * 100) > LONGEST
    nodes = len(trie.best)
    assert [trie.count(w) for w in words] == [brute(model, w) for w in words] and len(trie.best) == nodes


def test_ties_take_fewer_pieces():
    model = Unigram({"a": -1.0, "b": -1.0, "ab": -2.0}, 2, -9.0)
    assert Trie(model).count("ab") == model.count("ab") == 1


def test_documents(spark, model):
    long = " ".join(f"word{i % 3000}" for i in range(60_000))
    rows = [(1, None, 1), (2, "", 1), (3, " \t\n", 1), (4, "the end", 1), (4, "the end", 1), (None, "漢字", None), (5, long, 1), (6, "z" * 100_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(((r.row.doc_id, r.n_pretokens, r.n_tokens) for r in token_counts(df, model).collect()), key=str)
    want = []
    for i, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        known = {w: model.count(MARK + w) for w in set(words)}
        want.append((i, len(words), sum(known[w] for w in words)))
    assert got == sorted(want, key=str)
    assert token_counts(df.limit(0), model).collect() == []
