import hashlib
from collections import Counter
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkwatch.llm import alignment
from sparkwatch.llm.alignment import ByteLevel, Pieces, aligned, byte_letters, lanes, merge

A = partial(ByteLevel, public_tokenizers.path("byte_bpe_50k.json"))
B = partial(Pieces, public_tokenizers.path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, n_a string, batch int"


def spans(model, text):
    out, at = [], 0
    for i in model.encode([text])[0].tolist():
        out.append((i, at, at + len(model.token(i))))
        at = out[-1][2]
    return out, b"".join(model.token(i) for i, *_ in out)


def brute(texts):
    """All pairs of tokens of each text, compared one by one."""
    a, b, found, held = A(), B(), [], Counter()
    for text in texts:
        x, y = [], []
        if text:
            (x, left), (y, right) = spans(a, text), spans(b, text)
            if not left == right == b" " + text.encode():
                x, y = [], []
        links = [(i, j) for i, s, e in x for j, t, f in y if s < f and t < e]
        cuts = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in z if low <= s and e <= cut) for z in (x, y)))
            low = cut
        held.update(set(links))
        found.append((len(x), len(y), links, groups))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(n, most.get(i, 0))
    return [
        (
            n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for n_a, n_b, links, groups in found
    ]


TEXTS = [
    None, "", " ", "the end", "the end", "Straße naïve 漢字かな 😀 é", "a▁b loses its mark", "<|endoftext|> and <s> </s> <unk>",
    "  two  spaces\n\nand\ttabs\r\n ", "x" * 700, "nul \x00 byte", "don't we'll 12345.678", "supercalifragilistic " * 90, "  odd spaces　",
]


@pytest.fixture(scope="module")
def wanted():
    return brute(TEXTS)


@pytest.mark.parametrize("bounds", [(4 << 20, 512, 3), (60, 3, 5)])
def test_equals_all_pairs(spark, monkeypatch, wanted, bounds):
    monkeypatch.setattr(alignment, "BATCH_BYTES", bounds[0])
    monkeypatch.setattr(lanes, "__defaults__", (bounds[1],))
    rows = [(None if i == 3 else i // 2, t, "clash", i) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(bounds[2])
    got = {
        r.row.batch: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
        for r in aligned(df, A, B).collect()
    }
    assert [got[i] for i in range(len(rows))] == wanted
    assert wanted[6][0] == wanted[0][0] == 0 and wanted[7][0] > 10


def test_spans_and_links(spark):
    df = spark.createDataFrame([(1, "don't stop", "", 0), (2, None, "", 0)], SCHEMA)
    one, two = sorted(aligned(df, A, B, ["doc_id"], with_spans=True).collect(), key=lambda r: r.row.doc_id)
    (x, _), (y, _) = spans(A(), "don't stop"), spans(B(), "don't stop")
    assert [(l.a, l.b) for l in one.links] == [
        (i, j) for i, (_, s, e) in enumerate(x) for j, (_, t, f) in enumerate(y) if s < f and t < e
    ]
    assert [i for g in one.groups for i in g.a] == [i for i, *_ in x] and [i for g in one.groups for i in g.b] == [i for i, *_ in y]
    assert one.groups[-1].byte_end == len(" don't stop") and two.groups == two.links == []
    text = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in one.groups)
    assert one.groups_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    assert aligned(spark.createDataFrame([], SCHEMA), A, B).collect() == []


def test_lockstep_over_random_cuts():
    rng = np.random.default_rng(4)
    a_first, b_first, a_end, b_end, want = [0], [0], [], [], set()
    for size in (1, 2, 50, 400, 0, 3000):
        cuts = [np.sort(np.append(rng.choice(max(size - 1, 0), size // k, replace=False) + 1, size)) if size else np.zeros(0, int) for k in (2, 3)]
        for i, e in enumerate(cuts[0]):
            for j, f in enumerate(cuts[1]):
                s, t = (cuts[0][i - 1] if i else 0), (cuts[1][j - 1] if j else 0)
                if s < f and t < e:
                    want.add((len(a_end) + i, len(b_end) + j))
        a_end += cuts[0].tolist()
        b_end += cuts[1].tolist()
        a_first.append(len(a_end))
        b_first.append(len(b_end))
    arrays = [np.array(x, np.int64) for x in (a_first, a_end, b_first, b_end)]
    for size in (1, 7, 64, 10_000):
        begin_a, begin_b, stop_a, stop_b = lanes(*arrays, size)
        assert (begin_a[1:] == stop_a[:-1]).all() and (begin_b[1:] == stop_b[:-1]).all()
        left, right, *cuts = merge(arrays[1], arrays[3], begin_a, begin_b, stop_a)
        found = list(zip(left.tolist(), right.tolist(), strict=True))
        assert len(found) == len(want) and set(found) == want
        assert (arrays[1][cuts[0]] == arrays[3][cuts[1]]).all()
        assert (len(begin_a) > 5) == (size < 10_000)


def lists(model, texts):
    ids, count = model.encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(count)[:-1])] if texts else []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aB'sé漢9.,\u0300 \u00a0\u3000\u200b\x1c\n\t_▁😀", max_size=25), max_size=4))
def test_words_have_the_tokens_of_the_text(encoders, texts):
    for model in encoders:
        assert model.parts and lists(model, texts) == model.whole(texts)


@pytest.fixture(scope="module")
def encoders():
    return A(), B()


def test_long_prose_by_words(encoders):
    path = "/root/testdata/sf0.001/documents.parquet"
    texts = [t or "" for t in pq.read_table(path, columns=["text"]).column(0).to_pylist()]
    for model in encoders:
        assert lists(model, texts) == model.whole(texts)


def test_tokens_are_bytes():
    letters = byte_letters()
    assert len(letters) == 256 and set(letters.values()) == set(range(256)) and letters["Ġ"] == 0x20
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = " naïve 漢字\n\t😀"
    assert b"".join(A().token(i) for i in model.encode(text).ids) == text.encode()
    assert B().token(B()._model.piece_to_id("<0x0A>")) == b"\n" and B().table()[3].as_py() == b"\x00"
