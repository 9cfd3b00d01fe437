import random
from collections import defaultdict

import pytest

from sparkwatch.llm.packing import pack, packed, sequence_cost


@pytest.mark.parametrize("seed", range(4))
def test_bins_hold_their_pieces(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 7, 60, 100, 128, 255, 256, rng.randrange(1, 257)]) for _ in range(500)]
    bins, offset, capacity = pack(lengths, (64, 128, 256))
    held = defaultdict(list)
    for n, b, o in zip(lengths, bins, offset, strict=True):
        held[b].append((o, o + n))
    for b, spans in held.items():
        spans.sort()
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert capacity[b] == min(c for c in (64, 128, 256) if c >= spans[-1][1])
    assert sum(lengths) / capacity.sum() > 0.97


def test_best_fit_takes_the_least_room():
    # 70 and 60 open bins of 100; 30 fits both and goes where it leaves nothing.
    bins, offset, capacity = pack([60, 70, 30], (100,))
    assert bins[2] == bins[1] != bins[0] and offset[2] == 70 and capacity.tolist() == [100, 100]


def test_the_cheapest_size_is_opened_and_bins_shrink():
    assert pack([10, 10], (16, 64), cost=lambda c: c)[2].tolist() == [16, 16]  # a tie: the smaller
    assert pack([10, 10], (16, 64), cost=lambda c: 10 + c)[2].tolist() == [64]
    assert pack([10], (16, 64), cost=lambda c: 10 + c)[2].tolist() == [16]
    assert pack([], (16, 64))[2].tolist() == [] and sequence_cost(512) / 512 < sequence_cost(64) / 64


def test_documents(spark):
    long = "w " * 10_000
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "a b c", 0), (4, "a b c", 0), (None, "d", 0), (5, long, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bin int")
    got = packed(df, (16, 1024), load=4).collect()
    words = defaultdict(int)
    for r in got:
        words[r.row.doc_id] += r.n_words
        assert (r.bin is None) == (r.n_words == 0)
        assert r.bin is None or r.offset + r.n_words <= r.capacity
    assert words == {1: 0, 2: 0, 3: 0, 4: 6, None: 1, 5: 10_000}
    five = sorted((r.piece, r.first_word, r.n_words) for r in got if r.row.doc_id == 5)
    assert five == [(i, i * 1024, min(1024, 10_000 - i * 1024)) for i in range(10)]
    spans = sorted((r.bin, r.offset, r.offset + r.n_words) for r in got if r.bin is not None)
    assert all(x[0] != y[0] or x[2] <= y[1] for x, y in zip(spans, spans[1:], strict=False))
    assert len([r for r in got if r.row.doc_id == 4]) == 2
    assert packed(df.limit(0)).collect() == []
