import zlib

import pytest
from pyspark.sql import functions as F

from sparkwatch.llm.sharding import MULTIPLIER, jump_shard, sharded


def jump(key, n):
    key %= 1 << 64
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * MULTIPLIER + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 8, 9, 100])
def test_jump_equals_the_published_loop(spark, n):
    keys = [0, 1, 2, 7, -1, -5, 2**63 - 1, -(2**63), 123456789012345] + list(range(1000, 1200))
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", jump_shard(F.col("k"), n).alias("s"))
    assert {r.k: r.s for r in df.collect()} == {k: jump(k, n) for k in keys}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = sharded(df, 8).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert all(r.grown_shard == 8 for r in moved)
    assert abs(len(moved) / len(rows) - 1 / 9) < 0.02
    for s in range(8):
        own = sorted((r.doc_id, r.slot) for r in rows if r.shard == s)
        assert [slot for _, slot in own] == list(range(len(own)))
        assert abs(len(own) / len(rows) - 1 / 8) < 0.02


def test_odd_rows(spark):
    long = "é" * 100_000
    rows = [(1, None, 0), (1, None, 0), (None, "a", 1), (None, None, 2), (5, "", 3), (6, long, 4), (7, "b", None)]
    rows += [(9, "same", 5)] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharded(df, 4).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"key"}
    for r in got:
        assert r.shard == jump(r.doc_id or 0, 4)
    by_size = {(r.doc_id, r.size, r.text_crc32) for r in got}
    assert (1, 1, 0) in by_size and (6, 200_001, zlib.crc32(long.encode())) in by_size
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharded(df.limit(0), 4).collect() == []
