"""Batches of op6 are bounded by their bytes and not only by their rows."""

import random

import pytest
from pyspark.sql import functions as F
from test_substrings import brute, corpus, got

from sparkwatch.llm.substrings import BATCH_BYTES, BATCH_ROWS, batched


@pytest.mark.parametrize("rows, most", [(BATCH_ROWS, BATCH_BYTES), (7, 1000), (1, 1), (1000, 64_000)])
def test_long_texts_that_lie_together(spark, rows, most):
    sizes = [0, 1, 2, 63, 64, 65, 999, 1000, 1001] * 40 + [100_000] * 300 + [5_000_000] + [30] * 2000
    texts = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n int").coalesce(1)
    texts = texts.select("doc_id", F.when(F.col("n") > 0, F.repeat(F.lit("x"), "n")).alias("text"))
    out = batched(texts, ["doc_id"], rows, most).groupBy("batch").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")
    ).collect()
    assert sum(r.n for r in out) == len(sizes) and sum(r.bytes for r in out) == sum(sizes)
    assert all(r.n <= rows and (r.bytes <= most or r.n == 1) for r in out)


def test_short_texts_fill_their_batches(spark):
    texts = spark.range(5 * BATCH_ROWS).coalesce(1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    assert batched(texts, ["doc_id"], BATCH_ROWS, BATCH_BYTES).select("batch").distinct().count() == 5


@pytest.mark.parametrize("most", [1, 300, 5000])
def test_same_result_whatever_the_bytes(spark, most):
    rows = corpus(17)
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, batch_bytes=most) == brute(rows, 13)
