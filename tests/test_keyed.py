"""The previous event as keyed state, against the batch operator."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sparkwatch.operators.sequence import sequence_gap
from sparkwatch.streaming.keyed import KeyedSequence

START = datetime(2025, 11, 3)
SCHEMA = "id long, user string, t timestamp, country string, city string"
RULE = dict(changed="country", max_gap_seconds=600, tiebreak=["id"], carry=["city"])


def test_batches_with_late_rows_equal_one_batch(spark, root):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(6)}"
        at = START + timedelta(seconds=i * 40 - rng.choice([0, 0, 0, 200, 900]))
        rows.append((i, user, at, rng.choice(["X", "Y", None]), f"c{i % 5}"))
    rows += [(900, None, START, "X", "c"), (901, "u1", None, "X", "c")]
    for b in range(0, len(rows), 50):
        spark.createDataFrame(rows[b : b + 50], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    rule = KeyedSequence("user", "t", late_seconds=1000, **RULE)
    q = rule.start(stream, f"{root}/out", f"{root}/cp", available_now=True)
    q.awaitTermination()
    seen = spark.read.parquet(f"{root}/out")
    rest = rule.rest(spark, f"{root}/cp")
    assert seen.columns == rest.columns and seen.count() > 20 and rest.count() > 0
    got = sorted(map(tuple, seen.unionByName(rest).collect()))
    whole = spark.createDataFrame(rows, SCHEMA).where("user IS NOT NULL AND t IS NOT NULL")
    want = sequence_gap(whole, "user", "t", **RULE).select(*seen.columns)
    assert got == sorted(map(tuple, want.collect()))
    # A batch that brings one key updates the state of that key, and of no other.
    one = [(1000 + i, "u1", START + timedelta(seconds=400 * 40 + i), "X", "c") for i in range(3)]
    spark.createDataFrame(one, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    q = rule.start(stream, f"{root}/out", f"{root}/cp", available_now=True)
    q.awaitTermination()
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"]]
    total = q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert updated and max(updated) <= 8 < total
    more = rule.rest(spark, f"{root}/cp")
    assert more.where(F.col("user") == "u1").count() >= 0


def test_state_is_forgotten_after_the_gap(spark, root):
    for i, at in enumerate((0, 5000, 20_000, 40_000)):
        rows = [(i, f"u{i}", START + timedelta(seconds=at), "X", "c")]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    rule = KeyedSequence("user", "t", late_seconds=10, **RULE)
    q = rule.start(stream, f"{root}/out", f"{root}/cp", available_now=True)
    q.awaitTermination()
    last = spark.read.format("statestore").option("stateVarName", "last").load(f"{root}/cp")
    assert last.count() <= 1 and spark.read.parquet(f"{root}/out").count() == 0
