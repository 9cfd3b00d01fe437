"""Daily rollups: any order of batches, finished and open days, baselines equal to those over events."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkwatch.operators.baseline import baseline_zscore
from sparkwatch.streaming.rollup import DailyRollup

RAW = "user string, event_time timestamp, ip string"


def rollup(root):
    return DailyRollup(f"{root}/r", "user", "n", {"ips": "ip"})


def events(spark, seed, n=400):
    draw = random.Random(seed)
    start = datetime(2025, 1, 20)
    rows = [
        (
            draw.choice(["a", "a", "a", "b", "c", None]),
            start + timedelta(minutes=draw.randrange(20 * 1440)),
            draw.choice(["1", "2", "3", None]),
        )
        for _ in range(n)
    ]
    rows += [("a", None, "1"), ("d", datetime(2025, 2, 1), None)]
    return spark.createDataFrame(rows, RAW)


def plain_days(df):
    rows = {}
    for r in df.collect():
        if r.user is not None and r.event_time is not None:
            rows.setdefault((r.user, r.event_time.date()), []).append(r.ip)
    return {k: (len(v), len({x for x in v if x is not None})) for k, v in rows.items()}


def got(spark, days):
    rows = days.days(spark).collect()
    assert len({(r.user, r.event_date) for r in rows}) == len(rows)
    return {(r.user, r.event_date): (r.n, r.ips) for r in rows}


def test_days_are_exact_at_any_time(spark, root):
    r, seen = rollup(root), None
    assert got(spark, r) == {} and r.finish(spark) == -1
    for number in range(4):
        batch = events(spark, number, 0 if number == 2 else 150)
        r.add(batch, number)
        seen = batch if seen is None else seen.unionByName(batch)
        assert got(spark, r) == plain_days(seen)
        if number in (1, 3):
            if number == 1:
                r.add(batch, number)  # repeated after a failure
            assert r.finish(spark) == number and r.finish(spark) == number
            assert got(spark, r) == plain_days(seen)
    # A step that ended before its mark is not read, and can be repeated.
    late = events(spark, 9, 30)
    r.add(late, 4)
    spark.createDataFrame([("a", datetime(2025, 2, 1).date(), 99, 99)], "entity string, event_date date, n long, ips long").withColumn(
        "month", F.lit("2025-02-01").cast("date")
    ).write.partitionBy("month").parquet(f"{root}/r_days/upto=4")
    assert got(spark, r) == plain_days(seen.unionByName(late))
    r.finish(spark)
    assert got(spark, r) == plain_days(seen.unionByName(late))


@pytest.mark.parametrize(
    "as_of, history, gap",
    [
        ("2025-02-08 13:30:00", "14 days", "1 day"),
        ("2025-02-08 23:59:59", "950399 seconds", "86399 seconds"),  # whole days only
        ("2025-02-08 13:30:00", "2 days", "36 hours"),
        ("2025-02-08 23:00:00", "30 hours", "26 hours"),
    ],
)
def test_baselines_from_days_equal_those_from_events(spark, root, as_of, history, gap):
    df = events(spark, 5, 900).withColumn("event_date", F.to_date("event_time"))
    r = rollup(root)
    r.add(df, 0)
    how = dict(
        metrics={"n": F.count("*"), "ips": F.count_distinct("ip")}, today={"last": F.max("event_time")},
        as_of=as_of, history=history, gap=gap,
    )
    key = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in rows.collect())
    want = key(baseline_zscore(df, "user", "event_time", **how))
    assert want and repr(key(baseline_zscore(df, "user", "event_time", days=r.days(spark), **how))) == repr(want)


def test_events_of_whole_days_are_not_read(spark, root):
    df = events(spark, 6).where("event_time IS NOT NULL").withColumn("event_date", F.to_date("event_time"))
    df.write.partitionBy("event_date").parquet(f"{root}/events")
    r = rollup(root)
    r.add(df, 0)
    stored = spark.read.schema(df.schema).parquet(f"{root}/events")
    plan = baseline_zscore(
        stored, "user", "event_time", metrics={"n": F.count("*")}, as_of="2025-02-08 12:00:00", history="14 days",
        days=r.days(spark),
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    try:
        plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in text.splitlines() if "FileScan" in line and "user#" in line)
    filters = scan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
    # The days around the beginning and the end of the history, and today's.
    for day in ("2025-01-24", "2025-01-27", "2025-02-06", "2025-02-08", "2025-02-07"):
        assert day in filters, filters


def test_micro_batches_are_written_by_many_tasks(spark, root, monkeypatch):
    from suite import streams
    from suite import telemetry as T

    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: f"{root}/{name}")
    run = streams._rolled(
        "detect_user_behavior_anomaly", lambda spark, sf: T.okta(spark, sf).repartition(6), T.EVENTS_AS_OF, streams.BEHAVIOR_ROLLUP
    )
    run(spark, "/root/testdata/sf0.001").collect()
    days = streams.DailyRollup(f"{root}/rolled/days", **streams.BEHAVIOR_ROLLUP)
    assert {r.batch_id for r in days.table.numbered(spark).select("batch_id").distinct().collect()} == {0, 1, 2}
    files = spark.read.parquet(f"{root}/rolled/silver").select("_metadata.file_path").distinct().count()
    assert files > 6  # 3 before, one for each micro-batch
