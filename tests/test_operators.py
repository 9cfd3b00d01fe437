"""Boundary values of the generic operators."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkwatch.functions.neighbours import previous_by_range, with_previous
from sparkwatch.functions.severity import severity_rank, worst_severity
from sparkwatch.functions.text import base_name, or_else, sentence, to_int
from sparkwatch.functions.times import hour_within, micros
from sparkwatch.operators import baseline, cluster, quality, rarity, rolling, threshold
from sparkwatch.operators.sequence import sequence_gap

AS_OF = "2025-11-03 12:00:00"
NOW = datetime(2025, 11, 3, 12)


def minutes(n):
    return NOW - timedelta(minutes=n)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_worst_severity_is_by_rank(spark):
    df = spark.createDataFrame([("a", "HIGH"), ("a", "MEDIUM"), ("b", "LOW"), ("c", None)], "k string, s string")
    assert as_set(df.groupBy("k").agg(worst_severity("s"))) == {("a", "HIGH"), ("b", "LOW"), ("c", None)}
    assert [r[0] for r in df.select(severity_rank("s")).collect()] == [2, 3, 4, 5]


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("0x1F",), ("443.0",), ("12",), ("-",), ("",), (None,), ("99999999999",), (" 7 ",)], "t string"
    )
    assert [r[0] for r in df.select(to_int(F.col("t"))).collect()] == [31, 443, 12, None, None, None, None, 7]
    row = spark.range(1).select(
        sentence("n=", F.lit(None).cast("int"), "."), or_else(F.lit(""), F.lit("x")),
        base_name(F.lit("C:\\a\\b.exe")), base_name(F.lit("/bin/sh")),
    )
    assert tuple(row.first()) == ("n=unknown.", "x", "b.exe", "sh")


def test_hours_across_midnight(spark):
    df = spark.range(24).select(F.make_timestamp(*[F.lit(v) for v in (2025, 1, 1)], F.col("id").cast("int"), F.lit(0), F.lit(0)).alias("t"))
    got = [r[0] for r in df.where(hour_within("t", 22, 6)).select(F.hour("t")).collect()]
    assert sorted(got) == [0, 1, 2, 3, 4, 5, 6, 22, 23]


def failures(spark, counts, kind="timestamp"):
    rows = [(f"u{n}", "1.1.1.1", minutes(i * 0.5)) for n in counts for i in range(n)]
    return spark.createDataFrame(rows, "user string, ip string, t timestamp").withColumn("t", F.col("t").cast(kind))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_trailing_threshold(spark, kind):
    df = failures(spark, [4, 5, 7, 10], kind).unionByName(
        spark.createDataFrame([("u4", "1.1.1.1", minutes(10.01)), ("u4", "1.1.1.1", minutes(-1))], "user string, ip string, t timestamp")
        .withColumn("t", F.col("t").cast(kind))
    )
    out = threshold.threshold(df, ["user", "ip"], "t", as_of=AS_OF, within="10 minutes", min_count=5)
    assert as_set(out.select("user", "event_count")) == {("u5", 5), ("u7", 7), ("u10", 10)}


def test_trailing_filter_reaches_the_files(spark, root):
    failures(spark, [5], "timestamp_ntz").write.parquet(root)
    out = threshold.threshold(spark.read.parquet(root), ["user"], "t", as_of=AS_OF, within="10 minutes", min_count=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2025-11-03T11:50)" in plan


def test_sets_and_evidence(spark):
    df = failures(spark, [6]).withColumn("port", (F.minute("t") % 3).cast("int"))
    hits = threshold.threshold(df, ["user"], "t", as_of=AS_OF, within="10 minutes", min_count=5, sets={"ports": "port"})
    assert hits.first()["ports"] == sorted({minutes(i * 0.5).minute % 3 for i in range(6)})
    assert threshold.threshold_evidence(df, hits, ["user"], "t").count() == 6


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        threshold.threshold(failures(spark, [1]), ["user"], "t", min_count=1, within="1 day", mode="other")


def logins(spark, seed=0, n=400, users=5, hot=0.5):
    r = random.Random(seed)
    rows = [
        (
            None if r.random() < 0.1 else ("hot" if r.random() < hot else f"u{r.randrange(users)}"),
            NOW - timedelta(seconds=r.randrange(0, 20000)),
            i,
            r.choice(["A", "B", "C"]),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "user string, t timestamp, id int, country string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sliced_previous_row_equals_lag(spark, seed):
    df = logins(spark, seed)
    got = with_previous(df, "user", "t", ["id"], ["t", "country", "id"], slice_seconds=300)
    want = df.withColumn("prev", F.lag(F.struct("t", "country", "id")).over(W.partitionBy("user").orderBy("t", "id")))
    assert sorted(map(str, got.select("id", "prev").collect())) == sorted(map(str, want.select("id", "prev").collect()))
    assert got.count() == df.count()


def test_hot_key_is_spread_over_tasks(spark):
    """The rows of a hot key are partitioned by key and slice."""
    df = logins(spark, 4, 300, hot=1.0)
    out = with_previous(df, "user", "t", ["id"], ["country"], slice_seconds=300)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan.split("Window")[1]


@pytest.mark.parametrize(("seed", "hot"), [(1, 0.5), (2, 1.0)])
def test_previous_row_by_ranges_equals_lag(spark, seed, hot):
    df = logins(spark, seed, hot=hot).repartition(5)
    got = previous_by_range(df, "user", "t", ["id"], ["t", "country", "id"])
    want = df.withColumn("prev", F.lag(F.struct("t", "country", "id")).over(W.partitionBy("user").orderBy("t", "id")))
    assert sorted(map(str, got.select("id", "prev").collect())) == sorted(map(str, want.select("id", "prev").collect()))
    assert previous_by_range(df.limit(0), "user", "t", ["id"], ["t"]).collect() == []


def test_one_key_within_one_hour_is_parted_evenly(spark):
    """No range holds twice the median, though all rows have one key and lie within one hour."""
    df = spark.range(200_000).select(
        F.lit("hot").alias("user"), F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id") * 10 % 3_600_000).alias("t"),
        "id", (F.col("id") % 3).alias("country"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = previous_by_range(df, "user", "t", ["id"], ["country"])
        assert out.where("prev IS NULL").count() == 1
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        folder = [f for f in out.inputFiles() if "ranges" in f][0].rsplit("/", 1)[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = sorted(r["count"] for r in spark.read.parquet(folder).groupBy("_range").count().collect())
    assert len(sizes) == 4 and sizes[-1] < 2 * sizes[len(sizes) // 2] and "Window [" in plan and "_range" in plan.split("Window [")[1]


def test_gap_bounds(spark):
    base = NOW
    rows = []
    for user, gap, second in [("same", 0, "B"), ("one", 1, "B"), ("edge", 3600, "B"), ("late", 3601, "B"), ("still", 10, "A"), ("lost", 10, None)]:
        rows += [(user, base, 1, "A"), (user, base + timedelta(seconds=gap), 2, second)]
    df = spark.createDataFrame(rows, "user string, t timestamp, id int, country string")
    out = sequence_gap(df, "user", "t", changed="country", max_gap_seconds=3600, tiebreak=["id"])
    assert as_set(out.select("user", "gap_seconds", "previous_country")) == {("one", 1, "A"), ("edge", 3600, "A")}


def daily(user, counts, today):
    rows = []
    for day, n in enumerate(counts, start=2):
        rows += [(user, datetime(2025, 11, 3) - timedelta(days=day) + timedelta(hours=1, seconds=i), i) for i in range(n)]
    return rows + [(user, datetime(2025, 11, 3, 1) + timedelta(seconds=i), i) for i in range(today)]


def test_baseline_scores(spark):
    rows = daily("flat", [3, 3, 3], 9) + daily("one", [3], 9) + daily("var", [2, 4, 6], 8) + daily("gone", [2, 3], 0) + daily("new", [], 4)
    df = spark.createDataFrame(rows, "user string, t timestamp, v int")
    out = baseline.baseline_zscore(
        df, "user", "t", as_of=AS_OF, metrics={"n": F.count("*"), "d": F.count_distinct("v")},
        today={"last": F.max("t")},
    )
    got = {r["user"]: r for r in out.collect()}
    assert set(got) == {"flat", "one", "var"}
    assert got["flat"]["z_n"] is None and got["one"]["z_n"] is None
    assert got["var"]["avg_n"] == 4 and got["var"]["std_n"] == 2 and got["var"]["z_n"] == 2.0
    assert got["var"]["today_d"] == 8 and got["var"]["today_last"] == datetime(2025, 11, 3, 1, 0, 7)


def test_baseline_scores_at_a_threshold_do_not_depend_on_order(spark):
    rng = random.Random(3)
    rows = []
    for user in range(200):  # mean 2, deviation 1
        days = [1, 3] * 11 + [2]
        rng.shuffle(days)
        rows += [(user, datetime(2025, 11, 1) - timedelta(days=d), n) for d, n in enumerate(days)]
        rows.append((user, datetime(2025, 11, 3, 1), 4))
    df = spark.createDataFrame(rows, "user int, t timestamp, v int").repartition(7)
    out = baseline.baseline_zscore(df, "user", "t", as_of=AS_OF, metrics={"n": F.sum("v")})
    assert {(r["avg_n"], r["std_n"], r["z_n"]) for r in out.collect()} == {(2.0, 1.0, 2.0)}


def test_rarity_steps_and_rank(spark):
    counts = {"a": 5, "b": 6, "c": 20, "d": 21, "e": 100, "f": 101, "g": 5}
    rows = [(p, minutes(i % 1000 + 1)) for p, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "p string, t timestamp")
    out = rarity.rarity(df, "p", "t", as_of=AS_OF).select("p", "historical_count", "rarity_category", "rarity_percentile").distinct()
    freq = spark.createDataFrame(list(counts.items()), "p string, n int")
    rank = {r["p"]: r["r"] for r in freq.withColumn("r", F.percent_rank().over(W.orderBy("n"))).collect()}
    assert as_set(out) == {
        ("a", 5, "VERY_RARE", rank["a"]), ("g", 5, "VERY_RARE", rank["g"]), ("b", 6, "RARE", rank["b"]), ("c", 20, "RARE", rank["c"]),
    }


def test_rolling_sparse_and_dense(spark):
    hours = [h for h in range(26) if h != 10]
    rows = [(datetime(2025, 11, 1) + timedelta(hours=h, minutes=m),) for h in hours for m in range(40 if h == 25 else 2 + h % 2)]
    df = spark.createDataFrame(rows, "t timestamp")
    sparse = rolling.rolling_zscore(df, "t").where(F.col("zscore") >= 2)
    assert [r["event_count"] for r in sparse.collect()] == [40]
    dense = rolling.rolling_zscore(df, "t", dense=True)
    assert dense.count() == 26
    assert dense.where(F.hour("time_bucket") == 10).first()["event_count"] == 0


def test_cluster_outliers(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1), ("d", 2), ("e", 2), ("f", 2)], "u string, prediction int")
    assert as_set(cluster.cluster_outliers(df).select("u")) == {("a",), ("b",), ("c",)}


def test_cluster_finds_the_far_point(spark):
    rows = [(f"u{i}", float(i % 3), float(i % 2)) for i in range(40)] + [("odd", 500.0, 900.0)]
    df = spark.createDataFrame(rows, "u string, x double, y double")
    out = cluster.cluster_outliers(cluster.cluster(df, ["x", "y"], k=2))
    assert as_set(out.select("u")) == {("odd",)}


EXPECT = {"has_user": "user IS NOT NULL", "small": "v < 10"}


def graded(spark):
    return spark.createDataFrame([("a", 1), (None, 1), ("b", 20), (None, None)], "user string, v int")


def test_expect_warn_and_drop(spark):
    kept, seen = quality.expect(graded(spark), EXPECT)
    assert kept.count() == 4
    assert seen.get == {"total_rows": 4, "failed_has_user": 2, "failed_small": 2}
    dropped, seen = quality.expect(graded(spark), EXPECT, "drop")
    assert dropped.count() == 1
    assert seen.get["total_rows"] == 4


def test_expect_fail_and_flag(spark):
    broken, _ = quality.expect(graded(spark), EXPECT, "fail")
    with pytest.raises(Exception, match="row breaks a rule"):
        broken.collect()
    flagged, _ = quality.expect(graded(spark), EXPECT, "flag")
    good, bad = quality.quarantine(flagged)
    assert good.count() == 1 and bad.count() == 3
    assert as_set(bad.select(F.array_join("failed_rules", "+"))) == {("has_user",), ("small",), ("has_user+small",)}
    with pytest.raises(ValueError):
        quality.expect(graded(spark), EXPECT, "other")


def test_expectation_counts_and_null_rates(spark):
    assert as_set(quality.expectation_counts(graded(spark), EXPECT, "t")) == {("t", "has_user", 2, 2), ("t", "small", 2, 2)}
    assert as_set(quality.null_rates(graded(spark), ["user", "v"], "t")) == {("t", "user", 4, 2, 50.0, False), ("t", "v", 4, 1, 25.0, False)}


def valued(spark, n=300):
    """Group ``a`` holds almost all values, group null some, ``b`` too few."""
    rows = [("a", NOW - timedelta(seconds=i % 500), i % (n // 2)) for i in range(n)]
    rows += [(None, NOW, i % 7) for i in range(20)] + [("b", NOW, 1), ("b", NOW, 2)]
    rows += [("a", NOW, None), ("a", None, 5), ("a", NOW - timedelta(days=2), 9999), ("c", NOW, None)] * 3
    return spark.createDataFrame(rows, "g string, t timestamp, v long")


@pytest.mark.parametrize("by, least", [("events", 4), ("events", 3), ("values", 3), ("values", 2)])
def test_value_rows_hold_what_sets_hold(spark, by, least):
    df = valued(spark)
    got = threshold.threshold_values(df, ["g"], "t", "v", as_of=AS_OF, within="10 minutes", min_count=least, by=by)
    lists = threshold.threshold(
        df, ["g"], "t", as_of=AS_OF, within="10 minutes", min_count=least, sets={"vs": "v"},
        distinct="v" if by == "values" else None,
    )
    want = {(r.g, v) for r in lists.collect() for v in r.vs}
    rows = got.collect()
    assert len(rows) == len(want) and {(r.g, r.v) for r in rows} == want
    assert sum(r.event_count for r in rows if r.g == "a") == 300
    assert all(r.first_seen <= r.last_seen for r in rows)


def test_value_rows_of_sliding_spans(spark):
    df = valued(spark)
    how = dict(within="5 minutes", slide="1 minute", mode="sliding", min_count=3)
    got = threshold.threshold_values(df, ["g"], "t", "v", **how).collect()
    lists = threshold.threshold(df, ["g"], "t", sets={"vs": "v"}, **how).collect()
    assert {(r.g, r.window_start, r.window_end, r.v) for r in got} == {
        (r.g, r.window_start, r.window_end, v) for r in lists for v in r.vs
    }
    assert len(got) == sum(len(r.vs) for r in lists)


def test_many_values_without_a_list(spark):
    df = spark.range(200_000).select(
        F.lit("hot").alias("g"), F.lit(AS_OF).cast("timestamp").alias("t"), (F.col("id") % 150_000).alias("v")
    )
    out = threshold.threshold_values(df, ["g"], "t", "v", as_of=AS_OF, within="10 minutes", min_count=5)
    assert out.count() == 150_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan and "Window" not in plan
    empty = threshold.threshold_values(df.limit(0), ["g"], "t", "v", as_of=AS_OF, within="10 minutes", min_count=1)
    assert empty.count() == 0
    with pytest.raises(ValueError):
        threshold.threshold_values(df, ["g"], "t", "v", as_of=AS_OF, within="10 minutes", min_count=1, by="rows")


def test_sketches_merge_over_runs(spark):
    df = valued(spark, 6000).where("t is not null")
    parts = [
        threshold.threshold(
            df.where(F.pmod("v", F.lit(3)) == i), ["g"], "t", as_of=AS_OF, within="10 minutes", min_count=1,
            sketches={"vs": "v"},
        )
        for i in range(3)
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0])
    got = {r.g: r.vs for r in threshold.merged_estimates(both, ["g"], ["vs"]).collect()}
    assert got.keys() == {"a", "b", None} and abs(got["a"] - 3000) < 150 and (got["b"], got[None]) == (2, 7)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("bins", [None, "1 second", "7 minutes", "1 hour", "30 days"])
def test_evidence_by_bins_equals_all_pairs(spark, kind, bins):
    df = logins(spark, 4, n=300, hot=0.9).withColumn("t", F.when(F.col("id") > 3, F.col("t")).cast(kind))
    hits = threshold.threshold(df, ["user"], "t", within="20 minutes", slide="5 minutes", mode="sliding", min_count=3)
    got = threshold.threshold_evidence(df, hits, ["user"], "t", bins=bins).select("user", "id", "window_start").collect()
    events, spans = df.collect(), hits.collect()
    want = [
        (e.user, e.id, h.window_start) for h in spans for e in events
        if e.t is not None and e.user == h.user and h.first_seen <= e.t <= h.last_seen
    ]
    assert want and sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_evidence_of_a_hot_key_meets_in_bins(spark):
    """All events and one hit of one key: the trailing span is cut, and events of other times stay out."""
    df = spark.range(8000).select(
        F.lit("hot").alias("user"), (F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("t")
    )
    hits = threshold.threshold(df, ["user"], "t", as_of=AS_OF, within="2 hours", min_count=5)
    out = threshold.threshold_evidence(df, hits, ["user"], "t", as_of=AS_OF, within="2 hours")
    assert out.columns == ["user", "t"] and out.count() == 7201
    assert threshold.threshold_evidence(df, hits.limit(0), ["user"], "t", as_of=AS_OF, within="2 hours").count() == 0
    bins = df.select(F.floor(micros(df, "t") / (7200 * 1_000_000 / 16)).alias("b")).groupBy("b").count()
    assert bins.agg(F.max("count")).first()[0] <= 450 and "_event_bin" in out._jdf.queryExecution().optimizedPlan().toString()


def test_micros_keep_the_clock_of_times_without_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.999999' AS t UNION ALL SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.000001'")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = sorted(r[0] for r in df.select(micros(df, "t")).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    day = datetime(2024, 3, 10, 2, 30, 0, 1) - datetime(1970, 1, 1)
    assert got == [-1, day // timedelta(microseconds=1)]
