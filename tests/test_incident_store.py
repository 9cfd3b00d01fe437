"""Incidents that grow, move, meet and come back, over several runs."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkwatch.plans.detection import run_detections
from sparkwatch.plans.rules import BY_NAME, RULES, with_params
from sparkwatch.sinks.incidents import Chain, IncidentStore, chains_of
from sparkwatch.streaming import rules as stream_rules

START = datetime(2025, 11, 3, 10, 50)
CHAINS = chains_of(RULES)


def at(minutes):
    return START + timedelta(minutes=minutes)


def failures(spark, *bursts, user="a@x"):
    rows = [(at(m) + timedelta(seconds=5 * i), user, "1.1.1.1", "FAILURE") for m, n in bursts for i in range(n)]
    return spark.createDataFrame(rows, "event_time timestamp, user_email string, source_ip string, outcome string")


def okta(rows, minute, **how):
    rule = with_params(BY_NAME["detect_okta_bruteforce"], **how) if how else BY_NAME["detect_okta_bruteforce"]
    return run_detections({"okta_auth": rows}, at(minute), [rule]).alerts


def seen(store, spark):
    rows = store.incidents(spark).orderBy("first_event", "user").collect()
    assert len({r.alert_id for r in rows}) == len(rows)
    return [(r.severity, r.first_event, r.last_event, r.revision) for r in rows]


def test_an_incident_grows_over_runs_and_over_the_hour(spark, root):
    store = IncidentStore(root, CHAINS)
    rows = failures(spark, (0, 6), (7, 3), (14, 12))
    assert store.incidents(spark) is None
    ids = set()
    for minute, severity in ((5, "MEDIUM"), (9, "HIGH"), (16, "CRITICAL")):
        store.record(okta(rows, minute))
        (row,) = store.incidents(spark).collect()
        ids.add(row.alert_id)
        assert row.severity == severity and row.first_event == at(0) == row.event_time
    assert len(ids) == 1 and row.last_event == at(14) + timedelta(seconds=55) and row.revision == 2
    assert row.detection_time == at(5) and row.updated_at == at(16)
    assert {r.version for r in store.history(spark).collect()} == {1, 2, 3}
    store.record(okta(rows, 16))  # nothing new
    assert store.history(spark).count() == 3 and seen(store, spark)[0][3] == 2


def test_incidents_beyond_the_gap_are_apart_and_meet_through_late_hits(spark, root):
    store = IncidentStore(root, {"detect_okta_bruteforce": Chain(600)})
    store.record(okta(failures(spark, (0, 5), (40, 12)), 42, within="60 minutes", mode="sliding"))
    early = okta(failures(spark, (0, 5)), 2)
    late = okta(failures(spark, (40, 12)), 42)
    store = IncidentStore(f"{root}-2", {"detect_okta_bruteforce": Chain(600)})
    store.record(late)
    store.record(early)
    assert [s for s, *_ in seen(store, spark)] == ["MEDIUM", "CRITICAL"]
    bridge = failures(spark, *[(m, 5) for m in range(5, 40, 5)])
    store.record(okta(bridge, 41, within="60 minutes"))
    (one,) = seen(store, spark)
    assert one[:3] == ("CRITICAL", at(0), at(40) + timedelta(seconds=55))
    merged = store.history(spark).where("merged_into IS NOT NULL").collect()
    assert len(merged) == 1 and merged[0].merged_into == store.incidents(spark).first().alert_id
    store.record(okta(failures(spark, (44, 5)), 46))
    assert len(seen(store, spark)) == 1


def test_entities_and_rules_are_apart(spark, root):
    store = IncidentStore(root, CHAINS)
    rows = failures(spark, (0, 5)).unionByName(failures(spark, (1, 5), user="b@x"))
    alerts = okta(rows, 5)
    other = alerts.withColumns({
        "detection_rule": F.lit("detect_web_beaconing"), "context": F.lit('{"process_name":"p","destination_ip":"9"}'),
    })
    both = other.unionByName(other.withColumn("context", F.lit('{"process_name":"q","destination_ip":"9"}')))
    store.record(alerts.unionByName(both).unionByName(alerts.withColumn("detection_rule", F.lit("no chain"))))
    assert store.incidents(spark).groupBy("detection_rule").count().orderBy("detection_rule").collect() == [
        ("detect_okta_bruteforce", 2), ("detect_web_beaconing", 4),
    ]


def test_a_repeated_version_changes_nothing(spark, root):
    store = IncidentStore(root, CHAINS)
    rows = failures(spark, (0, 6), (8, 12))
    store.record(okta(rows, 5), version=1)
    for _ in range(2):
        store.record(okta(rows, 10), version=2)
    got = seen(store, spark)
    assert [(s, r) for s, *_, r in got] == [("CRITICAL", 1)] and store.history(spark).count() == 2


def test_compaction_keeps_what_readers_see(spark, root):
    store = IncidentStore(root, CHAINS)
    days = [-4 * 1440, -2 * 1440, 0]
    for d in days:
        for m, n in ((0, 5), (3, 12)):
            rows = failures(spark, (d, 5), (d + 3, n))
            store.record(okta(rows, d + m + 2, within="30 minutes"))
    before = seen(store, spark)
    assert [s for s, *_ in before] == ["CRITICAL"] * 3
    for _ in range(2):
        store.compact(spark, date(2025, 11, 2))
        assert seen(store, spark) == before
    closed = spark.read.parquet(f"{root}/closed")
    assert closed.count() == 2 and store.last_version(spark) == 6
    plan = store.incidents(spark, date(2025, 11, 3))._jdf.queryExecution().executedPlan().toString()
    assert "last_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # A late hit extends a closed incident, and the next compaction takes it over.
    late = failures(spark, (days[0] + 30, 5))
    store.record(okta(late, days[0] + 35))
    after = seen(store, spark)
    assert len(after) == 3 and after[0][2] > before[0][2] and after[1:] == before[1:]
    store.compact(spark, date(2025, 11, 4))
    assert seen(store, spark) == after and store.last_version(spark) == 7
    store.record(okta(failures(spark, (5, 12)), 8))
    assert len(seen(store, spark)) == 3


def test_hits_without_span_chain_by_their_time(spark, root):
    """A baseline rule and a clustering rule have one event per run and a gap of a day."""
    store = IncidentStore(root, CHAINS)
    base = okta(failures(spark, (0, 5)), 5).withColumn("context", F.lit("{}"))
    for hours in (0, 20, 40, 70):
        for rule in ("detect_user_behavior_anomaly", "detect_user_clustering"):
            moved = base.withColumns({"detection_rule": F.lit(rule), "event_time": F.col("event_time") + F.make_dt_interval(hours=F.lit(hours))})
            store.record(moved)
    got = store.incidents(spark).groupBy("detection_rule").agg(F.count("*"), F.max("revision")).collect()
    assert sorted(map(tuple, got)) == [("detect_user_behavior_anomaly", 2, 2), ("detect_user_clustering", 2, 2)]


@pytest.mark.parametrize("empty", [True, False])
def test_runs_without_hits(spark, root, empty):
    store = IncidentStore(root, CHAINS)
    alerts = okta(failures(spark, (0, 5)), 5)
    store.record(alerts.limit(0) if empty else alerts.withColumn("event_time", F.lit(None).cast("timestamp")))
    assert store.incidents(spark) is None or store.incidents(spark).count() == 0
    store.record(alerts)
    assert len(seen(store, spark)) == 1


def test_stream_writes_versions_by_batch(spark, root):
    """Parts of an attack that arrive in three batches are one incident with the last severity."""
    store = IncidentStore(f"{root}/incidents", CHAINS)
    rows = failures(spark, (0, 6), (7, 3), (14, 12))
    for limit in (5, 10, 16):
        part = rows.where(F.col("event_time").between(at(limit - 7), at(limit))).coalesce(1)
        part.write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    to_alerts = lambda batch: run_detections({"okta_auth": batch}, at(16), [with_params(BY_NAME["detect_okta_bruteforce"], within="1 hour", min_count=3)]).alerts
    q = stream_rules.start_incident_writer(stream, to_alerts, store, f"{root}/cp", available_now=True)
    q.awaitTermination()
    got = seen(store, spark)
    assert len(got) == 1 and got[0][:2] == ("CRITICAL", at(0)) and got[0][3] >= 1
    assert store.last_version(spark) == 3
