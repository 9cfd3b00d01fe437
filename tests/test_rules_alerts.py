"""Rule presets, the detection run, alert life cycle and streams."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkwatch import schemas, scratch_path
from sparkwatch.operators import alerts as A
from sparkwatch.operators.sequence import sequence_gap
from sparkwatch.plans import reports, rules, validation
from sparkwatch.plans.detection import register_views, run_detections, validate_rules
from sparkwatch.sinks import files, tables
from sparkwatch.sources import tables as source_tables
from sparkwatch.streaming import manage
from sparkwatch.streaming import rules as stream_rules

AS_OF = "2025-11-03 12:00:00"
NOW = datetime(2025, 11, 3, 12)


def as_rows(df):
    return sorted(map(tuple, df.collect()))


def process(spark, *rows):
    full = [(NOW, "H", name, 1, command, "u", "cmd.exe", 2, "h", "x", "sysmon", "process_creation", NOW) for name, command in rows]
    return spark.createDataFrame(full, schemas.SILVER["sysmon_process"])


def okta(spark, rows):
    full = [
        (t, f"e{i}", "x", user, user, ip, "ua", "c", country, outcome, None, None, "n", "okta", "authentication", t)
        for i, (t, user, ip, country, outcome) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.SILVER["okta_auth"])


def brute(spark, n=10):
    return okta(spark, [(NOW - timedelta(minutes=i), "v@x", "9.9.9.9", "X", "FAILURE") for i in range(n)])


def test_injected_samples(spark):
    samples = {
        "detect_mimikatz": (process(spark, ("mimikatz.exe", "mimikatz.exe sekurlsa::logonpasswords")), 1),
        "detect_okta_bruteforce": (brute(spark), 1),
        "detect_suspicious_powershell": (process(spark, ("powershell.exe", "powershell.exe -enc JABz")), 1),
        "detect_psexec": (process(spark, ("a.exe", "nothing")), 1),
    }
    got = {r["rule"]: r["passed"] for r in validate_rules(samples, AS_OF).collect()}
    assert got == {
        "detect_mimikatz": True, "detect_okta_bruteforce": True, "detect_suspicious_powershell": True, "detect_psexec": False,
    }


@pytest.mark.parametrize("n,severity", [(4, None), (5, "MEDIUM"), (6, "MEDIUM"), (7, "HIGH"), (10, "CRITICAL")])
def test_bruteforce_steps(spark, n, severity):
    rows = okta(spark, [(NOW - timedelta(seconds=30 * i), "v@x", "9.9.9.9", "X", "FAILURE") for i in range(n)])
    got = [r["severity"] for r in rules.okta_bruteforce(rows, AS_OF).collect()]
    assert got == ([severity] if severity else [])


@pytest.mark.parametrize("n,severity", [(19, None), (20, "LOW"), (50, "MEDIUM"), (100, "HIGH")])
def test_scan_steps(spark, n, severity):
    rows = [(NOW, "h", "p", 1, "u", f"10.0.0.{i}", 443, "normal", "sysmon", "network_connection", NOW) for i in range(n)]
    got = rules.network_scanning(spark.createDataFrame(rows * 2, schemas.SILVER["sysmon_network"]), AS_OF).collect()
    assert [r["severity"] for r in got] == ([severity] if severity else [])


def test_null_part_keeps_description(spark):
    rows = okta(spark, [(NOW, None, "9.9.9.9", "X", "FAILURE")] * 5)
    assert "for user unknown from" in rules.okta_bruteforce(rows, AS_OF).first()["description"]


def test_external_rdp_and_run_key(spark):
    rows = [
        (NOW, 4624, "h", kind, "n", "u", "d", "w", ip, "0", "c", True, "w", "a", NOW)
        for kind, ip in [(10, "8.8.8.8"), (10, "10.1.1.1"), (10, "192.168.0.1"), (3, "8.8.8.8"), (10, None)]
    ]
    auth = spark.createDataFrame(rows, schemas.SILVER["windows_auth"])
    assert rules.BY_NAME["detect_external_rdp"].hits(auth).count() == 1
    keys = spark.createDataFrame([(r"HKLM\CurrentVersion\RunOnce\a",), (r"HKLM\Other",), (None,)], "registry_path string")
    assert rules.BY_NAME["detect_registry_run_key"].hits(keys).count() == 1


def all_tables(spark):
    return {"sysmon_process": process(spark, ("mimikatz.exe", "x"), ("psexec.exe", "mimikatz lsadump::sam")), "okta_auth": brute(spark)}


QUICK = [r for r in rules.RULES if r.name != "detect_user_clustering"]


def test_run_isolates_missing_tables(spark):
    run = run_detections(all_tables(spark), AS_OF, QUICK)
    assert {"detect_windows_bruteforce", "detect_network_anomaly"} <= set(run.failed)
    assert [f.name for f in run.alerts.schema] == [f.name for f in schemas.ALERTS]
    counts = {r[0]: r[1] for r in run.summary().collect()}
    assert counts["detect_mimikatz"] == 2 and counts["detect_psexec"] == 1 and counts["detect_okta_bruteforce"] == 1
    assert sum(counts.values()) == run.alerts.count()


def test_new_from_gives_the_newer_hits(spark):
    step = timedelta(minutes=20)
    rows = okta(spark, [(NOW - i * step, "v@x", "9", "XY"[i % 2], "SUCCESS") for i in range(12)])
    every = rules.impossible_travel(rows, AS_OF)
    newer = rules.impossible_travel(rows, AS_OF, new_from="2025-11-03 11:00:00")
    assert every.count() == 11 and newer.count() == 4
    assert set(newer.collect()) == set(every.where("current_login_time >= timestamp'2025-11-03 11:00:00'").collect())
    chosen = [rules.BY_NAME["detect_mimikatz"], rules.BY_NAME["detect_impossible_travel"]]
    starts = process(spark, ("mimikatz.exe", "x"))
    both = {"sysmon_process": starts, "okta_auth": rows}
    assert run_detections(both, AS_OF, chosen, "2025-11-03 11:00:00").alerts.count() == 5
    assert run_detections(both, AS_OF, chosen, "2025-11-03 12:00:01").alerts.count() == 0


def test_broken_signature_does_not_stop_the_others(spark):
    bad = rules._rule("sysmon_process", "detect_bad", "Bad", "T0", "X", "LOW", match=lambda: (F.col("no_such"), F.lit("")))
    run = run_detections(all_tables(spark), AS_OF, [bad, rules.BY_NAME["detect_psexec"]])
    assert set(run.failed) == {"detect_bad"} and run.alerts.count() == 1


def test_ids_are_stable_and_append_is_idempotent(spark, root):
    first = run_detections(all_tables(spark), AS_OF, QUICK).alerts
    again = run_detections(all_tables(spark), "2025-11-03 12:05:00", QUICK).alerts
    ids = lambda df, rule: {r["alert_id"] for r in df.where(F.col("detection_rule") == rule).collect()}
    assert ids(first, "detect_mimikatz") == ids(again, "detect_mimikatz")
    tables.append_alerts(first, root)
    n = tables.read_alerts(spark, root).count()
    tables.append_alerts(first, root)
    assert tables.read_alerts(spark, root).count() == n == first.count()


def test_report_prunes_date_partitions(spark, root):
    tables.append_alerts(run_detections(all_tables(spark), AS_OF, QUICK).alerts, root)
    out = reports.hourly_series(tables.read_alerts(spark, root), AS_OF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "detection_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_rules_prune_date_partitions(spark, root):
    days = [(NOW - timedelta(days=d), "v@x", "9", "X", "FAILURE") for d in range(60)]
    tables.write_sorted(okta(spark, days), root)
    stored = spark.read.parquet(root)
    for find in (rules.okta_bruteforce, rules.timeseries_anomaly, rules.user_behavior_anomaly):
        plan = find(stored, AS_OF)._jdf.queryExecution().executedPlan().toString()
        assert all("event_date" in p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:])
    hits = rules.okta_bruteforce(stored, AS_OF, within="10 days", min_count=10)
    assert [r["failure_count"] for r in hits.collect()] == [11]


def test_triage(spark, root):
    base = run_detections(all_tables(spark), AS_OF, QUICK).alerts
    one = base.where(F.col("detection_rule") == "detect_psexec")
    assert A.with_status(base, spark.createDataFrame([], schemas.STATUS_EVENTS)).where("status != 'NEW'").count() == 0
    tables.append_status(A.status_change(one, "INVESTIGATING", "ann", "it's odd", "2025-11-03 13:00:00"), root)
    tables.append_status(A.status_change(one, "FALSE_POSITIVE", at="2025-11-03 14:00:00"), root)
    now = A.with_status(base, tables.read_status(spark, root))
    row = A.triaged(now).first()
    assert (row["status"], row["assigned_to"], row["notes"]) == ("FALSE_POSITIVE", "ann", "it's odd")
    assert now.count() == base.count()
    with pytest.raises(ValueError):
        A.status_change(one, "DONE")


def test_enrichment_scores(spark):
    row = (
        A.enrich(run_detections(all_tables(spark), AS_OF, QUICK).alerts)
        .where(F.col("detection_rule") == "detect_mimikatz")
        .first()
    )
    assert (row["base_risk_score"], row["composite_risk_score"], row["priority"], row["response_time_minutes"]) == (100, 120, "P1 - Immediate", 15)


def test_registry_joins_alerts(spark):
    alerts = run_detections(all_tables(spark), AS_OF, QUICK).alerts
    out = reports.rule_performance(rules.registry(spark, "2025-01-01 00:00:00"), alerts, AS_OF)
    got = {r["rule_name"]: r["total_alerts"] for r in out.collect()}
    assert got["Mimikatz Execution"] == 2 and got["Windows Brute Force"] == 0 and len(got) == len(rules.RULES)


def test_validation_table(spark):
    alerts = run_detections(all_tables(spark), AS_OF, QUICK).alerts.where(F.col("mitre_tactic") != "Execution")
    checks = validation.validate(spark, all_tables(spark), alerts, rules.registry(spark))
    failed = {(r["check"], r["subject"]) for r in checks.where(~F.col("passed")).collect()}
    assert failed == {("expected tactics covered", "security_alerts")}
    assert validation.missing_columns(alerts.drop("notes")) == ["notes"]
    assert validation.score(checks).first()["failed"] == 1


def test_exports(spark, root):
    alerts = run_detections(all_tables(spark), AS_OF, QUICK).alerts
    nested = alerts.select("alert_id", F.array("severity").alias("levels"))
    files.write_csv(nested, f"{root}/csv")
    assert spark.read.option("header", True).csv(f"{root}/csv").columns == ["alert_id", "levels"]
    files.write_json(A.export_rows(alerts, AS_OF), f"{root}/json")
    assert spark.read.json(f"{root}/json").count() == alerts.count()
    tables.write_sorted(alerts, f"{root}/sorted")
    assert spark.read.parquet(f"{root}/sorted").count() == alerts.count()


def test_managed_table(spark):
    tables.save_table(spark.range(3), "watch_numbers")
    tables.save_table(spark.range(2), "watch_numbers", "append")
    assert spark.table("watch_numbers").count() == 5
    spark.sql("DROP TABLE watch_numbers")


def test_top_entities_rank_severity(spark):
    alerts = run_detections(all_tables(spark), AS_OF, QUICK).alerts
    row = reports.top_entities(alerts, "user", AS_OF).where("user = 'u'").first()
    assert row["max_severity"] == "CRITICAL"


def stream_of(spark, root, batches):
    """Files that arrive in the given order, one per micro-batch."""
    for i, rows in enumerate(batches):
        okta(spark, rows).coalesce(1).write.parquet(f"{root}/in/{i}")
    return (
        spark.readStream.schema(schemas.SILVER["okta_auth"])
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .parquet(f"{root}/in")
    )


def test_stream_sequence_keeps_state_between_batches(spark, root):
    at = lambda s: NOW + timedelta(seconds=s)
    batches = [
        [(at(0), "a", "1", "X", "SUCCESS"), (at(0), "b", "1", "X", "SUCCESS")],
        [(at(3600), "a", "2", "Y", "SUCCESS"), (at(3601), "b", "2", "Y", "SUCCESS")],
        [(at(3700), "a", "3", "Y", "SUCCESS"), (at(3800), "a", "4", "Z", "SUCCESS")],
    ]
    stream = stream_of(spark, root, batches)
    sequence = travel_stream(root)
    sequence.start(stream, f"{root}/cp", available_now=True).awaitTermination()
    sequence.flush(spark)
    got = {(r["user_email"], r["previous_country"], r["country"], r["gap_seconds"]) for r in sequence.hits(spark).collect()}
    assert got == {("a", "X", "Y", 3600), ("a", "Y", "Z", 100)}


def test_append_reads_only_the_days_of_its_events(spark, root):
    alerts = run_detections(all_tables(spark), AS_OF, QUICK).alerts
    tables.append_alerts(alerts, f"{root}/alerts")
    n = tables.read_alerts(spark, f"{root}/alerts").count()
    tables.append_alerts(alerts, f"{root}/alerts")
    assert tables.read_alerts(spark, f"{root}/alerts").count() == n > 0
    day = NOW.date()
    plan = tables.stored_between(tables.read_alerts(spark, f"{root}/alerts"), day, day)
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in shown and "event_date" in shown.split("PartitionFilters: [")[1].split("]")[0]


def test_clustering_without_rows_gives_no_hits(spark):
    assert rules.user_clustering(okta(spark, []), AS_OF).collect() == []


def travel_stream(root, late_seconds=86_400):
    return stream_rules.SequenceStream(
        "user_email", "event_time", changed="country", max_gap_seconds=3600, tiebreak=("event_id",),
        carry=("city", "source_ip"), out=f"{root}/out", state=f"{root}/state", late_seconds=late_seconds,
    )


@pytest.mark.parametrize("late_seconds", [7200, 86_400])
def test_late_rows_give_the_hits_of_a_batch_run(spark, root, late_seconds):
    r = random.Random(9)
    rows = [(NOW + timedelta(seconds=90 * i), r.choice("ab"), str(i), r.choice("XYZ"), "SUCCESS") for i in range(200)]
    late = [(i + r.randrange(60), row) for i, row in enumerate(rows)]  # up to 90 minutes
    ordered = [row for _, row in sorted(late, key=lambda x: x[0])]
    stream = stream_of(spark, root, [ordered[i : i + 25] for i in range(0, 200, 25)])
    sequence = travel_stream(root, late_seconds)
    sequence.start(stream, f"{root}/cp", available_now=True).awaitTermination()
    sequence.flush(spark)
    want = sequence_gap(
        okta(spark, rows), "user_email", "event_time", changed="country", max_gap_seconds=3600,
        tiebreak=["event_id"], carry=["city", "source_ip"],
    )
    cols = ["user_email", "event_time", "previous_event_time", "country", "previous_country", "gap_seconds"]
    assert as_rows(sequence.hits(spark).select(*cols)) == as_rows(want.select(*cols)) != []


def test_distinct_counts_on_a_stream_are_exact(spark, root):
    at = lambda s: NOW + timedelta(seconds=s)
    rows = [(at(i % 59), "h", "p", 1, "u", f"10.0.{i % 20}.1", i % 3, "normal", "sysmon", "network_connection", NOW) for i in range(500)]
    rows += [(at(i), "h2", "p", 1, "u", f"10.0.{i % 19}.1", 1, "normal", "sysmon", "network_connection", NOW) for i in range(50)]
    rows.append((NOW + timedelta(days=1), "z", "p", 1, "u", "1.1.1.1", 443, "normal", "sysmon", "network_connection", NOW))
    schema = schemas.SILVER["sysmon_network"]
    batch = spark.createDataFrame(rows, schema)
    batch.repartition(5).write.parquet(f"{root}/in")
    hits = rules.network_scanning(spark.readStream.schema(schema).parquet(f"{root}/in"), mode="sliding", watermark="1 minute")
    manage.write_stream(hits, "scan", f"{root}/out", f"{root}/cp", "parquet", available_now=True).awaitTermination()
    cols = ["host", "unique_destinations", "total_connections", "ports_accessed", "first_connection", "last_connection"]
    want = rules.network_scanning(batch, mode="sliding").select(*cols)
    assert as_rows(spark.read.parquet(f"{root}/out").select(*cols)) == as_rows(want) != []


def test_counts_of_more_batches_than_a_query_keeps(spark, root):
    from sparkwatch.operators.quality import expect

    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        stream = stream_of(spark, root, [[(NOW, "a", str(i), None if i % 2 else "X", "SUCCESS")] for i in range(6)])
        checked, name = expect(stream, {"has_country": "country IS NOT NULL"}, name="checked")
        with manage.ObservedTotals(spark) as totals:
            q = manage.write_stream(checked, "counted", f"{root}/out", f"{root}/cp", "parquet", available_now=True)
            q.awaitTermination()
            assert totals.of(q, name) == {"total_rows": 6, "failed_has_country": 3}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


@pytest.mark.parametrize("folder", [False, True])
def test_table_streams_read_files_and_folders(spark, root, folder):
    df = spark.range(1000)
    if folder:
        df.repartition(3).write.parquet(f"{root}/t.parquet")
        path = f"{root}/t.parquet"
    else:
        df.coalesce(1).write.parquet(f"{root}/one")
        inner = spark.read.parquet(f"{root}/one").select("_metadata.file_path").first()[0]
        path = inner.replace("file:///", "/")
    stream = source_tables.table_stream(spark, path, df.schema)
    manage.write_stream(stream, "t", f"{root}/out", f"{root}/cp", "parquet", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == 1000


def test_threshold_rules_on_streams_equal_batch(spark, root):
    rows = [(NOW + timedelta(seconds=20 * i), "a@x", "1", "X", "FAILURE") for i in range(40)]
    rows += [(NOW + timedelta(seconds=20 * i), "b@x", "1", "X", "FAILURE") for i in range(3)]
    end = [(NOW + timedelta(days=2), "z@x", "1", "X", "FAILURE")]
    how = dict(mode="sliding", slide="5 minutes", steps=((20, "CRITICAL"), (7, "HIGH")))
    batch = rules.okta_bruteforce(okta(spark, rows + end), **how)
    hits = rules.okta_bruteforce(stream_of(spark, root, [rows, end]), watermark="10 minutes", **how)
    q = manage.write_stream(hits, "brute", f"{root}/out", f"{root}/cp", "parquet", available_now=True)
    q.awaitTermination()
    cols = ["user_email", "failure_count", "first_failure", "window_start", "severity", "description"]
    assert as_rows(spark.read.parquet(f"{root}/out").select(*cols)) == as_rows(batch.select(*cols)) != []


def test_scan_rule_on_a_stream(spark, root):
    at = lambda s: NOW + timedelta(seconds=s)
    rows = [(at(i), "h", "p", 1, "u", f"10.0.0.{i}", 443, "normal", "sysmon", "network_connection", NOW) for i in range(30)]
    rows.append((NOW + timedelta(days=1), "z", "p", 1, "u", "1.1.1.1", 443, "normal", "sysmon", "network_connection", NOW))
    schema = schemas.SILVER["sysmon_network"]
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/in")
    hits = rules.network_scanning(spark.readStream.schema(schema).parquet(f"{root}/in"), mode="sliding", watermark="1 minute")
    manage.write_stream(hits, "scan", f"{root}/out", f"{root}/cp", "parquet", available_now=True).awaitTermination()
    got = spark.read.parquet(f"{root}/out").collect()
    assert [(r["host"], r["severity"], r["ports_accessed"]) for r in got] == [("h", "LOW", [443])]


def test_stream_management(spark, root):
    spark.range(5).write.json(f"{root}/in")
    schema = schemas.flat("id long")
    ok = manage.StreamSpec("ok", lambda s: s.readStream.schema(schema).json(f"{root}/in"), lambda d: d, f"{root}/out", f"{root}/cp")
    bad = manage.StreamSpec("bad", lambda s: s.readStream.json(f"{root}/none"), lambda d: d, f"{root}/o2", f"{root}/c2")
    started, failed = manage.start_streams(spark, [ok, bad])
    assert set(started) == {"ok"} and set(failed) == {"bad"}
    started["ok"].processAllAvailable()
    assert [r["name"] for r in manage.stream_status(spark).collect()] == ["ok"]
    assert manage.stop_streams(spark) == ["ok"]
    assert spark.read.json(f"{root}/out").count() == 5


def test_notifier_sends_critical_alerts(spark, root):
    run_detections(all_tables(spark), AS_OF, QUICK).alerts.write.parquet(f"{root}/in")
    sent = []
    q = stream_rules.start_notifier(
        spark.readStream.schema(schemas.ALERTS).parquet(f"{root}/in"),
        lambda batch, n: sent.extend(r["payload"] for r in batch.collect()), f"{root}/cp", available_now=True,
    )
    q.awaitTermination()
    assert len(sent) == 3 and all('"color":"danger"' in p for p in sent)


def test_rule_views(spark):
    names = register_views(all_tables(spark), AS_OF, QUICK)
    assert spark.table("detect_psexec").count() == 1 and "detect_mimikatz" in names
    assert spark.sql("SELECT max(failure_count) FROM detect_okta_bruteforce").first()[0] == 10


def test_duplicate_alerts_on_a_stream(spark, root):
    alerts = run_detections(all_tables(spark), AS_OF, QUICK).alerts
    alerts.unionByName(alerts).write.parquet(f"{root}/in")
    stream = stream_rules.dedupe_alerts(spark.readStream.schema(schemas.ALERTS).parquet(f"{root}/in"))
    q = manage.write_stream(stream, "dedupe", f"{root}/out", f"{root}/cp", "parquet", available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == alerts.count()


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d: d)})()

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")
