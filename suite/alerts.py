"""Alert table, enrichment, triage and export queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkwatch import schemas
from sparkwatch.operators import alerts as A
from sparkwatch.plans.detection import register_views, run_detections, validate_rules
from sparkwatch.plans.rules import BY_NAME, RULES, with_params
from sparkwatch.session import scratch_path, written_table
from sparkwatch.sinks.files import write_csv, write_json
from sparkwatch.sinks.incidents import IncidentStore, chains_of
from sparkwatch.sinks.tables import (
    append_alerts,
    append_status,
    read_alerts,
    read_status,
    save_table,
    write_sorted,
)
from suite import detection as D
from suite import telemetry as T
from suite.telemetry import EVENTS_AS_OF as E
from suite.telemetry import load, plain, shown, sql

SIGNATURES = ("detect_mimikatz", "detect_suspicious_powershell", "detect_psexec", "detect_external_rdp")


def found(spark, sf):
    """Alerts of the signature rules, as the run yields them."""
    tables = {"sysmon_process": T.process(spark, sf), "windows_auth": T.windows(spark, sf)}
    return run_detections(tables, E, [BY_NAME[n] for n in SIGNATURES]).alerts


def _delay(t):
    return (F.minute(t) * 60 + F.second(t)) * 30 % 100000


def triaged_alerts(spark, sf):
    """The same alerts some time later: detected with delay, statuses set."""
    t = F.col("event_time")
    at = t + F.make_dt_interval(secs=_delay(t))
    return found(spark, sf).withColumns(
        {
            "detection_time": at,
            "updated_at": at,
            "status": T.pick(F.second(t) % 5, *schemas.STATUSES),
            "assigned_to": T.pick(F.minute(t) % 3, None, "analyst1", "analyst2").cast("string"),
        }
    )


def _alert_sql(rule, title, technique, tactic, severity, text, table, where, entity, context, identity):
    user, host, ip = entity
    parts = ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '-')" for c in (user, host, ip, shown("event_time"), *identity)
    )
    ctx = ", ".join(f"'{c}': {c}" for c in context)
    return f"""
  SELECT sha256(concat_ws('|', '{rule}', {parts})) AS alert_id, event_time, '{title}' AS alert_title,
    {text} AS description, '{severity}' AS severity, '{technique}' AS mitre_technique,
    '{tactic}' AS mitre_tactic, '{rule}' AS detection_rule, {user} AS "user", {host} AS host,
    {ip} AS source_ip, CAST(to_json({{{ctx}}}) AS VARCHAR) AS context
  FROM {table} WHERE {where}"""


_P = ('"user"', "host", "CAST(NULL AS VARCHAR)")
_ID = ("process_name", "command_line")
FOUND = "found AS (" + " UNION ALL ".join(
    [
        _alert_sql(
            "detect_mimikatz", "Mimikatz Credential Dumping Detected", "T1003.001", "Credential Access",
            "CRITICAL", D.MIMIKATZ_TEXT, "process", D.MIMIKATZ_WHERE, _P,
            ("process_name", "command_line", "parent_process_name", "file_hash_sha256"), _ID,
        ),
        _alert_sql(
            "detect_suspicious_powershell", "Suspicious PowerShell Execution", "T1059.001", "Execution",
            "HIGH", D.POWERSHELL_TEXT, "process", D.POWERSHELL_WHERE, _P,
            ("process_name", "command_line", "parent_process_name"), _ID,
        ),
        _alert_sql(
            "detect_psexec", "PsExec Lateral Movement Detected", "T1570", "Lateral Movement", "HIGH",
            D.PSEXEC_TEXT, "process", D.PSEXEC_WHERE, _P, ("process_name", "command_line"), _ID,
        ),
        _alert_sql(
            "detect_external_rdp", "Remote Desktop Logon From External Address", "T1021.001",
            "Lateral Movement", "MEDIUM", D.RDP_TEXT, "windows", D.RDP_WHERE,
            ("user_name", "host", "source_ip"), ("logon_type", "workstation", "domain"), (),
        ),
    ]
) + ")"

_DELAYED = "event_time + to_seconds((minute(event_time) * 60 + second(event_time)) * 30 % 100000)"
ALERTS = f"""{FOUND},
alerts AS (SELECT *, {_DELAYED} AS detection_time, {_DELAYED} AS updated_at,
  (['NEW', 'INVESTIGATING', 'FALSE_POSITIVE', 'TRUE_POSITIVE', 'RESOLVED'])[second(event_time) % 5 + 1] AS status,
  ([NULL, 'analyst1', 'analyst2'])[minute(event_time) % 3 + 1] AS assigned_to, CAST(NULL AS VARCHAR) AS notes
  FROM found)"""


def over_found(select):
    return sql(select, "process", "windows", extra=FOUND)


def over_alerts(select):
    return sql(select, "process", "windows", extra=ALERTS)


_FOUND_COLS = (
    f"alert_id, {shown('event_time')} AS event_time, alert_title, description, severity, mitre_technique, "
    'mitre_tactic, detection_rule, "user", host, source_ip'
)


def alerts_union(spark, sf):
    return plain(found(spark, sf).drop("detection_time", "updated_at", "assigned_to", "notes"))


def alerts_from_thresholds(spark, sf):
    tables = {"okta_auth": T.okta(spark, sf), "windows_auth": T.windows(spark, sf)}
    steps = ((4, "CRITICAL"), (3, "HIGH"))
    chosen = [
        with_params(BY_NAME["detect_okta_bruteforce"], within="7 days", min_count=2, steps=steps),
        with_params(BY_NAME["detect_windows_bruteforce"], within="30 days", min_count=2, steps=steps),
    ]
    run = run_detections(tables, E, chosen)
    return plain(
        run.alerts.groupBy("detection_rule", "severity", "mitre_tactic").agg(
            F.count("*").alias("alert_count"), F.min("event_time").alias("first_event"),
            F.count_distinct("alert_id").alias("ids"),
        )
    )


_GROUPED = """SELECT '{rule}' AS detection_rule, CASE WHEN n >= 4 THEN 'CRITICAL' WHEN n >= 3 THEN 'HIGH'
    ELSE 'MEDIUM' END AS severity, t FROM (SELECT count(*) AS n, min(event_time) AS t FROM {source}
    AND event_time >= TIMESTAMP '{e}' - INTERVAL {days} DAY AND event_time <= TIMESTAMP '{e}'
    GROUP BY {keys} HAVING count(*) >= 2)"""
FROM_THRESHOLDS = sql(
    f"""SELECT detection_rule, severity, 'Credential Access' AS mitre_tactic, count(*) AS alert_count,
  {shown('min(t)')} AS first_event, count(*) AS ids FROM (
  {_GROUPED.format(rule='detect_okta_bruteforce', source="okta WHERE outcome = 'FAILURE'", e=E, days=7,
                   keys='user_email, source_ip')} UNION ALL
  {_GROUPED.format(rule='detect_windows_bruteforce', source="windows WHERE NOT logon_success", e=E, days=30,
                   keys='user_name, host, source_ip')})
GROUP BY detection_rule, severity""",
    "okta",
    "windows",
)


def enriched(spark, sf):
    out = A.enrich(triaged_alerts(spark, sf))
    return plain(
        out.select(
            "alert_id", "severity", "mitre_tactic", "base_risk_score", "composite_risk_score", "priority",
            "response_time_minutes",
        )
    )


ENRICHED = over_alerts("""SELECT alert_id, severity, mitre_tactic, s AS base_risk_score,
  s + CASE mitre_tactic WHEN 'Credential Access' THEN 20 WHEN 'Privilege Escalation' THEN 15
    WHEN 'Lateral Movement' THEN 15 ELSE 0 END AS composite_risk_score,
  CASE severity WHEN 'CRITICAL' THEN 'P1 - Immediate' WHEN 'HIGH' THEN 'P2 - Urgent'
    WHEN 'MEDIUM' THEN 'P3 - Normal' ELSE 'P4 - Low' END AS priority,
  CASE severity WHEN 'CRITICAL' THEN 15 WHEN 'HIGH' THEN 60 WHEN 'MEDIUM' THEN 240 ELSE 1440 END
    AS response_time_minutes
FROM (SELECT *, CASE severity WHEN 'CRITICAL' THEN 100 WHEN 'HIGH' THEN 75 WHEN 'MEDIUM' THEN 50
  WHEN 'LOW' THEN 25 ELSE 0 END AS s FROM alerts) WHERE status = 'NEW'""")


def latest_status(spark, sf):
    log = load(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("alert_id"),
        F.upper("role").alias("status"),
        F.when(F.col("role") == "user", F.col("role")).alias("assigned_to"),
        F.when(F.col("turn") % 2 == 0, F.col("text")).alias("notes"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("turn").cast("int"))).alias(
            "updated_at"
        ),
    )
    return plain(A.latest_status(log))


_CONV = "{'turn': turn, 'v': #}"
LATEST_STATUS = f"""SELECT CAST(conv_id AS VARCHAR) AS alert_id,
  (max({_CONV.replace('#', 'upper(role)')})).v AS status,
  (max({_CONV.replace('#', 'role')}) FILTER (role = 'user')).v AS assigned_to,
  (max({_CONV.replace('#', 'text')}) FILTER (turn % 2 = 0)).v AS notes,
  {shown("TIMESTAMP '2024-01-01 00:00:00' + to_minutes(max(turn))")} AS updated_at
FROM conversations GROUP BY conv_id"""


def _triage(base):
    """Two entries of the triage log: a first look, and later a close of some of those."""
    second = F.second("event_time")
    first_entry = A.status_change(base.where(second >= 20), "INVESTIGATING", "analyst1", "first look", "2024-02-01 08:00:00")
    closed = A.status_change(base.where(second >= 40), "FALSE_POSITIVE", None, "it's expected", "2024-02-01 09:00:00")
    return first_entry, closed


_STATUS_COLS = ("alert_id", "status", "assigned_to", "notes", "updated_at")


def with_status(spark, sf):
    base = found(spark, sf)
    first_entry, closed = _triage(base)
    return plain(A.with_status(base, first_entry.unionByName(closed)).select(*_STATUS_COLS))


def with_stored_status(spark, sf):
    """The same triage history, appended to a stored log in two steps and read back."""
    base = written_table(found(spark, sf), "alerts")
    path = scratch_path(spark, "status")
    for entries in _triage(base):
        append_status(entries, path)
    return plain(A.with_status(base, read_status(spark, path)).select(*_STATUS_COLS))


def validated_rules(spark, sf):
    """Rules on the telemetry with injected rows of an attack; the rows of one kind are missing."""
    process = T.process(spark, sf)
    one = process.limit(1)
    tool = one.withColumns({"process_name": F.lit("mimikatz.exe"), "command_line": F.lit("mimikatz.exe sekurlsa::logonpasswords")})
    quiet = process.where("process_name LIKE 'tool%'")
    samples = {
        "detect_mimikatz": (A.consolidate([quiet, tool]), 1),
        "detect_psexec": (quiet, 1),
        "detect_suspicious_powershell": (process, 1),
    }
    return validate_rules(samples, E).select("rule", "expected", "found", "passed")


VALIDATED_RULES = sql(
    """SELECT 'detect_mimikatz' AS rule, 1 AS expected, 1 AS found, true AS passed
UNION ALL SELECT 'detect_psexec', 1, 0, false
UNION ALL SELECT 'detect_suspicious_powershell', 1, count(*), count(*) >= 1 FROM found
  WHERE detection_rule = 'detect_suspicious_powershell'""",
    "process", "windows", extra=FOUND,
)


def rule_views(spark, sf):
    """A temporary view of the hits of each rule, read through SQL."""
    register_views({"sysmon_process": T.process(spark, sf)}, E, [BY_NAME[n] for n in SIGNATURES[:3]])
    return spark.sql(
        " UNION ALL ".join(f"SELECT '{n}' AS detection_rule, count(*) AS hits FROM {n}" for n in SIGNATURES[:3])
    )


RULE_VIEWS = over_found(" UNION ALL ".join(
    f"SELECT '{n}' AS detection_rule, count(*) AS hits FROM found WHERE detection_rule = '{n}'" for n in SIGNATURES[:3]
))


def stored_tables(spark, sf):
    """The same events as partitioned JSON appended twice, as a managed table and sorted by time."""
    rows = load(spark, sf, "events").select("event_id", "event_type", F.col("ts").alias("event_time"))
    path = scratch_path(spark, "stored")
    for _ in range(2):
        write_json(rows, f"{path}/json", "append", ("event_type",))
    managed = f"watch_events_{uuid.uuid4().hex}"  # a name that no table of the user has
    save_table(rows, managed, partition_by=("event_type",))
    write_sorted(rows, f"{path}/sorted")
    back = {
        "json": spark.read.schema("event_id long, event_type string").json(f"{path}/json"),
        "managed": spark.table(managed),
        "sorted": spark.read.parquet(f"{path}/sorted"),
    }
    return A.consolidate([
        df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).withColumn("place", F.lit(name))
        for name, df in back.items()
    ])


STORED_TABLES = """SELECT event_type, count(*) * f AS n, CAST(sum(event_id) * f AS BIGINT) AS ids, place
FROM events, (VALUES ('json', 2), ('managed', 1), ('sorted', 1)) AS p(place, f) GROUP BY event_type, place, f"""


WITH_STATUS = over_found(f"""SELECT alert_id,
  CASE WHEN x >= 40 THEN 'FALSE_POSITIVE' WHEN x >= 20 THEN 'INVESTIGATING' ELSE 'NEW' END AS status,
  CASE WHEN x >= 20 THEN 'analyst1' END AS assigned_to,
  CASE WHEN x >= 40 THEN 'it''s expected' WHEN x >= 20 THEN 'first look' END AS notes,
  {shown(f"CASE WHEN x >= 40 THEN TIMESTAMP '2024-02-01 09:00:00' WHEN x >= 20 THEN TIMESTAMP '2024-02-01 08:00:00' ELSE TIMESTAMP '{E}' END")}
    AS updated_at
FROM (SELECT *, second(event_time) AS x FROM found)""")


def notify(spark, sf):
    return A.notification_payload(A.to_notify(triaged_alerts(spark, sf), 20))


NOTIFY = over_alerts("""SELECT alert_id, CAST(to_json({'text': 'Security Alert: ' || alert_title, 'attachments': [
  {'color': CASE WHEN severity IN ('CRITICAL', 'HIGH') THEN 'danger' ELSE 'warning' END, 'fields': [
    {'title': 'Severity', 'value': severity, 'short': true},
    {'title': 'User', 'value': coalesce("user", 'N/A'), 'short': true},
    {'title': 'Host', 'value': coalesce(host, 'N/A'), 'short': true},
    {'title': 'MITRE Technique', 'value': mitre_technique, 'short': true},
    {'title': 'Description', 'value': description, 'short': false}]}]}) AS VARCHAR) AS payload
FROM alerts WHERE severity = 'CRITICAL' AND status = 'NEW'
ORDER BY detection_time DESC, event_time DESC, alert_id LIMIT 20""")


def export(kind):
    def run(spark, sf):
        rows = A.export_rows(triaged_alerts(spark, sf), E, "10 days")
        path = scratch_path(spark, f"export-{kind}")
        if kind == "json":
            write_json(rows, path)
            back = spark.read.schema(rows.schema).json(path)
        else:
            write_csv(rows, path)
            back = spark.read.schema(rows.schema).options(header=True, escape='"').csv(path)
        return plain(back)

    return run


EXPORT = over_alerts(f"""SELECT {_FOUND_COLS}, {shown('detection_time')} AS detection_time, status FROM alerts
WHERE detection_time >= TIMESTAMP '{E}' - INTERVAL 10 DAY AND detection_time <= TIMESTAMP '{E}'""")


def stored_twice(spark, sf):
    """The same run appended two times leaves each alert once. Its alerts are found once and written."""
    rows = written_table(triaged_alerts(spark, sf), "run")
    path = scratch_path(spark, "alerts")
    append_alerts(rows, path)
    append_alerts(rows, path)
    return plain(
        read_alerts(spark, path)
        .groupBy("detection_date", "detection_rule")
        .agg(F.count("*").alias("alert_count"), F.count_distinct("alert_id").alias("ids"))
    )


STORED_TWICE = over_alerts("""SELECT CAST(CAST(detection_time AS DATE) AS VARCHAR) AS detection_date, detection_rule,
  count(*) AS alert_count, count(*) AS ids FROM (SELECT DISTINCT alert_id, detection_time, detection_rule FROM alerts)
GROUP BY ALL""")


RUNS = ("2024-01-28 23:30:00", "2024-01-29 23:30:00", E)
_MOVING = (("detect_okta_bruteforce", "7 days"), ("detect_windows_bruteforce", "30 days"))


def _recorded(spark, sf, runs=RUNS):
    """Two threshold rules and a baseline rule, run several times into a store of incidents."""
    tables = {"okta_auth": T.okta(spark, sf), "windows_auth": T.windows(spark, sf)}
    store = IncidentStore(scratch_path(spark, "incidents"), chains_of(RULES))
    chosen = [with_params(BY_NAME[n], within=span, min_count=2) for n, span in _MOVING]
    chosen.append(BY_NAME["detect_user_behavior_anomaly"])
    for at in runs:
        store.record(run_detections(tables, at, chosen).alerts)
    return store


def repeated_runs(spark, sf):
    """Rules over a moving span, run three times: an incident is one alert, however often it is found."""
    return (
        _recorded(spark, sf)
        .incidents(spark)
        .groupBy("detection_rule")
        .agg(F.count("*").alias("alert_count"), F.count_distinct("alert_id").alias("ids"))
    )


_SPANS = ("detection_rule", "user", "host", "source_ip", "first_event", "last_event", "severity")


def incident_spans(spark, sf):
    """The incidents of three runs with their whole span and their highest severity."""
    return plain(_recorded(spark, sf).incidents(spark).select(*_SPANS))


def _steps(n, critical, high):
    return f"CASE WHEN {n} >= {critical} THEN 'CRITICAL' WHEN {n} >= {high} THEN 'HIGH' ELSE 'MEDIUM' END"


def _span_hits(rule, source, entity, days, steps):
    """Hits of a threshold rule in all runs; contexts hold last events in milliseconds."""
    user, host, ip = entity
    keys = ", ".join(c for c in entity if c != "NULL")
    return " UNION ALL ".join(
        f"""SELECT '{rule}' AS detection_rule, {user} AS "user", CAST({host} AS VARCHAR) AS host, {ip} AS source_ip,
  min(event_time) AS f, greatest(min(event_time), date_trunc('milliseconds', max(event_time))) AS l,
  {_steps('count(*)', *steps)} AS severity, INTERVAL 1 HOUR AS gap
  FROM {source} AND event_time >= TIMESTAMP '{at}' - INTERVAL {days} DAY AND event_time <= TIMESTAMP '{at}'
  GROUP BY {keys} HAVING count(*) >= 2"""
        for at in RUNS
    )


_BASELINE_HITS = " UNION ALL ".join(
    f"""SELECT 'detect_user_behavior_anomaly', user_email, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
  CAST(event_time AS TIMESTAMP), CAST(event_time AS TIMESTAMP), severity, INTERVAL 1 DAY
  FROM ({D.BEHAVIOR.replace(E, at)})"""
    for at in RUNS
)
#: Gaps and islands over the hits of all runs: an incident ends where the next hit of its entity is further away.
_ISLANDS = f"""hits AS (
  {_span_hits('detect_okta_bruteforce', "okta WHERE outcome = 'FAILURE'", ('user_email', 'NULL', 'source_ip'), 7, (10, 7))}
  UNION ALL
  {_span_hits('detect_windows_bruteforce', "windows WHERE NOT logon_success", ('user_name', 'host', 'source_ip'), 30, (20, 15))}
  UNION ALL {_BASELINE_HITS}),
reached AS (SELECT *, max(l + gap) OVER (PARTITION BY detection_rule, "user", host, source_ip ORDER BY f, l
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM hits),
parts AS (SELECT *, sum(CASE WHEN f > r THEN 1 ELSE 0 END) OVER (PARTITION BY detection_rule, "user", host, source_ip
  ORDER BY f, l ROWS UNBOUNDED PRECEDING) AS part FROM reached),
incidents AS (SELECT detection_rule, "user", host, source_ip, part, min(f) AS first_event, max(l) AS last_event,
  arg_min(severity, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END) AS severity
  FROM parts GROUP BY ALL)"""

REPEATED_RUNS = sql(
    "SELECT detection_rule, count(*) AS alert_count, count(*) AS ids FROM incidents GROUP BY detection_rule",
    "okta", "windows", extra=_ISLANDS,
)
INCIDENT_SPANS = sql(
    f"""SELECT detection_rule, "user", host, source_ip, {shown('first_event')} AS first_event,
  {shown('last_event')} AS last_event, severity FROM incidents""",
    "okta", "windows", extra=_ISLANDS,
)


def unseen(spark, sf):
    rows = found(spark, sf)
    out = A.unseen(rows, rows.where(F.minute("event_time") < 30))
    return plain(out.select("alert_id", "detection_rule", "event_time"))


UNSEEN = over_found(f"""SELECT DISTINCT alert_id, detection_rule, {shown('event_time')} AS event_time FROM found
WHERE minute(event_time) >= 30""")


QUERIES = {
    "alerts_union": (
        alerts_union,
        over_found(f"SELECT {_FOUND_COLS}, context, 'NEW' AS status FROM found"),
    ),
    "alerts_from_thresholds": (alerts_from_thresholds, FROM_THRESHOLDS),
    "alerts_enriched": (enriched, ENRICHED),
    "alerts_latest_status": (latest_status, LATEST_STATUS),
    "alerts_with_status": (with_status, WITH_STATUS),
    "alerts_notification": (notify, NOTIFY),
    "alerts_export_json": (export("json"), EXPORT),
    "alerts_export_csv": (export("csv"), EXPORT),
    "alerts_stored_twice": (stored_twice, STORED_TWICE),
    "alerts_unseen": (unseen, UNSEEN),
    "alerts_repeated_runs": (repeated_runs, REPEATED_RUNS),
    "incident_spans": (incident_spans, INCIDENT_SPANS),
    "alerts_stored_status": (with_stored_status, WITH_STATUS),
    "rules_validated_on_samples": (validated_rules, VALIDATED_RULES),
    "rule_views": (rule_views, RULE_VIEWS),
    "stored_tables": (stored_tables, STORED_TABLES),
}
