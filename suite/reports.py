"""Reports over alerts and event tables."""

from __future__ import annotations

from sparkwatch.operators import silver
from sparkwatch.plans import reports as R
from sparkwatch.plans import rules, validation
from suite import telemetry as T
from suite.alerts import over_alerts, triaged_alerts
from suite.telemetry import EVENTS_AS_OF as E
from suite.telemetry import LINES_AS_OF, ORDERS_AS_OF, plain, shown, sql, unix


def over(report, *args, as_of=None, **kw):
    """A report over the triaged alerts."""

    def run(spark, sf):
        more = {"as_of": as_of, **kw} if as_of else kw
        return plain(report(triaged_alerts(spark, sf), *args, **more))

    return run


def since(days):
    return f"detection_time >= TIMESTAMP '{E}' - INTERVAL {days} DAY AND detection_time <= TIMESTAMP '{E}'"


def cnt(cond):
    return f"count(*) FILTER ({cond})"


_TP, _FP = cnt("status = 'TRUE_POSITIVE'"), cnt("status = 'FALSE_POSITIVE'")
_RATE = f"round({_TP} * 100.0 / nullif({_TP} + {_FP}, 0), 2)"
_WORST = """CASE min(CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3
  WHEN 'LOW' THEN 4 END) WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' WHEN 4 THEN 'LOW' END"""
_USERS = 'count(DISTINCT "user") AS affected_users, count(DISTINCT host) AS affected_hosts'
_LEVELS = ", ".join(f"{cnt(f'severity = {s!r}')} AS {s.lower()}" for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW"))
_MIN = f"(({unix('detection_time')} - {unix('event_time')}) / 60)"


def top(entity):
    second = (
        "count(DISTINCT detection_rule) AS unique_detections"
        if entity == "user"
        else 'count(DISTINCT "user") AS unique_users'
    )
    return over_alerts(
        f"""SELECT "{entity}", count(*) AS alert_count, {_WORST} AS max_severity, {second},
  {shown('max(detection_time)')} AS last_alert FROM alerts WHERE {since(7)} AND "{entity}" IS NOT NULL
GROUP BY "{entity}" ORDER BY alert_count DESC, "{entity}" LIMIT 10"""
    )


def performance(spark, sf):
    rows = rules.registry(spark, "2024-01-01 00:00:00")
    return plain(R.rule_performance(rows, triaged_alerts(spark, sf), E))


_REGISTRY = ", ".join(
    f"('{r.name}', '{r.rule_name or r.alert.title}', '{r.version}', true, "
    f"{'NULL' if r.expected_fpr is None else r.expected_fpr})"
    for r in rules.RULES
)
PERFORMANCE = over_alerts(
    f"""SELECT rule_name, rule_version, enabled, coalesce(n, 0) AS total_alerts, coalesce(tp, 0) AS true_positives,
  coalesce(fp, 0) AS false_positives, round(tp * 100.0 / nullif(tp + fp, 0), 2) AS true_positive_rate,
  CAST(fpr AS DOUBLE) AS expected_fpr, {shown('last_triggered')} AS last_triggered
FROM (VALUES {_REGISTRY}) r(rule, rule_name, rule_version, enabled, fpr)
LEFT JOIN (SELECT detection_rule, count(*) AS n, {_TP} AS tp, {_FP} AS fp, max(detection_time) AS last_triggered
  FROM alerts WHERE {since(30)} GROUP BY detection_rule) ON rule = detection_rule"""
)


def _silver(table, report, as_of, **kw):
    return lambda spark, sf: plain(report(table(spark, sf), as_of, **kw))


def common(spark, sf):
    return silver.common_events(
        {
            "sysmon_process": T.process(spark, sf),
            "okta_auth": T.okta(spark, sf),
            "windows_auth": T.windows(spark, sf),
            "cloudtrail": T.cloud(spark, sf),
            "sysmon_network": T.network(spark, sf),
        }
    )


COMMON = """
common AS (SELECT log_source, event_category, event_time, "user", CAST(NULL AS VARCHAR) AS source_ip,
    processed_timestamp FROM process
  UNION ALL SELECT log_source, event_category, event_time, user_email, source_ip, processed_timestamp FROM okta
  UNION ALL SELECT log_source, event_category, event_time, user_name, source_ip, processed_timestamp FROM windows
  UNION ALL SELECT log_source, event_category, event_time, user_name, source_ip, processed_timestamp FROM cloud
  UNION ALL SELECT log_source, event_category, event_time, "user", NULL, processed_timestamp FROM network)"""
_TABLES = ("process", "okta", "windows", "cloud", "network")
LONG = "20000 days"
_P = "processed_timestamp"


def over_common(select):
    return sql(select, *_TABLES, extra=COMMON)


def events_report(report, **kw):
    return lambda spark, sf: plain(report(common(spark, sf), E, **kw))


def within(days):
    return f"{_P} >= TIMESTAMP '{E}' - INTERVAL {days} DAY AND {_P} <= TIMESTAMP '{E}'"


_LAG = f"(({unix(_P)} - {unix('event_time')}) / 60)"


def activity(spark, sf):
    return plain(R.user_activity(spark, common(spark, sf), "user17"))


def quality(spark, sf):
    return R.source_quality(
        {
            "sysmon_process": T.process(spark, sf),
            "okta_auth": T.okta(spark, sf),
            "windows_auth": T.windows(spark, sf),
            "cloudtrail": T.cloud(spark, sf),
        }
    )


def _quality(name, table, entity, cond):
    return f"""SELECT '{name}' AS log_source, count(*) AS total_events, count(DISTINCT {entity}) AS unique_entities,
  {cnt(cond)} AS flagged_events, round({cnt(cond)} * 100.0 / count(*), 2) AS flagged_pct FROM {table}"""


QUALITY = sql(
    " UNION ALL ".join(
        [
            _quality("sysmon_process", "process", "host", "threat_indicator <> 'normal'"),
            _quality("okta_auth", "okta", "user_email", "outcome = 'FAILURE'"),
            _quality("windows_auth", "windows", "host", "NOT logon_success"),
            _quality("cloudtrail", "cloud", "user_name", "risk_classification = 'high_risk_action'"),
        ]
    ),
    "process", "okta", "windows", "cloud",
)


def gaps(spark, sf):
    wanted = (*validation.EXPECTED_TACTICS, "Exfiltration", "Impact")
    return validation.tactic_gaps(spark, triaged_alerts(spark, sf), wanted)


def checks(spark, sf):
    tables = {"sysmon_process": T.process(spark, sf), "okta_auth": T.okta(spark, sf)}
    return validation.validate(
        spark, tables, triaged_alerts(spark, sf), rules.registry(spark, "2024-01-01 00:00:00")
    )


def silver_counts(spark, sf):
    return validation.table_counts(
        {
            "sysmon_process": T.process(spark, sf),
            "sysmon_network": T.network(spark, sf),
            "okta_auth": T.okta(spark, sf),
            "windows_auth": T.windows(spark, sf),
            "cloudtrail": T.cloud(spark, sf),
        }
    )


SILVER_COUNTS = sql(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS rows, {cnt(cond)} AS suspicious_rows, count(*) > 0 AS passed
  FROM {view}"""
        for name, view, cond in (
            ("sysmon_process", "process", "threat_indicator <> 'normal'"),
            ("sysmon_network", "network", "port_classification <> 'normal'"),
            ("okta_auth", "okta", "risk_indicator <> 'normal'"),
            ("windows_auth", "windows", "false"),
            ("cloudtrail", "cloud", "risk_classification <> 'normal'"),
        )
    ),
    *_TABLES,
)


def check_score(spark, sf):
    return validation.score(checks(spark, sf))


CHECKS = over_alerts(
    f"""SELECT 'table has rows' AS "check", t AS subject, CAST(n AS DOUBLE) AS value, n > 0 AS passed FROM (
  SELECT 'sysmon_process' AS t, count(*) AS n FROM process UNION ALL
  SELECT 'okta_auth', count(*) FROM events UNION ALL SELECT 'security_alerts', count(*) FROM alerts)
UNION ALL SELECT 'alert columns present', 'all', 0.0, true
UNION ALL SELECT 'rules registered', 'detection_rules', {len(rules.RULES)}.0, true
UNION ALL SELECT 'expected tactics covered', 'security_alerts', CAST(n AS DOUBLE), n = 0 FROM (
  SELECT 3 - count(DISTINCT mitre_tactic) AS n FROM alerts
  WHERE mitre_tactic IN ('Credential Access', 'Execution', 'Lateral Movement'))
UNION ALL SELECT 'nulls below limit', s, 0.0, true FROM (VALUES ('security_alerts.alert_id'),
  ('security_alerts.detection_time'), ('security_alerts.severity'), ('sysmon_process.event_time'),
  ('okta_auth.user_email')) v(s)"""
)

_PCOLS = 'host, "user", process_name, command_line, parent_process_name, threat_indicator'
_OCOLS = "user_email, source_ip, country, city, outcome, failure_reason, target_application"
_CCOLS = "event_name, user_name, source_ip, service, region, risk_classification, api_success, error_code"
_NCOLS = 'event_time, host, process_name, "user", destination_ip, destination_port, port_classification'


def _newest(cols, table, view, cond, as_of, days):
    return sql(
        f"""SELECT {shown('event_time')} AS event_time, {cols} FROM (SELECT event_time, {cols} FROM {table}
  WHERE {cond} AND event_time >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY AND event_time <= TIMESTAMP '{as_of}'
  ORDER BY event_time DESC, {', '.join(c + ' NULLS FIRST' for c in cols.split(', '))} LIMIT 100)""",
        view,
    )


QUERIES = {
    "kpi_count_by_severity": (
        over(R.count_by_severity),
        over_alerts("SELECT severity, count(*) AS alert_count FROM alerts GROUP BY severity"),
    ),
    "kpi_count_by_severity_rule": (
        over(R.count_by_severity_rule),
        over_alerts("SELECT severity, detection_rule, count(*) AS alert_count FROM alerts GROUP BY ALL"),
    ),
    "kpi_new_alert_rollup": (
        over(R.new_alert_rollup),
        over_alerts(f"""SELECT severity, count(*) AS alert_count, {_USERS},
  count(DISTINCT mitre_technique) AS unique_techniques FROM alerts WHERE status = 'NEW' GROUP BY severity"""),
    ),
    "kpi_recent_severe": (
        over(R.recent_severe),
        over_alerts(f"""SELECT alert_id, {shown('detection_time')} AS detection_time, alert_title, severity, "user",
  host, source_ip, mitre_technique, description, status, assigned_to FROM alerts
WHERE severity IN ('CRITICAL', 'HIGH') ORDER BY alerts.detection_time DESC, event_time DESC, alert_id LIMIT 25"""),
    ),
    "kpi_performance": (
        over(R.performance_24h, as_of=E),
        over_alerts(f"""SELECT count(*) AS total_alerts, {_USERS}, count(DISTINCT detection_rule) AS triggered_rules,
  {cnt("severity = 'CRITICAL'")} AS critical_alerts, {cnt("severity = 'HIGH'")} AS high_alerts,
  {cnt("severity = 'MEDIUM'")} AS medium_alerts, {_TP} AS true_positives, {_FP} AS false_positives,
  {_RATE} AS true_positive_rate FROM alerts WHERE {since(1)}"""),
    ),
    "kpi_rule_effectiveness": (
        over(R.rule_effectiveness),
        over_alerts(f"""SELECT detection_rule, severity, count(*) AS alert_count,
  count(DISTINCT "user") AS affected_users, {shown('min(detection_time)')} AS first_detection,
  {shown('max(detection_time)')} AS last_detection, {_TP} AS true_positives, {_FP} AS false_positives
FROM alerts GROUP BY detection_rule, severity"""),
    ),
    "kpi_summary": (
        over(R.summary_24h, as_of=E),
        over_alerts(f"SELECT count(*) AS total_alerts, {_LEVELS}, {_USERS} FROM alerts WHERE {since(1)}"),
    ),
    "kpi_hourly_series": (
        over(R.hourly_series, as_of=E),
        over_alerts(f"""SELECT {shown("date_trunc('hour', detection_time)")} AS hour, severity,
  count(*) AS alert_count FROM alerts WHERE {since(7)} GROUP BY date_trunc('hour', detection_time), severity"""),
    ),
    "kpi_top_users": (over(R.top_entities, "user", as_of=E), top("user")),
    "kpi_top_hosts": (over(R.top_entities, "host", as_of=E), top("host")),
    "kpi_technique_coverage": (
        over(R.technique_coverage, as_of=E),
        over_alerts(f"""SELECT mitre_tactic, mitre_technique, count(*) AS detection_count, {_WORST} AS max_severity
FROM alerts WHERE {since(30)} GROUP BY mitre_tactic, mitre_technique"""),
    ),
    "kpi_status_share": (
        over(R.status_share, as_of=E),
        over_alerts(f"""SELECT status, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
FROM alerts WHERE {since(7)} GROUP BY status"""),
    ),
    "kpi_time_to_detect": (
        over(R.time_to_detect, as_of=E),
        over_alerts(f"""SELECT round(avg(m), 2) AS avg_mttd_minutes, round(min(m), 2) AS min_mttd_minutes,
  round(max(m), 2) AS max_mttd_minutes, round(quantile_cont(m, 0.5), 2) AS median_mttd_minutes
FROM (SELECT {_MIN} AS m FROM alerts WHERE {since(7)}) WHERE m BETWEEN 0 AND 1440"""),
    ),
    "kpi_rule_performance": (performance, PERFORMANCE),
    "kpi_daily_volume": (
        over(R.daily_volume, as_of=E),
        over_alerts(f"""SELECT {shown("date_trunc('day', detection_time)")} AS day, detection_rule,
  count(*) AS alert_count FROM alerts WHERE {since(30)} GROUP BY date_trunc('day', detection_time), detection_rule"""),
    ),
    "kpi_outcome_rates": (
        over(R.outcome_rates, as_of=E),
        over_alerts(f"""SELECT detection_rule, {_TP} AS true_positives, {_FP} AS false_positives,
  round({_TP} * 100.0 / count(*), 2) AS tp_rate, round({_FP} * 100.0 / count(*), 2) AS fp_rate
FROM alerts WHERE {since(30)} AND status IN ('TRUE_POSITIVE', 'FALSE_POSITIVE') GROUP BY detection_rule"""),
    ),
    "kpi_tactic_coverage": (
        over(R.tactic_coverage, as_of=E),
        over_alerts(f"""SELECT mitre_tactic, count(DISTINCT mitre_technique) AS unique_techniques,
  count(DISTINCT detection_rule) AS detection_rules, {_TP} AS confirmed_threats
FROM alerts WHERE {since(30)} GROUP BY mitre_tactic"""),
    ),
    "kpi_weekly_heatmap": (
        over(R.weekly_heatmap, as_of=E),
        over_alerts(f"""SELECT CAST(dayofweek(detection_time) + 1 AS INTEGER) AS day_of_week,
  CAST(hour(detection_time) AS INTEGER) AS hour_of_day, count(*) AS alert_count
FROM alerts WHERE {since(30)} GROUP BY ALL"""),
    ),
    "kpi_alert_flow": (
        over(R.alert_flow, as_of=E),
        over_alerts(f"""SELECT detection_rule AS source, status AS target, count(*) AS value FROM alerts
WHERE {since(7)} GROUP BY ALL UNION ALL
SELECT status, coalesce(assigned_to, 'Unassigned'), count(*) FROM alerts WHERE {since(7)} GROUP BY ALL"""),
    ),
    "kpi_source_ip_rollup": (
        over(R.source_ip_rollup, as_of=E),
        over_alerts(f"""SELECT source_ip, count(*) AS alert_count, {_WORST} AS max_severity FROM alerts
WHERE source_ip IS NOT NULL AND {since(7)} GROUP BY source_ip"""),
    ),
    "kpi_titles_by_count": (
        over(R.titles_by_count),
        over_alerts("SELECT alert_title, count(*) AS alert_count FROM alerts GROUP BY alert_title"),
    ),
    "hunt_suspicious_processes": (
        _silver(T.process, R.suspicious_processes, E),
        _newest(_PCOLS, "process", "process", "threat_indicator <> 'normal'", E, 7),
    ),
    "hunt_failed_logins": (
        _silver(T.okta, R.failed_logins, E),
        _newest(_OCOLS, "okta", "okta", "outcome = 'FAILURE'", E, 1),
    ),
    "hunt_connections": (
        _silver(T.network, R.connection_analysis, LINES_AS_OF, within="30 days"),
        sql(
            f"""SELECT {shown('event_time')} AS event_time, {_NCOLS.removeprefix('event_time, ')}, connection_count
FROM (SELECT {_NCOLS}, count(*) AS connection_count FROM network
  WHERE event_time >= TIMESTAMP '{LINES_AS_OF}' - INTERVAL 30 DAY AND event_time <= TIMESTAMP '{LINES_AS_OF}'
  GROUP BY ALL ORDER BY connection_count DESC, {_NCOLS} LIMIT 100)""",
            "network",
        ),
    ),
    "hunt_high_risk_calls": (
        _silver(T.cloud, R.high_risk_calls, ORDERS_AS_OF),
        _newest(_CCOLS, "cloud", "cloud", "risk_classification = 'high_risk_action'", ORDERS_AS_OF, 7),
    ),
    "user_activity_param": (
        activity,
        over_common(f"""SELECT log_source, event_category, count(*) AS event_count, {shown('min(event_time)')} AS first_seen,
  {shown('max(event_time)')} AS last_seen,
  count(DISTINCT CASE WHEN log_source = 'okta' THEN source_ip END) AS unique_ips
FROM common WHERE "user" = 'user17' GROUP BY log_source, event_category"""),
    ),
    "src_volume_span": (
        events_report(R.ingestion_volume, within=LONG),
        over_common(f"""SELECT log_source, count(*) AS event_count, {shown(f'min({_P})')} AS first_processed,
  {shown(f'max({_P})')} AS last_processed, round(({unix(f'max({_P})')} - {unix(f'min({_P})')}) / 3600, 2) AS hours_span
FROM common WHERE {within(20000)} GROUP BY log_source"""),
    ),
    "src_lag": (
        events_report(R.ingestion_lag, within=LONG),
        over_common(f"""SELECT log_source, round(avg({_LAG}), 2) AS avg_lag_minutes,
  round(max({_LAG}), 2) AS max_lag_minutes, count(*) AS sample_count
FROM common WHERE {within(20000)} AND event_time IS NOT NULL GROUP BY log_source"""),
    ),
    "src_hourly": (
        events_report(R.events_per_hour),
        over_common(f"""SELECT {shown(f"date_trunc('hour', {_P})")} AS hour, log_source, count(*) AS event_count
FROM common WHERE {within(7)} GROUP BY date_trunc('hour', {_P}), log_source"""),
    ),
    "src_missing": (
        events_report(R.missing_fields, within=LONG),
        over_common(f"""SELECT log_source, count(*) AS total_events, {cnt('event_time IS NULL')} AS missing_timestamp,
  {cnt('"user" IS NULL')} AS missing_user,
  round({cnt('event_time IS NULL')} * 100.0 / count(*), 2) AS pct_missing_timestamp
FROM common WHERE {within(20000)} GROUP BY log_source"""),
    ),
    "src_quality": (quality, QUALITY),
    "tactic_gaps": (
        gaps,
        over_alerts("""SELECT t AS mitre_tactic FROM (VALUES ('Credential Access'), ('Execution'),
  ('Lateral Movement'), ('Exfiltration'), ('Impact')) v(t) WHERE t NOT IN (SELECT mitre_tactic FROM alerts)"""),
    ),
    "validation_table_counts": (silver_counts, SILVER_COUNTS),
    "validation_checks": (checks, CHECKS),
    "validation_score": (
        check_score,
        f"""WITH c AS ({CHECKS}) SELECT {cnt('passed')} AS passed, {cnt('NOT passed')} AS failed,
  round({cnt('passed')} * 100.0 / count(*), 1) AS score_pct FROM c""",
    ),
}
