"""K-01 to K-29: reports over alerts, rules and event tables.

All take ``as_of``, so a report can be repeated for any moment. Alert reports
bound the detection time first, which on the stored alert table also prunes
its date partitions.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from sparkwatch.functions.severity import SEVERITIES, severity_rank, worst_severity
from sparkwatch.functions.times import AsOf, minutes_between, percent, trailing, trunc_like



def _is(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def recent_alerts(alerts: DataFrame, as_of: AsOf, within: str) -> DataFrame:
    """FLT-11 over alerts."""
    return alerts.where(trailing(alerts, "detection_time", as_of, within))


def _tp_rate() -> Column:
    tp, fp = _is("status", "TRUE_POSITIVE"), _is("status", "FALSE_POSITIVE")
    return percent(tp, tp + fp)


def count_by_severity(alerts: DataFrame) -> DataFrame:
    """K-01 by severity only."""
    return alerts.groupBy("severity").agg(F.count("*").alias("alert_count"))


def count_by_severity_rule(alerts: DataFrame) -> DataFrame:
    """K-01"""
    return alerts.groupBy("severity", "detection_rule").agg(F.count("*").alias("alert_count"))


def new_alert_rollup(alerts: DataFrame) -> DataFrame:
    """K-02: new alerts by severity, worst first."""
    return (
        alerts.where(F.col("status") == "NEW")
        .groupBy("severity")
        .agg(
            F.count("*").alias("alert_count"),
            F.count_distinct("user").alias("affected_users"),
            F.count_distinct("host").alias("affected_hosts"),
            F.count_distinct("mitre_technique").alias("unique_techniques"),
        )
        .orderBy(severity_rank("severity"))
    )


def recent_severe(alerts: DataFrame, limit: int = 25) -> DataFrame:
    """K-03: newest critical and high alerts."""
    return (
        alerts.where(F.col("severity").isin("CRITICAL", "HIGH"))
        .orderBy(F.col("detection_time").desc(), F.col("event_time").desc(), "alert_id")
        .limit(limit)
        .select(
            "alert_id", "detection_time", "alert_title", "severity", "user", "host", "source_ip",
            "mitre_technique", "description", "status", "assigned_to",
        )
    )


def performance_24h(alerts: DataFrame, as_of: AsOf = None, within: str = "24 hours") -> DataFrame:
    """K-04"""
    return recent_alerts(alerts, as_of, within).agg(
        F.count("*").alias("total_alerts"),
        F.count_distinct("user").alias("affected_users"),
        F.count_distinct("host").alias("affected_hosts"),
        F.count_distinct("detection_rule").alias("triggered_rules"),
        *[_is("severity", s).alias(f"{s.lower()}_alerts") for s in SEVERITIES[:3]],
        _is("status", "TRUE_POSITIVE").alias("true_positives"),
        _is("status", "FALSE_POSITIVE").alias("false_positives"),
        _tp_rate().alias("true_positive_rate"),
    )


def rule_effectiveness(alerts: DataFrame) -> DataFrame:
    """K-05"""
    return alerts.groupBy("detection_rule", "severity").agg(
        F.count("*").alias("alert_count"),
        F.count_distinct("user").alias("affected_users"),
        F.min("detection_time").alias("first_detection"),
        F.max("detection_time").alias("last_detection"),
        _is("status", "TRUE_POSITIVE").alias("true_positives"),
        _is("status", "FALSE_POSITIVE").alias("false_positives"),
    )


def summary_24h(alerts: DataFrame, as_of: AsOf = None, within: str = "24 hours") -> DataFrame:
    """K-06"""
    return recent_alerts(alerts, as_of, within).agg(
        F.count("*").alias("total_alerts"),
        *[_is("severity", s).alias(s.lower()) for s in SEVERITIES],
        F.count_distinct("user").alias("affected_users"),
        F.count_distinct("host").alias("affected_hosts"),
    )


def hourly_series(alerts: DataFrame, as_of: AsOf = None, within: str = "7 days") -> DataFrame:
    """K-07"""
    hour = trunc_like(alerts, "detection_time", "hour").alias("hour")
    return recent_alerts(alerts, as_of, within).groupBy(hour, "severity").agg(F.count("*").alias("alert_count"))


def top_entities(
    alerts: DataFrame, entity: str, as_of: AsOf = None, within: str = "7 days", limit: int = 10
) -> DataFrame:
    """K-08: users or hosts with most alerts (SRT-06)."""
    second = (
        F.count_distinct("detection_rule").alias("unique_detections")
        if entity == "user"
        else F.count_distinct("user").alias("unique_users")
    )
    return (
        recent_alerts(alerts, as_of, within)
        .where(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(
            F.count("*").alias("alert_count"),
            worst_severity("severity").alias("max_severity"),
            second,
            F.max("detection_time").alias("last_alert"),
        )
        .orderBy(F.col("alert_count").desc(), entity)
        .limit(limit)
    )


def technique_coverage(alerts: DataFrame, as_of: AsOf = None, within: str = "30 days") -> DataFrame:
    """K-09"""
    return (
        recent_alerts(alerts, as_of, within)
        .groupBy("mitre_tactic", "mitre_technique")
        .agg(F.count("*").alias("detection_count"), worst_severity("severity").alias("max_severity"))
    )


def status_share(alerts: DataFrame, as_of: AsOf = None, within: str = "7 days") -> DataFrame:
    """K-10, WIN-05: the window sees one row per status."""
    counts = recent_alerts(alerts, as_of, within).groupBy("status").agg(F.count("*").alias("count"))
    return counts.withColumn("percentage", percent(F.col("count"), F.sum("count").over(W.partitionBy())))


def time_to_detect(alerts: DataFrame, as_of: AsOf = None, within: str = "7 days") -> DataFrame:
    """K-11: delay from event to detection, between 0 and 1440 minutes.

    Delays are whole seconds of one day, so the exact median keeps at most
    86,401 distinct values however many alerts there are.
    """
    minutes = minutes_between(F.col("detection_time"), F.col("event_time"))
    rows = (
        recent_alerts(alerts, as_of, within)
        .where(F.col("event_time").isNotNull())
        .select(minutes.alias("m"))
        .where(F.col("m").between(0, 1440))
    )
    return rows.agg(
        F.round(F.avg("m"), 2).alias("avg_mttd_minutes"),
        F.round(F.min("m"), 2).alias("min_mttd_minutes"),
        F.round(F.max("m"), 2).alias("max_mttd_minutes"),
        F.round(F.percentile("m", 0.5), 2).alias("median_mttd_minutes"),
    )


def rule_performance(
    rules: DataFrame, alerts: DataFrame, as_of: AsOf = None, within: str = "30 days"
) -> DataFrame:
    """K-12, JN-04: every rule with its outcome, also rules without alerts.

    Alerts are reduced to one row per rule name before the join, so a rule
    with very many alerts does not travel.
    """
    per_rule = (
        recent_alerts(alerts, as_of, within)
        .groupBy("detection_rule")
        .agg(
            F.count("alert_id").alias("n"),
            _is("status", "TRUE_POSITIVE").alias("tp"),
            _is("status", "FALSE_POSITIVE").alias("fp"),
            F.max("detection_time").alias("last_triggered"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return rules.join(per_rule, "detection_rule", "left").select(
        "rule_name",
        "rule_version",
        "enabled",
        zero("n").alias("total_alerts"),
        zero("tp").alias("true_positives"),
        zero("fp").alias("false_positives"),
        percent(F.col("tp"), F.col("tp") + F.col("fp")).alias("true_positive_rate"),
        F.col("false_positive_rate").alias("expected_fpr"),
        "last_triggered",
    )


def daily_volume(alerts: DataFrame, as_of: AsOf = None, within: str = "30 days") -> DataFrame:
    """K-13"""
    day = trunc_like(alerts, "detection_time", "day").alias("day")
    return recent_alerts(alerts, as_of, within).groupBy(day, "detection_rule").agg(F.count("*").alias("alert_count"))


def outcome_rates(alerts: DataFrame, as_of: AsOf = None, within: str = "30 days") -> DataFrame:
    """K-14"""
    tp, fp = _is("status", "TRUE_POSITIVE"), _is("status", "FALSE_POSITIVE")
    return (
        recent_alerts(alerts, as_of, within)
        .where(F.col("status").isin("TRUE_POSITIVE", "FALSE_POSITIVE"))
        .groupBy("detection_rule")
        .agg(
            tp.alias("true_positives"),
            fp.alias("false_positives"),
            percent(tp, F.count("*")).alias("tp_rate"),
            percent(fp, F.count("*")).alias("fp_rate"),
        )
    )


def tactic_coverage(alerts: DataFrame, as_of: AsOf = None, within: str = "30 days") -> DataFrame:
    """K-15"""
    return (
        recent_alerts(alerts, as_of, within)
        .groupBy("mitre_tactic")
        .agg(
            F.count_distinct("mitre_technique").alias("unique_techniques"),
            F.count_distinct("detection_rule").alias("detection_rules"),
            _is("status", "TRUE_POSITIVE").alias("confirmed_threats"),
        )
    )


def weekly_heatmap(alerts: DataFrame, as_of: AsOf = None, within: str = "30 days") -> DataFrame:
    """K-16: alerts by day of week (1 is Sunday) and hour."""
    return (
        recent_alerts(alerts, as_of, within)
        .groupBy(
            F.dayofweek("detection_time").alias("day_of_week"), F.hour("detection_time").alias("hour_of_day")
        )
        .agg(F.count("*").alias("alert_count"))
    )


def _newest(df: DataFrame, limit: int, *tiebreak: str) -> DataFrame:
    return df.orderBy(F.col("event_time").desc(), *tiebreak).limit(limit)


def suspicious_processes(process: DataFrame, as_of: AsOf = None, within: str = "7 days", limit: int = 100) -> DataFrame:
    """K-17"""
    rows = process.where((F.col("threat_indicator") != "normal") & trailing(process, "event_time", as_of, within))
    cols = ["event_time", "host", "user", "process_name", "command_line", "parent_process_name", "threat_indicator"]
    return _newest(rows.select(*cols), limit, *cols[1:])


def failed_logins(auth: DataFrame, as_of: AsOf = None, within: str = "24 hours", limit: int = 100) -> DataFrame:
    """K-18"""
    rows = auth.where((F.col("outcome") == "FAILURE") & trailing(auth, "event_time", as_of, within))
    cols = [
        "event_time", "user_email", "source_ip", "country", "city", "outcome", "failure_reason",
        "target_application",
    ]
    return _newest(rows.select(*cols), limit, *cols[1:])


def connection_analysis(network: DataFrame, as_of: AsOf = None, within: str = "24 hours", limit: int = 100) -> DataFrame:
    """K-19, AGG-18: equal connections with their count, most frequent first."""
    cols = [
        "event_time", "host", "process_name", "user", "destination_ip", "destination_port",
        "port_classification",
    ]
    return (
        network.where(trailing(network, "event_time", as_of, within))
        .groupBy(*cols)
        .agg(F.count("*").alias("connection_count"))
        .orderBy(F.col("connection_count").desc(), *cols)
        .limit(limit)
    )


def high_risk_calls(cloud: DataFrame, as_of: AsOf = None, within: str = "7 days", limit: int = 100) -> DataFrame:
    """K-20"""
    rows = cloud.where(
        (F.col("risk_classification") == "high_risk_action") & trailing(cloud, "event_time", as_of, within)
    )
    cols = [
        "event_time", "event_name", "user_name", "source_ip", "service", "region",
        "risk_classification", "api_success", "error_code",
    ]
    return _newest(rows.select(*cols), limit, *cols[1:])


def user_activity(spark: SparkSession, events: DataFrame, user: str) -> DataFrame:
    """K-21, SRC-13: activity of one user by source; the user is a bound parameter."""
    return spark.sql(
        """
        SELECT log_source, event_category, count(*) AS event_count,
               min(event_time) AS first_seen, max(event_time) AS last_seen,
               count(DISTINCT CASE WHEN log_source = 'okta' THEN source_ip END) AS unique_ips
        FROM {events} WHERE user = :user
        GROUP BY log_source, event_category
        """,
        args={"user": user},
        events=events,
    )


def ingestion_volume(events: DataFrame, as_of: AsOf = None, within: str = "24 hours") -> DataFrame:
    """K-22: rows and time span per source."""
    t = "processed_timestamp"
    hours = (F.unix_timestamp(F.max(t)) - F.unix_timestamp(F.min(t))) / F.lit(3600)
    return (
        events.where(trailing(events, t, as_of, within))
        .groupBy("log_source")
        .agg(
            F.count("*").alias("event_count"),
            F.min(t).alias("first_processed"),
            F.max(t).alias("last_processed"),
            F.round(hours, 2).alias("hours_span"),
        )
    )


def ingestion_lag(events: DataFrame, as_of: AsOf = None, within: str = "1 hour") -> DataFrame:
    """K-23, AGG-17: minutes from event to processing per source."""
    lag = minutes_between(F.col("processed_timestamp"), F.col("event_time"))
    return (
        events.where(trailing(events, "processed_timestamp", as_of, within))
        .where(F.col("event_time").isNotNull())
        .groupBy("log_source")
        .agg(
            F.round(F.avg(lag), 2).alias("avg_lag_minutes"),
            F.round(F.max(lag), 2).alias("max_lag_minutes"),
            F.count("*").alias("sample_count"),
        )
    )


def events_per_hour(events: DataFrame, as_of: AsOf = None, within: str = "7 days") -> DataFrame:
    """K-24"""
    hour = trunc_like(events, "processed_timestamp", "hour").alias("hour")
    return (
        events.where(trailing(events, "processed_timestamp", as_of, within))
        .groupBy(hour, "log_source")
        .agg(F.count("*").alias("event_count"))
    )


def missing_fields(events: DataFrame, as_of: AsOf = None, within: str = "24 hours") -> DataFrame:
    """K-25"""
    lost = F.count_if(F.col("event_time").isNull())
    return (
        events.where(trailing(events, "processed_timestamp", as_of, within))
        .groupBy("log_source")
        .agg(
            F.count("*").alias("total_events"),
            lost.alias("missing_timestamp"),
            F.count_if(F.col("user").isNull()).alias("missing_user"),
            percent(lost, F.count("*")).alias("pct_missing_timestamp"),
        )
    )


def alert_flow(alerts: DataFrame, as_of: AsOf = None, within: str = "7 days") -> DataFrame:
    """K-26, SET-03: edges rule to status and status to assignee.

    One grouping by (rule, status, assignee) feeds both edge lists, so the
    alerts are read once.
    """
    base = (
        recent_alerts(alerts, as_of, within)
        .groupBy("detection_rule", "status", F.coalesce("assigned_to", F.lit("Unassigned")).alias("who"))
        .agg(F.count("*").alias("n"))
    )
    edges = F.array(
        F.struct(F.lit(1).alias("step"), F.col("detection_rule").alias("source"), F.col("status").alias("target")),
        F.struct(F.lit(2).alias("step"), F.col("status").alias("source"), F.col("who").alias("target")),
    )
    return (
        base.select(F.explode(edges).alias("e"), "n")
        .groupBy("e")
        .agg(F.sum("n").alias("value"))
        .select("e.source", "e.target", "value")
    )


def source_ip_rollup(alerts: DataFrame, as_of: AsOf = None, within: str = "7 days") -> DataFrame:
    """K-27"""
    return (
        recent_alerts(alerts, as_of, within)
        .where(F.col("source_ip").isNotNull())
        .groupBy("source_ip")
        .agg(F.count("*").alias("alert_count"), worst_severity("severity").alias("max_severity"))
    )


# Entity counted and condition flagged per table in the quality report.
_QUALITY = {
    "sysmon_process": ("host", lambda: F.col("threat_indicator") != "normal"),
    "okta_auth": ("user_email", lambda: F.col("outcome") == "FAILURE"),
    "windows_auth": ("host", lambda: ~F.col("logon_success")),
    "cloudtrail": ("user_name", lambda: F.col("risk_classification") == "high_risk_action"),
}


def source_quality(silver: Mapping[str, DataFrame]) -> DataFrame:
    """K-28, SET-02: one row per source with entity count and flagged share."""
    parts = []
    for name, (entity, flagged) in _QUALITY.items():
        if name in silver:
            bad = F.count_if(flagged())
            parts.append(
                silver[name]
                .agg(
                    F.count("*").alias("total_events"),
                    F.count_distinct(entity).alias("unique_entities"),
                    bad.alias("flagged_events"),
                    percent(bad, F.count("*")).alias("flagged_pct"),
                )
                .select(F.lit(name).alias("log_source"), "*")
            )
    return reduce(DataFrame.unionByName, parts)


def titles_by_count(alerts: DataFrame) -> DataFrame:
    """K-29"""
    return alerts.groupBy("alert_title").agg(F.count("*").alias("alert_count"))
