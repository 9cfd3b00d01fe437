"""G-01, G-04 to G-07, SNK-10, SNK-15: the alert table and its life cycle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkwatch import schemas
from sparkwatch.functions.times import AsOf, trailing

# Scores, priorities and response times per severity.
BASE_SCORES = {"CRITICAL": 100, "HIGH": 75, "MEDIUM": 50, "LOW": 25}
TACTIC_BONUS = {"Credential Access": 20, "Privilege Escalation": 15, "Lateral Movement": 15}
PRIORITIES = {"CRITICAL": "P1 - Immediate", "HIGH": "P2 - Urgent", "MEDIUM": "P3 - Normal"}
OTHER_PRIORITY = "P4 - Low"
RESPONSE_MINUTES = {"CRITICAL": 15, "HIGH": 60, "MEDIUM": 240}
OTHER_RESPONSE_MINUTES = 1440

EXPORT_COLUMNS = (
    "alert_id",
    "detection_time",
    "event_time",
    "alert_title",
    "description",
    "severity",
    "mitre_technique",
    "mitre_tactic",
    "detection_rule",
    "user",
    "host",
    "source_ip",
    "status",
)


@dataclass(frozen=True)
class AlertMap:
    """Which hit columns fill the canonical alert row.

    A rule over a moving span sees the first event of an incident change from run to run.
    ``period_seconds`` puts the start of the aligned period that holds the event in the id
    instead of the event's own time, so an entity has one alert in each period.
    """

    rule: str
    title: str
    technique: str
    tactic: str
    event_time: str = "event_time"
    user: str | None = None
    host: str | None = None
    source_ip: str | None = None
    context: tuple[str, ...] = ()
    identity: tuple[str, ...] = field(default=())
    period_seconds: int | None = None


def lookup(column: str, values: dict, default) -> Column:
    """PRJ-10: map a column through a small fixed table."""
    out = F.lit(default)
    for key, value in values.items():
        out = F.when(F.col(column) == key, F.lit(value)).otherwise(out)
    return out


def _detected_at(as_of: AsOf) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def alert_fields(m: AlertMap, severity: Column, description: Column, as_of: AsOf = None) -> dict[str, Column]:
    """The 17 alert columns over the columns of a hit.

    The id is a hash of rule, entity, event time and the identity columns, so a
    rule that runs again over the same events yields the same ids (SCL-17).
    """
    name = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    at = F.col(m.event_time).cast("timestamp")
    parts = [name(m.user), name(m.host), name(m.source_ip)]
    start = at
    if m.period_seconds:
        start = F.timestamp_seconds(F.floor(F.unix_timestamp(at) / m.period_seconds) * m.period_seconds)
    parts.append(F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    parts += [F.col(c).cast("string") for c in m.identity]
    key = F.concat_ws("|", F.lit(m.rule), *[F.coalesce(p, F.lit("-")) for p in parts])
    found = _detected_at(as_of)
    context = F.to_json(F.struct(*m.context)) if m.context else F.lit("{}")
    values = {
        "alert_id": F.sha2(key, 256),
        "detection_time": found,
        "event_time": at,
        "alert_title": F.lit(m.title),
        "description": description,
        "severity": severity,
        "mitre_technique": F.lit(m.technique),
        "mitre_tactic": F.lit(m.tactic),
        "detection_rule": F.lit(m.rule),
        "user": name(m.user),
        "host": name(m.host),
        "source_ip": name(m.source_ip),
        "context": context,
        "status": F.lit("NEW"),
        "assigned_to": F.lit(None).cast("string"),
        "notes": F.lit(None).cast("string"),
        "updated_at": found,
    }
    return {f.name: values[f.name] for f in schemas.ALERTS.fields}


def to_alert(hits: DataFrame, m: AlertMap, as_of: AsOf = None) -> DataFrame:
    """G-01: rule hits with ``severity`` and ``description`` as alert rows."""
    values = alert_fields(m, F.col("severity"), F.col("description"), as_of)
    return hits.select(*[c.alias(name) for name, c in values.items()])


def consolidate(parts: Sequence[DataFrame]) -> DataFrame:
    """SET-05: alerts of several rules in one table."""
    return reduce(DataFrame.unionByName, parts)


def unseen(alerts: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Alerts not stored yet, each id once. Reads only the id column of the store."""
    fresh = alerts.dropDuplicates(["alert_id"])
    return fresh if stored is None else fresh.join(stored.select("alert_id"), "alert_id", "left_anti")


def enrich(alerts: DataFrame) -> DataFrame:
    """G-04: risk scores, priority and response time of new alerts."""
    base = lookup("severity", BASE_SCORES, 0)
    return alerts.where(F.col("status") == "NEW").withColumns(
        {
            "base_risk_score": base,
            "composite_risk_score": base + lookup("mitre_tactic", TACTIC_BONUS, 0),
            "priority": lookup("severity", PRIORITIES, OTHER_PRIORITY),
            "response_time_minutes": lookup("severity", RESPONSE_MINUTES, OTHER_RESPONSE_MINUTES),
        }
    )


def status_change(
    alerts: DataFrame,
    status: str,
    assigned_to: str | None = None,
    notes: str | None = None,
    at: AsOf = None,
) -> DataFrame:
    """G-05, SNK-10: triage entries for the given alerts, to be appended.

    A null assignee or note means unchanged.
    """
    if status not in schemas.STATUSES:
        raise ValueError(f"unknown status {status!r}")
    return alerts.select(
        "alert_id",
        F.lit(status).alias("status"),
        F.lit(assigned_to).cast("string").alias("assigned_to"),
        F.lit(notes).cast("string").alias("notes"),
        _detected_at(at).alias("updated_at"),
    )


def latest_status(events: DataFrame) -> DataFrame:
    """Newest status per alert, and the newest assignee and note that were set.

    All three are mergeable maxima, so an alert with many entries is reduced
    before the shuffle. Equal times are settled by the larger value.
    """
    when = F.col("updated_at")
    newest = lambda c: F.max(
        F.when(F.col(c).isNotNull(), F.struct(when, F.col(c)))
    )[c].alias(c)
    return events.groupBy("alert_id").agg(
        newest("status"), newest("assigned_to"), newest("notes"), F.max(when).alias("updated_at")
    )


def with_status(alerts: DataFrame, events: DataFrame) -> DataFrame:
    """Alerts with the outcome of their triage history applied."""
    now = latest_status(events).select(
        "alert_id", *[F.col(c).alias(f"_{c}") for c in ("status", "assigned_to", "notes", "updated_at")]
    )
    joined = alerts.join(now, "alert_id", "left")
    for c in ("status", "assigned_to", "notes", "updated_at"):
        joined = joined.withColumn(c, F.coalesce(F.col(f"_{c}"), F.col(c)))
    return joined.select(*alerts.columns)


def triaged(alerts: DataFrame) -> DataFrame:
    """Alerts that are past NEW."""
    return alerts.where(F.col("status") != "NEW").select(
        "alert_id", "alert_title", "status", "assigned_to", "notes"
    )


def to_notify(alerts: DataFrame, limit: int = 5) -> DataFrame:
    """G-06: the newest critical alerts nobody has looked at."""
    return (
        alerts.where((F.col("severity") == "CRITICAL") & (F.col("status") == "NEW"))
        .orderBy(F.col("detection_time").desc(), F.col("event_time").desc(), "alert_id")
        .limit(limit)
    )


def notification_payload(alerts: DataFrame) -> DataFrame:
    """SNK-15: chat message per alert as JSON text, ready for any sender."""

    def entry(title: str, value: Column, short: bool) -> Column:
        return F.struct(
            F.lit(title).alias("title"),
            F.coalesce(value, F.lit("N/A")).alias("value"),
            F.lit(short).alias("short"),
        )

    color = F.when(F.col("severity").isin("CRITICAL", "HIGH"), "danger").otherwise("warning")
    fields = F.array(
        entry("Severity", F.col("severity"), True),
        entry("User", F.col("user"), True),
        entry("Host", F.col("host"), True),
        entry("MITRE Technique", F.col("mitre_technique"), True),
        entry("Description", F.col("description"), False),
    )
    body = F.struct(
        F.concat(F.lit("Security Alert: "), F.col("alert_title")).alias("text"),
        F.array(F.struct(color.alias("color"), fields.alias("fields"))).alias("attachments"),
    )
    return alerts.select("alert_id", F.to_json(body).alias("payload"))


def export_rows(alerts: DataFrame, as_of: AsOf = None, within: str = "24 hours") -> DataFrame:
    """G-07: recent alerts with the columns handed to other systems."""
    return alerts.where(trailing(alerts, "detection_time", as_of, within)).select(*EXPORT_COLUMNS)
