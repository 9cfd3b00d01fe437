"""V-01 to V-06: checks of a whole installation as one table of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkwatch import schemas
from sparkwatch.functions.times import percent

# Tactics that need at least one alert.
EXPECTED_TACTICS = ("Credential Access", "Execution", "Lateral Movement")

NULL_LIMIT_PCT = 5.0
CRITICAL_COLUMNS = {
    "security_alerts": ("alert_id", "detection_time", "severity"),
    "sysmon_process": ("event_time",),
    "okta_auth": ("user_email",),
}


# Column that marks suspicious rows, per table that has one.
INDICATORS = {
    "sysmon_process": "threat_indicator",
    "sysmon_network": "port_classification",
    "okta_auth": "risk_indicator",
    "cloudtrail": "risk_classification",
}


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V-01: rows and suspicious rows per table; an empty table fails."""
    parts = []
    for name, df in tables.items():
        mark = F.col(INDICATORS[name]) != "normal" if name in INDICATORS else F.lit(False)
        parts.append(
            df.agg(F.count("*").alias("rows"), F.count_if(mark).alias("suspicious_rows")).select(
                F.lit(name).alias("table_name"), "rows", "suspicious_rows"
            )
        )
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("rows") > 0)


def missing_columns(df: DataFrame, wanted: Sequence[str] | None = None) -> list[str]:
    """V-02: alert columns the table lacks."""
    wanted = wanted or [f.name for f in schemas.ALERTS.fields]
    return [c for c in wanted if c not in df.columns]


def registry_state(rules: DataFrame) -> DataFrame:
    """V-03"""
    return rules.agg(
        F.count("*").alias("rules"), F.count_if(F.col("enabled")).alias("enabled_rules")
    )


def tactic_gaps(
    spark: SparkSession, alerts: DataFrame, expected: Sequence[str] = EXPECTED_TACTICS
) -> DataFrame:
    """V-04: expected tactics without any alert."""
    wanted = spark.createDataFrame([(t,) for t in expected], "mitre_tactic string")
    covered = alerts.select("mitre_tactic").distinct()
    return wanted.join(covered, "mitre_tactic", "left_anti")


def validate(
    spark: SparkSession, silver: Mapping[str, DataFrame], alerts: DataFrame, rules: DataFrame
) -> DataFrame:
    """All checks as (check, subject, value, passed); each table is scanned once."""
    lost = missing_columns(alerts)
    parts = [
        spark.range(1).select(
            F.lit("alert columns present").alias("check"),
            F.lit(",".join(lost) or "all").alias("subject"),
            F.lit(float(len(lost))).alias("value"),
            F.lit(not lost).alias("passed"),
        ),
        registry_state(rules).select(
            F.lit("rules registered").alias("check"),
            F.lit("detection_rules").alias("subject"),
            F.col("enabled_rules").cast("double").alias("value"),
            (F.col("rules") > 0).alias("passed"),
        ),
    ]
    parts += [_table_checks(name, df) for name, df in {**silver, "security_alerts": alerts}.items()]
    return reduce(DataFrame.unionByName, parts)


def _table_checks(table: str, df: DataFrame) -> DataFrame:
    """Rows, missing values and covered tactics of one table from one aggregate."""
    columns = CRITICAL_COLUMNS.get(table, ())
    tactics = EXPECTED_TACTICS if table == "security_alerts" else ()
    found = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)],
        *[F.max(F.col("mitre_tactic") == t).alias(f"tactic_{i}") for i, t in enumerate(tactics)],
    )
    row = lambda check, subject, value, passed: F.struct(
        F.lit(check).alias("check"), F.lit(subject).alias("subject"), value.cast("double").alias("value"),
        passed.alias("passed"),
    )
    checks = [row("table has rows", table, F.col("rows"), F.col("rows") > 0)]
    for i, c in enumerate(columns):
        nulls = F.col(f"null_{i}")
        share = F.coalesce(percent(nulls, F.col("rows")), F.lit(0.0))
        low = (nulls == 0) | (nulls * 100 < F.col("rows") * NULL_LIMIT_PCT)
        checks.append(row("nulls below limit", f"{table}.{c}", share, low))
    if tactics:
        gaps = sum((F.when(F.coalesce(f"tactic_{i}", F.lit(False)), 0).otherwise(1) for i in range(len(tactics))), F.lit(0))
        checks.append(row("expected tactics covered", table, gaps, gaps == 0))
    return found.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def score(checks: DataFrame) -> DataFrame:
    """V-06: passed, failed and share passed."""
    ok = F.count_if(F.col("passed"))
    return checks.agg(
        ok.alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.round(ok * F.lit(100.0).cast("double") / F.count("*"), 1).alias("score_pct"),
    )
