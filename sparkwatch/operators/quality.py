"""NRM-13, STR-09, V-05: named row constraints and missing-value rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from sparkwatch.functions.times import percent

# Constraints per silver table.
SILVER_RULES = {
    "sysmon_process": {
        "valid_timestamp": "event_time IS NOT NULL",
        "valid_process": "process_name IS NOT NULL",
    },
    "sysmon_network": {
        "valid_timestamp": "event_time IS NOT NULL",
        "valid_destination": "destination_ip IS NOT NULL OR destination_port IS NOT NULL",
    },
    "sysmon_registry": {
        "valid_timestamp": "event_time IS NOT NULL",
        "valid_path": "registry_path IS NOT NULL",
    },
    "okta_auth": {
        "valid_timestamp": "event_time IS NOT NULL",
        "valid_user": "user_email IS NOT NULL",
    },
    "windows_auth": {
        "valid_timestamp": "event_time IS NOT NULL",
        "valid_user": "user_name IS NOT NULL",
    },
    "cloudtrail": {
        "valid_timestamp": "event_time IS NOT NULL",
        "valid_event": "event_name IS NOT NULL",
    },
}


def _holds(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def _all_hold(rules: Mapping[str, str]) -> Column:
    out = F.lit(True)
    for rule in rules.values():
        out = out & _holds(rule)
    return out


def expect(
    df: DataFrame, rules: Mapping[str, str], action: str = "warn", name: str = "expectations"
) -> tuple[DataFrame, Observation | str]:
    """Count the rows that break each rule, and act on them.

    ``warn`` keeps all rows, ``drop`` removes offenders, ``fail`` raises at run
    time, ``flag`` keeps all rows with a list of broken rules in
    ``failed_rules`` for routing to quarantine. Counts appear as metrics
    ``total_rows`` and ``failed_<rule>`` on the returned observation, or on a
    stream in its progress under ``name``.
    """
    metrics = [F.count("*").alias("total_rows")]
    metrics += [F.count_if(~_holds(r)).alias(f"failed_{k}") for k, r in rules.items()]
    handle: Observation | str = name if df.isStreaming else Observation()
    out = df.observe(handle, *metrics)
    if action == "drop":
        out = out.where(_all_hold(rules))
    elif action == "fail":
        broken = F.concat(F.lit("row breaks a rule of "), F.lit(name))
        out = out.where(F.when(_all_hold(rules), F.lit(True)).otherwise(F.raise_error(broken).cast("boolean")))
    elif action == "flag":
        failed = [F.when(~_holds(r), F.lit(k)) for k, r in rules.items()]
        out = out.withColumn("failed_rules", F.array_compact(F.array(*failed)))
    elif action != "warn":
        raise ValueError(f"unknown action {action!r}")
    return out, handle


def quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows marked by ``expect(action='flag')`` into good and broken ones."""
    bad = F.size("failed_rules") > 0
    return flagged.where(~bad).drop("failed_rules"), flagged.where(bad)


def expectation_counts(df: DataFrame, rules: Mapping[str, str], table: str) -> DataFrame:
    """One row per rule with passed and failed counts, from a single scan."""
    counted = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(~_holds(r)).alias(k) for k, r in rules.items()],
    )
    pairs = [F.struct(F.lit(k).alias("rule"), F.col(k).alias("failed")) for k in rules]
    return counted.select("total", F.explode(F.array(*pairs)).alias("r")).select(
        F.lit(table).alias("table_name"),
        "r.rule",
        (F.col("total") - F.col("r.failed")).alias("passed"),
        "r.failed",
    )


def expectation_totals(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(metric, value): ``total_rows`` and ``failed_<rule>`` from a single scan, as ``expect`` counts them."""
    found = df.agg(F.count("*").alias("total_rows"), *[F.count_if(~_holds(r)).alias(f"failed_{k}") for k, r in rules.items()])
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in found.columns]
    return found.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def null_rates(df: DataFrame, columns: Sequence[str], table: str, limit_pct: float = 5.0) -> DataFrame:
    """V-05: missing values per column; a column passes below ``limit_pct``."""
    counted = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    nulls, total = F.col("r.null_count"), F.col("total")
    return counted.select("total", F.explode(F.array(*pairs)).alias("r")).select(
        F.lit(table).alias("table_name"),
        "r.column_name",
        total.alias("total_count"),
        "r.null_count",
        F.coalesce(percent(nulls, total, 2), F.lit(0.0)).alias("null_pct"),
        ((nulls == 0) | (nulls * 100 < total * limit_pct)).alias("passed"),
    )
