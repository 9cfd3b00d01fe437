"""Incidents of one entity within the hour that their ids hold."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkwatch import schemas
from sparkwatch.plans.detection import run_detections
from sparkwatch.plans.rules import BY_NAME, with_params
from sparkwatch.sinks import tables

START = datetime(2025, 11, 3, 10, 5)


def failures(spark, *bursts):
    rows = [
        (START + timedelta(minutes=at, seconds=7.001 * i), "a@x", "1.1.1.1", "FAILURE")
        for at, n in bursts for i in range(n)
    ]
    return spark.createDataFrame(rows, "event_time timestamp, user_email string, source_ip string, outcome string")


def run(spark, rows, minute, **how):
    chosen = with_params(BY_NAME["detect_okta_bruteforce"], **how) if how else BY_NAME["detect_okta_bruteforce"]
    return run_detections({"okta_auth": rows}, START + timedelta(minutes=minute), [chosen]).alerts


def severities(spark, root):
    rows = tables.read_alerts(spark, root).orderBy("event_time").collect()
    assert len({r.alert_id for r in rows}) == len(rows)
    return [r.severity for r in rows]


def test_second_burst_in_the_hour_is_stored(spark, root):
    rows = failures(spark, (0, 5), (40, 12))
    for minute in (3, 5, 43, 43, 45, 5):
        tables.append_alerts(run(spark, rows, minute), root)
    assert severities(spark, root) == ["MEDIUM", "CRITICAL"]


def test_overlapping_windows_are_one_incident(spark, root):
    rows = failures(spark, (0, 5), (7, 5), (13, 12), (40, 6))
    sliding = dict(mode="sliding", within="10 minutes", slide="5 minutes")
    for _ in range(2):
        tables.append_alerts(run(spark, rows, 60, **sliding), root)
        got = severities(spark, root)
        # Windows 10:05-10:15 and 10:10-10:20 share the second burst, and the third is in the latter and the next.
        assert got == ["CRITICAL", "MEDIUM"]
    one = run(spark, rows.where(F.col("event_time") < START + timedelta(minutes=3)), 3)
    tables.append_alerts(one, root)
    assert severities(spark, root) == got


@pytest.mark.parametrize("context", ["{}", None])
def test_ids_without_span_are_stored_once(spark, root, context):
    row = spark.range(2).select(
        *[
            {
                "alert_id": F.lit("x"), "context": F.lit(context), "detection_time": F.lit(START), "severity": F.lit("LOW"),
                "event_time": F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int")),
            }.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.ALERTS.fields
        ]
    )
    for _ in range(2):
        tables.append_alerts(row, root)
    assert tables.read_alerts(spark, root).count() == 1
