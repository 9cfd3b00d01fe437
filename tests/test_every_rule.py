"""The run of all rules gives a row for each of them, with alerts that are really counted."""

from __spark_entry__ import queries
from sparkwatch.plans.rules import RULES

SF = "/root/testdata/sf0.001"


def test_every_enabled_rule_is_counted(spark):
    rows = {r.detection_rule: r for r in queries()["detections_every_rule"](spark, SF).collect()}
    assert set(rows) == {r.name for r in RULES if r.enabled}
    assert rows["detect_user_clustering"].alert_count > 0
    assert all(r.alert_count is not None and r.failed_rules == 0 for r in rows.values())
    # More than the signature rules find something.
    assert {n for n, r in rows.items() if r.alert_count} > {r.name for r in RULES if r.match}
