"""G-03, G-08: run all rules over the silver tables as one alert table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from sparkwatch.functions.times import AsOf, as_of_bound, since
from sparkwatch.operators.alerts import alert_fields, consolidate, to_alert
from sparkwatch.operators.signature import match_all
from sparkwatch.plans.rules import RULES, Rule


@dataclass
class DetectionRun:
    """Alerts of one run and the rules that could not be planned."""

    alerts: DataFrame
    failed: dict[str, str] = field(default_factory=dict)

    def summary(self) -> DataFrame:
        """Alerts per rule."""
        return self.alerts.groupBy("detection_rule").agg(F.count("*").alias("alert_count"))


def _signatures(df: DataFrame, rules: Sequence[Rule], as_of: AsOf) -> DataFrame:
    cases = {}
    for r in rules:
        test, text = r.match()
        cases[r.name] = (test, alert_fields(r.alert, F.lit(r.severity), text, as_of))
    return match_all(df, cases)


def run_detections(
    tables: Mapping[str, DataFrame],
    as_of: AsOf = None,
    rules: Sequence[Rule] = RULES,
    new_from: AsOf = None,
) -> DetectionRun:
    """Alerts of all enabled rules, unwritten.

    Signature rules on one table share one scan of it; every other rule adds
    its own branch, and the union is written by one job. A rule whose table or
    columns are missing is reported in ``failed`` and does not stop the others.
    Most rules look at a span that ends at ``as_of``. Signature and sequence
    rules have no such span; in repeated runs ``new_from`` limits them to hits
    from then on, so that they do not read the whole history again.
    """
    active = [r for r in rules if r.enabled]
    parts: list[DataFrame] = []
    failed: dict[str, str] = {}

    by_table: dict[str, list[Rule]] = {}
    for r in active:
        if r.table not in tables:
            failed[r.name] = f"table {r.table} is missing"
        elif r.match:
            by_table.setdefault(r.table, []).append(r)
        else:
            try:
                more = {"new_from": new_from} if r.incremental and new_from is not None else {}
                parts.append(to_alert(r.hits(tables[r.table], as_of, **more), r.alert, as_of))
            except PySparkException as error:  # isolate the rule; errors of Python code are faults of the library
                failed[r.name] = str(error).splitlines()[0]
    for table, group in by_table.items():
        df = tables[table]
        if new_from is not None:
            ts = group[0].alert.event_time
            df = df.where(since(df, ts, as_of_bound(df, ts, new_from)))
        try:
            parts.append(_signatures(df, group, as_of))
        except PySparkException:  # find out which rule it was
            for r in group:
                try:
                    parts.append(_signatures(df, [r], as_of))
                except PySparkException as error:
                    failed[r.name] = str(error).splitlines()[0]
    if not parts:
        raise ValueError(f"no rule could run: {failed}")
    return DetectionRun(consolidate(parts), failed)


def register_views(tables: Mapping[str, DataFrame], as_of: AsOf = None, rules: Sequence[Rule] = RULES) -> list[str]:
    """SNK-09: a temporary view of the hits per rule whose table is given.

    Rules that need an eager step, such as fitting a model, run it here.
    """
    names = []
    for r in rules:
        if r.table in tables:
            r.hits(tables[r.table], as_of).createOrReplaceTempView(r.name)
            names.append(r.name)
    return names


def validate_rules(
    samples: Mapping[str, tuple[DataFrame, int]], as_of: AsOf = None, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """G-08: run rules on sample rows and compare with the expected hit counts.

    ``samples`` maps a rule name to its input and the least number of hits.
    """
    known = {r.name: r for r in rules}
    parts = [
        known[name]
        .hits(df, as_of)
        .agg(F.count("*").alias("found"))
        .select(
            F.lit(name).alias("rule"),
            F.lit(least).cast("long").alias("expected"),
            "found",
            (F.col("found") >= least).alias("passed"),
        )
        for name, (df, least) in samples.items()
    ]
    return consolidate(parts)
