"""Severity order: rank, worst-of aggregate and value-to-severity steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Alert severities from worst to mildest.
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

Step = tuple[float, str]


def severity_rank(severity: Column | str) -> Column:
    """SRT-03: 1 for CRITICAL to 4 for LOW, 5 for anything else."""
    c = F.col(severity) if isinstance(severity, str) else severity
    rank = F.lit(len(SEVERITIES) + 1)
    for i in range(len(SEVERITIES), 0, -1):
        rank = F.when(c == SEVERITIES[i - 1], F.lit(i)).otherwise(rank)
    return rank


def worst_severity(severity: Column | str) -> Column:
    """AGG-07: the worst severity of a group.

    Aggregates the integer rank, so the hash aggregate keeps a fixed-width
    buffer, and turns the winning rank back into its name.
    """
    names = F.array(*[F.lit(s) for s in SEVERITIES], F.lit(None).cast("string"))
    return F.element_at(names, F.min(severity_rank(severity)))


def severity_steps(value: Column, steps: Sequence[Step], default: str) -> Column:
    """First step whose bound ``value`` reaches, steps given from high to low."""
    result = None
    for bound, name in steps:
        test = value >= bound
        result = F.when(test, name) if result is None else result.when(test, name)
    return F.lit(default) if result is None else result.otherwise(default)
