"""SEQ: two consecutive events of one key that should not follow each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sparkwatch.functions.neighbours import previous_by_range


def sequence_gap(
    df: DataFrame,
    key: str,
    ts: str,
    *,
    changed: str,
    max_gap_seconds: int,
    tiebreak: Sequence[str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Events whose previous event of the same key differs in ``changed`` and
    lies more than 0 and at most ``max_gap_seconds`` seconds back.

    Adds ``previous_<column>`` for the time, the changed column and ``carry``,
    and the gap in whole seconds.
    """
    fields = list(dict.fromkeys([ts, changed, *carry]))
    out = previous_by_range(df, key, ts, tiebreak, fields)
    gap = F.unix_timestamp(ts) - F.unix_timestamp(F.col("prev")[ts])
    return (
        out.withColumn("gap_seconds", gap)
        .where(
            F.col("prev")[changed].isNotNull()
            & (F.col(changed) != F.col("prev")[changed])
            & (F.col("gap_seconds") > 0)
            & (F.col("gap_seconds") <= max_gap_seconds)
        )
        .withColumns({f"previous_{f}": F.col("prev")[f] for f in fields})
        .drop("prev")
    )
