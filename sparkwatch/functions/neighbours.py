"""Previous-row access that does not hold one key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkwatch.session import written_table

#: Width of the time slices in which the rows of a key are ordered.
SLICE_SECONDS = 3600


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def with_previous(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    carry: Sequence[str],
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """WIN-01: add struct ``prev`` with the ``carry`` columns of the row before.

    Rows are ordered by ``ts`` and ``tiebreak`` within ``key``. A plain LAG
    sorts all rows of a key in one task, so every key is partitioned by (key,
    time slice). The last row of each slice, one aggregated row, is copied into
    the next slice of the key that has rows, which makes LAG exact across
    the cut; the copies are dropped again afterwards. So a task holds what one
    key has in one slice, and the input is read twice.
    """
    order = [ts, *tiebreak]
    width = slice_seconds * 1_000_000
    rows = df.withColumn("_slice", F.floor(_micros(F.col(ts)) / F.lit(width)))
    kept = list(dict.fromkeys([*carry, *order]))
    tails = (
        rows.groupBy(key, "_slice")
        .agg(F.max(F.struct(*order, *[c for c in kept if c not in order])).alias("_last"))
        .withColumn("_slice", F.lead("_slice").over(W.partitionBy(key).orderBy("_slice")))
        .where(F.col("_slice").isNotNull())
        .select(key, "_slice", "_last.*", F.lit(True).alias("_copy"))
    )
    both = rows.withColumn("_copy", F.lit(False)).unionByName(tails, allowMissingColumns=True)
    window = W.partitionBy(key, "_slice").orderBy(*order)
    return (
        both.withColumn("prev", F.lag(F.struct(*carry)).over(window))
        .where(~F.col("_copy"))
        .drop("_slice", "_copy")
    )


def previous_by_range(
    df: DataFrame,
    key: str,
    ts: str,
    tiebreak: Sequence[str],
    carry: Sequence[str],
) -> DataFrame:
    """WIN-01: add struct ``prev`` with the ``carry`` columns of the row before.

    Rows are ordered by ``ts`` and ``tiebreak`` within ``key``. A plain LAG sorts all rows of a
    key in one task. Here all rows are dealt into ranges of (key, ts, tiebreak) of like size, so a key that holds
    most rows, even within one moment, is parted like any other; rows that are equal in all of these
    stay together and have no order among them. The ranges are written to the shared folder once, since
    their bounds must not change between two passes. The last row of each range, one row per range, is
    copied into the next one, which makes LAG exact across the cut; the copies are dropped again.
    """
    order = [key, ts, *tiebreak]
    kept = list(dict.fromkeys([*order, *carry]))
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    rows = written_table(dealt, "ranges").withColumn("_copy", F.lit(False))
    tails = (
        rows.groupBy("_range")
        .agg(F.max(F.struct(*kept)).alias("_last"))
        # One row per range.
        .withColumn("_range", F.lead("_range").over(W.orderBy("_range")))
        .where(F.col("_range").isNotNull())
        .select("_range", "_last.*", F.lit(True).alias("_copy"))
    )
    both = rows.unionByName(tails, allowMissingColumns=True)
    window = W.partitionBy("_range").orderBy(*order, F.desc("_copy"))
    before = F.lag(F.struct(F.col(key).alias("key"), F.struct(*carry).alias("row"))).over(window)
    return (
        both.withColumn("_before", before)
        .where(~F.col("_copy"))
        .withColumn("prev", F.when(F.col("_before.key").eqNullSafe(F.col(key)), F.col("_before.row")))
        .drop("_range", "_copy", "_before")
    )
