"""RZ: a bucketed count against the mean and deviation of the buckets before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkwatch.functions.times import trunc_like


def rolling_zscore(
    df: DataFrame,
    ts: str,
    *,
    bucket: str = "hour",
    rows: int = 24,
    by: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
    dense: bool = False,
) -> DataFrame:
    """Per bucket: count, mean and deviation of the ``rows`` buckets before.

    The window runs over one row per bucket, so its input is bounded by the
    time span and not by the events. By default the frame covers the previous
    non-empty buckets; ``dense`` first fills empty buckets with zero. ``by``
    keeps several series apart.
    """
    extra = dict(extra or {})
    series = df.groupBy(*by, trunc_like(df, ts, bucket).alias("time_bucket")).agg(
        F.count("*").alias("event_count"), *[c.alias(k) for k, c in extra.items()]
    )
    if dense:
        kind = dict(series.dtypes)["time_bucket"]
        ends = series.groupBy(*by).agg(
            F.min("time_bucket").alias("_lo"), F.max("time_bucket").alias("_hi")
        )
        grid = ends.select(
            *by,
            F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL 1 {bucket}"))).alias("time_bucket"),
        ).withColumn("time_bucket", F.col("time_bucket").cast(kind))
        series = grid.join(series, [*by, "time_bucket"], "left").fillna(0, ["event_count", *extra])
    frame = W.partitionBy(*by).orderBy("time_bucket").rowsBetween(-rows, -1)
    n = F.col("event_count")
    return series.withColumns(
        {
            "baseline_avg": F.avg(n).over(frame),
            "baseline_stddev": F.stddev_samp(n).over(frame),
        }
    ).withColumns(
        {
            "zscore": (n - F.col("baseline_avg")) / F.nullif(F.col("baseline_stddev"), F.lit(0.0)),
            "pct_change": (n - F.col("baseline_avg"))
            / F.nullif(F.col("baseline_avg"), F.lit(0.0))
            * 100,
        }
    )
