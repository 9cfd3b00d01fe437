"""BZ: today's activity of an entity against its own daily history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from sparkwatch.functions.times import AsOf, as_of_bound, between_any, midnight, since, trailing, until


def baseline_zscore(
    df: DataFrame,
    key: str,
    ts: str,
    *,
    metrics: Mapping[str, Column],
    as_of: AsOf = None,
    history: str = "30 days",
    gap: str = "1 day",
    today: Mapping[str, Column] | None = None,
    recent_from: str | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Per key: today's value, historic daily mean and deviation, and z-score.

    History is ``[as_of - history, as_of - gap)`` cut into days, today starts
    at midnight of ``as_of`` (or at ``recent_from``). Both come from one scan
    and one grouping by (key, day), where today's rows share the null day; a
    second grouping by key then folds the days. This takes the place of two
    aggregates joined on the key (JN-01, JN-02). ``metrics`` and ``today`` map
    names to aggregate columns; ``today`` ones have no baseline. Keys need rows
    on both sides, and today must not begin before the history ends.

    Deviation and z-score of whole-number metrics, such as counts, come from exact sums. They do not change with
    the order in which partitions are merged, and a score that is 2 or 3 by its definition is not 1.9999.

    ``days`` is a rollup (``DailyRollup.days``) with ``metrics`` by ``key`` and ``event_date``. The whole days
    of the history then come from it, and of the events only today's and those of the two days
    that the history begins and ends within are read.
    """
    start = as_of_bound(df, ts, as_of, history)
    end = as_of_bound(df, ts, as_of, gap)
    now = as_of_bound(df, ts, as_of)
    fresh = (
        midnight(df, ts, as_of)
        if recent_from is None
        else as_of_bound(df, ts, recent_from)
    )
    t = F.col(ts)
    today = today or {}
    span = F.col(key).isNotNull() & since(df, ts, F.least(start, fresh)) & until(df, ts, now)
    if days is None:
        rows = df.where(span & (((t >= start) & (t < end)) | (t >= fresh)))
    else:
        # The history holds the whole days from `first` up to the one before `last`.
        first = F.date_add(F.to_date(start - F.expr("INTERVAL 1 MICROSECOND")), 1)
        last = F.to_date(end)
        kind = df.schema[ts].dataType
        edges = (
            (start, F.least(first.cast(kind), end)),
            (F.greatest(last.cast(kind), first.cast(kind)), end),
            (fresh, None),
        )
        rows = df.where(span & between_any(df, ts, edges))
    daily = rows.groupBy(
        key, F.when(t < fresh, F.to_date(ts)).alias("_day")
    ).agg(
        *[c.alias(name) for name, c in {**metrics, **today}.items()]
    )
    if days is not None:
        whole = days.where((F.col("event_date") >= first) & (F.col("event_date") < last) & F.col(key).isNotNull())
        if "month" in days.columns:
            whole = whole.where((F.col("month") >= F.trunc(first, "month")) & (F.col("month") <= last))
        daily = daily.unionByName(
            whole.select(key, F.col("event_date").alias("_day"), *metrics), allowMissingColumns=True
        )
    past, now_row = F.col("_day").isNotNull(), F.col("_day").isNull()
    whole_numbers = [m for m in metrics if isinstance(daily.schema[m].dataType, IntegralType)]
    exact = {m: F.when(past, F.col(m)).cast("decimal(19,0)") for m in whole_numbers}
    folded = daily.groupBy(key).agg(
        F.count_if(past).alias("_days"),
        F.count_if(now_row).alias("_now"),
        *[F.avg(F.when(past, F.col(m))).alias(f"avg_{m}") for m in metrics],
        *[F.stddev_samp(F.when(past, F.col(m))).alias(f"std_{m}") for m in metrics if m not in exact],
        *[a for m, c in exact.items() for a in _sums(m, c)],
        *[
            F.first(F.when(now_row, F.col(m)), ignorenulls=True).alias(f"today_{m}")
            for m in [*metrics, *today]
        ],
    )
    folded = folded.where((F.col("_days") > 0) & (F.col("_now") > 0))
    if exact:
        folded = folded.withColumns({name: c for m in exact for name, c in _exact_scores(m).items()})
    folded = folded.withColumns(
        {
            f"z_{m}": (F.col(f"today_{m}") - F.col(f"avg_{m}")) / F.nullif(F.col(f"std_{m}"), F.lit(0.0))
            for m in metrics
            if m not in exact
        }
    )
    scores = [f"{p}_{m}" for m in metrics for p in ("avg", "std")]
    return folded.select(key, *scores, *[f"today_{m}" for m in [*metrics, *today]], *[f"z_{m}" for m in metrics])


def _sums(m: str, value: Column) -> list[Column]:
    """Days, sum and sum of squares of a whole number, exact and mergeable."""
    return [
        F.count(value).alias(f"_n_{m}"), F.sum(value).alias(f"_sum_{m}"), F.sum(value * value).alias(f"_squares_{m}"),
    ]


def _exact_scores(m: str) -> dict[str, Column]:
    """Deviation and z-score from the sums of ``_sums``; both are one root of a quotient of whole numbers.

    With n days and sums s and q, the variance is (nq - s^2) / n(n - 1) and z^2 is (nx - s)^2 (n - 1) / n(nq - s^2).
    """
    whole = lambda c: c.cast("decimal(38,0)")
    n, s, q = (whole(F.col(f"_{name}_{m}")) for name in ("n", "sum", "squares"))
    spread = n * q - s * s
    off = n * whole(F.col(f"today_{m}")) - s
    square = (off * off * (n - 1)).cast("double") / F.nullif((n * spread).cast("double"), F.lit(0.0))
    several = F.col(f"_n_{m}") > 1
    return {
        f"std_{m}": F.when(several, F.sqrt(spread.cast("double") / (n * (n - 1)).cast("double"))),
        f"z_{m}": F.when(several, F.signum(off.cast("double")) * F.sqrt(square)),
    }


def user_profile(df: DataFrame, key: str, ts: str, as_of: AsOf = None, history: str = "30 days") -> DataFrame:
    """D-10a: daily login habits of each user, averaged over ``history``.

    Expects the columns of the silver authentication table. Days are grouped
    first and users second (AGG-09).
    """
    hour = F.hour(ts)
    daily = (
        df.where(trailing(df, ts, as_of, history))
        .groupBy(key, F.to_date(ts).alias("login_date"))
        .agg(
            F.count("*").alias("logins"),
            F.count_distinct("source_ip").alias("ips"),
            F.count_distinct("country").alias("countries"),
            F.avg(hour).alias("hour_mean"),
            F.stddev_samp(hour).alias("hour_std"),
            F.count_if(F.col("outcome") == "FAILURE").alias("failures"),
            F.count_if(F.col("outcome") == "SUCCESS").alias("successes"),
        )
    )
    return daily.groupBy(key).agg(
        F.avg("logins").alias("avg_daily_logins"),
        F.stddev_samp("logins").alias("stddev_daily_logins"),
        F.avg("ips").alias("avg_unique_ips"),
        F.stddev_samp("ips").alias("stddev_unique_ips"),
        F.avg("countries").alias("avg_unique_countries"),
        F.avg("hour_mean").alias("typical_login_hour"),
        F.avg("hour_std").alias("login_hour_variability"),
        F.try_divide(
            F.sum("failures").cast("double"),
            F.sum(F.col("successes") + F.col("failures")).cast("double"),
        ).alias("failure_rate"),
    )
