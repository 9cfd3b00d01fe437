"""THR: too many events of one group within a time span."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkwatch.functions.times import AsOf, micros, trailing


def threshold(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    min_count: int,
    within: str,
    where: Column | None = None,
    as_of: AsOf = None,
    mode: str = "trailing",
    slide: str | None = None,
    watermark: str | None = None,
    distinct: str | None = None,
    sets: Mapping[str, str] | None = None,
    sketches: Mapping[str, str] | None = None,
    count_as: str = "event_count",
    first_as: str = "first_seen",
    last_as: str = "last_seen",
    distinct_as: str = "distinct_count",
    approx: bool = False,
) -> DataFrame:
    """Groups with at least ``min_count`` events, or distinct values, in a span.

    ``trailing`` looks at the last ``within`` before ``as_of``. ``sliding``
    covers all history with event-time windows of that length, moved by
    ``slide``, and works on streams when ``watermark`` is set. Distinct values
    are counted exactly in both; a stream groups by the value first and counts
    the groups of closed windows, unless ``approx`` asks for an estimate. ``sets``
    names sorted value sets to keep per group; use it for columns of few
    distinct values such as ports or API names. Any number of values is either
    rows of ``threshold_values``, exact, or ``sketches``: binary columns of at most some
    4 KB that ``merged_estimates`` adds up over groups and spans.
    """
    df, groups = _spans(df, keys, ts, within, where, as_of, mode, slide, watermark)
    aggs = [
        F.count("*").alias(count_as),
        F.min(ts).alias(first_as),
        F.max(ts).alias(last_as),
    ]
    level = distinct_as if distinct else count_as
    chained = bool(distinct) and df.isStreaming and not approx
    if chained:
        df, groups = _by_value(df, groups, distinct, aggs, sets, sketches), [F.col(g) for g in _names(keys, mode)]
        aggs = [
            F.sum(count_as).alias(count_as),
            F.min(first_as).alias(first_as),
            F.max(last_as).alias(last_as),
            F.count("_value").alias(distinct_as),
        ]
    elif distinct:
        count = F.approx_count_distinct if approx else F.count_distinct
        aggs.append(count(distinct).alias(distinct_as))
    for name, column in (sets or {}).items():
        # On streams equal sets of several values collapse, as they are sorted.
        found = F.flatten(F.collect_set(name)) if chained else F.collect_set(column)
        aggs.append(F.sort_array(F.array_distinct(found)).alias(name))
    for name, column in (sketches or {}).items():
        aggs.append((F.hll_union_agg(name) if chained else F.hll_sketch_agg(column)).alias(name))

    return _with_span(df.groupBy(*groups).agg(*aggs).where(F.col(level) >= min_count))


def _spans(df, keys, ts, within, where, as_of, mode, slide, watermark=None) -> tuple[DataFrame, list]:
    """The rows that count and what groups them: the keys, and the window of sliding spans."""
    if where is not None:
        df = df.where(where)
    groups: list = [F.col(k) for k in keys]
    if mode == "trailing":
        return df.where(trailing(df, ts, as_of, within)), groups
    if mode != "sliding":
        raise ValueError(f"unknown mode {mode!r}")
    if watermark:
        df = df.withWatermark(ts, watermark)
    span = F.window(ts, within, slide) if slide else F.window(ts, within)
    return df, [*groups, span.alias("_span")]


def _with_span(out: DataFrame) -> DataFrame:
    if "_span" not in out.columns:
        return out
    return out.withColumns({"window_start": F.col("_span.start"), "window_end": F.col("_span.end")}).drop("_span")


def threshold_values(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    *,
    min_count: int,
    within: str,
    where: Column | None = None,
    as_of: AsOf = None,
    mode: str = "trailing",
    slide: str | None = None,
    by: str = "events",
    count_as: str = "event_count",
    first_as: str = "first_seen",
    last_as: str = "last_seen",
) -> DataFrame:
    """AGG-11: the value set of each hit as rows, one per distinct value, with its count and times.

    Groups and spans are those of ``threshold``; ``by`` says whether ``min_count`` is of events or of
    distinct ``values``. Rows are aggregated by group and value, and the totals of groups from such rows too,
    in a second, narrower pass. A group with a million values is a million rows in
    the partitions of its values, and no row holds a list; AQE splits it in the join with its total.
    That join is an inner one, as Catalyst would move a semi-join below the aggregate to the single events.
    A null value counts as an event and is no row of the set. Null keys form a group.
    """
    if by not in ("events", "values"):
        raise ValueError(f"unknown count {by!r}")
    df, groups = _spans(df, keys, ts, within, where, as_of, mode, slide)
    names = _names(keys, mode)
    rows = df.groupBy(*groups, F.col(value).alias("_value")).agg(
        F.count("*").alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    total = F.sum("_n") if by == "events" else F.count("_value")
    hits = rows.groupBy(*names).agg(total.alias("_total")).where(F.col("_total") >= min_count)
    hits = hits.select(*[F.col(n).alias(f"_hit{i}") for i, n in enumerate(names)])
    same = F.lit(True)
    for i, n in enumerate(names):
        same = same & F.col(n).eqNullSafe(F.col(f"_hit{i}"))
    found = rows.where(F.col("_value").isNotNull()).join(hits, same)
    return _with_span(
        found.select(
            *names,
            F.col("_value").alias(value),
            F.col("_n").alias(count_as),
            F.col("_first").alias(first_as),
            F.col("_last").alias(last_as),
        )
    )


def merged_estimates(hits: DataFrame, keys: Sequence[str], sketches: Sequence[str]) -> DataFrame:
    """Estimated distinct counts over all spans of each key, from the sketches of ``threshold``.

    Sketches merge in any order, so those of different runs may be stored and added up later.
    """
    return hits.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(s)).alias(s) for s in sketches])


def _names(keys: Sequence[str], mode: str) -> list[str]:
    return [*keys, "_span"] if mode == "sliding" else list(keys)


def _by_value(df, groups, distinct, aggs, sets, sketches) -> DataFrame:
    """One row per group and distinct value, with what the groups need of it."""
    kept = [F.sort_array(F.collect_set(column)).alias(name) for name, column in (sets or {}).items()]
    kept += [F.hll_sketch_agg(column).alias(name) for name, column in (sketches or {}).items()]
    return df.groupBy(*groups, F.col(distinct).alias("_value")).agg(*aggs, *kept)


def threshold_evidence(
    df: DataFrame,
    hits: DataFrame,
    keys: Sequence[str],
    ts: str,
    first_as: str = "first_seen",
    last_as: str = "last_seen",
    as_of: AsOf = None,
    within: str | None = None,
    bins: str | None = None,
) -> DataFrame:
    """AGG-10: the events behind each hit, one row per event.

    A list of all event times per group would grow without bound in one row;
    this long form holds the same times. Sliding hits keep their window columns, since an
    event may lie in several windows. With the ``within`` and ``as_of`` of trailing hits only
    that span is read.

    Events and spans meet by key and time bin: an event is in one bin, a span in all that it
    touches. So a key with most events and hits is as many join keys as it has bins, and an event is
    compared with the spans of its bin only. ``bins`` is their length, a sixteenth of ``within`` where that is
    given; a span of length s is at most s / ``bins`` + 2 rows, so give ``bins`` near the
    length of sliding windows. Without both the join is by key alone and left to AQE.
    Null keys are a key; null times and hits without span give no rows.
    """
    if within is not None:
        df = df.where(trailing(df, ts, as_of, within))
    window = [c for c in ("window_start", "window_end") if c in hits.columns]
    spans = hits.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        *window,
        F.col(first_as).alias("_from"),
        F.col(last_as).alias("_to"),
    )
    same = F.col(ts).between(F.col("_from"), F.col("_to"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    if bins is not None or within is not None:
        length = _micros_of(bins) if bins is not None else F.greatest(F.floor(_micros_of(within) / 16), F.lit(1))
        number = lambda rows, c: F.floor(micros(rows, c) / length)
        spans = spans.withColumn("_span_bin", F.explode(F.sequence(number(spans, "_from"), number(spans, "_to"))))
        df = df.withColumn("_event_bin", number(df, ts))
        same = same & (F.col("_event_bin") == F.col("_span_bin"))
    return df.join(spans, same).drop("_from", "_to", "_span_bin", "_event_bin", *[f"_{k}" for k in keys])


def _micros_of(length: str) -> Column:
    """An interval in microseconds, which the optimizer folds to a literal."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp")
    return F.unix_micros(start + F.expr(f"INTERVAL {length}")) - F.unix_micros(start)
