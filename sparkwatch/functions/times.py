"""Time bounds that keep the type of the filtered column.

A bound of the column's own type stays a literal after constant folding and so
reaches the Parquet reader; casting the column instead would not.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType

AsOf = datetime | str | None


def _type(df: DataFrame, ts: str) -> str:
    return "timestamp_ntz" if isinstance(df.schema[ts].dataType, TimestampNTZType) else "timestamp"


def as_of_bound(df: DataFrame, ts: str, as_of: AsOf, back: str | None = None) -> Column:
    """SCL-03/07: ``as_of`` (now if not given) minus an interval such as ``10 minutes``."""
    kind = _type(df, ts)
    if as_of is None:
        at = F.localtimestamp() if kind == "timestamp_ntz" else F.current_timestamp()
    else:
        at = F.lit(str(as_of)).cast(kind)
    return at - F.expr(f"INTERVAL {back}") if back else at


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970, of a time without zone as its clock shows it.

    Casting that to an instant would change its order where clocks are set.
    """
    t = F.col(ts)
    if _type(df, ts) == "timestamp":
        return F.unix_micros(t)
    second = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
    hours = F.unix_date(t.cast("date")).cast("long") * 24 + F.hour(t)
    return (hours * 60 + F.minute(t)) * 60_000_000 + second


def _day(df: DataFrame, ts: str) -> Column | None:
    """The date partition that goes with a time: ``event_date`` for ``event_time``."""
    name = ts.removesuffix("_time") + "_date"
    return F.col(name) if ts.endswith("_time") and name in df.columns else None


def since(df: DataFrame, ts: str, bound: Column) -> Column:
    """``ts >= bound``, also on the date partition where the table has one.

    A filter on the time alone would open the files of every day. The day is
    taken one too wide, so the partition may have been cut in another time zone.
    """
    day = _day(df, ts)
    test = F.col(ts) >= bound
    return test if day is None else test & (day >= F.date_sub(F.to_date(bound), 1))


def until(df: DataFrame, ts: str, bound: Column) -> Column:
    """``ts <= bound``, also on the date partition where the table has one."""
    day = _day(df, ts)
    test = F.col(ts) <= bound
    return test if day is None else test & (day <= F.date_add(F.to_date(bound), 1))


def between_any(df: DataFrame, ts: str, spans: Sequence[tuple[Column, Column | None]]) -> Column:
    """``ts`` in one of the spans ``[from, to)``, also on the date partition where the table has one.

    The days are a condition of their own, so that they prune partitions.
    """
    day = _day(df, ts)
    tests, days = [], []
    for low, high in spans:
        tests.append(F.col(ts) >= low if high is None else (F.col(ts) >= low) & (F.col(ts) < high))
        if day is not None:
            from_ = day >= F.date_sub(F.to_date(low), 1)
            days.append(from_ if high is None else from_ & (day <= F.date_add(F.to_date(high), 1)) & (low < high))
    any_ = lambda tests: reduce(lambda a, b: a | b, tests)
    return any_(tests) & any_(days) if days else any_(tests)


def trailing(df: DataFrame, ts: str, as_of: AsOf, within: str) -> Column:
    """FLT-11: rows of the last ``within`` up to ``as_of``."""
    return since(df, ts, as_of_bound(df, ts, as_of, within)) & until(df, ts, as_of_bound(df, ts, as_of))


def midnight(df: DataFrame, ts: str, as_of: AsOf) -> Column:
    """FLT-13: start of the day of ``as_of``."""
    return F.date_trunc("day", as_of_bound(df, ts, as_of)).cast(_type(df, ts))


def minutes_between(later: Column, earlier: Column) -> Column:
    """SCL-04: whole seconds between two times, as minutes."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60)


def hour_within(ts: Column | str, start: int, end: int) -> Column:
    """FLT-14: hour in ``start..end``, where the range may pass midnight."""
    hour = F.hour(ts)
    if start <= end:
        return hour.between(start, end)
    return (hour >= start) | (hour <= end)


def trunc_like(df: DataFrame, ts: str, unit: str) -> Column:
    """SCL-05: ``date_trunc`` in the type of the column."""
    return F.date_trunc(unit, F.col(ts)).cast(_type(df, ts))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """AGG-15: share in percent as double, null for an empty whole."""
    return F.round(
        part.cast("double") * F.lit(100.0).cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)),
        digits,
    )
