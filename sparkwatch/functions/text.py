"""Predicates and messages over text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(text: Column | str, parts: Sequence[str], ignore_case: bool = False) -> Column:
    """FLT-04/05: true if any part occurs in the text."""
    c = F.lower(_col(text)) if ignore_case else _col(text)
    return reduce(lambda a, b: a | b, [c.contains(p) for p in parts])


def starts_with_any(text: Column | str, parts: Sequence[str]) -> Column:
    """FLT-06: true if the text starts with any of the parts."""
    c = _col(text)
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in parts])


def first_match(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """PRJ-09: text of the first case that holds."""
    result = None
    for test, text in cases:
        result = F.when(test, text) if result is None else result.when(test, text)
    return F.lit(default) if result is None else result.otherwise(default)


def sentence(*parts: Column | str) -> Column:
    """SCL-02: join texts and values; a missing value reads ``unknown``.

    Plain strings are taken as text. A null part would otherwise make the
    whole message null.
    """
    done = [
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("unknown"))
        for p in parts
    ]
    return F.concat(*done)


def or_else(first: Column, second: Column) -> Column:
    """SCL-10: ``second`` where ``first`` is null or empty."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def base_name(path: Column) -> Column:
    """File name of a Windows or Unix path."""
    return F.regexp_extract(path, r"([^\\/]*)$", 1)


def to_int(text: Column) -> Column:
    """SCL-18: decimal or ``0x`` text to int, null if it is neither.

    Text is checked before the cast: a failed cast costs an exception per row.
    """
    value = F.trim(text.cast("string"))
    number = F.when(value.rlike(r"^[+-]?[0-9]{1,18}(\.[0-9]*)?$"), value).when(
        value.rlike(r"^0[xX][0-9A-Fa-f]{1,16}$"), F.conv(F.substring(value, 3, 16), 16, 10)
    )
    return number.try_cast("double").try_cast("int")
