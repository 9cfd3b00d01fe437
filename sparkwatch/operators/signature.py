"""SIG: rows that match a known pattern."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def signature(df: DataFrame, where: Column, severity: Column | str, description: Column | str) -> DataFrame:
    """Rows that satisfy ``where`` with a severity and a description."""
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    return df.where(where).withColumns(
        {"severity": as_col(severity), "description": as_col(description)}
    )


def match_all(df: DataFrame, cases: Mapping[str, tuple[Column, Mapping[str, Column]]]) -> DataFrame:
    """Test many signatures in one pass over ``df``.

    ``cases`` maps a name to its predicate and its result columns; all cases
    have the same column names. A row yields one output row per signature it
    matches. Only the number of the matched signature is generated; the result
    columns are chosen by it afterwards, so those nobody reads are pruned.
    """
    tests = [test for test, _ in cases.values()]
    numbers = F.array(*[F.when(test, F.lit(i)) for i, test in enumerate(tests)])
    hits = df.where(reduce(lambda a, b: a | b, tests)).withColumn(
        "_case", F.explode(F.array_compact(numbers))
    )
    columns = [out for _, out in cases.values()]

    def choose(name: str) -> Column:
        picked = columns[-1][name]
        for i in range(len(columns) - 2, -1, -1):
            picked = F.when(F.col("_case") == i, columns[i][name]).otherwise(picked)
        return picked

    return hits.select(*[choose(name).alias(name) for name in columns[0]])
