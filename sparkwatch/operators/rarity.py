"""RAR: recent events whose item was seen only a few times in the history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from sparkwatch.functions.times import AsOf, trailing

# Most frequent items removed ahead of the join; none of them is rare.
FREQUENT_ITEMS = 1000


def rarity(
    df: DataFrame,
    item: str,
    ts: str,
    *,
    as_of: AsOf = None,
    history: str = "30 days",
    recent: str = "1 day",
    steps: Sequence[int] = (5, 20, 100),
) -> DataFrame:
    """Events of the last ``recent`` whose item is very rare or rare.

    Adds ``historical_count``, ``rarity_category`` and ``rarity_percentile``,
    the latter equal to PERCENT_RANK over all items by count (WIN-02). The rank
    of a rare count only needs the number of items with a smaller count, so a
    histogram of at most ``steps[1] + 1`` rows takes the place of a global
    window. A frequent item cannot be rare, hence the top of the frequency
    table is dropped from the events before they are shuffled for the join.
    """
    very_rare, rare, _ = steps
    counts = (
        df.where(F.col(item).isNotNull())
        .where(trailing(df, ts, as_of, history))
        .groupBy(item)
        .agg(F.count("*").alias("historical_count"))
    )
    n = F.col("historical_count")
    fewer = W.orderBy("_level").rowsBetween(W.unboundedPreceding, -1)
    ranks = (
        counts.groupBy(F.least(n, F.lit(rare + 1)).alias("_level"))
        .agg(F.count("*").alias("_items"))
        .withColumn("_below", F.coalesce(F.sum("_items").over(fewer), F.lit(0)))
        .withColumn("_all", F.sum("_items").over(W.partitionBy()))
        .where(F.col("_level") <= rare)
        .select(
            "_level",
            F.when(F.col("_all") > 1, F.col("_below") / (F.col("_all") - 1))
            .otherwise(0.0)
            .alias("rarity_percentile"),
        )
    )
    scarce = (
        counts.where(n <= rare)
        .join(F.broadcast(ranks), n == F.col("_level"))
        .drop("_level")
        .withColumn("rarity_category", F.when(n <= very_rare, "VERY_RARE").otherwise("RARE"))
    )
    frequent = counts.orderBy(n.desc()).limit(FREQUENT_ITEMS).where(n > rare).select(item)
    events = df.where(trailing(df, ts, as_of, recent)).join(
        F.broadcast(frequent), item, "left_anti"
    )
    return events.join(scarce, item)


def rarity_table(df: DataFrame, item: str, ts: str, *, as_of: AsOf = None, history: str = "30 days",
                 steps: Sequence[int] = (5, 20, 100)) -> DataFrame:
    """Frequency, span and category of every item in the history."""
    very_rare, rare, uncommon = steps
    n = F.col("execution_count")
    return (
        df.where(trailing(df, ts, as_of, history))
        .groupBy(item)
        .agg(
            F.count("*").alias("execution_count"),
            F.count_distinct("host").alias("host_count"),
            F.count_distinct("user").alias("user_count"),
            F.min(ts).alias("first_seen"),
            F.max(ts).alias("last_seen"),
        )
        .withColumn(
            "rarity_category",
            F.when(n <= very_rare, "VERY_RARE")
            .when(n <= rare, "RARE")
            .when(n <= uncommon, "UNCOMMON")
            .otherwise("COMMON"),
        )
    )
