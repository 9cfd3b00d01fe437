"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwatch.session import written_table


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and all its neighbours as ``m``.

    The minimum is aggregated before it is joined back, so that a node with very many
    edges never needs all of them in one task.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """Per node of the links (a, b): node, component (the smallest node it reaches).

    Each round is written to the shared folder, which ends the lineage there. Nulls and
    loops link nothing. The number of rounds grows with the logarithm of the size; the
    bound only catches an error and raises.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    edges = written_table(edges, "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = _least_neighbour(large)
        small = low.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = written_table(small.where("u <> v").distinct(), "edges")
        after = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if after == before or not after[0]:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    tops = edges.select(F.col("v").alias("u"), "v")
    return edges.unionByName(tops).distinct().select(
        F.col("u").alias("node"), F.col("v").alias("component")
    )
