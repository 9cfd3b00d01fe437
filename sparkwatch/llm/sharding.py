"""Shards by jump consistent hashing.

A key's shard follows from the key and the number of shards alone. The generator below visits the
shard counts at which the key would move, in rising order, and stops at the last one below
the number of shards. Going from n to n + 1 shards therefore moves only the keys whose next jump
is to shard n, about one in n + 1, and all of those to the new shard.

Spark's longs raise an error on overflow, so the 64-bit generator runs on three limbs of 22, 22
and 20 bits, whose products fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwatch.session import written_table

#: The multiplier of the published algorithm's generator (a fixed value).
MULTIPLIER = 2862933555777941757
_LIMB, _TOP = (1 << 22) - 1, (1 << 20) - 1


def _next_limbs(low: Column, mid: Column, high: Column) -> tuple[Column, Column, Column]:
    """The limbs of key * MULTIPLIER + 1 modulo 2^64."""
    m = [MULTIPLIER & _LIMB, (MULTIPLIER >> 22) & _LIMB, MULTIPLIER >> 44]
    a = low * m[0] + 1
    b = low * m[1] + mid * m[0] + F.shiftright(a, 22)
    c = low * m[2] + mid * m[1] + high * m[0] + F.shiftright(b, 22)
    return a.bitwiseAND(_LIMB), b.bitwiseAND(_LIMB), c.bitwiseAND(_TOP)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a long key. A null key has the shard of 0."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.lit(0).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("jump"),
        key.bitwiseAND(_LIMB).alias("low"),
        F.shiftright(key, 22).bitwiseAND(_LIMB).alias("mid"),
        F.shiftright(key, 44).bitwiseAND(_TOP).alias("high"),
    )

    def step(state: Column, _: Column) -> Column:
        low, mid, high = _next_limbs(state["low"], state["mid"], state["high"])
        top = F.shiftleft(high, 11) + F.shiftright(mid, 11)  # the upper 31 bits
        jump = F.floor((state["jump"] + 1) * (F.lit(float(1 << 31)) / (top + 1).cast("double")))
        moved = F.struct(
            state["jump"].alias("shard"), jump.cast("long").alias("jump"),
            low.alias("low"), mid.alias("mid"), high.alias("high"),
        )
        return F.when(state["jump"] < shards, moved).otherwise(state)

    # Each jump goes up by one at least, so there are never more of them than shards.
    turns = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(turns, start, step, lambda s: s["shard"].cast("int"))


def sharded(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 length plus 1; a null text is an empty one. The law is ``key``:
    doc_id and the number of shards decide, and ``grown_shard`` is the shard with one more. Slots
    count the rows of a shard from 0 without gaps, by doc_id, checksum and size; rows equal in all
    of these are interchangeable. Rows without doc_id come first in the shard of key 0. Other
    columns are not read.

    Rows are dealt by ranges of (shard, doc_id, ...) with a random last key, so a doc_id that a
    third of the rows repeat is spread over several ranges. A range knows the rows before it in
    its shard from a table with one row for each range and shard; no window runs over rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumns(
        {"shard": jump_shard(F.col("doc_id"), shards), "grown_shard": jump_shard(F.col("doc_id"), shards + 1)}
    )
    order = ["shard", "doc_id", "text_crc32", "size"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("salt", F.rand(11)).repartitionByRange(parts, *order, "salt")
    placed = salted.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = written_table(placed.drop("salt").withColumn("part", F.shiftright("place", 33)), "shards")
    runs = placed.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    found = placed.join(runs.drop("n"), ["shard", "part"])
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("place") - F.col("least") + F.col("before")).alias("slot"), "grown_shard",
    )
