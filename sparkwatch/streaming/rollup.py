"""D-10, D-12, STR-13: daily baselines that grow with the stream, so that a rule reads days and not events."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sparkwatch import schemas
from sparkwatch.streaming.batches import NumberedTable

_PARTS = schemas.flat("entity string, kind string, value string, n long, event_date date, month date")


@dataclass(frozen=True)
class DailyRollup:
    """Per entity and day: the number of events as ``count`` and exact distinct counts by name.

    ``distinct`` maps names to columns. A micro-batch adds rows (entity, day, kind, value, n): one with
    its events and one for each value of each column. These merge in any order, so late rows and several batches of
    one day need no state, and no set of values is ever one row. ``finish`` folds the days that batches have
    touched since the last time into rows of one per entity and day, as a further version of those days:

    ``<path>``                    the rows of batches (``NumberedTable``)
    ``<path>_days/upto=<n>``      the days touched up to batch n, folded from all batches
    ``<path>_finished/upto=<n>``  written last

    Readers take the newest finished version of a day and fold what came after it themselves, so they are exact
    at any time. Nothing is overwritten but by the repetition of the same step. Rows without entity or time have
    no day and are left out, as by the rules. Tables are partitioned by month.
    """

    path: str
    key: str
    count: str
    distinct: Mapping[str, str] = field(default_factory=dict)
    ts: str = "event_time"

    @property
    def table(self) -> NumberedTable:
        return NumberedTable(self.path, _PARTS, ("month",))

    @property
    def metrics(self) -> list[str]:
        return [self.count, *self.distinct]

    def add(self, batch: DataFrame, number: int) -> None:
        kinds = [F.struct(F.lit(self.count).alias("kind"), F.lit(None).cast("string").alias("value"))] + [
            F.struct(F.lit(name).alias("kind"), F.col(c).cast("string").alias("value"))
            for name, c in self.distinct.items()
        ]
        rows = batch.where(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull()).select(
            F.col(self.key).cast("string").alias("entity"),
            F.to_date(self.ts).alias("event_date"),
            F.explode(F.array(*kinds)).alias("k"),
        )
        counted = (
            rows.where((F.col("k.kind") == self.count) | F.col("k.value").isNotNull())
            .groupBy("entity", "event_date", F.col("k.kind").alias("kind"), F.col("k.value").alias("value"))
            .agg(F.count("*").alias("n"))
        )
        self.table.write(counted.withColumn("month", F.trunc("event_date", "month")), number)

    def start(
        self, stream: DataFrame, checkpoint: str, name: str, every: str = "30 seconds", available_now: bool = False
    ) -> StreamingQuery:
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        columns = dict.fromkeys([self.key, self.ts, *self.distinct.values()])
        return (
            stream.select(*columns).writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.add)
            .trigger(**trigger)
            .start()
        )

    def _fold(self, parts: DataFrame) -> DataFrame:
        # One row per value first, so that distinct counts are plain counts.
        values = parts.groupBy("entity", "event_date", "kind", "value").agg(F.sum("n").alias("n"))
        return values.groupBy("entity", "event_date").agg(
            F.sum(F.when(F.col("kind") == self.count, F.col("n"))).alias(self.count),
            *[F.count_if(F.col("kind") == name).alias(name) for name in self.distinct],
        )

    def _parts(self, spark: SparkSession) -> DataFrame:
        return self.table.numbered(spark)

    def _last(self, spark: SparkSession, folder: str, column: str) -> int:
        try:
            marks = spark.read.schema(f"at timestamp, {column} long").parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1
        return marks.agg(F.max(column)).first()[0]

    def _open(self, spark: SparkSession, mark: int) -> tuple[DataFrame, DataFrame]:
        """The days touched after the mark, a row each, and the rows of those days from all batches."""
        parts = self._parts(spark)
        touched = parts.where(F.col("batch_id") > mark).select("month", "event_date").distinct()
        return touched, parts.join(F.broadcast(touched), ["month", "event_date"], "left_semi")

    def finish(self, spark: SparkSession) -> int:
        """Fold all days that changed since the last call; the number of the last batch that is in them."""
        mark = self._last(spark, f"{self.path}_finished", "upto")
        last = self._last(spark, f"{self.path}_commits", "batch_id")
        if last > mark:
            _, parts = self._open(spark, mark)
            days = self._fold(parts).withColumn("month", F.trunc("event_date", "month"))
            days.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(
                f"{self.path}_days/upto={last}"
            )
            spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(
                f"{self.path}_finished/upto={last}"
            )
        return last

    def days(self, spark: SparkSession) -> DataFrame:
        """``key``, ``event_date``, ``month`` and the metrics, exact for all batches committed by now."""
        mark = self._last(spark, f"{self.path}_finished", "upto")
        touched, parts = self._open(spark, mark)
        names = ["entity", "event_date", "month", *self.metrics]
        out = self._fold(parts).withColumn("month", F.trunc("event_date", "month")).select(*names)
        if mark >= 0:
            numbers = ", ".join(f"`{m}` long" for m in self.metrics)
            schema = StructType.fromDDL(f"entity string, event_date date, {numbers}, upto long, month date")
            stored = spark.read.schema(schema).parquet(f"{self.path}_days").where(F.col("upto") <= mark)
            day = ["month", "event_date"]
            newest = stored.groupBy(*day).agg(F.max("upto").alias("upto")).join(F.broadcast(touched), day, "left_anti")
            out = out.unionByName(stored.join(F.broadcast(newest), [*day, "upto"], "left_semi").select(*names))
        return out.withColumnRenamed("entity", self.key)
