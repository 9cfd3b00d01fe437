"""SNK-04, STR-09: tables written by micro-batch number, with their expectation counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sparkwatch import schemas
from sparkwatch.operators.quality import expectation_totals

_COUNT = schemas.flat("metric string, value long")


@dataclass(frozen=True)
class NumberedTable:
    """A table to which each micro-batch adds what its number says.

    ``<path>/batch_id=<n>``          the rows of batch n, by ``partition_by``
    ``<path>_counts/batch_id=<n>``   what its expectations counted, over all rows of the batch
    ``<path>_commits/batch_id=<n>``  written last

    A batch that is repeated after a failure overwrites its own folders and so adds nothing twice, and
    readers see committed batches only. Rows are rebalanced by the partition columns before the write: AQE
    splits a value that holds most of a batch over several tasks and joins small ones, so
    that neither a hot day is one task nor every task writes a file per day. ``keep`` is applied after the
    expectations have seen the rows.
    """

    path: str
    schema: StructType
    partition_by: Sequence[str] = ()
    rules: Mapping[str, str] = field(default_factory=dict)
    keep: str = "true"

    def write(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(self.keep).select(*self.schema.names)
        if self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        writer = rows.write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/batch_id={number}")
        # A pass of its own over the columns of the rules: metrics observed on the write are lost where
        # adaptive execution finds that nothing is left of a batch. Without rules all that was written counts, and
        # a batch that comes from an aggregate is not computed again.
        whole = not self.rules and self.keep == "true"
        seen = spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={number}") if whole else batch
        counts = expectation_totals(seen, self.rules)
        counts.write.mode("overwrite").parquet(f"{self.path}_counts/batch_id={number}")
        spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(
            f"{self.path}_commits/batch_id={number}"
        )

    def start(
        self, stream: DataFrame, checkpoint: str, name: str, every: str = "30 seconds", available_now: bool = False
    ) -> StreamingQuery:
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return (
            stream.writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.write)
            .trigger(**trigger)
            .start()
        )

    def _numbered(self, spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
        """The committed part of a folder, without rows before the first commit."""
        whole = StructType([*schema.fields, *schemas.flat("batch_id long").fields])
        try:
            done = spark.read.schema("at timestamp, batch_id long").parquet(f"{self.path}_commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], whole)
        # Batches are committed one after the other.
        last = done.agg(F.max("batch_id")).first()[0]
        return spark.read.schema(whole).parquet(folder).where(F.col("batch_id") <= F.lit(last))

    def numbered(self, spark: SparkSession) -> DataFrame:
        """The rows with the number of their batch."""
        return self._numbered(spark, self.path, self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.numbered(spark).drop("batch_id")

    def counts(self, spark: SparkSession) -> DataFrame:
        """STR-09: the counts of all batches since the table began, whatever was restarted in between."""
        return self._numbered(spark, f"{self.path}_counts", _COUNT).groupBy("metric").agg(F.sum("value").alias("value"))
