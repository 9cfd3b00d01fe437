"""STR-10 to STR-13: rules and alert writing on unbounded input."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkwatch.operators.alerts import notification_payload
from sparkwatch.operators.sequence import sequence_gap
from sparkwatch.sinks.incidents import IncidentStore
from sparkwatch.sinks.tables import append_alerts


def event_time_stream(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need a timestamp with time zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def enrich_stream(stream: DataFrame, static: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """STR-13: join each micro-batch with a registry or a stored baseline.

    Spark broadcasts the static side when its size allows it and shuffles both
    sides otherwise.
    """
    return stream.join(static, list(on), how)


def dedupe_alerts(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """STR-12: drop repeated alert ids whose events are within ``late``."""
    return stream.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["alert_id"])


def start_alert_writer(
    stream: DataFrame, to_alerts: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
    name: str = "alerts", every: str = "1 minute", available_now: bool = False,
) -> StreamingQuery:
    """STR-12: turn each micro-batch into alerts and add the unseen ones.

    Ids are deterministic, so a batch that is repeated after a failure adds
    nothing twice.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        append_alerts(to_alerts(batch), path)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )


def start_incident_writer(
    stream: DataFrame, to_alerts: Callable[[DataFrame], DataFrame], store: IncidentStore, checkpoint: str,
    name: str = "incidents", every: str = "1 minute", available_now: bool = False,
) -> StreamingQuery:
    """STR-12: chain the hits of each micro-batch with the stored incidents.

    The batch number orders versions, so a batch that is repeated after a failure overwrites
    its own version and nothing is counted twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store.record(to_alerts(batch), batch_id + 1)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )


def start_notifier(
    alerts: DataFrame, send: Callable[[DataFrame, int], None], checkpoint: str, name: str = "notify",
    every: str = "1 minute", available_now: bool = False,
) -> StreamingQuery:
    """SNK-15: hand the payloads of new critical alerts to ``send`` per micro-batch.

    ``send`` gets a DataFrame (alert_id, payload) and the batch number; how the
    messages leave is up to it.
    """
    critical = alerts.where((F.col("severity") == "CRITICAL") & (F.col("status") == "NEW"))
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return (
        notification_payload(critical)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(send)
        .trigger(**trigger)
        .start()
    )


@dataclass(frozen=True)
class SequenceStream:
    """STR-11: ``sequence_gap`` on a stream, with the result of a batch run.

    Rows may arrive up to ``late_seconds`` after newer ones. The edge is the newest time seen less
    that span; what lies before it is complete. Each micro-batch is put together with the rows
    kept below ``state``, the batch operator runs over both, and hits whose later row has come
    to lie before the edge are written, each once, to ``out/batch_id=<n>``. Rows from the edge less
    the gap on are kept. Two folders take turns, so a batch that is repeated after a failure
    finds the state it started from. Rows that arrive later than allowed are left out, as
    behind a watermark; ``flush`` writes the hits after the last edge when a stream has ended.
    """

    key: str
    ts: str
    changed: str
    max_gap_seconds: int
    tiebreak: Sequence[str]
    out: str
    state: str
    carry: Sequence[str] = ()
    late_seconds: int = 86_400
    describe: Callable[[DataFrame], DataFrame] | None = None

    def start(
        self, stream: DataFrame, checkpoint: str, name: str = "sequence", every: str = "1 minute",
        available_now: bool = False,
    ) -> StreamingQuery:
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return (
            stream.writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self._run)
            .trigger(**trigger)
            .start()
        )

    def hits(self, spark: SparkSession) -> DataFrame:
        """All hits written so far."""
        return spark.read.parquet(self.out).drop("batch_id")

    def flush(self, spark: SparkSession) -> None:
        """Write the hits after the last edge; for streams that have ended."""
        slots = [s for s in (0, 1) if self._edge(spark, s) is not None]
        if slots:
            slot = max(slots, key=lambda s: self._edge(spark, s)["batch_id"])
            edge = self._edge(spark, slot)
            rows = spark.read.parquet(f"{self.state}/slot={slot}")
            self._write(rows, edge["edge"], None, edge["batch_id"] + 1)

    def _edge(self, spark: SparkSession, slot: int):
        """Edge and number of the batch that wrote a slot, None before the first."""
        try:
            return spark.read.schema("edge timestamp, batch_id long").parquet(f"{self.state}/edge={slot}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _write(self, rows: DataFrame, after, until, batch_id: int) -> None:
        found = sequence_gap(
            rows, self.key, self.ts, changed=self.changed, max_gap_seconds=self.max_gap_seconds,
            tiebreak=self.tiebreak, carry=self.carry,
        )
        time = F.col(self.ts).cast("timestamp")
        if after is not None:
            found = found.where(time > F.lit(after))
        if until is not None:
            found = found.where(time <= F.lit(until))
        found = self.describe(found) if self.describe else found
        found.write.mode("overwrite").parquet(f"{self.out}/batch_id={batch_id}")

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fields = list(dict.fromkeys([self.key, self.ts, *self.tiebreak, self.changed, *self.carry]))
        time = F.col(self.ts).cast("timestamp")
        last = self._edge(spark, (batch_id - 1) % 2) if batch_id > 0 else None
        before = last["edge"] if last else None
        rows = batch.select(*fields)
        if before is not None:
            rows = rows.where(time > F.lit(before))
        if last is not None:
            rows = rows.unionByName(spark.read.parquet(f"{self.state}/slot={(batch_id - 1) % 2}"))
        rows = rows.persist()
        try:
            newest = rows.agg(F.max(time).alias("t")).first()["t"]
            edge = None if newest is None else newest - timedelta(seconds=self.late_seconds)
            edge = before if edge is None or before is not None and edge < before else edge
            if edge is not None:
                self._write(rows, before, edge, batch_id)
                kept = rows.where(time > F.lit(edge - timedelta(seconds=self.max_gap_seconds + 1)))
            else:
                kept = rows
            kept.write.mode("overwrite").parquet(f"{self.state}/slot={batch_id % 2}")
            mark = spark.createDataFrame([(edge, batch_id)], "edge timestamp, batch_id long")
            mark.write.mode("overwrite").parquet(f"{self.state}/edge={batch_id % 2}")
        finally:
            rows.unpersist()
