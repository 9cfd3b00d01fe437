"""STR-01 to STR-08, SNK-01, SNK-04: start, watch and stop ingestion streams."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sparkwatch.sinks.files import JSON_TIME

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class StreamSpec:
    """One stream: where rows come from, what happens to them, where they go."""

    name: str
    read: Callable[[SparkSession], DataFrame]
    transform: Transform
    out: str
    checkpoint: str
    format: str = "json"
    every: str = "10 seconds"


def write_stream(
    df: DataFrame, name: str, out: str, checkpoint: str, format: str = "json",
    every: str = "10 seconds", available_now: bool = False, partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to files, at an interval or once over what is there."""
    writer = (
        df.writeStream.queryName(name)
        .format(format)
        .option("checkpointLocation", checkpoint)
        .option("path", out)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "json":
        writer = writer.option("timestampFormat", JSON_TIME)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def start_streams(
    spark: SparkSession, specs: Sequence[StreamSpec], available_now: bool = False
) -> tuple[dict[str, StreamingQuery], dict[str, str]]:
    """STR-05: start all streams; a source that cannot start does not stop the rest."""
    started: dict[str, StreamingQuery] = {}
    failed: dict[str, str] = {}
    for s in specs:
        try:
            df = s.transform(s.read(spark))
            started[s.name] = write_stream(df, s.name, s.out, s.checkpoint, s.format, s.every, available_now)
        except Exception as error:  # noqa: BLE001
            failed[s.name] = str(error).splitlines()[0]
    return started, failed


def finish(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait for streams that were started with ``available_now``."""
    for q in queries.values():
        q.awaitTermination()


def stream_status(spark: SparkSession) -> DataFrame:
    """STR-06: one row per active stream with its last progress."""
    rows = []
    for q in spark.streams.active:
        last = q.lastProgress
        rows.append(
            (
                q.name,
                str(q.id),
                q.status["message"],
                int(last["batchId"]) if last else None,
                int(last["numInputRows"]) if last else None,
                float(last["processedRowsPerSecond"]) if last else None,
            )
        )
    return spark.createDataFrame(
        rows, "name string, id string, status string, batch_id long, input_rows long, rows_per_second double"
    )


def stop_streams(spark: SparkSession, names: Sequence[str] | None = None) -> list[str]:
    """STR-07: stop all active streams, or those of the given names, and name them."""
    stopped = []
    for q in spark.streams.active:
        if names is not None and q.name not in names:
            continue
        stopped.append(q.name or str(q.id))
        q.stop()
    return stopped


class ObservedTotals(StreamingQueryListener):
    """STR-09: expectation counts of streams, added up over all their batches.

    A query itself keeps the progress of its last batches only. This listens to every progress
    from the start of the ``with`` block on and counts each batch once. To carry counts over a
    restart, store what ``of`` returns.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.batches: dict[tuple[str, str], dict[int, dict[str, int]]] = {}
        self.ended: set[str] = set()
        self.news = threading.Condition()

    def __enter__(self) -> ObservedTotals:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        with self.news:
            for name, row in progress.observedMetrics.items():
                counts = self.batches.setdefault((str(progress.runId), name), {})
                counts[progress.batchId] = row.asDict()
            self.news.notify_all()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def of(self, query: StreamingQuery, name: str, wait_seconds: float = 60) -> dict[str, int]:
        """The counts named ``name`` of a query; of one that has ended, when all have arrived."""
        run = str(query.runId)
        with self.news:
            if not query.isActive and not self.news.wait_for(lambda: run in self.ended, wait_seconds):
                raise TimeoutError(f"the last counts of {query.name} did not arrive")
            totals: dict[str, int] = {}
            for counts in self.batches.get((run, name), {}).values():
                for k, v in counts.items():
                    totals[k] = totals.get(k, 0) + v
        return totals
