"""STR-11: the previous event of a key as state in Spark's state store.

A micro-batch touches the state of its own keys, and of those whose timer the watermark has passed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructField, StructType

from sparkwatch.operators.sequence import sequence_gap
from sparkwatch.session import DEFAULTS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"



class PreviousEvent(StatefulProcessor):
    """Rows wait in ``pending`` until the watermark has passed them; ``last`` is the row before those.

    One timer per key is set to the earliest pending row. When it expires, rows up to the watermark
    are complete, are paired in their order, and leave. A key without pending rows keeps its last row for the
    longest gap and is then forgotten.
    """

    def __init__(self, kept: StructType, order: Sequence[int], changed: int, gap_seconds: int):
        """``kept`` begins with the time in microseconds; ``order`` and ``changed`` are places in it."""
        self._kept, self._names = kept, kept.names
        self._time, self._order, self._changed, self._gap = 0, list(order), changed, gap_seconds

    def init(self, handle) -> None:
        self._handle = handle
        self._pending = handle.getListState("pending", self._kept)
        self._last = handle.getValueState("last", self._kept)

    def _wake_at(self, micros: int) -> None:
        wanted = micros // 1000
        for timer in self._handle.listTimers():
            if timer <= wanted:
                return
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(max(wanted, 0))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            part = part[self._names].astype(object).where(part[self._names].notna(), None)
            self._pending.appendList(list(part.itertuples(index=False, name=None)))
            self._wake_at(int(part[self._names[self._time]].min()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        edge = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self._pending.get(), key=lambda r: [(r[i] is not None, r[i]) for i in (self._time, *self._order)])
        ready = [r for r in rows if r[self._time] <= edge]
        rest = rows[len(ready) :]
        before, found = self._last.get(), []
        for row in ready:
            if before is not None and before[self._changed] is not None and row[self._changed] is not None:
                gap = row[self._time] // 1_000_000 - before[self._time] // 1_000_000
                if row[self._changed] != before[self._changed] and 0 < gap <= self._gap:
                    found.append((*key, *row, gap, *before))
            before = row
        if rest:
            self._pending.put(rest)
            self._last.clear() if before is None else self._last.update(tuple(before))
            self._handle.registerTimer(rest[0][self._time] // 1000)
        elif before is None or before[self._time] + (self._gap + 1) * 1_000_000 <= edge:
            self._pending.clear()
            self._last.clear()
        else:
            self._pending.clear()
            self._last.update(tuple(before))
            self._handle.registerTimer(before[self._time] // 1000 + (self._gap + 1) * 1000)
        if found:
            names = ["key", *self._names, "gap_seconds", *[f"previous_{c}" for c in self._names]]
            yield pd.DataFrame({c: pd.Series(list(v), dtype=object) for c, v in zip(names, zip(*found), strict=True)})

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class KeyedSequence:
    """``sequence_gap`` on a stream with the previous row of each key in the state store.

    Rows may arrive up to ``late_seconds`` after newer ones; later ones are left out, as behind every
    watermark. A hit comes out when the watermark has passed its row. ``rest`` gives the hits
    that still wait when a stream has ended, read from the state of its checkpoint. Rows without
    key or time are left out; they have no previous row.
    """

    key: str
    ts: str
    changed: str
    max_gap_seconds: int
    tiebreak: Sequence[str]
    carry: Sequence[str] = field(default=())
    late_seconds: int = 86_400

    def _fields(self) -> list[str]:
        return list(dict.fromkeys([*self.tiebreak, self.changed, *self.carry]))

    def _places(self) -> dict[str, str]:
        """Names within the state, where names of any form would not do."""
        return {c: f"f{i}" for i, c in enumerate(self._fields(), 1)}

    def hits(self, stream: DataFrame) -> DataFrame:
        """A stream of hits, to be written in append mode: the columns of ``sequence_gap``."""
        places = self._places()
        rows = stream.where(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull()).withColumn(
            self.ts, F.col(self.ts).cast("timestamp")
        ).withWatermark(self.ts, f"{self.late_seconds} seconds")
        rows = rows.select(
            F.col(self.key).alias("key"), F.col(self.ts).alias("time"), F.unix_micros(self.ts).alias("f0"),
            *[F.col(c).alias(p) for c, p in places.items()],
        )
        kept = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields[2:]])
        previous = [StructField(f"previous_{f.name}", f.dataType) for f in kept.fields]
        gap = StructType.fromDDL("gap_seconds long").fields
        out = StructType([rows.schema["key"], *kept.fields, *gap, *previous])
        at = lambda c: kept.names.index(places[c])
        processor = PreviousEvent(kept, [at(c) for c in self.tiebreak], at(self.changed), self.max_gap_seconds)
        found = rows.groupBy("key").transformWithStateInPandas(processor, out, "append", "eventTime")
        before = list(dict.fromkeys([self.changed, *self.carry]))
        return found.select(
            F.col("key").alias(self.key), F.timestamp_micros("f0").alias(self.ts),
            *[F.col(p).alias(c) for c, p in places.items()], "gap_seconds",
            F.timestamp_micros("previous_f0").alias(f"previous_{self.ts}"),
            *[F.col(f"previous_{places[c]}").alias(f"previous_{c}") for c in before],
        )

    def rest(self, spark: SparkSession, checkpoint: str) -> DataFrame:
        """Hits among the rows that wait in the state of a stream that has ended."""

        def state(name: str) -> DataFrame:
            rows = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
            value = next(c for c in rows.columns if c not in ("key", "partition_id", "expiration_timestamp"))
            return rows.select(
                F.col("key.key").alias(self.key), F.timestamp_micros(f"{value}.f0").alias(self.ts),
                *[F.col(f"{value}.{p}").alias(c) for c, p in self._places().items()],
            )

        pending, last = state("pending"), state("last")
        both = pending.withColumn("_new", F.lit(True)).unionByName(last.withColumn("_new", F.lit(False)))
        found = sequence_gap(
            both, self.key, self.ts, changed=self.changed, max_gap_seconds=self.max_gap_seconds,
            tiebreak=self.tiebreak, carry=self.carry,
        ).where("_new")
        before = list(dict.fromkeys([self.ts, self.changed, *self.carry]))
        return found.select(self.key, self.ts, *self._fields(), "gap_seconds", *[f"previous_{c}" for c in before])

    def start(
        self, stream: DataFrame, out: str, checkpoint: str, name: str = "sequence", every: str = "1 minute",
        available_now: bool = False, describe=None,
    ) -> StreamingQuery:
        """Append the hits to Parquet files below ``out``; the file log makes repeated batches harmless."""
        found = self.hits(stream)
        conf = stream.sparkSession.conf
        # State of this kind needs this provider; a stream keeps the settings it was started with.
        set_before = conf.get(_PROVIDER, None)
        conf.set(_PROVIDER, DEFAULTS[_PROVIDER])
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        try:
            return self._write(describe(found) if describe else found, out, checkpoint, name, trigger)
        finally:
            conf.set(_PROVIDER, set_before) if set_before else conf.unset(_PROVIDER)

    @staticmethod
    def _write(found: DataFrame, out: str, checkpoint: str, name: str, trigger: dict) -> StreamingQuery:
        return (
            found.writeStream.queryName(name)
            .option("checkpointLocation", checkpoint)
            .format("parquet")
            .option("path", out)
            .outputMode("append")
            .trigger(**trigger)
            .start()
        )
