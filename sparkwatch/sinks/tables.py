"""SNK-05 to SNK-07, SNK-10, SNK-11: the alert store and managed tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from sparkwatch import schemas
from sparkwatch.functions.severity import severity_rank
from sparkwatch.session import written_table


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """SNK-05, SNK-06: managed Parquet table."""
    df.write.mode(mode).partitionBy(*partition_by).format("parquet").saveAsTable(name)


def _stored_schema():
    days = schemas.flat("detection_date date, event_date date")
    return schemas.StructType([*schemas.ALERTS.fields, *days.fields])


def read_alerts(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored alerts with their partition columns, or None before the first write."""
    try:
        return spark.read.schema(_stored_schema()).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stored_between(stored: DataFrame, first, last) -> DataFrame:
    """Stored alerts whose events lie on the given days or have no time; prunes partitions."""
    day = F.col("event_date")
    return stored.where(day.isNull() | day.between(F.lit(first), F.lit(last)))


#: Context fields with the last event of a hit, which starts at ``event_time``.
SPAN_ENDS = ("last_failure", "last_connection")


def _with_spans(alerts: DataFrame) -> DataFrame:
    """``_root``, the id that the rule gave, and the span of events. Without a last event it is all time."""
    said = lambda *keys: F.coalesce(*[F.get_json_object("context", f"$.{k}") for k in keys])
    last = F.greatest(said("incident_to", *SPAN_ENDS).try_cast("timestamp"), "event_time")
    spanned = said(*SPAN_ENDS).isNotNull()
    first = F.coalesce(said("incident_from").try_cast("timestamp"), "event_time")
    return alerts.withColumns({
        "_root": F.coalesce(said("incident_of"), "alert_id"),
        "_first": F.when(spanned, first).otherwise(F.lit("1970-01-01").cast("timestamp")),
        "_last": F.when(spanned, last).otherwise(F.lit("9999-01-01").cast("timestamp")),
    })


def _new_incidents(fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
    """One alert, the most severe, of each incident that has no stored alert.

    Hits of one id belong to one incident where their spans of events overlap, directly or
    through others. An incident beside another one of the same id gets an id of its own, and
    its context names the first one. Times in contexts are milliseconds.
    """
    spans = fresh.withColumn("_old", F.lit(False))
    if stored is not None:
        old = _with_spans(stored).select("_root", "_first", "_last", F.lit(True).alias("_old"))
        old = old.join(fresh.select("_root").distinct(), "_root", "left_semi")
        spans = spans.unionByName(old, allowMissingColumns=True)
    in_order = W.partitionBy("_root").orderBy("_first", "_last")
    before = F.max("_last").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    apart = F.coalesce(F.col("_first") > before + F.expr("INTERVAL '0.001' SECOND"), F.lit(False))
    spans = spans.withColumn("_apart", apart.cast("int")).withColumn(
        "_part", F.sum("_apart").over(in_order.rowsBetween(W.unboundedPreceding, 0))
    )
    whole = W.partitionBy("_root", "_part")
    best = whole.orderBy("_old", severity_rank("severity"), F.col("_last").desc(), "_first")
    spans = spans.withColumns({
        "_known": F.max("_old").over(W.partitionBy("_root")),
        "_seen": F.max("_old").over(whole),
        "_from": F.min("_first").over(whole),
        "_to": F.max("_last").over(whole),
        "_place": F.row_number().over(best),
    }).where(~F.col("_seen") & (F.col("_place") == 1))
    other = F.col("_known") | (F.col("_part") > 0)
    wider = (F.col("_from") < F.col("_first")) | (F.col("_to") > F.col("_last"))
    shown = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    more = F.to_json(F.struct(
        F.when(other, F.col("_root")).alias("incident_of"),
        F.when(wider, shown("_from")).alias("incident_from"),
        F.when(wider, shown("_to")).alias("incident_to"),
    ))
    joined = F.concat(F.expr("left(context, length(context) - 1)"), F.lit(","), F.substring(more, 2, 1 << 20))
    return spans.select(
        *[
            {
                "alert_id": F.when(other, F.sha2(F.concat_ws("|", "_root", shown("_from")), 256)).otherwise(F.col(c)),
                "context": F.when(other | wider, joined).otherwise(F.col(c)),
            }.get(c, F.col(c)).alias(c)
            for c in fresh.columns
            if not c.startswith("_")
        ]
    )


def append_alerts(alerts: DataFrame, path: str) -> None:
    """SNK-07: add alerts of incidents that are not stored yet.

    The store is partitioned by detection date, the column reports filter on, and event date.
    The new alerts are written to the shared folder once; the days of their events are
    literals in the look-up of stored ids, so only partitions of those days are read and not
    the whole store. An id belongs to one day, since periods in ids do not cross midnight.
    A stored alert keeps its count and severity when its incident goes on.
    Rows are clustered by date before the write, so a partition gets few files, and
    a date with most of the rows is split by AQE.
    """
    fresh = _with_spans(alerts.withColumn("event_date", F.to_date("event_time")))
    fresh = written_table(fresh.dropDuplicates(["alert_id", "_first", "_last"]), "alerts")
    stored = read_alerts(alerts.sparkSession, path)
    if stored is not None:
        days = fresh.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
        stored = stored_between(stored, days["first"], days["last"])
    (
        _new_incidents(fresh, stored)
        .withColumn("detection_date", F.to_date("detection_time"))
        .hint("rebalance", "detection_date", "event_date")
        .write.mode("append")
        .partitionBy("detection_date", "event_date")
        .parquet(path)
    )


def append_status(events: DataFrame, path: str) -> None:
    """SNK-10: triage entries are only ever appended; the log is the change feed."""
    events.select(*[f.name for f in schemas.STATUS_EVENTS.fields]).write.mode("append").parquet(path)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STATUS_EVENTS).parquet(path)


def write_sorted(df: DataFrame, path: str, ts: str = "event_time", mode: str = "overwrite") -> None:
    """SNK-11: date partitions with rows in time order, for min/max skipping.

    Range partitioning on the full time splits a busy day over several tasks.
    """
    (
        df.withColumn("event_date", F.to_date(ts))
        .repartitionByRange("event_date", ts)
        .sortWithinPartitions("event_date", ts)
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )
