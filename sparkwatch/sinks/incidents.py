"""G-01, SNK-07, STR-12: a versioned store of incidents.

A rule over a moving span finds the same incident again in every run, each time with other counts,
another span and perhaps another severity. The store chains hits of one entity whose spans lie no
further apart than the rule's gap. An incident keeps the id of its first version. Whatever changes is
appended as a new version, nothing is rewritten, and readers see the newest version of each incident.

``log/version=<n>/last_date=<day>``   what run or micro-batch n changed
``closed/last_date=<day>``            newest versions of days that compaction has closed
``marks``                             up to which day and version compaction has come
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from sparkwatch import schemas
from sparkwatch.functions.severity import severity_rank
from sparkwatch.session import written_table

#: Context fields with the last event of a hit, which starts at ``event_time``.
SPAN_ENDS = ("last_failure", "last_connection")


@dataclass(frozen=True)
class Chain:
    """How hits of a rule are chained: the longest gap, and the context fields that name the entity
    beside user, host and address."""

    gap_seconds: int
    identity: tuple[str, ...] = ()


def chains_of(rules) -> dict[str, Chain]:
    """The chains of all rules over a moving span: their period is the gap."""
    return {r.name: Chain(r.alert.period_seconds, tuple(r.alert.identity)) for r in rules if r.alert.period_seconds}


def _columns():
    more = schemas.flat("entity string, first_event timestamp, last_event timestamp, revision int, merged_into string")
    return [*schemas.ALERTS.fields, *more.fields]


def _log_schema():
    return schemas.StructType([*_columns(), *schemas.flat("version long, last_date date").fields])


def newest_versions(rows: DataFrame) -> DataFrame:
    """The row with the highest version of each incident; reduced before the shuffle."""
    top = F.max_by(F.struct(*rows.columns), "version").alias("top")
    return rows.groupBy("alert_id").agg(top).select("top.*")


@dataclass(frozen=True)
class IncidentStore:
    """Incidents below ``path`` of the rules in ``chains``."""

    path: str
    chains: Mapping[str, Chain] = field(default_factory=dict)

    # Reading

    def _read(self, spark: SparkSession, folder: str, schema) -> DataFrame | None:
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _mark(self, spark: SparkSession):
        """Day and version of the last finished compaction, or None."""
        marks = self._read(spark, "marks", schemas.flat("day date, version long"))
        return None if marks is None else marks.orderBy(F.col("version").desc(), F.col("day").desc()).first()

    def _versions(self, spark: SparkSession, since: date | None = None, below: int | None = None) -> DataFrame | None:
        """Newest versions, also of merged incidents, whose last event is on ``since`` or later.

        Last events never move back, so an incident whose newest version lies before ``since`` has all its
        versions there, and partitions before that day need not be read.
        """
        log = self._read(spark, "log", _log_schema())
        if log is None:
            return None
        if below is not None:
            log = log.where(F.col("version") < below)
        mark = self._mark(spark)
        if mark is not None and (below is None or mark["version"] < below):
            log = log.where((F.col("last_date") >= F.lit(mark["day"])) | (F.col("version") > mark["version"]))
            closed = self._read(spark, "closed", _log_schema())
            if closed is not None:  # nothing was closed if there is no folder
                log = log.unionByName(closed.where(F.col("last_date") < F.lit(mark["day"])))
        if since is not None:
            log = log.where(F.col("last_date") >= F.lit(since))
        return newest_versions(log)

    def incidents(self, spark: SparkSession, since: date | None = None) -> DataFrame | None:
        """One row per incident, as it is now; None before the first write.

        With ``since`` only incidents whose last event is on that day or later.
        """
        rows = self._versions(spark, since)
        return None if rows is None else rows.where("merged_into IS NULL")

    def history(self, spark: SparkSession) -> DataFrame | None:
        """All versions of all incidents that the log holds."""
        return self._read(spark, "log", _log_schema())

    # Writing

    def _per_rule(self, value, kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for rule, chain in self.chains.items():
            out = F.when(F.col("detection_rule") == rule, value(chain)).otherwise(out)
        return out

    def _hits(self, alerts: DataFrame) -> DataFrame:
        """Alerts as hits with their entity, span and gap."""
        said = lambda key: F.get_json_object("context", f"$.{key}")
        last = F.coalesce(*[said(k) for k in SPAN_ENDS]).try_cast("timestamp")
        named = lambda chain: F.concat_ws("|", F.lit(""), *[F.coalesce(said(k), F.lit("-")) for k in chain.identity])
        parts = [F.coalesce(F.col(c), F.lit("-")) for c in ("detection_rule", "user", "host", "source_ip")]
        return alerts.where(F.col("detection_rule").isin(*self.chains)).withColumns({
            "entity": F.sha2(F.concat(F.concat_ws("|", *parts), self._per_rule(named, "string")), 256),
            "first_event": F.col("event_time"),
            "last_event": F.greatest("event_time", last),
            "revision": F.lit(0),
            "merged_into": F.lit(None).cast("string"),
        }).where("event_time IS NOT NULL")

    def _chained(self, hits: DataFrame, stored: DataFrame | None) -> DataFrame:
        """The versions that the hits add: new and changed incidents, and those that became part of another.

        Hits and stored incidents of an entity are put in the order of their first events. One begins
        a new incident where it lies further than the gap behind all before it.
        """
        names = [f.name for f in _columns()]
        rows = hits.select(*names, F.lit(False).alias("_old"))
        if stored is not None:
            rows = rows.unionByName(stored.select(*names, F.lit(True).alias("_old")))
        rows = rows.withColumns({
            "_gap": F.make_dt_interval(secs=self._per_rule(lambda c: F.lit(c.gap_seconds), "int")),
            "_rank": severity_rank("severity"),
        })
        order = W.partitionBy("entity").orderBy("first_event", "last_event", "alert_id")
        reached = F.max(F.col("last_event") + F.col("_gap")).over(order.rowsBetween(W.unboundedPreceding, -1))
        rows = rows.withColumn("_apart", F.coalesce(F.col("first_event") > reached, F.lit(False)).cast("int"))
        rows = rows.withColumn("_part", F.sum("_apart").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
        whole = W.partitionBy("entity", "_part")
        over = lambda c: c.over(whole)
        old = lambda c: F.when(F.col("_old"), c)
        strongest = whole.orderBy("_rank", F.col("last_event").desc(), F.col("_old"), "alert_id")
        rows = rows.withColumns({
            "_from": over(F.min("first_event")),
            "_to": over(F.max("last_event")),
            "_own": over(F.min(old(F.struct("first_event", "alert_id", "last_event", "_rank", "revision")))),
            "_best_old": over(F.min(old(F.col("_rank")))),
            "_olds": over(F.count(old(F.lit(1)))),
            "_news": over(F.count(F.when(~F.col("_old"), F.lit(1)))),
            "_top": over(F.min("_rank")),
            "_found": over(F.min("detection_time")),
            "_seen": over(F.max("updated_at")),
            "_place": F.row_number().over(strongest),
        })
        first_id = F.sha2(F.concat_ws("|", "entity", F.date_format("_from", "yyyy-MM-dd HH:mm:ss.SSSSSS")), 256)
        changed = (
            F.col("_own").isNull() | (F.col("_olds") > 1) | (F.col("_top") < F.col("_own._rank"))
            | (F.col("_from") < F.col("_own.first_event")) | (F.col("_to") > F.col("_own.last_event"))
        )
        kept = rows.where((F.col("_place") == 1) & (F.col("_news") > 0) & changed).withColumns({
            "alert_id": F.coalesce(F.col("_own.alert_id"), first_id),
            "event_time": F.col("_from"),
            "first_event": F.col("_from"),
            "last_event": F.col("_to"),
            "detection_time": F.col("_found"),
            "updated_at": F.col("_seen"),
            "revision": F.coalesce(F.col("_own.revision") + 1, F.lit(0)),
        })
        gone = rows.where(F.col("_old") & (F.col("_news") > 0) & (F.col("alert_id") != F.col("_own.alert_id"))).withColumns({
            "merged_into": F.col("_own.alert_id"), "revision": F.col("revision") + 1, "updated_at": F.col("_seen"),
        })
        return kept.select(*names).unionByName(gone.select(*names))

    def record(self, alerts: DataFrame, version: int | None = None) -> int:
        """Chain the alerts of one run with the stored incidents, and append what changed.

        ``version`` orders runs; a stream hands on its batch number, so that a batch that is repeated after a
        failure sees what it saw before and overwrites its own version. Without it the next number is taken.
        Only partitions from the day of the earliest hit less the longest gap on are read. Alerts of
        rules without a chain, or without a time, are not of this store. Returns the version.
        """
        spark = alerts.sparkSession
        if version is None:
            version = 1 + max(self.last_version(spark), 0)
        hits = written_table(self._hits(alerts), "hits")
        first = hits.agg(F.min("first_event").alias("t")).first()["t"]
        gap = timedelta(seconds=max((c.gap_seconds for c in self.chains.values()), default=0))
        # A day more, since the driver's clock may be in another zone than the session.
        since = None if first is None else (first - gap).date() - timedelta(days=1)
        stored = self._versions(spark, since, below=version)
        if stored is not None:
            stored = stored.where("merged_into IS NULL").join(hits.select("entity").distinct(), "entity", "left_semi")
        (
            self._chained(hits, stored)
            .withColumn("last_date", F.to_date("last_event"))
            .hint("rebalance", "last_date")
            .write.mode("overwrite")
            .partitionBy("last_date")
            .parquet(f"{self.path}/log/version={version}")
        )
        return version

    def last_version(self, spark: SparkSession) -> int:
        """The highest version in the log, 0 before the first."""
        log = self._read(spark, "log", _log_schema())
        if log is None:
            return 0
        mark = self._mark(spark)
        done = mark["version"] if mark is not None else 0
        top = log.where(F.col("version") > done).agg(F.max("version")).first()[0]
        return top or done

    def compact(self, spark: SparkSession, before: date) -> None:
        """Close the days before ``before``: their incidents keep their newest version only.

        Closed partitions are overwritten one by one and the mark is written last, so a compaction that fails
        on the way changes nothing for readers and can be repeated. Later hits may still extend a
        closed incident; they are newer than the mark and found in the log.
        """
        top = self.last_version(spark)
        rows = self._versions(spark, below=top + 1)
        if rows is None:
            return
        mark = self._mark(spark)
        day = before if mark is None else max(before, mark["day"])
        rows = written_table(rows.where(F.col("last_date") < F.lit(day)), "closing")
        (
            rows.hint("rebalance", "last_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("last_date")
            .parquet(f"{self.path}/closed")
        )
        mark = spark.createDataFrame([(day, top)], schemas.flat("day date, version long"))
        mark.write.mode("append").parquet(f"{self.path}/marks")
