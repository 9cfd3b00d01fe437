"""The given tables as streams: normalising, rules with state, alert writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwatch import schemas
from sparkwatch.operators import normalize as N
from sparkwatch.operators import silver
from sparkwatch.operators.alerts import consolidate
from sparkwatch.operators.quality import expect
from sparkwatch.operators.threshold import threshold
from sparkwatch.plans import pipeline, rules
from sparkwatch.plans.detection import run_detections, validate_rules
from sparkwatch.session import scratch_path, written_table
from sparkwatch.sinks.tables import read_alerts
from sparkwatch.sources import files, tables
from sparkwatch.streaming.batches import NumberedTable
from sparkwatch.streaming.keyed import KeyedSequence
from sparkwatch.streaming.rollup import DailyRollup
from sparkwatch.streaming import manage
from sparkwatch.streaming import rules as stream_rules
from suite import detection as D
from suite import telemetry as T
from suite.alerts import over_found
from suite.detection import TRAVEL
from suite.ingest import _CLOUD_COLS, _SYSMON_COLS, _SYSMON_SQL, NRM_CLOUDTRAIL, cloud_files, sysmon_xml
from suite.telemetry import load, plain, shown, sql


def table_stream(spark, sf, name):
    """One of the given tables as a stream, be it a file or a folder of parts."""
    return tables.table_stream(spark, f"{sf}/{name}.parquet", load(spark, sf, name).schema)


def stream_normalize(spark, sf):
    """Gzip event XML files through a stream into JSON files. A gzip file is read by one task, so its rows are bounded."""
    root = scratch_path(spark, "stream-xml")
    xml = sysmon_xml(spark, sf).select("value")
    xml.write.option("maxRecordsPerFile", 50_000).text(f"{root}/in", compression="gzip")
    spec = manage.StreamSpec(
        "sysmon", lambda s: files.read_event_xml(s, f"{root}/in", stream=True, glob="*.txt.gz"), N.normalize_sysmon_raw,
        f"{root}/out", f"{root}/checkpoint",
    )
    started, failed = manage.start_streams(spark, [spec], available_now=True)
    if failed:
        raise RuntimeError(str(failed))
    manage.finish(started)
    return plain(spark.read.schema(schemas.SYSMON).json(f"{root}/out").select(*_SYSMON_COLS))


def stream_cloudtrail(spark, sf):
    """Gzip delivery files with nested records in folders by region, as a stream."""
    root = scratch_path(spark, "stream-cloud")
    lines = cloud_files(spark, sf).select(F.to_json(F.struct("Records")).alias("value"), F.lit("eu").alias("region"))
    lines.write.option("compression", "gzip").partitionBy("region").text(f"{root}/in")
    read = lambda s: files.read_json(s, f"{root}/in", schemas.RAW_CLOUDTRAIL_FILE, stream=True, recursive=True)
    spec = manage.StreamSpec("cloudtrail", read, N.normalize_cloudtrail_raw, f"{root}/out", f"{root}/checkpoint")
    started, failed = manage.start_streams(spark, [spec], available_now=True)
    if failed:
        raise RuntimeError(str(failed))
    manage.finish(started)
    return plain(spark.read.schema(schemas.CLOUDTRAIL).json(f"{root}/out").select(*_CLOUD_COLS))


def stream_threshold(spark, sf):
    """Tumbling windows closed by the watermark."""
    root = scratch_path(spark, "stream-threshold")
    rows = stream_rules.event_time_stream(table_stream(spark, sf, "events"), "ts").where(F.col("event_type") == "error")
    hits = threshold(rows, ["user_id"], "ts", within="1 day", min_count=2, mode="sliding", watermark="1 hour")
    q = manage.write_stream(hits, "threshold", f"{root}/out", f"{root}/checkpoint", "parquet", available_now=True)
    q.awaitTermination()
    return plain(spark.read.schema(hits.schema).parquet(f"{root}/out"))


STREAM_THRESHOLD = f"""SELECT user_id, count(*) AS event_count, {shown('min(ts)')} AS first_seen,
  {shown('max(ts)')} AS last_seen, {shown("date_trunc('day', ts)")} AS window_start,
  {shown("date_trunc('day', ts) + INTERVAL 1 DAY")} AS window_end
FROM events WHERE event_type = 'error' GROUP BY user_id, date_trunc('day', ts)
HAVING count(*) >= 2 AND date_trunc('day', ts) + INTERVAL 1 DAY
  <= (SELECT max(ts) FROM events WHERE event_type = 'error') - INTERVAL 1 HOUR"""


def stream_threshold_distinct(spark, sf):
    """Distinct values per window of a stream, counted exactly."""
    root = scratch_path(spark, "stream-distinct")
    rows = stream_rules.event_time_stream(table_stream(spark, sf, "events"), "ts")
    hits = threshold(
        rows, ["user_id"], "ts", within="2 days", min_count=2, mode="sliding", watermark="1 hour", distinct="event_type",
        sets={"types": "event_type"},
    )
    q = manage.write_stream(hits, "distinct", f"{root}/out", f"{root}/checkpoint", "parquet", available_now=True)
    q.awaitTermination()
    return plain(spark.read.schema(hits.schema).parquet(f"{root}/out"))


STREAM_DISTINCT = f"""WITH w AS (SELECT *, time_bucket(INTERVAL 2 DAY, ts, TIMESTAMP '1970-01-01') AS s FROM events)
SELECT user_id, count(*) AS event_count, {shown('min(ts)')} AS first_seen, {shown('max(ts)')} AS last_seen,
  count(DISTINCT event_type) AS distinct_count, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types,
  {shown('s')} AS window_start, {shown('s + INTERVAL 2 DAY')} AS window_end
FROM w GROUP BY user_id, s HAVING count(DISTINCT event_type) >= 2
  AND s + INTERVAL 2 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""


def stream_travel(spark, sf):
    """Impossible travel with the last login per user as state."""
    root = scratch_path(spark, "stream-travel")
    logins = T.okta_stream(table_stream(spark, sf, "events")).where(
        (F.col("outcome") == "SUCCESS") & F.col("country").isNotNull()
    )
    sequence = KeyedSequence(
        "user_email", "event_time", changed="country", max_gap_seconds=3600, tiebreak=("event_id",),
        carry=("city", "source_ip"),
    )
    sequence.start(
        logins, f"{root}/out", f"{root}/checkpoint", available_now=True, describe=rules.describe_travel
    ).awaitTermination()
    waiting = rules.describe_travel(sequence.rest(spark, f"{root}/checkpoint"))
    return plain(spark.read.schema(waiting.schema).parquet(f"{root}/out").unionByName(waiting))


def delivered(rows, path):
    """Raw rows as gzip JSON lines, as logs are delivered. Such a file is read by one task, so its rows are bounded."""
    rows.write.option("maxRecordsPerFile", 200_000).json(path, compression="gzip")


def stream_pipeline(spark, sf):
    """Raw files of seven years through bronze and silver streams, with expectations."""
    root = scratch_path(spark, "stream-pipeline")
    raw = T.raw_okta(spark, sf)
    delivered(raw.withColumn("published", F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), f"{root}/okta")
    delivered(T.raw_network(spark, sf), f"{root}/sysmon")
    pipeline.run_pipeline(spark, {"okta": f"{root}/okta", "sysmon": f"{root}/sysmon"}, f"{root}/tables")
    out = []
    for name in ("okta_auth", "sysmon_network"):
        rows = spark.read.schema(schemas.SILVER[name]).parquet(f"{root}/tables/{name}")
        out.append(
            rows.groupBy("log_source", "event_category").agg(
                F.count("*").alias("n"), F.min("event_time").alias("first_event"), F.max("event_time").alias("last_event")
            )
        )
    return plain(out[0].unionByName(out[1]))


STREAM_PIPELINE = sql(
    " UNION ALL ".join(
        f"""SELECT log_source, event_category, count(*) AS n, {shown('min(event_time)')} AS first_event,
  {shown('max(event_time)')} AS last_event FROM {view} GROUP BY ALL"""
        for view in ("okta", "network")
    ),
    "okta",
    "network",
)


def written_pipeline(spark, sf, network=False, whole=False):
    """All four raw sources as JSON files, through bronze and silver streams. With ``whole`` every row of the
    tables is in each source made from it, network connections included."""
    root = scratch_path(spark, "stream-all")
    time = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    hosts = T.raw_process(spark, sf).unionByName(T.raw_registry(spark, sf, whole), allowMissingColumns=True)
    if network or whole:
        hosts = hosts.unionByName(T.raw_network(spark, sf), allowMissingColumns=True)
    raw = {
        "okta": (T.raw_okta(spark, sf), "published"),
        "windows": (T.raw_windows(spark, sf), "TimeCreated"),
        "cloudtrail": (T.raw_cloudtrail(spark, sf), "eventTime"),
        "sysmon": (hosts, "EventTime"),
    }
    for name, (rows, ts) in raw.items():
        delivered(rows.withColumn(ts, time(ts)), f"{root}/{name}")
    pipeline.run_pipeline(spark, {n: f"{root}/{n}" for n in raw}, f"{root}/tables", numbered=True)
    return pipeline.read_silver(spark, f"{root}/tables", numbered=True)


def bronze_growing(spark, sf):
    """Three deliveries of API logs, each by a start of the pipeline of its own: the declared format; one with a
    number, a structure and a nested field more; one where the number has a fraction, the structure
    is a text, a declared text is a structure and some lines are broken. All rows in the schema known at the end."""
    root = scratch_path(spark, "stream-grown")
    number = F.col("uuid").cast("long")
    part, n = number % 3, number % 50
    rows = T.raw_okta(spark, sf).withColumn("published", F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    second = rows.withColumns({
        "riskScore": n, "device": F.struct(F.lit("linux").alias("os")),
        "actor": F.col("actor").withField("rank", n),
    })
    third = rows.withColumns({
        "riskScore": n + 0.5, "device": F.lit("mac"), "severity": F.struct(n.alias("level")),
    })
    for i, format_ in enumerate((rows, second, third)):
        line = F.to_json(F.struct(*format_.columns))
        if i == 2:
            line = F.when(n == 7, F.concat(F.lit("{"), "uuid")).otherwise(line)
        format_.where(part == i).select(line.alias("value")).write.mode("append").text(f"{root}/okta")
        pipeline.run_pipeline(spark, {"okta": f"{root}/okta"}, f"{root}/tables", rescue=True)
    return pipeline.read_bronze(spark, f"{root}/tables", "okta").select(
        "uuid", F.col("actor.alternateId").alias("actor_id"), F.col("actor.rank").alias("actor_rank"),
        F.col("riskScore").alias("risk_score"), "device", "severity", F.col("outcome.result").alias("outcome"), "rescued",
    )


BRONZE_GROWING = """WITH e AS (
  SELECT event_id, user_id, event_type, event_id % 3 AS part, event_id % 50 AS n, event_id % 3 = 2 AND event_id % 50 = 7 AS broken
  FROM events)
SELECT CASE WHEN NOT broken THEN CAST(event_id AS VARCHAR) END AS uuid,
  CASE WHEN NOT broken THEN 'user' || user_id || '@example.com' END AS actor_id,
  CASE WHEN part = 1 THEN n END AS actor_rank,
  CASE WHEN part = 1 THEN CAST(n AS DOUBLE) WHEN part = 2 AND NOT broken THEN n + CAST(0.5 AS DOUBLE) END AS risk_score,
  CASE WHEN part = 1 THEN '{"os":"linux"}' WHEN part = 2 AND NOT broken THEN 'mac' END AS device,
  CASE WHEN part = 2 AND NOT broken THEN '{"level":' || n || '}' END AS severity,
  CASE WHEN broken THEN NULL WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome,
  CASE WHEN broken THEN '{"_line":"{' || event_id || '"}' END AS rescued
FROM e"""


def _rolled(rule, table, as_of, rollup, **params):
    """A baseline rule over days that a stream has rolled up: the table arrives in two halves of random rows, the first
    in two micro-batches, after which its days are finished; the days of the second half are open. Each micro-batch is
    written by the tasks that read it, so none holds more as the table grows."""

    def run(spark, sf):
        root = scratch_path(spark, "rolled")
        rows = table(spark, sf).withColumn("event_date", F.to_date("event_time"))
        quarter = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(4))
        arriving = written_table(rows.withColumn("arrives", F.least(quarter, F.lit(2))), "arriving", "arrives")
        days = DailyRollup(f"{root}/days", **rollup)
        for i in range(3):
            part = arriving.where(F.col("arrives") == i).drop("arrives")
            part.write.mode("append").parquet(f"{root}/silver")
            stream = tables.table_stream(spark, f"{root}/silver", part.schema)
            days.start(stream, f"{root}/checkpoint", "rolled", available_now=True).awaitTermination()
            if i == 1:
                days.finish(spark)
        silver_ = spark.read.schema(part.schema).parquet(f"{root}/silver")
        hits = rules.BY_NAME[rule].hits(silver_, as_of, days=days.days(spark), **params)
        return plain(hits.drop("processed_timestamp"))

    return run


BEHAVIOR_ROLLUP = {"key": "user_email", "count": "logins", "distinct": {"ips": "source_ip"}}
NETWORK_ROLLUP = {
    "key": "host", "count": "connections", "distinct": {"ips": "destination_ip", "ports": "destination_port"},
}


def streams_at_interval(spark, sf):
    """Two streams at an interval, watched while they run, fed once more and stopped: the rows that each wrote, whether
    it was seen running with its progress, and whether it was among those that were stopped."""
    root = scratch_path(spark, "interval")
    rows = load(spark, sf, "events").select("event_id", "event_type")
    later = F.col("event_id") % 4 == 3
    specs = []
    for kind, wanted in (("errors", "event_type = 'error'"), ("others", "event_type <> 'error'")):
        rows.where(~later).where(wanted).write.parquet(f"{root}/in/{kind}")
        specs.append(
            manage.StreamSpec(
                f"{root.rsplit('-', 1)[-1]}-{kind}",
                lambda s, kind=kind: tables.table_stream(s, f"{root}/in/{kind}", rows.schema),
                lambda df: df, f"{root}/out/{kind}", f"{root}/checkpoint/{kind}", "parquet", "1 second",
            )
        )
    started, failed = manage.start_streams(spark, specs)
    try:
        if failed:
            raise RuntimeError(str(failed))
        for kind, wanted in (("errors", "event_type = 'error'"), ("others", "event_type <> 'error'")):
            rows.where(later).where(wanted).write.mode("append").parquet(f"{root}/in/{kind}")
        for q in started.values():
            q.processAllAvailable()
        status = {r["name"]: r["batch_id"] is not None for r in manage.stream_status(spark).collect()}
    finally:
        stopped = manage.stop_streams(spark, list(started))
    out = [
        spark.read.schema(rows.schema).parquet(s.out).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")).select(
            F.lit(s.name.rsplit("-", 1)[-1]).alias("stream"), "n", "ids", F.lit(status.get(s.name, False)).alias("seen"),
            F.lit(s.name in stopped and not started[s.name].isActive).alias("stopped"),
        )
        for s in specs
    ]
    return consolidate(out)


AT_INTERVAL = """SELECT CASE WHEN event_type = 'error' THEN 'errors' ELSE 'others' END AS stream, count(*) AS n,
  CAST(sum(event_id) AS BIGINT) AS ids, true AS seen, true AS stopped FROM events GROUP BY 1"""


PIPED = {
    "okta_auth": "okta", "windows_auth": "windows", "cloudtrail": "cloud", "sysmon_process": "process",
    "sysmon_network": "network", "sysmon_registry": "registry_whole",
}


def stream_pipeline_all(spark, sf):
    """Rows and a checksum over all columns of each of the six silver tables, and the days it is partitioned by."""
    tables_, out = written_pipeline(spark, sf, whole=True), []
    for name in PIPED:
        rows = tables_[name].drop("processed_timestamp")
        values = [F.coalesce(c.cast("string"), F.lit("-")) for c in map(F.col, plain(rows.drop("event_date")).columns)]
        line = plain(rows).select(F.md5(F.concat_ws("|", *values)).alias("h"), "event_date")
        number = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
        out.append(
            line.agg(
                F.count("*").alias("n"), F.sum(number).alias("checksum"), F.count_distinct("event_date").alias("days")
            ).select(F.lit(name).alias("table_name"), "n", "checksum", "days")
        )
    return consolidate(out)


def _checksum(name, view):
    parts = []
    for f in schemas.SILVER[name].fields:
        if f.name != "processed_timestamp":
            column = f'"{f.name}"' if f.name == "user" else f.name
            column = shown(column) if f.dataType.typeName() == "timestamp" else f"CAST({column} AS VARCHAR)"
            parts.append(f"coalesce({column}, '-')")
    line = f"md5(concat_ws('|', {', '.join(parts)}))"
    return f"""SELECT '{name}' AS table_name, count(*) AS n,
  CAST(sum(CAST('0x' || substr({line}, 1, 8) AS BIGINT)) AS BIGINT) AS checksum,
  count(DISTINCT CAST(event_time AS DATE)) AS days FROM {view} WHERE {pipeline.KEEP.get(name, 'true')}"""


STREAM_PIPELINE_ALL = sql(
    " UNION ALL ".join(_checksum(name, view) for name, view in PIPED.items()),
    *PIPED.values(),
)


def detections_over_pipeline(spark, sf):
    """Four signature rules over the tables of the pipeline, and how many of all enabled rules fail to be planned.

    ``detections_every_rule`` has the alerts of all rules.
    """
    tables_ = written_pipeline(spark, sf)
    tables_["sysmon_network"] = T.network(spark, sf)
    run = run_detections(tables_, T.EVENTS_AS_OF)
    named = ("detect_registry_run_key", "detect_event_log_cleared", "detect_mimikatz", "detect_psexec")
    return run.summary().where(F.col("detection_rule").isin(*named)).withColumn("failed_rules", F.lit(len(run.failed)))


DETECTIONS_OVER_PIPELINE = sql(
    """SELECT 'detect_registry_run_key' AS detection_rule, count(*) AS alert_count, 0 AS failed_rules FROM registry
WHERE registry_path LIKE '%CurrentVersion\\Run%' HAVING count(*) > 0
UNION ALL SELECT 'detect_event_log_cleared', count(*), 0 FROM events WHERE event_type = 'purchase' HAVING count(*) > 0
UNION ALL SELECT 'detect_psexec', count(*), 0 FROM events WHERE event_type = 'purchase' HAVING count(*) > 0
UNION ALL SELECT 'detect_mimikatz', count(*), 0 FROM ev WHERE event_type = 'signup' AND k <= 10 HAVING count(*) > 0""",
    "registry",
)


#: Time of the run by table where it is not that of the events, and parameters of the rules' own queries.
RUN_AT = {"cloudtrail": T.ORDERS_AS_OF, "sysmon_network": T.LINES_AS_OF}
RUN_WITH = {
    "detect_okta_bruteforce": dict(within="7 days", min_count=2),
    "detect_windows_bruteforce": dict(within="30 days", min_count=2),
    "detect_aws_api_failures": dict(within="1000 days", min_count=3),
    "detect_network_scanning": dict(within="60 days", min_count=6),
    "detect_rare_process_execution": dict(steps=(55, 60, 100), top=None),
    "detect_network_anomaly": dict(history="300 days", gap="6 days", recent_from="2001-06-10 00:00:00"),
    "detect_timeseries_anomaly": dict(z=1.0, high=2.0, recent="72 hours"),
    "detect_web_beaconing": dict(within="2000 days", min_count=2),
}


def detections_every_rule(spark, sf):
    """All enabled rules over the tables of the pipeline: a row per rule, also where it finds nothing."""
    tables_ = written_pipeline(spark, sf, network=True)
    chosen = [
        rules.with_params(r, **RUN_WITH[r.name]) if r.name in RUN_WITH else r for r in rules.RULES if r.enabled
    ]
    runs = [
        run_detections(tables_, at, [r for r in chosen if RUN_AT.get(r.table, T.EVENTS_AS_OF) == at])
        for at in (T.EVENTS_AS_OF, *RUN_AT.values())
    ]
    found = consolidate([run.summary() for run in runs])
    names = spark.createDataFrame([(r.name,) for r in chosen], "detection_rule string")
    failed = sum(len(run.failed) for run in runs)
    return names.join(found, "detection_rule", "left").select(
        "detection_rule",
        F.coalesce("alert_count", F.lit(0)).alias("alert_count"),
        F.lit(failed).alias("failed_rules"),
    )


def _rule_count(name, query=None, where="true"):
    return f"""SELECT '{name}' AS detection_rule, count(*) AS alert_count,
  0 AS failed_rules FROM ({query or D.QUERIES[name][1]}) WHERE {where}"""


DETECTIONS_EVERY_RULE = " UNION ALL ".join(
    [
        *[
            _rule_count(r.name)
            for r in rules.RULES
            if r.name not in ("detect_user_clustering", "detect_impossible_travel", "detect_registry_run_key")
        ],
        _rule_count(
            "detect_impossible_travel", D.TRAVEL, f"current_login_time <= '{T.EVENTS_AS_OF}.000000'"
        ),
        _rule_count(
            "detect_registry_run_key",
            sql("SELECT * FROM registry WHERE registry_path LIKE '%CurrentVersion\\Run%'", "registry"),
        ),
        _rule_count("detect_user_clustering", D.CLUSTERING),
    ]
)


#: Rules of every kind but signatures, with the hits that a validation asks for; the second asks for too many.
VALIDATED = {
    "detect_okta_bruteforce": 1,
    "detect_windows_bruteforce": 1_000_000_000,
    "detect_impossible_travel": 1,
    "detect_user_behavior_anomaly": 0,
    "detect_rare_process_execution": 1,
    "detect_timeseries_anomaly": 0,
    "detect_user_clustering": 1,
}


def rules_validated_every_kind(spark, sf):
    """G-08: threshold, sequence, baseline, rarity, time series and clustering rules against their whole tables."""
    tables_ = {"okta_auth": T.okta(spark, sf), "windows_auth": T.windows(spark, sf), "sysmon_process": T.process(spark, sf)}
    chosen = [rules.with_params(rules.BY_NAME[n], **RUN_WITH.get(n, {})) for n in VALIDATED]
    return validate_rules({r.name: (tables_[r.table], VALIDATED[r.name]) for r in chosen}, T.EVENTS_AS_OF, chosen)


def _validated(name, expected):
    query, where = {
        "detect_impossible_travel": (D.TRAVEL, f"current_login_time <= '{T.EVENTS_AS_OF}.000000'"),
        "detect_user_clustering": (D.CLUSTERING, "true"),
    }.get(name) or (D.QUERIES[name][1], "true")
    return f"""SELECT '{name}' AS rule, CAST({expected} AS BIGINT) AS expected, count(*) AS found, count(*) >= {expected} AS passed
FROM ({query}) WHERE {where}"""


RULES_VALIDATED_EVERY_KIND = " UNION ALL ".join(_validated(*x) for x in VALIDATED.items())


def stream_expectations(spark, sf):
    """Expectation counts of a stream that ended after half of its input and was started again."""
    root = scratch_path(spark, "stream-expect")
    raw = T.raw_network(spark, sf)
    table = NumberedTable(
        f"{root}/network", schemas.SILVER["sysmon_network"], rules={"has_address": "destination_ip IS NOT NULL"}
    )
    half = F.crc32(F.col("EventTime").cast("string").cast("binary")) % 2
    for part in (0, 1):
        raw.where(half == part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(raw.schema).parquet(f"{root}/in")
        rows = silver.sysmon_network(stream, keep_incomplete=True)
        table.start(rows, f"{root}/checkpoint", "expect", available_now=True).awaitTermination()
    return table.counts(spark)


STREAM_EXPECTATIONS = """SELECT 'total_rows' AS metric, count(*) AS value FROM lineitem
UNION ALL SELECT 'failed_has_address', count(*) FROM lineitem WHERE l_tax <= 0 AND l_discount <= 0"""


def stream_alerts(spark, sf):
    """Signature alerts of each micro-batch into the alert store."""
    root = scratch_path(spark, "stream-alerts")
    starts = T.process_stream(table_stream(spark, sf, "events"))
    chosen = [rules.BY_NAME[n] for n in ("detect_mimikatz", "detect_suspicious_powershell", "detect_psexec")]

    def to_alerts(batch):
        return run_detections({"sysmon_process": batch}, T.EVENTS_AS_OF, chosen).alerts

    q = stream_rules.start_alert_writer(starts, to_alerts, f"{root}/alerts", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    return plain(
        read_alerts(spark, f"{root}/alerts").select("alert_id", "detection_rule", "event_time", "severity")
    )


STREAM_ALERTS = over_found(f"""SELECT DISTINCT alert_id, detection_rule, {shown('event_time')} AS event_time, severity
FROM found WHERE detection_rule <> 'detect_external_rdp'""")


def stream_enriched(spark, sf):
    """Stream joined with a static per-user profile."""
    root = scratch_path(spark, "stream-enriched")
    profile = load(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("usual"))
    out = stream_rules.enrich_stream(table_stream(spark, sf, "events"), profile, ["user_id"]).select(
        "event_id", "user_id", "usual"
    )
    q = manage.write_stream(out, "enriched", f"{root}/out", f"{root}/checkpoint", "parquet", available_now=True)
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


QUERIES = {
    "stream_normalize_xml": (stream_normalize, sql(f"SELECT {_SYSMON_SQL} FROM ev", "ev")),
    "stream_cloudtrail_gzip": (stream_cloudtrail, NRM_CLOUDTRAIL),
    "stream_threshold": (stream_threshold, STREAM_THRESHOLD),
    "stream_threshold_distinct": (stream_threshold_distinct, STREAM_DISTINCT),
    "stream_impossible_travel": (stream_travel, TRAVEL),
    "stream_bronze_silver": (stream_pipeline, STREAM_PIPELINE),
    "rollup_user_behavior": (
        _rolled("detect_user_behavior_anomaly", T.okta, T.EVENTS_AS_OF, BEHAVIOR_ROLLUP), D.BEHAVIOR
    ),
    "rollup_network": (
        _rolled("detect_network_anomaly", T.network, D.L, NETWORK_ROLLUP, history="300 days", gap="6 days",
                recent_from="2001-06-10 00:00:00"),
        D.NETWORK,
    ),
    "streams_at_interval": (streams_at_interval, AT_INTERVAL),
    "bronze_growing_format": (bronze_growing, BRONZE_GROWING),
    "stream_bronze_silver_all": (stream_pipeline_all, STREAM_PIPELINE_ALL),
    "detections_all_rules": (detections_over_pipeline, DETECTIONS_OVER_PIPELINE),
    "rules_validated_every_kind": (rules_validated_every_kind, RULES_VALIDATED_EVERY_KIND),
    "detections_every_rule": (detections_every_rule, DETECTIONS_EVERY_RULE),
    "stream_expectations": (stream_expectations, STREAM_EXPECTATIONS),
    "stream_alert_writer": (stream_alerts, STREAM_ALERTS),
    "stream_static_enrichment": (
        stream_enriched,
        "SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS usual FROM events",
    ),
}
