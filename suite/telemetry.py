"""The given tables read as security telemetry, in Spark and in SQL.

``events`` plays host processes, identity and Windows logons, ``orders`` plays
cloud API calls and ``lineitem`` plays network connections. Every row of a
table becomes one record. The same mapping exists as SQL views for the
comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, TimestampNTZType, TimestampType

from sparkwatch.operators import silver

EVENTS_AS_OF = "2024-01-30 23:30:00"
ORDERS_AS_OF = "2000-06-15 12:00:00"
LINES_AS_OF = "2001-06-15 12:00:00"


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Times and arrays as text, decimals as double, for comparison across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def pick(index: Column, *values) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return with_k(load(spark, sf, "events"))




def process_raw_from(events: DataFrame) -> DataFrame:
    k, kind, uid = F.col("k"), F.col("event_type"), F.col("user_id")
    flags = pick(
        k % 10, "-enc SQBFAFgA", "-encodedcommand SQBFAFgA", "-w hidden", "-windowstyle hidden",
        "IEX $x", "Invoke-WebRequest", "x.DownloadString(y)", "-nop", "-noprofile", "Get-ChildItem",
    )
    name = (
        F.when(kind == "error", F.lit("PowerShell.exe"))
        .when(kind == "purchase", F.lit("PsExec64.exe"))
        .when((kind == "signup") & (k == 10), F.lit("Mimikatz.exe"))
        .when(kind == "signup", F.lit("rundll32.exe"))
        .otherwise(text("tool", k, ".exe"))
    )
    command = (
        F.when(kind == "error", text("powershell.exe ", flags))
        .when((kind == "signup") & (k < 5), F.lit("run Sekurlsa::LogonPasswords"))
        .when((kind == "signup") & (k < 10), F.lit("run lsadump::sam"))
        .otherwise(text("run ", F.col("props")))
    )
    return with_k(events).select(
        F.lit(1).alias("EventID"),
        F.col("ts").alias("EventTime"),
        text("WS-", uid % 40).alias("Computer"),
        name.alias("ProcessName"),
        (F.col("event_id") % 5000).alias("ProcessId"),
        command.alias("CommandLine"),
        text("user", uid).alias("User"),
        pick(uid % 4, "explorer.exe", "cmd.exe", "services.exe", "winword.exe").alias("ParentProcessName"),
        F.lit(4).alias("ParentProcessId"),
        F.sha2("props", 256).alias("SHA256"),
        F.lit(None).cast("string").alias("DestinationIP"),
        F.lit(None).cast("int").alias("DestinationPort"),
    )


def raw_registry(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    """Errors and views as changes of autorun and other registry keys; with ``whole`` all events are changes."""
    key = F.when(F.col("event_type") == "error", F.lit("RunOnce")).otherwise("Fonts")
    rows = events(spark, sf)
    if not whole:
        rows = rows.where(F.col("event_type").isin("error", "view"))
    return rows.select(
        F.lit(13).alias("EventID"),
        F.col("ts").alias("EventTime"),
        text("WS-", F.col("user_id") % 40).alias("Computer"),
        F.lit("reg.exe").alias("ProcessName"),
        text("user", F.col("user_id")).alias("User"),
        text("HKLM\\Software\\CurrentVersion\\", key, "\\v", F.col("k")).alias("TargetObject"),
    )


def okta_raw_from(events: DataFrame) -> DataFrame:
    k, kind, uid = F.col("k"), F.col("event_type"), F.col("user_id")
    event = (
        F.when(kind == "purchase", F.lit("user.mfa.update"))
        .when(kind == "signup", F.lit("policy.rule.add"))
        .otherwise("user.authentication.sso")
    )
    app = F.struct(F.lit("Salesforce").alias("displayName"))
    return with_k(events).select(
        F.col("event_id").cast("string").alias("uuid"),
        F.col("ts").alias("published"),
        event.alias("eventType"),
        F.struct(
            text("user", uid, "@example.com").alias("alternateId"), text("User ", uid).alias("displayName")
        ).alias("actor"),
        F.struct(
            F.lit("Mozilla/5.0").alias("userAgent"),
            text("10.", uid % 8, ".", k % 3, ".1").alias("ipAddress"),
            F.struct(
                text("City", k).alias("city"),
                F.when(k != 99, text("Country", F.floor(k / 10))).alias("country"),
            ).alias("geographicalContext"),
        ).alias("client"),
        F.struct(
            F.when(kind == "error", F.lit("FAILURE")).otherwise("SUCCESS").alias("result"),
            F.when(kind == "error", F.lit("INVALID_CREDENTIALS")).alias("reason"),
        ).alias("outcome"),
        F.slice(F.array(app), 1, F.when(k % 2 == 0, 1).otherwise(0)).alias("target"),
    )


def raw_windows(spark: SparkSession, sf: str) -> DataFrame:
    k, kind, uid = F.col("k"), F.col("event_type"), F.col("user_id")
    event = (
        F.when(kind == "error", 4625).when(kind == "signup", 4672).when(kind == "purchase", 1102).otherwise(4624)
    )
    return events(spark, sf).select(
        event.alias("EventID"),
        F.col("ts").alias("TimeCreated"),
        text("WS-", uid % 40).alias("Computer"),
        pick(k % 4, 2, 3, 10, 7).alias("LogonType"),
        pick(k % 4, "Interactive", "Network", "RemoteInteractive", "Unlock").alias("LogonTypeName"),
        text("user", uid).alias("TargetUserName"),
        F.lit("CORP").alias("TargetDomainName"),
        text("WS-", k).alias("WorkstationName"),
        text(pick(k % 3, "10.0.0.", "192.168.1.", "203.0.113."), k).alias("SourceNetworkAddress"),
        F.when(kind == "error", F.lit("0xC000006D")).otherwise("0x0").alias("Status"),
    )


def raw_cloudtrail(spark: SparkSession, sf: str) -> DataFrame:
    cust, priority, status = F.col("o_custkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    call = (
        F.when(priority == "1-URGENT", F.lit("CreateAccessKey"))
        .when(priority == "2-HIGH", F.lit("AttachUserPolicy"))
        .when(priority == "3-MEDIUM", F.lit("PutObject"))
        .when(priority == "4-NOT SPECIFIED", F.lit("StopLogging"))
        .otherwise("DeleteBucket")
    )
    error = F.when(status == "F", F.lit("AccessDenied")).when(status == "P", F.lit("Throttling"))
    return load(spark, sf, "orders").select(
        F.col("o_orderdate").alias("eventTime"),
        F.col("o_orderkey").cast("string").alias("eventID"),
        call.alias("eventName"),
        F.lit("AwsApiCall").alias("eventType"),
        pick(cust % 3, "iam.amazonaws.com", "s3.amazonaws.com", "ec2.amazonaws.com").alias("eventSource"),
        pick(cust % 4, "us-east-1", "us-west-2", "eu-west-1", "eu-central-1").alias("awsRegion"),
        text("172.16.", cust % 16, ".1").alias("sourceIPAddress"),
        F.lit("aws-cli").alias("userAgent"),
        error.alias("errorCode"),
        F.when(error.isNotNull(), text("call failed with ", error)).alias("errorMessage"),
        F.struct(
            text("cust", cust).alias("userName"),
            text("AIDA", cust).alias("principalId"),
            text("arn:aws:iam::user/cust", cust).alias("arn"),
        ).alias("userIdentity"),
        F.struct(
            F.when(priority == "3-MEDIUM", F.lit("bucket-a")).alias("bucketName"),
            F.when(priority == "2-HIGH", F.lit("target")).alias("userName"),
        ).alias("requestParameters"),
    )


def network_raw_from(lines: DataFrame) -> DataFrame:
    part = F.col("l_partkey")
    known = (F.col("l_tax") > 0) | (F.col("l_discount") > 0)
    return lines.select(
        F.lit(3).alias("EventID"),
        F.col("l_shipdate").alias("EventTime"),
        text("WS-", F.col("l_suppkey")).alias("Computer"),
        pick(F.col("l_linenumber") % 3, "chrome.exe", "agent.exe", "svchost.exe").alias("ProcessName"),
        F.col("l_linenumber").alias("ProcessId"),
        text("user", F.col("l_suppkey") % 7).alias("User"),
        F.when(known, text("10.1.", F.floor(part / 256), ".", part % 256)).alias("DestinationIP"),
        pick(F.col("l_linenumber"), 0, 443, 80, 22, 3389, 4444, 8080, 445).alias("DestinationPort"),
    )


def raw_process(spark, sf):
    return process_raw_from(load(spark, sf, "events"))


def raw_okta(spark, sf):
    return okta_raw_from(load(spark, sf, "events"))


def raw_network(spark, sf):
    return network_raw_from(load(spark, sf, "lineitem"))


def _processed(df: DataFrame) -> DataFrame:
    """A processing time that follows the event by five minutes plus its seconds."""
    t = F.col("event_time")
    later = t + F.expr("INTERVAL 5 MINUTES") + F.make_dt_interval(secs=F.second(t))
    return df.withColumn("processed_timestamp", later)


def process(spark, sf):
    return _processed(silver.sysmon_process(raw_process(spark, sf)))


def okta(spark, sf):
    return _processed(silver.okta_auth(raw_okta(spark, sf)))


def windows(spark, sf):
    return _processed(silver.windows_auth(raw_windows(spark, sf)))


def cloud(spark, sf):
    return _processed(silver.cloudtrail(raw_cloudtrail(spark, sf)))


def network(spark, sf):
    return _processed(silver.sysmon_network(raw_network(spark, sf)))


def process_stream(events: DataFrame) -> DataFrame:
    return silver.sysmon_process(process_raw_from(events))


def okta_stream(events: DataFrame) -> DataFrame:
    return silver.okta_auth(okta_raw_from(events))


# The same tables in SQL.


def unix(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


def shown(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


_LATER = "event_time + INTERVAL 5 MINUTE + to_seconds(CAST(second(event_time) AS BIGINT)) AS processed_timestamp"

_REGISTRY = """SELECT ts AS event_time, 'WS-' || (user_id % 40) AS host, 'user' || user_id AS "user", 'reg.exe' AS process_name,
    'HKLM\\Software\\CurrentVersion\\' || CASE event_type WHEN 'error' THEN 'RunOnce' ELSE 'Fonts' END || '\\v' || k
      AS registry_path, 'sysmon' AS log_source, 'registry_change' AS event_category
  FROM ev"""

_VIEWS = {
    "ev": """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "process": f"""
process_raw AS (
  SELECT ts AS event_time, 'WS-' || (user_id % 40) AS host,
    CASE WHEN event_type = 'error' THEN 'PowerShell.exe'
         WHEN event_type = 'purchase' THEN 'PsExec64.exe'
         WHEN event_type = 'signup' AND k = 10 THEN 'Mimikatz.exe'
         WHEN event_type = 'signup' THEN 'rundll32.exe'
         ELSE 'tool' || k || '.exe' END AS process_name,
    CAST(event_id % 5000 AS INTEGER) AS process_id,
    CASE WHEN event_type = 'error' THEN 'powershell.exe ' || (['-enc SQBFAFgA', '-encodedcommand SQBFAFgA',
           '-w hidden', '-windowstyle hidden', 'IEX $x', 'Invoke-WebRequest', 'x.DownloadString(y)', '-nop',
           '-noprofile', 'Get-ChildItem'])[k % 10 + 1]
         WHEN event_type = 'signup' AND k < 5 THEN 'run Sekurlsa::LogonPasswords'
         WHEN event_type = 'signup' AND k < 10 THEN 'run lsadump::sam'
         ELSE 'run ' || props END AS command_line,
    'user' || user_id AS "user",
    (['explorer.exe', 'cmd.exe', 'services.exe', 'winword.exe'])[user_id % 4 + 1] AS parent_process_name,
    4 AS parent_process_id, sha256(props) AS file_hash_sha256
  FROM ev),
process AS (
  SELECT *, CASE WHEN regexp_matches(lower(process_name), 'mimikatz|procdump|psexec|pwdump')
                   THEN 'suspicious_process'
                 WHEN regexp_matches(lower(command_line), '-enc|-encodedcommand|-w hidden|-nop')
                   THEN 'suspicious_commandline'
                 WHEN lower(process_name) LIKE '%powershell%'
                      AND regexp_matches(lower(command_line), 'iex|invoke-|downloadstring')
                   THEN 'powershell_download'
                 ELSE 'normal' END AS threat_indicator,
    'sysmon' AS log_source, 'process_creation' AS event_category, {_LATER}
  FROM process_raw)""",
    "okta": f"""
okta AS (
  SELECT ts AS event_time, CAST(event_id AS VARCHAR) AS event_id,
    CASE event_type WHEN 'purchase' THEN 'user.mfa.update' WHEN 'signup' THEN 'policy.rule.add'
      ELSE 'user.authentication.sso' END AS event_type,
    'user' || user_id || '@example.com' AS user_email, 'User ' || user_id AS user_name,
    '10.' || (user_id % 8) || '.' || (k % 3) || '.1' AS source_ip, 'Mozilla/5.0' AS user_agent,
    'City' || k AS city, CASE WHEN k <> 99 THEN 'Country' || (k // 10) END AS country,
    CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome,
    CASE WHEN event_type = 'error' THEN 'INVALID_CREDENTIALS' END AS failure_reason,
    CASE WHEN k % 2 = 0 THEN 'Salesforce' END AS target_application,
    CASE WHEN event_type = 'error' THEN 'failed_auth' WHEN event_type IN ('purchase', 'signup')
      THEN 'privileged_action' ELSE 'normal' END AS risk_indicator,
    'okta' AS log_source, 'authentication' AS event_category, {_LATER.replace('event_time', 'ts')}
  FROM ev)""",
    "windows": f"""
windows_raw AS (
  SELECT ts AS event_time,
    CASE event_type WHEN 'error' THEN 4625 WHEN 'signup' THEN 4672 WHEN 'purchase' THEN 1102
      ELSE 4624 END AS event_id,
    'WS-' || (user_id % 40) AS host, ([2, 3, 10, 7])[k % 4 + 1] AS logon_type,
    (['Interactive', 'Network', 'RemoteInteractive', 'Unlock'])[k % 4 + 1] AS logon_type_name,
    'user' || user_id AS user_name, 'CORP' AS domain, 'WS-' || k AS workstation,
    (['10.0.0.', '192.168.1.', '203.0.113.'])[k % 3 + 1] || k AS source_ip,
    CASE WHEN event_type = 'error' THEN '0xC000006D' ELSE '0x0' END AS status_code
  FROM ev),
windows AS (
  SELECT *, CASE WHEN event_id = 4625 THEN 'failed_logon' WHEN event_id = 4672 THEN 'privileged_logon'
      WHEN logon_type = 10 THEN 'rdp_logon' WHEN logon_type = 3 THEN 'network_logon'
      ELSE 'normal_logon' END AS logon_classification,
    event_id <> 4625 AS logon_success, 'windows_security' AS log_source,
    'authentication' AS event_category, {_LATER}
  FROM windows_raw WHERE event_id IN (4624, 4625, 4672))""",
    "cloud": f"""
cloud_raw AS (
  SELECT o_orderdate AS event_time, CAST(o_orderkey AS VARCHAR) AS event_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CreateAccessKey' WHEN '2-HIGH' THEN 'AttachUserPolicy'
      WHEN '3-MEDIUM' THEN 'PutObject' WHEN '4-NOT SPECIFIED' THEN 'StopLogging'
      ELSE 'DeleteBucket' END AS event_name,
    'AwsApiCall' AS event_type,
    (['iam.amazonaws.com', 's3.amazonaws.com', 'ec2.amazonaws.com'])[o_custkey % 3 + 1] AS service,
    (['us-east-1', 'us-west-2', 'eu-west-1', 'eu-central-1'])[o_custkey % 4 + 1] AS region,
    '172.16.' || (o_custkey % 16) || '.1' AS source_ip, 'aws-cli' AS user_agent,
    CASE o_orderstatus WHEN 'F' THEN 'AccessDenied' WHEN 'P' THEN 'Throttling' END AS error_code,
    'cust' || o_custkey AS user_name, 'AIDA' || o_custkey AS principal_id,
    'arn:aws:iam::user/cust' || o_custkey AS user_arn,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'bucket-a' END AS s3_bucket,
    CASE WHEN o_orderpriority = '2-HIGH' THEN 'target' END AS target_user
  FROM orders),
cloud AS (
  SELECT *, 'call failed with ' || error_code AS error_message,
    CASE WHEN regexp_matches(event_name, 'Create.*Key|Attach.*Policy|Create.*User|Delete.*')
           THEN 'high_risk_action'
         WHEN error_code IS NOT NULL THEN 'failed_api_call' ELSE 'normal' END AS risk_classification,
    error_code IS NULL AS api_success, 'cloudtrail' AS log_source, 'cloud_api' AS event_category, {_LATER}
  FROM cloud_raw)""",
    "registry": f"""
registry AS (
  {_REGISTRY} WHERE event_type IN ('error', 'view'))""",
    "registry_whole": f"""
registry_whole AS (
  {_REGISTRY})""",
    "network": f"""
network AS (
  SELECT l_shipdate AS event_time, 'WS-' || l_suppkey AS host,
    (['chrome.exe', 'agent.exe', 'svchost.exe'])[l_linenumber % 3 + 1] AS process_name,
    CAST(l_linenumber AS INTEGER) AS process_id, 'user' || (l_suppkey % 7) AS "user",
    '10.1.' || (l_partkey // 256) || '.' || (l_partkey % 256) AS destination_ip,
    ([0, 443, 80, 22, 3389, 4444, 8080, 445])[l_linenumber + 1] AS destination_port,
    CASE WHEN l_linenumber IN (3, 4, 7) THEN 'lateral_movement_port'
         WHEN l_linenumber IN (5, 6) THEN 'c2_common_port' ELSE 'normal' END AS port_classification,
    'sysmon' AS log_source, 'network_connection' AS event_category,
    {_LATER.replace('event_time', 'l_shipdate')}
  FROM lineitem WHERE l_tax > 0 OR l_discount > 0)""",
}
_NEEDS = {"process": ["ev"], "okta": ["ev"], "windows": ["ev"], "registry": ["ev"], "registry_whole": ["ev"]}


def sql(select: str, *views: str, extra: str = "") -> str:
    """A statement over some of the views above."""
    names: list[str] = []
    for v in views:
        for n in [*_NEEDS.get(v, []), v]:
            if n not in names:
                names.append(n)
    parts = [_VIEWS[n] for n in names] + ([extra] if extra else [])
    return ("WITH " + ",".join(parts) + "\n" if parts else "") + select
