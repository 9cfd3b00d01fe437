"""Sources, normalisers, silver tables and quality checks over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkwatch import schemas
from sparkwatch.operators import normalize as N
from sparkwatch.operators import quality as Q
from sparkwatch.operators import silver
from sparkwatch.plans.rules import BY_NAME
from sparkwatch.session import scratch_path
from sparkwatch.sources import files, tables
from suite import telemetry as T
from suite.reports import common, over_common
from suite.telemetry import EVENTS_AS_OF as E
from suite.telemetry import load, plain, shown, sql, text


def iso(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def escaped(c):
    """Text made safe for XML."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def data(**fields):
    parts = [text(f'<Data Name="{n}">', escaped(v.cast("string")), "</Data>") for n, v in fields.items()]
    return F.concat_ws("\n    ", *parts)


def spread_events(spark, sf):
    """``events`` dealt evenly over tasks: parsing a row as XML takes far longer than reading it, and
    a small file or a few row groups would be parsed by few tasks."""
    rows = files.spread(T.load(spark, sf, "events"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return T.with_k(rows)


def sysmon_xml(spark, sf):
    """``events`` as host event XML with prolog; every fifth has an attribute on EventID."""
    e = spread_events(spark, sf)
    k, uid = F.col("k"), F.col("user_id")
    fields = data(
        RuleName=F.lit(""), User=text("CORP\\user", uid), ProcessId=F.col("event_id") % 5000,
        Image=text("C:\\Windows\\tool", k, ".exe"), CommandLine=text("run --props=", F.col("props")),
        ParentImage=F.lit("C:\\Windows\\explorer.exe"), ParentProcessId=text("0x", F.lower(F.hex(k + 16))),
        Hashes=text("MD5=00,SHA256=", F.upper(F.sha2("props", 256))), DestinationIp=text("10.0.0.", k),
        DestinationPort=F.lit(443), IntegrityLevel=F.lit("High"),
    )
    body = text(
        '<?xml version="1.0" encoding="utf-8"?>\n<Event xmlns="http://schemas.example/event">\n  <System>\n',
        F.when(k % 5 == 0, F.lit('    <EventID Qualifiers="0">1</EventID>\n')).otherwise("    <EventID>1</EventID>\n"),
        '    <TimeCreated SystemTime="', iso("ts"), '"/>\n    <Computer>', text("WS-", uid % 40),
        "</Computer>\n  </System>\n  <EventData>\n    ", fields,
        '\n    <Data Name="User">last wins</Data>\n  </EventData>\n</Event>',
    )
    return e.select("event_id", body.alias("value"))


def sysmon_events(spark, sf):
    xml = sysmon_xml(spark, sf).select(
        F.regexp_replace("value", r"^<\?xml[^>]*\?>\s*", "").alias("value")
    )
    return N.normalize_sysmon_raw(xml)


_SYSMON_SQL = f"""1 AS "EventID", {shown('ts')} AS "EventTime", 'WS-' || (user_id % 40) AS "Computer",
  'last wins' AS "User", CAST(event_id % 5000 AS INTEGER) AS "ProcessId",
  'C:\\Windows\\tool' || k || '.exe' AS "Image", 'run --props=' || props AS "CommandLine",
  k + 16 AS "ParentProcessId", 'MD5=00,SHA256=' || upper(sha256(props)) AS "Hashes",
  '10.0.0.' || k AS "DestinationIp", 443 AS "DestinationPort\""""
_SYSMON_COLS = (
    "EventID EventTime Computer User ProcessId Image CommandLine ParentProcessId Hashes DestinationIp "
    "DestinationPort"
).split()


def nrm_sysmon_xml(spark, sf):
    return plain(sysmon_events(spark, sf).select(*_SYSMON_COLS))


def nrm_sysmon_json(spark, sf):
    """``events`` as JSON lines of the same shape."""
    e = T.with_k(T.load(spark, sf, "events"))
    as_json = F.to_json(
        F.struct(
            F.lit(1).alias("EventID"), iso("ts").alias("EventTime"), text("WS-", F.col("user_id") % 40).alias("Computer"),
            F.lit("last wins").alias("User"), (F.col("event_id") % 5000).alias("ProcessId"),
            text("C:\\Windows\\tool", F.col("k"), ".exe").alias("Image"),
            text("run --props=", F.col("props")).alias("CommandLine"), (F.col("k") + 16).alias("ParentProcessId"),
            text("MD5=00,SHA256=", F.upper(F.sha2("props", 256))).alias("Hashes"),
            text("10.0.0.", F.col("k")).alias("DestinationIp"), F.lit(443.0).alias("DestinationPort"),
        )
    )
    return plain(N.normalize_sysmon_raw(e.select(as_json.alias("value"))).select(*_SYSMON_COLS))


def sysmon_to_silver(spark, sf):
    """XML to canonical to silver, in one plan."""
    out = silver.sysmon_process(N.sysmon_to_raw(sysmon_events(spark, sf)))
    return plain(
        out.select(
            "event_time", "host", "process_name", "process_id", "command_line", "parent_process_name",
            "parent_process_id", "file_hash_sha256", "threat_indicator",
        )
    )


SYSMON_TO_SILVER = sql(
    f"""SELECT {shown('ts')} AS event_time, 'WS-' || (user_id % 40) AS host, 'tool' || k || '.exe' AS process_name,
  CAST(event_id % 5000 AS INTEGER) AS process_id, 'run --props=' || props AS command_line,
  'explorer.exe' AS parent_process_name, k + 16 AS parent_process_id, upper(sha256(props)) AS file_hash_sha256,
  'normal' AS threat_indicator FROM ev""",
    "ev",
)


def windows_xml(spark, sf):
    e = spread_events(spark, sf)
    k, uid = F.col("k"), F.col("user_id")
    fields = data(
        SubjectUserName=F.when(k % 2 == 0, text("svc", k)).otherwise(F.lit("")),
        SubjectDomainName=F.lit("CORP"), TargetUserName=text("user", uid), TargetDomainName=F.lit("LAB"),
        LogonType=T.pick(k % 4, 2, 3, 10, 7), ProcessId=text("0x", F.lower(F.hex("k"))),
        IpAddress=text("10.0.0.", k), IpPort=F.lit("-"), Status=F.lit("0x0"), WorkstationName=text("WS-", k),
    )
    body = text(
        "<Event>\n  <System>\n    <Provider Name=\"Audit\" Guid=\"{1}\"/>\n    <EventID>",
        F.when(F.col("event_type") == "error", 4625).otherwise(4624), "</EventID>\n    <EventRecordID>",
        F.col("event_id"), '</EventRecordID>\n    <TimeCreated SystemTime="', iso("ts"), '"/>\n    <Channel>Security</Channel>',
        "\n    <Computer>", text("WS-", uid % 40), "</Computer>\n  </System>\n  <EventData>\n    ", fields,
        "\n  </EventData>\n  <RenderingInfo><Message>an account</Message></RenderingInfo>\n</Event>",
    )
    return e.select(body.alias("value"))


_WINDOWS_COLS = (
    "EventID EventRecordID TimeCreated Computer Channel ProviderName AccountName AccountDomain ProcessID IpAddress "
    "TargetUserName LogonType Message"
).split()


def nrm_windows(spark, sf):
    return plain(N.normalize_windows_raw(windows_xml(spark, sf)).select(*_WINDOWS_COLS))


NRM_WINDOWS = sql(
    f"""SELECT CASE WHEN event_type = 'error' THEN 4625 ELSE 4624 END AS "EventID", event_id AS "EventRecordID",
  {shown('ts')} AS "TimeCreated", 'WS-' || (user_id % 40) AS "Computer", 'Security' AS "Channel",
  'Audit' AS "ProviderName", CASE WHEN k % 2 = 0 THEN 'svc' || k ELSE 'user' || user_id END AS "AccountName",
  'CORP' AS "AccountDomain", k AS "ProcessID", '10.0.0.' || k AS "IpAddress",
  'user' || user_id AS "TargetUserName", ([2, 3, 10, 7])[k % 4 + 1] AS "LogonType", 'an account' AS "Message"
FROM ev""",
    "ev",
)


def windows_to_silver(spark, sf):
    raw = N.windows_to_raw(N.normalize_windows_raw(windows_xml(spark, sf)))
    return plain(
        silver.windows_auth(raw).select(
            "event_time", "event_id", "host", "logon_type", "logon_type_name", "user_name", "domain", "workstation",
            "source_ip", "status_code", "logon_classification", "logon_success",
        )
    )


WINDOWS_TO_SILVER = sql(
    f"""SELECT {shown('ts')} AS event_time, CASE WHEN event_type = 'error' THEN 4625 ELSE 4624 END AS event_id,
  'WS-' || (user_id % 40) AS host, ([2, 3, 10, 7])[k % 4 + 1] AS logon_type,
  (['Interactive', 'Network', 'RemoteInteractive', 'Unlock'])[k % 4 + 1] AS logon_type_name,
  'user' || user_id AS user_name, 'LAB' AS domain, 'WS-' || k AS workstation, '10.0.0.' || k AS source_ip,
  '0x0' AS status_code, CASE WHEN event_type = 'error' THEN 'failed_logon' WHEN k % 4 = 2 THEN 'rdp_logon'
    WHEN k % 4 = 1 THEN 'network_logon' ELSE 'normal_logon' END AS logon_classification,
  event_type <> 'error' AS logon_success FROM ev""",
    "ev",
)


def okta_api(spark, sf):
    """``events`` as nested identity records, parsed from JSON text."""
    k, uid = F.col("k"), F.col("user_id")
    place = F.struct(text("City", k).alias("city"), text("Country", F.floor(k / 10)).alias("country"))
    record = F.struct(
        F.col("event_id").cast("string").alias("uuid"), iso("ts").alias("published"), F.lit("user.session.start").alias("eventType"),
        F.struct(text("u", uid).alias("id"), text("user", uid, "@example.com").alias("alternateId")).alias("actor"),
        F.struct(
            F.struct(F.lit("Mozilla/5.0").alias("rawUserAgent"), F.lit("Linux").alias("os")).alias("userAgent"),
            text("10.0.0.", k).alias("ipAddress"), place.alias("geographicalContext"),
        ).alias("client"),
        F.struct(F.when(F.col("event_type") == "error", F.lit("FAILURE")).otherwise("SUCCESS").alias("result")).alias("outcome"),
        F.when(k % 2 == 0, F.array(F.struct(F.lit("Salesforce").alias("displayName")))).alias("target"),
        F.struct(F.struct(F.col("props").alias("requestUri")).alias("debugData")).alias("debugContext"),
    )
    lines = T.with_k(T.load(spark, sf, "events")).select(F.to_json(record).alias("value"))
    return lines.select(F.from_json("value", schemas.RAW_OKTA_API).alias("r")).select("r.*")


def okta_arrays(spark, sf):
    """SRC-07: answers of an API, each a file with one pretty-printed array of up to 5000 records."""
    rows = okta_api(spark, sf).withColumn("answer", F.floor(F.col("uuid").cast("long") / 5000))
    # Sorted as pairs with the uuid, since maps, of which a record has one, cannot be compared.
    records = F.transform(
        F.array_sort(F.collect_list(F.struct("uuid", F.to_json(F.struct(*schemas.RAW_OKTA_API.names)).alias("j")))),
        lambda x: F.parse_json(x["j"]),
    )
    answers = rows.groupBy("answer").agg(F.to_json(records, {"pretty": "true"}).alias("value"))
    path = scratch_path(spark, "answers")
    answers.write.partitionBy("answer").text(path)
    read = files.read_json(spark, path, schemas.RAW_OKTA_API, multi_line=True, recursive=True)
    return plain(N.normalize_okta_api(read).select(*_OKTA_COLS))


_OKTA_COLS = (
    "uuid published eventType actor_id actor_alternateId client_userAgent_rawUserAgent client_userAgent_os "
    "client_ipAddress client_geographicalContext_city client_geographicalContext_country outcome_result target "
    "authenticationContext debugContext"
).split()


def nrm_okta(spark, sf):
    return plain(N.normalize_okta_api(okta_api(spark, sf)).select(*_OKTA_COLS))


NRM_OKTA = sql(
    f"""SELECT CAST(event_id AS VARCHAR) AS uuid, {shown('ts')} AS published, 'user.session.start' AS "eventType",
  'u' || user_id AS actor_id, 'user' || user_id || '@example.com' AS "actor_alternateId",
  'Mozilla/5.0' AS "client_userAgent_rawUserAgent", 'Linux' AS "client_userAgent_os", '10.0.0.' || k AS "client_ipAddress",
  'City' || k AS "client_geographicalContext_city", 'Country' || (k // 10) AS "client_geographicalContext_country",
  CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome_result,
  CASE WHEN k % 2 = 0 THEN '[{{"displayName":"Salesforce"}}]' ELSE '[]' END AS target, '{{}}' AS "authenticationContext",
  CAST(to_json({{'debugData': {{'requestUri': props}}}}) AS VARCHAR) AS "debugContext" FROM ev""",
    "ev",
)


def okta_to_silver(spark, sf):
    out = silver.okta_auth(N.okta_to_raw(N.normalize_okta_api(okta_api(spark, sf))))
    return plain(out.select("event_time", "event_id", "user_email", "source_ip", "city", "country", "outcome", "target_application", "risk_indicator"))


OKTA_TO_SILVER = sql(
    f"""SELECT {shown('ts')} AS event_time, CAST(event_id AS VARCHAR) AS event_id,
  'user' || user_id || '@example.com' AS user_email, '10.0.0.' || k AS source_ip, 'City' || k AS city,
  'Country' || (k // 10) AS country, CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome,
  CASE WHEN k % 2 = 0 THEN 'Salesforce' END AS target_application,
  CASE WHEN event_type = 'error' THEN 'failed_auth' ELSE 'normal' END AS risk_indicator FROM ev""",
    "ev",
)


def cloud_files(spark, sf):
    """``orders`` as delivery records, two calls per order, parsed from JSON text."""

    def call(name):
        return F.struct(
            F.lit("1.08").alias("eventVersion"), iso("o_orderdate").alias("eventTime"),
            text(F.col("o_orderkey"), "-", name).alias("eventID"), F.lit(name).alias("eventName"),
            F.lit("s3.amazonaws.com").alias("eventSource"),
            F.when(F.col("o_orderstatus") == "F", F.lit("AccessDenied")).alias("errorCode"),
            F.struct(text("cust", F.col("o_custkey")).alias("userName"), F.lit("IAMUser").alias("type")).alias("userIdentity"),
            F.struct(F.col("o_orderpriority").alias("bucketName")).alias("requestParameters"),
        )

    lines = T.load(spark, sf, "orders").select(
        F.to_json(F.struct(F.array(call("GetObject"), call("DeleteObject")).alias("Records"))).alias("value")
    )
    return lines.select(F.from_json("value", schemas.RAW_CLOUDTRAIL_FILE).alias("f")).select("f.*")


_CLOUD_COLS = (
    "eventVersion eventTime eventID eventName eventSource errorCode userIdentity_userName userIdentity_type "
    "requestParameters responseElements"
).split()


def nrm_cloudtrail(spark, sf):
    return plain(N.normalize_cloudtrail_raw(cloud_files(spark, sf)).select(*_CLOUD_COLS))


_CALLS = "(SELECT *, unnest(['GetObject', 'DeleteObject']) AS call FROM orders)"
NRM_CLOUDTRAIL = f"""SELECT '1.08' AS "eventVersion", {shown('o_orderdate')} AS "eventTime",
  o_orderkey || '-' || call AS "eventID", call AS "eventName", 's3.amazonaws.com' AS "eventSource",
  CASE WHEN o_orderstatus = 'F' THEN 'AccessDenied' END AS "errorCode", 'cust' || o_custkey AS "userIdentity_userName",
  'IAMUser' AS "userIdentity_type", CAST(to_json({{'bucketName': o_orderpriority}}) AS VARCHAR) AS "requestParameters",
  CAST(NULL AS VARCHAR) AS "responseElements" FROM {_CALLS}"""


def cloudtrail_to_silver(spark, sf):
    out = silver.cloudtrail(N.cloudtrail_to_raw(N.normalize_cloudtrail_raw(cloud_files(spark, sf), partitions=spark.sparkContext.defaultParallelism)))
    return plain(out.select("event_time", "event_id", "event_name", "user_name", "s3_bucket", "risk_classification", "api_success"))


CLOUDTRAIL_TO_SILVER = f"""SELECT {shown('o_orderdate')} AS event_time, o_orderkey || '-' || call AS event_id,
  call AS event_name, 'cust' || o_custkey AS user_name, o_orderpriority AS s3_bucket,
  CASE WHEN call = 'DeleteObject' THEN 'high_risk_action' WHEN o_orderstatus = 'F' THEN 'failed_api_call'
    ELSE 'normal' END AS risk_classification, o_orderstatus <> 'F' AS api_success FROM {_CALLS}"""


def registry_keys(spark, sf):
    """``events`` as registry changes in event XML; errors touch run keys, views are no registry events."""
    e = T.with_k(T.load(spark, sf, "events"))
    path = text("HKLM\\Software\\CurrentVersion\\", F.when(F.col("event_type") == "error", F.lit("RunOnce")).otherwise("Fonts"), "\\v", F.col("k"))
    body = text(
        "<Event><System><EventID>", F.when(F.col("event_type") == "view", 11).otherwise(13), '</EventID><TimeCreated SystemTime="', iso("ts"),
        '"/><Computer>PC</Computer></System><EventData>', data(TargetObject=path, Image=F.lit("C:\\a\\reg.exe"), User=text("user", F.col("user_id"))),
        "</EventData></Event>",
    )
    changes = silver.sysmon_registry(N.normalize_sysmon_raw(e.select(body.alias("value"))))
    hits = BY_NAME["detect_registry_run_key"].hits(changes)
    return plain(hits.select("event_time", "user", "process_name", "registry_path", "severity", "description"))


REGISTRY_KEYS = sql(
    f"""SELECT {shown('ts')} AS event_time, 'user' || user_id AS "user", 'reg.exe' AS process_name, p AS registry_path,
  'MEDIUM' AS severity, 'Autorun key changed: ' || p AS description
FROM (SELECT *, 'HKLM\\Software\\CurrentVersion\\RunOnce\\v' || k AS p FROM ev) WHERE event_type = 'error'""",
    "ev",
)


def _converted(df):
    """Whole rows, all columns but the time of conversion."""
    return plain(df.drop("conversion_timestamp"))


def _nulls(names, kind="VARCHAR"):
    return ", ".join(f'CAST(NULL AS {kind}) AS "{n}"' for n in names.split())


def convert_sysmon(spark, sf):
    return _converted(
        N.convert_sysmon_xml(sysmon_xml(spark, sf).select(F.regexp_extract("value", r"(?s)(<Event.*)", 1).alias("value")))
    )


CONVERT_SYSMON = sql(
    f"""SELECT 1 AS "EventID", {shown('ts')} AS "EventTime", 'WS-' || (user_id % 40) AS "Computer", 'last wins' AS "User",
  CAST(event_id % 5000 AS INTEGER) AS "ProcessId", 'C:\\Windows\\tool' || k || '.exe' AS "Image",
  'run --props=' || props AS "CommandLine", 'C:\\Windows\\explorer.exe' AS "ParentImage", k + 16 AS "ParentProcessId",
  'MD5=00,SHA256=' || upper(sha256(props)) AS "Hashes", 'High' AS "IntegrityLevel",
  {_nulls("ProcessGuid CurrentDirectory ParentCommandLine ParentProcessGuid LogonId")},
  'sysmon' AS source_system, 'xml' AS source_format FROM ev""",
    "ev",
)


def convert_windows(spark, sf):
    return _converted(N.convert_windows_xml(windows_xml(spark, sf)))


CONVERT_WINDOWS = sql(
    f"""SELECT CASE WHEN event_type = 'error' THEN 4625 ELSE 4624 END AS "EventID", event_id AS "EventRecordID",
  {shown('ts')} AS "TimeCreated", 'WS-' || (user_id % 40) AS "Computer", 'Security' AS "Channel",
  'user' || user_id AS "TargetUserName", 'LAB' AS "TargetDomainName", ([2, 3, 10, 7])[k % 4 + 1] AS "LogonType",
  '10.0.0.' || k AS "IpAddress", {_nulls("IpPort", "INTEGER")}, '0x0' AS "Status", 'WS-' || k AS "WorkstationName",
  {_nulls("ProcessName")}, 'windows' AS source_system, 'xml' AS source_format FROM ev""",
    "ev",
)


def convert_okta(spark, sf):
    return _converted(N.convert_okta_api(okta_api(spark, sf)))


CONVERT_OKTA = sql(
    f"""SELECT CAST(event_id AS VARCHAR) AS uuid, {shown('ts')} AS published, 'user.session.start' AS "eventType",
  'u' || user_id AS actor_id, 'user' || user_id || '@example.com' AS "actor_alternateId",
  '10.0.0.' || k AS "client_ipAddress", 'Linux' AS "client_userAgent_os",
  'City' || k AS "client_geographicalContext_city", 'Country' || (k // 10) AS "client_geographicalContext_country",
  CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome_result,
  {_nulls("severity displayMessage actor_type actor_displayName client_userAgent_browser "
          "client_geographicalContext_state outcome_reason")},
  'okta' AS source_system, 'api' AS source_format FROM ev""",
    "ev",
)


def convert_cloud(spark, sf):
    return _converted(N.convert_cloudtrail(cloud_files(spark, sf)))


CONVERT_CLOUD = f"""SELECT '1.08' AS "eventVersion", {shown('o_orderdate')} AS "eventTime",
  o_orderkey || '-' || call AS "eventID", call AS "eventName", 's3.amazonaws.com' AS "eventSource",
  CASE WHEN o_orderstatus = 'F' THEN 'AccessDenied' END AS "errorCode", 'IAMUser' AS "userIdentity_type",
  'cust' || o_custkey AS "userIdentity_userName",
  {_nulls("eventType awsRegion sourceIPAddress userAgent errorMessage requestID userIdentity_principalId "
          "userIdentity_arn userIdentity_accountId")},
  'cloudtrail' AS source_system, 'json_gz' AS source_format FROM {_CALLS}"""


def damaged(spark, sf):
    """Windows events of which every record with k below 7 is cut off."""
    e = windows_xml(spark, sf)
    port = F.regexp_extract("value", r"10\.0\.0\.(\d+)", 1).cast("int")
    return e.select(F.when(port < 7, F.substring("value", 1, 300)).otherwise(F.col("value")).alias("value"))


def conversion(spark, sf):
    return N.conversion_rate(damaged(spark, sf), "windows", formats=("xml",))


CONVERSION = sql(
    """SELECT 'windows' AS source, count(*) AS raw_count, count(*) FILTER (k >= 7) AS converted_count,
  round(count(*) FILTER (k >= 7) * 100.0 / count(*), 2) AS success_rate FROM ev""",
    "ev",
)


def unparsed(spark, sf):
    return N.unparsed(damaged(spark, sf)).agg(F.count("*").alias("n"), F.max(F.length("value")).alias("longest"))


def damaged_json(spark, sf):
    """Host events as JSON lines of which those with k below 7 are cut off."""
    e = T.events(spark, sf)
    line = F.to_json(F.struct(F.lit(1).alias("EventID"), text("user", F.col("user_id")).alias("User"), "props"))
    return e.select(F.when(F.col("k") < 7, F.substring(line, 1, 12)).otherwise(line).alias("value"))


def broken_json(spark, sf):
    """Broken lines are left out by the normaliser, returned as evidence and counted."""
    raw = damaged_json(spark, sf)
    kept = N.normalize_sysmon_raw(raw).agg(F.count("*").alias("rows"), F.count("User").alias("with_user"))
    rest = N.unparsed(raw).agg(F.count("*").alias("broken"), F.max(F.length("value")).alias("longest"))
    rate = N.conversion_rate(raw, "sysmon").select("raw_count", "converted_count", "success_rate")
    return kept.crossJoin(rest).crossJoin(rate)  # three single rows


BROKEN_JSON = sql(
    """SELECT count(*) FILTER (k >= 7) AS rows, count(*) FILTER (k >= 7) AS with_user, count(*) FILTER (k < 7) AS broken,
  12 AS longest, count(*) AS raw_count, count(*) FILTER (k >= 7) AS converted_count,
  round(count(*) FILTER (k >= 7) * 100.0 / count(*), 2) AS success_rate FROM ev""",
    "ev",
)


def rescued_fields(spark, sf):
    """A later format: a new field, a value of another type, and lines that are no objects."""
    e, k = T.events(spark, sf), F.col("k")
    line = F.when(k == 7, F.lit("{broken")).otherwise(
        text(
            '{"event_id":', F.col("event_id"), ',"score":', F.when(k % 5 == 0, F.lit('"n/a"')).otherwise(k.cast("string")),
            F.when(k % 3 == 0, F.lit(',"extra":{"a":1}')).otherwise(""), "}",
        )
    )
    path = scratch_path(spark, "rescued")
    e.select(line.alias("value")).write.text(path)
    return files.read_json_rescued(spark, path, schemas.flat("event_id long, score int"))


RESCUED_FIELDS = sql(
    """SELECT CASE WHEN k <> 7 THEN event_id END AS event_id, CASE WHEN k <> 7 AND k % 5 <> 0 THEN k END AS score,
  CASE WHEN k = 7 THEN '{"_line":"{broken"}' WHEN k % 5 = 0 AND k % 3 = 0 THEN '{"score":"n/a","extra":"{\\"a\\":1}"}'
    WHEN k % 5 = 0 THEN '{"score":"n/a"}' WHEN k % 3 = 0 THEN '{"extra":"{\\"a\\":1}"}' END AS rescued FROM ev""",
    "ev",
)


def silver_table(table, *drop):
    return lambda spark, sf: plain(table(spark, sf).drop(*drop))


def _cols(schema):
    out = []
    for f in schemas.SILVER[schema].fields:
        q = f'"{f.name}"' if f.name == "user" else f.name
        out.append(f"{shown(q)} AS {q}" if f.dataType.typeName() == "timestamp" else q)
    return ", ".join(out)


def silver_sql(schema, view):
    return sql(f"SELECT {_cols(schema)} FROM {view}", view)


def common_counts(spark, sf):
    out = common(spark, sf).groupBy("log_source", "event_category").agg(
        F.count("*").alias("n"), F.count_distinct("user").alias("users"), F.count("source_ip").alias("with_ip"),
        F.max("event_time").alias("last_event"),
    )
    return plain(out)


COMMON_COUNTS = over_common(
    f"""SELECT log_source, event_category, count(*) AS n, count(DISTINCT "user") AS users,
  count(source_ip) AS with_ip, {shown('max(event_time)')} AS last_event FROM common GROUP BY log_source, event_category"""
)


def expectations(spark, sf):
    net = silver.sysmon_network(T.raw_network(spark, sf), keep_incomplete=True)
    rules = {**Q.SILVER_RULES["sysmon_network"], "has_address": "destination_ip IS NOT NULL"}
    return Q.expectation_counts(net, rules, "sysmon_network")


EXPECTATIONS = """SELECT 'sysmon_network' AS table_name, r AS rule,
  count(*) FILTER (r <> 'has_address' OR l_tax > 0 OR l_discount > 0) AS passed,
  count(*) FILTER (r = 'has_address' AND l_tax <= 0 AND l_discount <= 0) AS failed
FROM (SELECT *, unnest(['valid_timestamp', 'valid_destination', 'has_address']) AS r FROM lineitem) GROUP BY r"""


def quarantined(spark, sf):
    net = silver.sysmon_network(T.raw_network(spark, sf), keep_incomplete=True)
    flagged, _ = Q.expect(net, {"has_address": "destination_ip IS NOT NULL"}, "flag")
    good, bad = Q.quarantine(flagged)
    part = lambda df, name: df.groupBy("port_classification").agg(F.count("*").alias("n")).withColumn("part", F.lit(name))
    return part(good, "good").unionByName(part(bad, "quarantine"))


QUARANTINED = """SELECT CASE WHEN l_linenumber IN (3, 4, 7) THEN 'lateral_movement_port' WHEN l_linenumber IN (5, 6)
    THEN 'c2_common_port' ELSE 'normal' END AS port_classification, count(*) AS n,
  CASE WHEN l_tax > 0 OR l_discount > 0 THEN 'good' ELSE 'quarantine' END AS part FROM lineitem GROUP BY ALL"""


def dropped(spark, sf):
    net = silver.sysmon_network(T.raw_network(spark, sf), keep_incomplete=True)
    kept, _ = Q.expect(net, {"has_address": "destination_ip IS NOT NULL"}, "drop")
    return kept.groupBy("host").agg(F.count("*").alias("n"))


def nulls(spark, sf):
    return Q.null_rates(T.okta(spark, sf), ["event_time", "country", "target_application"], "okta_auth")


NULLS = sql(
    "SELECT 'okta_auth' AS table_name, c AS column_name, count(*) AS total_count, sum(x)::BIGINT AS null_count, "
    "round(sum(x) * 100.0 / count(*), 2) AS null_pct, sum(x) * 100.0 / count(*) < 5 AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS x FROM okta"
        for c in ("event_time", "country", "target_application")
    )
    + ") GROUP BY c",
    "okta",
)


def json_extract(spark, sf):
    parsed = F.from_json("props", "k int")
    return load(spark, sf, "events").select("event_id", parsed["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text"))


def json_explode(spark, sf):
    """Turns wrapped in a JSON array of records and unwrapped again."""
    turn = F.struct("turn", "role", F.length("text").alias("chars"))
    lines = load(spark, sf, "conversations").select("conv_id", F.to_json(F.struct(F.array(turn).alias("Records"))).alias("value"))
    records = F.from_json("value", "Records array<struct<turn bigint, role string, chars int>>")["Records"]
    return lines.select("conv_id", F.explode(records).alias("r")).select("conv_id", "r.*")


def unexpected(spark, sf):
    lines = load(spark, sf, "events").select(F.col("props").alias("value"))
    return files.unexpected_keys(lines, schemas.flat("a string, b string"))


def xml_files(spark, sf):
    """Event XML written as files with prologs, read back by the event reader."""
    path = scratch_path(spark, "xml") + "/events"
    sysmon_xml(spark, sf).select("value").write.text(path)
    return plain(N.normalize_sysmon_raw(files.read_event_xml(spark, path, glob="*.txt")).select(*_SYSMON_COLS))


def json_files(spark, sf):
    """JSON lines in gzip files, read back with an explicit schema and file origin."""
    path = scratch_path(spark, "json")
    rows = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    rows.write.option("compression", "gzip").json(path)
    back = files.with_origin(files.read_json(spark, path, rows.schema, recursive=True))
    return files.spread(back, spark.sparkContext.defaultParallelism).groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.max("event_id").alias("last_id"),
        F.count("source_file").alias("with_file"),
    )


def report(spark, sf):
    path = scratch_path(spark, "report")
    load(spark, sf, "events").select("event_id").write.json(path)
    schema = schemas.flat("event_id long")
    return files.source_report(spark, {"events": (path, schema), "missing": (path + "-none", schema)}).fillna(-1, ["events"])


def since(spark, sf):
    rows = load(spark, sf, "events")
    done = rows.where(F.col("ts") <= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return plain(tables.read_since(rows, done, "ts", E).select("event_id", "ts"))


SINCE = f"""SELECT event_id, {shown('ts')} AS ts FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00') AND ts <= TIMESTAMP '{E}'"""


def named_parameter(spark, sf):
    load(spark, sf, "events").createOrReplaceTempView("events_param")
    return tables.query(
        spark, "SELECT event_type, count(*) AS n, sum(value) AS total FROM events_param WHERE user_id = :user GROUP BY event_type",
        user=17,
    ).withColumn("total", F.round("total", 4))


def namespace_tables(spark, sf):
    """SRC-14, SRC-15: silver tables in a namespace of their own, listed, counted and looked at."""
    before, name = spark.catalog.currentDatabase(), f"watch_{uuid.uuid4().hex}"
    kept = {"okta_auth": T.okta(spark, sf), "sysmon_process": T.process(spark, sf), "windows_auth": T.windows(spark, sf)}
    try:
        tables.use_namespace(spark, name)
        for table, df in kept.items():
            df.write.saveAsTable(table)
        found = tables.use_namespace(spark, name).select("tableName")
        # The tables belong to no namespace that is current, so that the result can be read later.
        stored = {table: spark.table(f"{name}.{table}") for table in kept}
    finally:
        spark.catalog.setCurrentDatabase(before)
    counts = None
    for table, df in stored.items():
        seen = tables.preview(df.select("event_time"), 3).distinct().withColumn("_seen", F.lit(True))
        rows = df.select("event_time").join(F.broadcast(seen), "event_time", "left").agg(
            F.count("*").alias("rows"), F.count_distinct(F.when(F.col("_seen"), F.col("event_time"))).alias("previewed")
        )
        rows = rows.select(F.lit(table).alias("tableName"), "rows", F.col("previewed").between(1, 3).alias("previewed"))
        counts = rows if counts is None else counts.unionByName(rows)
    return found.join(counts, "tableName", "full")


NAMESPACE_TABLES = sql(
    """SELECT 'okta_auth' AS "tableName", count(*) AS rows, true AS previewed FROM okta
UNION ALL SELECT 'sysmon_process', count(*), true FROM process
UNION ALL SELECT 'windows_auth', count(*), true FROM windows""",
    "okta", "process", "windows",
)


QUERIES = {
    "nrm_sysmon_xml": (nrm_sysmon_xml, sql(f"SELECT {_SYSMON_SQL} FROM ev", "ev")),
    "nrm_sysmon_json": (nrm_sysmon_json, sql(f"SELECT {_SYSMON_SQL} FROM ev", "ev")),
    "nrm_windows_xml": (nrm_windows, NRM_WINDOWS),
    "nrm_okta_api": (nrm_okta, NRM_OKTA),
    "read_json_answers": (okta_arrays, NRM_OKTA),
    "nrm_cloudtrail_records": (nrm_cloudtrail, NRM_CLOUDTRAIL),
    "raw_to_silver_sysmon": (sysmon_to_silver, SYSMON_TO_SILVER),
    "raw_to_silver_windows": (windows_to_silver, WINDOWS_TO_SILVER),
    "raw_to_silver_okta": (okta_to_silver, OKTA_TO_SILVER),
    "raw_to_silver_cloudtrail": (cloudtrail_to_silver, CLOUDTRAIL_TO_SILVER),
    "convert_sysmon_xml": (convert_sysmon, CONVERT_SYSMON),
    "convert_windows_xml": (convert_windows, CONVERT_WINDOWS),
    "convert_okta_api": (convert_okta, CONVERT_OKTA),
    "convert_cloudtrail": (convert_cloud, CONVERT_CLOUD),
    "conversion_rate": (conversion, CONVERSION),
    "unparsed_records": (unparsed, sql("SELECT count(*) AS n, 300 AS longest FROM ev WHERE k < 7", "ev")),
    "broken_json_records": (broken_json, BROKEN_JSON),
    "bronze_rescued_fields": (rescued_fields, RESCUED_FIELDS),
    "silver_sysmon_process": (silver_table(T.process), silver_sql("sysmon_process", "process")),
    "silver_sysmon_network": (silver_table(T.network), silver_sql("sysmon_network", "network")),
    "silver_okta_auth": (silver_table(T.okta), silver_sql("okta_auth", "okta")),
    "silver_windows_auth": (silver_table(T.windows), silver_sql("windows_auth", "windows")),
    "silver_cloudtrail": (silver_table(T.cloud), silver_sql("cloudtrail", "cloud")),
    "common_events": (common_counts, COMMON_COUNTS),
    "detect_registry_run_key": (registry_keys, REGISTRY_KEYS),
    "expect_counts": (expectations, EXPECTATIONS),
    "expect_quarantine": (quarantined, QUARANTINED),
    "expect_drop": (
        dropped,
        "SELECT 'WS-' || l_suppkey AS host, count(*) AS n FROM lineitem WHERE l_tax > 0 OR l_discount > 0 GROUP BY 1",
    ),
    "null_rate_checks": (nulls, NULLS),
    "json_extract_props": (
        json_extract,
        sql("SELECT event_id, k, CAST(k AS VARCHAR) AS k_text FROM ev", "ev"),
    ),
    "json_explode_records": (
        json_explode,
        "SELECT conv_id, turn, role, CAST(length(text) AS INTEGER) AS chars FROM conversations",
    ),
    "json_unexpected_keys": (unexpected, "SELECT 'k' AS key, count(*) AS rows FROM events"),
    "read_event_xml_files": (xml_files, sql(f"SELECT {_SYSMON_SQL} FROM ev", "ev")),
    "read_json_gzip_files": (
        json_files,
        """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, max(event_id) AS last_id,
  count(*) AS with_file FROM events GROUP BY event_type""",
    ),
    "source_report": (
        report,
        "SELECT 'events' AS source, count(*) AS events, true AS available FROM events UNION ALL SELECT 'missing', -1, false",
    ),
    "read_since_mark": (since, SINCE),
    "namespace_tables": (namespace_tables, NAMESPACE_TABLES),
    "query_named_parameter": (
        named_parameter,
        "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE user_id = 17 GROUP BY event_type",
    ),
}
