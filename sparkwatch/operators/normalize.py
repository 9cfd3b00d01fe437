"""NRM-01 to NRM-05: raw records to one flat table per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructType, TimestampType

from sparkwatch import schemas
from sparkwatch.functions.text import base_name, or_else, to_int


def _conform(df: DataFrame, schema: StructType, extra: list[Column]) -> DataFrame:
    """PRJ-07: the columns of ``schema`` in order, cast without failing rows."""
    out = []
    for field in schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, IntegerType):
            c = to_int(c)
        elif isinstance(field.dataType, LongType):
            c = c.try_cast("long")
        elif isinstance(field.dataType, TimestampType):
            c = F.try_to_timestamp(c.cast("string"))
        out.append(c.alias(field.name))
    return df.select(*out, *extra)


def _stamp(source: str) -> list[Column]:
    return [
        F.current_timestamp().alias("ingestion_timestamp"),
        F.lit(source).alias("source_system"),
    ]


def _once(df: DataFrame, **parsed: Column) -> DataFrame:
    """Add costly columns so that each is computed once per row.

    A filter on a projected column is pushed below the projection and repeats
    its expression there; a filter on a generated column stays above.
    """
    one = F.array(F.struct(*[c.alias(name) for name, c in parsed.items()]))
    return df.select("*", F.explode(one).alias("_one")).select("*", "_one.*").drop("_one")


def _event(text: Column) -> Column:
    return F.from_xml(text, schemas.EVENT_XML, {"columnNameOfCorruptRecord": "_corrupt"})


def parse_event_xml(df: DataFrame, names: list[str], text: str = "value") -> DataFrame:
    """UDF-01, UDF-02: event XML to struct ``event``, the named values of its
    EventData as JSON in ``data_json``, and those in ``names`` as struct ``data``.

    For a repeated name the last value counts; an empty element is an empty
    string. ``event._corrupt`` keeps the text that could not be parsed.
    """
    return _with_data(_once(df, event=_event(F.col(text))), names)


def _with_data(df: DataFrame, names: Sequence[str], otherwise: Column | None = None) -> DataFrame:
    """The struct is read from the JSON in one go: twenty lookups in a map make
    a generated method so long that the JVM does not compile it. Where there is no
    event it is read from ``otherwise``."""
    named = F.filter(F.col("event.EventData.Data"), lambda d: d["_Name"].isNotNull())
    pairs_type = "array<struct<_Name:string,_VALUE:string>>"
    df = df.withColumn("_data", F.when(_is_event(F.col("event")), F.coalesce(named, F.array().cast(pairs_type))))
    df = df.withColumn("data_json", F.to_json(F.map_from_entries(_last_of_each(F.col("_data"))))).drop("_data")
    text = F.col("data_json") if otherwise is None else F.coalesce("data_json", otherwise)
    return _once(df, data=_json(text, names))


def _last_of_each(data: Column) -> Column:
    """Entries (name, value) of a list of named values, the last of each name, in the order of the list.

    Almost no event repeats a name, which a hash of the names tells. Otherwise entries are sorted by
    name and place, those followed by their own name go, and the rest is sorted back by place.
    """
    entry = lambda d: F.struct(d["_Name"].alias("key"), F.coalesce(d["_VALUE"], F.lit("")).alias("value"))
    numbered = F.array_sort(
        F.transform(data, lambda d, i: F.struct(d["_Name"].alias("_Name"), i.alias("i"), d["_VALUE"].alias("_VALUE")))
    )
    beside = F.zip_with(
        numbered,
        F.slice(numbered, F.lit(2), F.size(data)),
        lambda d, after: F.struct(d["i"].alias("i"), d.alias("d"), after["_Name"].alias("after")),
    )
    last = F.filter(beside, lambda p: p["after"].isNull() | (p["after"] != p["d"]["_Name"]))
    repeated = F.size(F.array_distinct(F.transform(data, lambda d: d["_Name"]))) < F.size(data)
    return F.when(repeated, F.transform(F.array_sort(last), lambda p: entry(p["d"]))).otherwise(F.transform(data, entry))


#: JSON as its standard has it; ``_corrupt`` keeps the text of what is none.
_STRICT = {"columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _json(text: Column, names: Sequence[str] = ()) -> Column:
    """The fields ``names`` of a JSON object as text, parsed once; of a repeated field the last."""
    schema = schemas.nested(" ".join([*names, "_corrupt"]))
    return F.from_json(F.when(text.startswith("{"), text), schema, _STRICT)


def _is_json(parsed: Column) -> Column:
    return parsed.isNotNull() & parsed["_corrupt"].isNull()


def _is_event(event: Column) -> Column:
    return event.isNotNull() & event["_corrupt"].isNull() & event["System"].isNotNull()


def unparsed(df: DataFrame, text: str = "value") -> DataFrame:
    """Records that are neither readable event XML nor a JSON object.

    The normalisers leave such rows out, this gives them back as evidence.
    """
    value = F.col(text)
    good = F.coalesce(_is_event(F.col("event")), F.lit(False)) | F.coalesce(_is_json(F.col("json")), F.lit(False))
    return _once(df, event=_event(F.when(value.startswith("<Event"), value)), json=_json(value)).where(~good).drop(
        "event", "json"
    )


def normalize_sysmon_raw(df: DataFrame, text: str = "value") -> DataFrame:
    """NRM-01: host events in XML or JSON text to the canonical table.

    One pass: XML gives the JSON of its named values and a JSON record is its own, so both are
    read into the same columns. Records that are not readable are left out; ``unparsed`` returns them.
    """
    return _sysmon(df, text, otherwise=F.col("value"))


def _sysmon(df: DataFrame, text: str, otherwise: Column | None = None) -> DataFrame:
    value = F.col("value")
    names = [f.name for f in schemas.SYSMON.fields]
    parsed = _once(df.select(F.col(text).alias("value")), event=_event(F.when(value.startswith("<Event"), value)))
    rows = _with_data(parsed, names, otherwise).where(_is_json(F.col("data")))
    system = {
        "EventID": F.col("event.System.EventID"),
        "EventTime": F.col("event.System.TimeCreated._SystemTime"),
        "Computer": F.col("event.System.Computer"),
        "RawEventData": F.col("data_json"),
    }
    data = lambda n: F.col("data")[n]
    rows = rows.select(*[(F.coalesce(system[n], data(n)) if n in system else data(n)).alias(n) for n in names])
    return _conform(rows, schemas.SYSMON, _stamp("sysmon"))


_WINDOWS_DATA = (
    "SubjectUserName TargetUserName SubjectDomainName TargetDomainName SubjectLogonId TargetLogonId "
    "ProcessId ProcessName IpAddress IpPort LogonType Status WorkstationName"
).split()


def normalize_windows_raw(df: DataFrame, text: str = "value") -> DataFrame:
    """NRM-02: Windows event XML to the canonical table, with status and workstation.

    Other records are left out after parsing: a filter on the text would be pushed below the
    projection that makes it, and make it twice.
    """
    value = F.col(text)
    good = _once(df, event=_event(F.when(value.startswith("<Event"), value)))
    parsed = _with_data(good.where(_is_event(F.col("event"))), _WINDOWS_DATA)
    data = lambda name: F.col("data")[name]
    system = lambda name: F.col(f"event.System.{name}")
    rows = parsed.select(
        *[system(n).alias(n) for n in ("EventID", "EventRecordID", "Computer", "Channel", "Level", "Task", "Keywords")],
        system("TimeCreated._SystemTime").alias("TimeCreated"),
        system("Provider._Name").alias("ProviderName"),
        system("Provider._Guid").alias("ProviderGuid"),
        system("Security._UserID").alias("UserID"),
        or_else(data("SubjectUserName"), data("TargetUserName")).alias("AccountName"),
        or_else(data("SubjectDomainName"), data("TargetDomainName")).alias("AccountDomain"),
        or_else(data("SubjectLogonId"), data("TargetLogonId")).alias("LogonID"),
        data("ProcessId").alias("ProcessID"),
        *[data(n).alias(n) for n in _WINDOWS_DATA[7:] + ["TargetUserName", "TargetDomainName"]],
        F.col("event.RenderingInfo.Message").alias("Message"),
        F.col("data_json").alias("EventData"),
    )
    return _conform(rows, schemas.WINDOWS, [F.col("Status"), F.col("WorkstationName"), *_stamp("windows")])


def normalize_okta_api(df: DataFrame) -> DataFrame:
    """NRM-03: nested identity events to flat columns; the rest as JSON text."""
    rows = df.select(
        "uuid",
        "published",
        "eventType",
        "version",
        "severity",
        "displayMessage",
        *[F.col(f"actor.{n}").alias(f"actor_{n}") for n in ("id", "type", "alternateId", "displayName")],
        *[
            F.col(f"client.userAgent.{n}").alias(f"client_userAgent_{n}")
            for n in ("rawUserAgent", "os", "browser")
        ],
        F.col("client.device").alias("client_device"),
        F.col("client.ipAddress").alias("client_ipAddress"),
        *[
            F.col(f"client.geographicalContext.{n}").alias(f"client_geographicalContext_{n}")
            for n in ("city", "state", "country")
        ],
        F.col("outcome.result").alias("outcome_result"),
        F.col("outcome.reason").alias("outcome_reason"),
        F.coalesce(F.to_json("target"), F.lit("[]")).alias("target"),
        F.coalesce(F.to_json("authenticationContext"), F.lit("{}")).alias("authenticationContext"),
        F.coalesce(F.to_json("debugContext"), F.lit("{}")).alias("debugContext"),
    )
    return _conform(rows, schemas.OKTA, _stamp("okta"))


def normalize_cloudtrail_raw(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """NRM-04: delivery files with a ``Records`` array to one row per call.

    Delivery files are gzip and each is read by one task; ``partitions``
    spreads the exploded rows before the heavier projection.
    """
    records = df.select(F.explode("Records").alias("r")).select("r.*")
    if partitions:
        records = records.repartition(partitions)
    identity = ("type", "principalId", "arn", "accountId", "accessKeyId", "userName")
    rows = records.select(
        *[
            n
            for n in (
                "eventVersion eventTime eventID eventType eventName eventSource awsRegion "
                "sourceIPAddress userAgent errorCode errorMessage requestID"
            ).split()
        ],
        *[F.col(f"userIdentity.{n}").alias(f"userIdentity_{n}") for n in identity],
        *[F.to_json(n).alias(n) for n in ("requestParameters", "responseElements", "resources")],
    )
    return _conform(rows, schemas.CLOUDTRAIL, _stamp("cloudtrail"))


def _converted(df: DataFrame, columns: str, source: str, fmt: str) -> DataFrame:
    return df.select(
        *columns.split(),
        F.lit(source).alias("source_system"),
        F.lit(fmt).alias("source_format"),
        F.current_timestamp().alias("conversion_timestamp"),
    )


def convert_sysmon_xml(df: DataFrame, text: str = "value") -> DataFrame:
    """NRM-05: the shorter table of the one-off XML conversion."""
    extra = F.from_json("RawEventData", "IntegrityLevel string, LogonId string")
    rows = _sysmon(df, text)
    return _converted(
        rows.withColumn("_x", extra).withColumns(
            {"IntegrityLevel": F.col("_x.IntegrityLevel"), "LogonId": F.col("_x.LogonId")}
        ),
        "EventID EventTime Computer User ProcessGuid ProcessId Image CommandLine CurrentDirectory "
        "ParentImage ParentCommandLine ParentProcessGuid ParentProcessId Hashes IntegrityLevel LogonId",
        "sysmon",
        "xml",
    )


def convert_windows_xml(df: DataFrame, text: str = "value") -> DataFrame:
    """NRM-05: the shorter Windows table."""
    return _converted(
        normalize_windows_raw(df, text),
        "EventID EventRecordID TimeCreated Computer Channel TargetUserName TargetDomainName "
        "LogonType IpAddress IpPort Status WorkstationName ProcessName",
        "windows",
        "xml",
    )


def convert_okta_api(df: DataFrame) -> DataFrame:
    """NRM-05: the shorter identity table."""
    return _converted(
        normalize_okta_api(df),
        "uuid published eventType severity displayMessage actor_id actor_type actor_alternateId "
        "actor_displayName client_ipAddress client_userAgent_os client_userAgent_browser "
        "client_geographicalContext_city client_geographicalContext_state "
        "client_geographicalContext_country outcome_result outcome_reason",
        "okta",
        "api",
    )


def convert_cloudtrail(df: DataFrame) -> DataFrame:
    """NRM-05: the shorter cloud audit table."""
    return _converted(
        normalize_cloudtrail_raw(df),
        "eventVersion eventTime eventID eventType eventName eventSource awsRegion sourceIPAddress "
        "userAgent errorCode errorMessage requestID userIdentity_type userIdentity_principalId "
        "userIdentity_arn userIdentity_accountId userIdentity_userName",
        "cloudtrail",
        "json_gz",
    )


def conversion_rate(raw: DataFrame, source: str, text: str = "value", formats: Sequence[str] = ("xml", "json")) -> DataFrame:
    """K-31: records in, records a normaliser converts and the share in percent.

    One scan: each record is parsed once and counted by whether it could be. ``formats`` are
    those that the normaliser of the source takes.
    """
    value = F.col(text)
    rows = raw.select(value.alias("value"))
    parsed, good = {}, F.lit(False)
    if "json" in formats:
        parsed["json"] = _json(F.col("value"))
        good = good | F.coalesce(_is_json(F.col("json")), F.lit(False))
    if "xml" in formats:
        parsed["event"] = _event(F.when(F.col("value").startswith("<Event"), F.col("value")))
        good = good | F.coalesce(_is_event(F.col("event")), F.lit(False))
    if parsed:
        rows = _once(rows, **parsed)
    rows = rows.select(good.alias("good"))
    return rows.agg(F.count("*").alias("raw_count"), F.count_if("good").alias("converted_count")).select(
        F.lit(source).alias("source"),
        "raw_count",
        "converted_count",
        F.round(F.try_divide(F.col("converted_count") * 100.0, F.col("raw_count")).cast("double"), 2).alias(
            "success_rate"
        ),
    )


# Canonical tables to the shape the silver tables read.


def sysmon_to_raw(df: DataFrame) -> DataFrame:
    """Process names without their path, the SHA-256 out of the hash list."""
    sha = F.regexp_extract("Hashes", r"SHA256=([0-9A-Fa-f]+)", 1)
    return df.select(
        "EventID",
        "EventTime",
        "Computer",
        base_name(F.col("Image")).alias("ProcessName"),
        "ProcessId",
        "CommandLine",
        "User",
        base_name(F.col("ParentImage")).alias("ParentProcessName"),
        "ParentProcessId",
        F.nullif(sha, F.lit("")).alias("SHA256"),
        F.col("DestinationIp").alias("DestinationIP"),
        "DestinationPort",
    )


# Names of the Windows logon types.
LOGON_TYPES = {
    2: "Interactive",
    3: "Network",
    4: "Batch",
    5: "Service",
    7: "Unlock",
    10: "RemoteInteractive",
    11: "CachedInteractive",
}


def windows_to_raw(df: DataFrame) -> DataFrame:
    """Source address under its raw name, logon type spelled out."""
    name = F.lit(None).cast("string")
    for code, text in LOGON_TYPES.items():
        name = F.when(F.col("LogonType") == code, text).otherwise(name)
    return df.select(
        "EventID",
        "TimeCreated",
        "Computer",
        "LogonType",
        name.alias("LogonTypeName"),
        "TargetUserName",
        "TargetDomainName",
        "WorkstationName",
        F.col("IpAddress").alias("SourceNetworkAddress"),
        "Status",
    )


def okta_to_raw(df: DataFrame) -> DataFrame:
    """Flat identity columns back into the nested raw shape."""
    return df.select(
        "uuid",
        "published",
        "eventType",
        F.struct(
            F.col("actor_alternateId").alias("alternateId"), F.col("actor_displayName").alias("displayName")
        ).alias("actor"),
        F.struct(
            F.col("client_userAgent_rawUserAgent").alias("userAgent"),
            F.col("client_ipAddress").alias("ipAddress"),
            F.struct(
                F.col("client_geographicalContext_city").alias("city"),
                F.col("client_geographicalContext_country").alias("country"),
            ).alias("geographicalContext"),
        ).alias("client"),
        F.struct(F.col("outcome_result").alias("result"), F.col("outcome_reason").alias("reason")).alias(
            "outcome"
        ),
        F.from_json("target", "array<struct<displayName:string>>").alias("target"),
    )


def cloudtrail_to_raw(df: DataFrame) -> DataFrame:
    """Flat audit columns back into the nested raw shape."""
    return df.select(
        "eventTime",
        "eventID",
        "eventName",
        "eventType",
        "eventSource",
        "awsRegion",
        "sourceIPAddress",
        "userAgent",
        "errorCode",
        "errorMessage",
        F.struct(
            F.col("userIdentity_userName").alias("userName"),
            F.col("userIdentity_principalId").alias("principalId"),
            F.col("userIdentity_arn").alias("arn"),
        ).alias("userIdentity"),
        F.from_json("requestParameters", "bucketName string, userName string").alias("requestParameters"),
    )
