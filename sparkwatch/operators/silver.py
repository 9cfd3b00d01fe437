"""NRM-07 to NRM-12: typed, classified event tables from raw records.

The functions are plain projections and filters and run unchanged on streams.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from sparkwatch.functions.text import first_match, to_int

# Patterns and codes behind the classification columns.
TOOL_NAMES = "mimikatz|procdump|psexec|pwdump"
COMMAND_FLAGS = "-enc|-encodedcommand|-w hidden|-nop"
DOWNLOAD_CALLS = "iex|invoke-|downloadstring"
LATERAL_PORTS = (22, 3389, 445, 135)
C2_PORTS = (4444, 8080, 1337)
PRIVILEGED_EVENTS = "admin|policy|mfa"
LOGON_EVENTS = (4624, 4625, 4672)
HIGH_RISK_CALLS = "Create.*Key|Attach.*Policy|Create.*User|Delete.*"


def _time(df: DataFrame, name: str) -> Column:
    """PRJ-05: text to timestamp; a column that is a time already stays as it is,
    so that time filters still reach the files."""
    if isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType)):
        return F.col(name)
    return F.try_to_timestamp(F.col(name).cast("string"))


def _labels(source: str, category: str) -> list[Column]:
    return [
        F.lit(source).alias("log_source"),
        F.lit(category).alias("event_category"),
        F.current_timestamp().alias("processed_timestamp"),
    ]


def sysmon_process(raw: DataFrame) -> DataFrame:
    """NRM-07: process starts (EventID 1) with a threat indicator."""
    name, command = F.lower("ProcessName"), F.lower("CommandLine")
    threat = first_match(
        [
            (name.rlike(TOOL_NAMES), "suspicious_process"),
            (command.rlike(COMMAND_FLAGS), "suspicious_commandline"),
            (name.contains("powershell") & command.rlike(DOWNLOAD_CALLS), "powershell_download"),
        ],
        "normal",
    )
    return raw.where(F.col("EventID") == 1).select(
        _time(raw, "EventTime").alias("event_time"),
        F.col("Computer").alias("host"),
        F.col("ProcessName").alias("process_name"),
        to_int(F.col("ProcessId")).alias("process_id"),
        F.col("CommandLine").alias("command_line"),
        F.col("User").alias("user"),
        F.col("ParentProcessName").alias("parent_process_name"),
        to_int(F.col("ParentProcessId")).alias("parent_process_id"),
        F.col("SHA256").alias("file_hash_sha256"),
        threat.alias("threat_indicator"),
        *_labels("sysmon", "process_creation"),
    )


def sysmon_network(raw: DataFrame, keep_incomplete: bool = False) -> DataFrame:
    """NRM-08: connections (EventID 3) with a port class.

    ``keep_incomplete`` leaves rows without a destination in, so that an
    expectation on the destination can see them before they are filtered.
    """
    port = to_int(F.col("DestinationPort"))
    kind = first_match(
        [
            (port.isin(*LATERAL_PORTS), "lateral_movement_port"),
            (port.isin(*C2_PORTS), "c2_common_port"),
        ],
        "normal",
    )
    rows = raw.where(F.col("EventID") == 3)
    if not keep_incomplete:
        rows = rows.where(F.col("DestinationIP").isNotNull())
    return rows.select(
        _time(raw, "EventTime").alias("event_time"),
        F.col("Computer").alias("host"),
        F.col("ProcessName").alias("process_name"),
        to_int(F.col("ProcessId")).alias("process_id"),
        F.col("User").alias("user"),
        F.col("DestinationIP").alias("destination_ip"),
        port.alias("destination_port"),
        kind.alias("port_classification"),
        *_labels("sysmon", "network_connection"),
    )


def okta_auth(raw: DataFrame) -> DataFrame:
    """NRM-09: identity events, flat, with a risk indicator."""
    result = F.col("outcome.result")
    risk = first_match(
        [
            (result == "FAILURE", "failed_auth"),
            (F.col("eventType").rlike(PRIVILEGED_EVENTS) & (result == "SUCCESS"), "privileged_action"),
        ],
        "normal",
    )
    return raw.select(
        _time(raw, "published").alias("event_time"),
        F.col("uuid").alias("event_id"),
        F.col("eventType").alias("event_type"),
        F.col("actor.alternateId").alias("user_email"),
        F.col("actor.displayName").alias("user_name"),
        F.col("client.ipAddress").alias("source_ip"),
        F.col("client.userAgent").alias("user_agent"),
        F.col("client.geographicalContext.city").alias("city"),
        F.col("client.geographicalContext.country").alias("country"),
        result.alias("outcome"),
        F.col("outcome.reason").alias("failure_reason"),
        F.get("target", F.lit(0))["displayName"].alias("target_application"),
        risk.alias("risk_indicator"),
        *_labels("okta", "authentication"),
    )


def windows_auth(raw: DataFrame) -> DataFrame:
    """NRM-10: logon events with a class and a success flag."""
    event, logon = F.col("EventID"), to_int(F.col("LogonType"))
    kind = first_match(
        [
            (event == 4625, "failed_logon"),
            (event == 4672, "privileged_logon"),
            (logon == 10, "rdp_logon"),
            (logon == 3, "network_logon"),
        ],
        "normal_logon",
    )
    return raw.where(event.isin(*LOGON_EVENTS)).select(
        _time(raw, "TimeCreated").alias("event_time"),
        event.cast("int").alias("event_id"),
        F.col("Computer").alias("host"),
        logon.alias("logon_type"),
        F.col("LogonTypeName").alias("logon_type_name"),
        F.col("TargetUserName").alias("user_name"),
        F.col("TargetDomainName").alias("domain"),
        F.col("WorkstationName").alias("workstation"),
        F.col("SourceNetworkAddress").alias("source_ip"),
        F.col("Status").alias("status_code"),
        kind.alias("logon_classification"),
        (event != 4625).alias("logon_success"),
        *_labels("windows_security", "authentication"),
    )


def cloudtrail(raw: DataFrame) -> DataFrame:
    """NRM-11: cloud API calls with a risk class and a success flag."""
    error = F.col("errorCode")
    risk = first_match(
        [
            (F.col("eventName").rlike(HIGH_RISK_CALLS), "high_risk_action"),
            (error.isNotNull(), "failed_api_call"),
        ],
        "normal",
    )
    return raw.select(
        _time(raw, "eventTime").alias("event_time"),
        F.col("eventID").alias("event_id"),
        F.col("eventName").alias("event_name"),
        F.col("eventType").alias("event_type"),
        F.col("eventSource").alias("service"),
        F.col("awsRegion").alias("region"),
        F.col("sourceIPAddress").alias("source_ip"),
        F.col("userAgent").alias("user_agent"),
        error.alias("error_code"),
        F.col("errorMessage").alias("error_message"),
        F.col("userIdentity.userName").alias("user_name"),
        F.col("userIdentity.principalId").alias("principal_id"),
        F.col("userIdentity.arn").alias("user_arn"),
        F.col("requestParameters.bucketName").alias("s3_bucket"),
        F.col("requestParameters.userName").alias("target_user"),
        risk.alias("risk_classification"),
        error.isNull().alias("api_success"),
        *_labels("cloudtrail", "cloud_api"),
    )


def sysmon_registry(raw: DataFrame) -> DataFrame:
    """Registry changes (EventID 12 to 14), needed by the run-key rule.

    Reads canonical host events, whose registry path is in the event data, and flat raw
    ones, which have a column for it.
    """
    flat = "TargetObject" in raw.columns
    path = F.col("TargetObject") if flat else F.get_json_object("RawEventData", "$.TargetObject")
    image = F.col("ProcessName") if flat else F.regexp_extract("Image", r"([^\\/]*)$", 1)
    return raw.where(F.col("EventID").between(12, 14)).select(
        _time(raw, "EventTime").alias("event_time"),
        F.col("Computer").alias("host"),
        F.col("User").alias("user"),
        image.alias("process_name"),
        path.alias("registry_path"),
        *_labels("sysmon", "registry_change"),
    )


# Silver column that names the acting user and the address, per table.
ACTORS = {
    "sysmon_process": ("user", None),
    "sysmon_network": ("user", None),
    "okta_auth": ("user_email", "source_ip"),
    "windows_auth": ("user_name", "source_ip"),
    "cloudtrail": ("user_name", "source_ip"),
}


def common_events(silver: dict[str, DataFrame]) -> DataFrame:
    """NRM-12: the silver tables in one narrow shape (SET-01)."""
    parts = []
    for name, df in silver.items():
        user, ip = ACTORS[name]
        parts.append(
            df.select(
                "log_source",
                "event_category",
                "event_time",
                F.col(user).alias("user"),
                (F.col(ip) if ip else F.lit(None).cast("string")).alias("source_ip"),
                "processed_timestamp",
            )
        )
    return reduce(DataFrame.unionByName, parts)
