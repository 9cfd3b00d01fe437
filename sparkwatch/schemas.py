"""Field lists of the raw, canonical, silver and gold tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "date": DateType(),
    "array<string>": ArrayType(StringType()),
}


def flat(fields: str) -> StructType:
    """Schema of ``name type`` pairs separated by commas."""
    pairs = (f.split() for f in fields.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


def nested(text: str = "", **fields: DataType) -> StructType:
    """Schema of string fields named in ``text``, then of ``fields``."""
    strings = [StructField(n, StringType()) for n in text.split()]
    return StructType(strings + [StructField(n, t) for n, t in fields.items()])


# Raw shapes as delivered by the sources.

RAW_SYSMON = flat(
    "EventID int, EventTime string, Computer string, ProcessName string, ProcessId double,"
    "CommandLine string, User string, ParentProcessName string, ParentProcessId double,"
    "SHA256 string, DestinationIP string, DestinationPort double, TargetObject string"
)

_PLACE = "city state country postalCode"
_ACTOR = "id type alternateId displayName"

RAW_OKTA = nested(
    "uuid published eventType displayMessage severity",
    actor=nested(_ACTOR),
    client=nested("userAgent ipAddress", geographicalContext=nested(_PLACE)),
    outcome=nested("result reason"),
    target=ArrayType(nested(_ACTOR)),
)

RAW_OKTA_API = nested(
    "uuid published eventType version severity displayMessage legacyEventType",
    actor=nested(_ACTOR + " detailEntry"),
    client=nested(
        "zone device id ipAddress",
        userAgent=nested("rawUserAgent os browser"),
        geographicalContext=nested(_PLACE, geolocation=flat("lat double, lon double")),
    ),
    outcome=nested("result reason"),
    target=ArrayType(nested(_ACTOR)),
    transaction=nested("type id", detail=MapType(StringType(), StringType())),
    debugContext=nested(debugData=nested("requestId requestUri threatSuspected url")),
    authenticationContext=nested(
        "authenticationProvider credentialProvider credentialType issuer externalSessionId interface"
    ),
)

RAW_WINDOWS = flat(
    "EventID int, TimeCreated string, Computer string, EventRecordID long, Channel string,"
    "LogonType double, LogonTypeName string, TargetUserName string, TargetDomainName string,"
    "WorkstationName string, SourceNetworkAddress string, SourcePort double, Status string,"
    "SubStatus string, ProcessName string"
)

RAW_CLOUDTRAIL = nested(
    "eventVersion eventTime eventID eventName eventType eventSource awsRegion sourceIPAddress "
    "userAgent errorCode errorMessage requestID recipientAccountId",
    userIdentity=nested("type principalId arn accountId accessKeyId userName"),
    requestParameters=nested("bucketName key userName"),
    responseElements=nested("status"),
    resources=ArrayType(nested("ARN accountId type")),
    readOnly=BooleanType(),
    managementEvent=BooleanType(),
)
RAW_CLOUDTRAIL_FILE = nested(Records=ArrayType(RAW_CLOUDTRAIL))

EVENT_XML = nested(
    System=nested(
        "EventID EventRecordID Channel Computer Level Task Keywords",
        Provider=nested("_Name _Guid"),
        TimeCreated=nested("_SystemTime"),
        Security=nested("_UserID"),
    ),
    EventData=nested(Data=ArrayType(nested("_Name _VALUE"))),
    RenderingInfo=nested("Message"),
    _corrupt=StringType(),
)

# Canonical flat tables, one per source.

SYSMON = flat(
    "EventID int, EventTime timestamp, Computer string, User string, ProcessGuid string,"
    "ProcessId int, Image string, CommandLine string, CurrentDirectory string,"
    "ParentImage string, ParentCommandLine string, ParentProcessGuid string,"
    "ParentProcessId int, TargetFilename string, DestinationIp string, DestinationPort int,"
    "SourceIp string, SourcePort int, Protocol string, Hashes string, RawEventData string"
)

WINDOWS = flat(
    "EventID int, EventRecordID long, TimeCreated timestamp, Computer string, Channel string,"
    "Level string, Task string, Keywords string, ProviderName string, ProviderGuid string,"
    "UserID string, AccountName string, AccountDomain string, LogonID string, ProcessID int,"
    "ProcessName string, IpAddress string, IpPort int, TargetUserName string,"
    "TargetDomainName string, LogonType int, Message string, EventData string"
)

OKTA = flat(
    "uuid string, published timestamp, eventType string, version string, severity string,"
    "displayMessage string, actor_id string, actor_type string, actor_alternateId string,"
    "actor_displayName string, client_userAgent_rawUserAgent string, client_userAgent_os string,"
    "client_userAgent_browser string, client_device string, client_ipAddress string,"
    "client_geographicalContext_city string, client_geographicalContext_state string,"
    "client_geographicalContext_country string, outcome_result string, outcome_reason string,"
    "target string, authenticationContext string, debugContext string"
)

CLOUDTRAIL = flat(
    "eventVersion string, eventTime timestamp, eventID string, eventType string,"
    "eventName string, eventSource string, awsRegion string, sourceIPAddress string,"
    "userAgent string, errorCode string, errorMessage string, requestID string,"
    "userIdentity_type string, userIdentity_principalId string, userIdentity_arn string,"
    "userIdentity_accountId string, userIdentity_accessKeyId string,"
    "userIdentity_userName string, requestParameters string, responseElements string,"
    "resources string"
)

# Silver tables.

SILVER = {
    "sysmon_process": flat(
        "event_time timestamp, host string, process_name string, process_id int,"
        "command_line string, user string, parent_process_name string, parent_process_id int,"
        "file_hash_sha256 string, threat_indicator string, log_source string,"
        "event_category string, processed_timestamp timestamp"
    ),
    "sysmon_network": flat(
        "event_time timestamp, host string, process_name string, process_id int, user string,"
        "destination_ip string, destination_port int, port_classification string,"
        "log_source string, event_category string, processed_timestamp timestamp"
    ),
    "sysmon_registry": flat(
        "event_time timestamp, host string, user string, process_name string, registry_path string,"
        "log_source string, event_category string, processed_timestamp timestamp"
    ),
    "okta_auth": flat(
        "event_time timestamp, event_id string, event_type string, user_email string,"
        "user_name string, source_ip string, user_agent string, city string, country string,"
        "outcome string, failure_reason string, target_application string,"
        "risk_indicator string, log_source string, event_category string,"
        "processed_timestamp timestamp"
    ),
    "windows_auth": flat(
        "event_time timestamp, event_id int, host string, logon_type int,"
        "logon_type_name string, user_name string, domain string, workstation string,"
        "source_ip string, status_code string, logon_classification string,"
        "logon_success boolean, log_source string, event_category string,"
        "processed_timestamp timestamp"
    ),
    "cloudtrail": flat(
        "event_time timestamp, event_id string, event_name string, event_type string,"
        "service string, region string, source_ip string, user_agent string,"
        "error_code string, error_message string, user_name string, principal_id string,"
        "user_arn string, s3_bucket string, target_user string, risk_classification string,"
        "api_success boolean, log_source string, event_category string,"
        "processed_timestamp timestamp"
    ),
}

# Gold tables.

ALERTS = flat(
    "alert_id string, detection_time timestamp, event_time timestamp, alert_title string,"
    "description string, severity string, mitre_technique string, mitre_tactic string,"
    "detection_rule string, user string, host string, source_ip string, context string,"
    "status string, assigned_to string, notes string, updated_at timestamp"
)

# States of an alert.
STATUSES = ("NEW", "INVESTIGATING", "FALSE_POSITIVE", "TRUE_POSITIVE", "RESOLVED")

STATUS_EVENTS = flat(
    "alert_id string, status string, assigned_to string, notes string, updated_at timestamp"
)

RULES = flat(
    "rule_id string, rule_name string, rule_version string, rule_query string,"
    "description string, severity string, mitre_technique string, mitre_tactic string,"
    "enabled boolean, false_positive_rate double, last_tuned_date timestamp,"
    "created_by string, created_at timestamp, updated_at timestamp, tags array<string>,"
    "detection_rule string"
)
