"""D-01 to D-19: the detection rules as data over the generic operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkwatch import schemas
from sparkwatch.functions.severity import severity_steps
from sparkwatch.functions.text import contains_any, first_match, sentence, starts_with_any
from sparkwatch.functions.times import AsOf, as_of_bound, minutes_between, since, trailing, until
from sparkwatch.operators.alerts import AlertMap
from sparkwatch.operators.baseline import baseline_zscore
from sparkwatch.operators.cluster import cluster, cluster_outliers, cluster_rounds, user_features
from sparkwatch.operators.rarity import rarity
from sparkwatch.operators.rolling import rolling_zscore
from sparkwatch.operators.sequence import sequence_gap
from sparkwatch.operators.threshold import threshold

# Texts, codes and names the rules look for.
MIMIKATZ_COMMANDS = ("sekurlsa::logonpasswords", "lsadump::sam")
POWERSHELL_ENCODED = ("-enc", "-encodedcommand")
POWERSHELL_HIDDEN = ("-w hidden", "-windowstyle hidden")
POWERSHELL_QUIET = ("-nop", "-noprofile")
POWERSHELL_RUN = ("iex", "invoke-expression")
POWERSHELL_CALLS = ("iex", "invoke-", "downloadstring")
POWERSHELL_LOADS = ("downloadstring", "downloadfile")
IAM_CALLS = (
    "CreateAccessKey",
    "AttachUserPolicy",
    "AttachRolePolicy",
    "PutUserPolicy",
    "PutRolePolicy",
    "CreateUser",
    "CreateLoginProfile",
    "DeleteTrail",
    "StopLogging",
    "DeleteDetector",
    "UpdateDetector",
)
IAM_TEXTS = (
    ("CreateAccessKey", "Creation of new access key - potential persistence"),
    ("AttachUserPolicy", "Attachment of policy to user - privilege escalation"),
    ("CreateUser", "Creation of new IAM user"),
    ("CreateLoginProfile", "Creation of console login profile"),
    ("DeleteTrail", "CloudTrail deletion - defense evasion"),
    ("StopLogging", "CloudTrail logging disabled - defense evasion"),
)
QUIET_PARENTS = ("services.exe", "svchost.exe", "taskhost.exe")
QUIET_NAMES = ("update", "install")
SHELL_PARENTS = ("explorer.exe", "cmd.exe")
RUN_KEYS = (r"\CurrentVersion\Run", r"\CurrentVersion\RunOnce")
LOG_CLEARED = 1102
WEB_PORTS = (80, 443, 8080)
KNOWN_CLIENTS = ("chrome.exe", "firefox.exe", "teams.exe")
REMOTE_DESKTOP = 10
INTERNAL_NETWORKS = ("10.", "192.168.")


# SIG rules: predicate and description over one silver table.


def mimikatz() -> tuple[Column, Column]:
    test = F.lower("process_name").contains("mimikatz") | contains_any(
        "command_line", MIMIKATZ_COMMANDS, ignore_case=True
    )
    return test, F.lit("Detected execution of Mimikatz, a tool commonly used for credential theft")


def suspicious_powershell() -> tuple[Column, Column]:
    seen = lambda parts: contains_any("command_line", parts)
    lowered = lambda parts: contains_any("command_line", parts, ignore_case=True)
    test = F.lower("process_name").contains("powershell") & (
        seen((*POWERSHELL_ENCODED, *POWERSHELL_HIDDEN, *POWERSHELL_QUIET)) | lowered(POWERSHELL_CALLS)
    )
    text = first_match(
        [
            (seen(POWERSHELL_ENCODED), "Base64 encoded PowerShell command"),
            (seen(POWERSHELL_HIDDEN), "Hidden window PowerShell execution"),
            (lowered(POWERSHELL_RUN), "PowerShell download and execute pattern"),
            (lowered(POWERSHELL_LOADS), "PowerShell file download"),
        ],
        "Suspicious PowerShell pattern",
    )
    return test, text


def psexec() -> tuple[Column, Column]:
    test = F.lower("process_name").contains("psexec") | F.lower("command_line").contains("psexec")
    return test, F.lit("Detected use of PsExec for potential lateral movement")


def aws_privilege_escalation() -> tuple[Column, Column]:
    name = F.col("event_name")
    test = (F.col("risk_classification") == "high_risk_action") | name.isin(*IAM_CALLS)
    text = first_match([(name.startswith(p), t) for p, t in IAM_TEXTS], "High-risk IAM operation")
    return test, text


def registry_run_key() -> tuple[Column, Column]:
    return contains_any("registry_path", RUN_KEYS), sentence("Autorun key changed: ", F.col("registry_path"))


def event_log_cleared() -> tuple[Column, Column]:
    return F.col("EventID") == LOG_CLEARED, sentence("Event log cleared on host ", F.col("Computer"))


def external_rdp() -> tuple[Column, Column]:
    ip = F.col("source_ip")
    test = (F.col("logon_type") == REMOTE_DESKTOP) & ~starts_with_any(ip, INTERNAL_NETWORKS)
    return test, sentence("Remote desktop logon of ", F.col("user_name"), " from external address ", ip)


# Other kinds: functions from a silver table to hits.


def okta_bruteforce(
    df: DataFrame, as_of: AsOf = None, within: str = "10 minutes", min_count: int = 5,
    steps=((10, "CRITICAL"), (7, "HIGH")), **how,
) -> DataFrame:
    """D-04"""
    hits = threshold(
        df, ["user_email", "source_ip"], "event_time", where=F.col("outcome") == "FAILURE",
        as_of=as_of, within=within, min_count=min_count, count_as="failure_count",
        first_as="first_failure", last_as="last_failure", **how,
    )
    n, span = F.col("failure_count"), F.col("duration_minutes")
    return hits.withColumn(
        "duration_minutes", F.round(minutes_between(F.col("last_failure"), F.col("first_failure")), 2)
    ).withColumns(
        {
            "severity": severity_steps(n, steps, "MEDIUM"),
            "description": sentence(
                "Detected ", n, " failed login attempts for user ", F.col("user_email"), " from IP ",
                F.col("source_ip"), " within ", span, " minutes",
            ),
        }
    )


def windows_bruteforce(
    df: DataFrame, as_of: AsOf = None, within: str = "5 minutes", min_count: int = 10,
    steps=((20, "CRITICAL"), (15, "HIGH")), **how,
) -> DataFrame:
    """D-05"""
    hits = threshold(
        df, ["user_name", "host", "source_ip"], "event_time", where=~F.col("logon_success"),
        as_of=as_of, within=within, min_count=min_count, count_as="failure_count",
        first_as="first_failure", last_as="last_failure", **how,
    )
    n = F.col("failure_count")
    return hits.withColumns(
        {
            "severity": severity_steps(n, steps, "MEDIUM"),
            "description": sentence(
                "Detected ", n, " failed logon attempts for user ", F.col("user_name"), " on host ",
                F.col("host"), " from IP ", F.col("source_ip"),
            ),
        }
    )


def aws_api_failures(
    df: DataFrame, as_of: AsOf = None, within: str = "10 minutes", min_count: int = 15, **how
) -> DataFrame:
    """D-06"""
    hits = threshold(
        df, ["user_name", "source_ip", "service", "error_code"], "event_time",
        where=~F.col("api_success"), as_of=as_of, within=within, min_count=min_count,
        sets={"failed_apis": "event_name"}, count_as="failure_count", first_as="first_failure",
        last_as="last_failure", **how,
    )
    return hits.withColumns(
        {
            "unique_api_count": F.size("failed_apis"),
            "severity": F.lit("MEDIUM"),
            "description": sentence(
                "User ", F.col("user_name"), " from IP ", F.col("source_ip"), " generated ",
                F.col("failure_count"), " failed API calls to ", F.col("service"), " with error: ",
                F.col("error_code"),
            ),
        }
    )


def network_scanning(
    df: DataFrame, as_of: AsOf = None, within: str = "1 minute", min_count: int = 20,
    steps=((100, "HIGH"), (50, "MEDIUM")), **how,
) -> DataFrame:
    """D-07"""
    hits = threshold(
        df, ["host", "user", "process_name"], "event_time", as_of=as_of, within=within,
        min_count=min_count, distinct="destination_ip", sets={"ports_accessed": "destination_port"},
        count_as="total_connections", first_as="first_connection", last_as="last_connection",
        distinct_as="unique_destinations", **how,
    )
    n = F.col("unique_destinations")
    return hits.withColumns(
        {
            "unique_ports": F.size("ports_accessed"),
            "severity": severity_steps(n, steps, "LOW"),
            "description": sentence(
                "Process ", F.col("process_name"), " on host ", F.col("host"), " connected to ", n,
                " unique destinations (", F.col("total_connections"), " total connections)",
            ),
        }
    )


def impossible_travel(
    df: DataFrame, as_of: AsOf = None, max_gap_seconds: int = 3600, new_from: AsOf = None, **how
) -> DataFrame:
    """D-08. Without ``as_of`` all logins count, with it those up to then.

    ``new_from`` gives the hits from then on; it reads back no further than the
    gap, since an older login cannot be part of one.
    """
    logins = df.where((F.col("outcome") == "SUCCESS") & F.col("country").isNotNull())
    if as_of is not None:
        logins = logins.where(until(df, "event_time", as_of_bound(df, "event_time", as_of)))
    if new_from is not None:
        back = f"{max_gap_seconds + 1} seconds"
        logins = logins.where(since(df, "event_time", as_of_bound(df, "event_time", new_from, back)))
    hits = sequence_gap(
        logins, "user_email", "event_time", changed="country", max_gap_seconds=max_gap_seconds,
        tiebreak=["event_id"], carry=["city", "source_ip"], **how,
    )
    if new_from is not None:
        hits = hits.where(F.col("event_time") >= as_of_bound(df, "event_time", new_from))
    return describe_travel(hits)


def describe_travel(hits: DataFrame) -> DataFrame:
    minutes = F.round(F.col("gap_seconds") / F.lit(60), 2)
    return hits.select(
        "user_email",
        F.col("event_time").alias("current_login_time"),
        F.col("previous_event_time").alias("previous_login_time"),
        minutes.alias("time_diff_minutes"),
        F.col("country").alias("current_country"),
        F.col("previous_country"),
        F.col("city").alias("current_city"),
        F.col("previous_city"),
        F.col("source_ip").alias("current_ip"),
        F.col("previous_source_ip").alias("previous_ip"),
        F.lit("HIGH").alias("severity"),
        sentence(
            "User ", F.col("user_email"), " logged in from ", F.col("country"), " (", F.col("city"),
            ") only ", minutes, " minutes after logging in from ", F.col("previous_country"), " (",
            F.col("previous_city"), ")",
        ).alias("description"),
    )


def user_behavior_anomaly(
    df: DataFrame, as_of: AsOf = None, z: float = 2.0, high: float = 3.0, countries: int = 3, **how
) -> DataFrame:
    """D-10"""
    b = baseline_zscore(
        df, "user_email", "event_time", as_of=as_of,
        metrics={"logins": F.count("*"), "ips": F.count_distinct("source_ip")},
        today={"countries": F.count_distinct("country"), "last_login": F.max("event_time")}, **how,
    )
    zl, zi = F.abs("z_logins"), F.abs("z_ips")
    hits = b.where((zl >= z) | (zi >= z) | (F.col("today_countries") >= countries))
    return hits.select(
        "user_email",
        F.col("today_last_login").alias("event_time"),
        F.col("today_logins").alias("today_login_count"),
        F.round("avg_logins", 2).alias("baseline_avg_logins"),
        F.round("std_logins", 2).alias("baseline_stddev_logins"),
        F.col("today_ips").alias("today_unique_ips"),
        F.round("avg_ips", 2).alias("baseline_avg_ips"),
        F.col("today_countries").alias("today_unique_countries"),
        F.round("z_logins", 2).alias("login_count_zscore"),
        F.round("z_ips", 2).alias("unique_ip_zscore"),
        severity_steps(zl, ((high, "HIGH"), (z, "MEDIUM")), "LOW").alias("severity"),
        sentence(
            "User ", F.col("user_email"), " shows anomalous behavior: ", F.col("today_logins"),
            " logins (baseline: ", F.round("avg_logins", 1), " ±", F.round("std_logins", 1), "), ",
            F.col("today_ips"), " unique IPs (baseline: ", F.round("avg_ips", 1), ")",
        ).alias("description"),
    )


def rare_process_execution(
    df: DataFrame, as_of: AsOf = None, steps=(5, 20, 100), top: int | None = 100, **how
) -> DataFrame:
    """D-11. ``top=None`` gives all rare executions instead of the top list."""
    calm = ~contains_any("process_name", QUIET_NAMES, ignore_case=True)
    parent = F.col("parent_process_name")
    r = rarity(df, "process_name", "event_time", as_of=as_of, steps=steps, **how).where(
        calm & ~F.lower(parent).isin(*QUIET_PARENTS)
    )
    if top is not None:
        r = r.orderBy(
            "rarity_percentile", F.col("event_time").desc(), "process_name", "host", "user", "command_line"
        ).limit(top)
    very = F.col("rarity_category") == "VERY_RARE"
    return r.select(
        "event_time", "host", "user", "process_name", "command_line", "parent_process_name",
        "historical_count", "rarity_category",
        F.round(F.col("rarity_percentile") * 100, 2).alias("rarity_score"),
        F.when(very & ~parent.isin(*SHELL_PARENTS), "HIGH").when(very, "MEDIUM").otherwise("LOW").alias(
            "severity"
        ),
        sentence(
            "Rare process executed: ", F.col("process_name"), " (seen only ", F.col("historical_count"),
            " times historically, rarity: ", F.col("rarity_category"), ") on host ", F.col("host"),
            " by user ", F.col("user"),
        ).alias("description"),
    )


def network_anomaly(
    df: DataFrame, as_of: AsOf = None, z: float = 2.0, high: float = 3.0, **how
) -> DataFrame:
    """D-12"""
    b = baseline_zscore(
        df, "host", "event_time", as_of=as_of,
        metrics={
            "connections": F.count("*"),
            "ips": F.count_distinct("destination_ip"),
            "ports": F.count_distinct("destination_port"),
        },
        today={
            "last": F.max("event_time"),
            "port_set": F.sort_array(F.collect_set("destination_port")),
        },
        **how,
    )
    zc, zi = F.abs("z_connections"), F.abs("z_ips")
    level = (
        F.when((zc >= high) | (zi >= high), "HIGH").when(zc >= z, "MEDIUM").otherwise("LOW")
    )
    return b.where((zc >= z) | (zi >= z)).select(
        "host",
        F.col("today_last").alias("event_time"),
        F.col("today_connections"),
        F.round("avg_connections", 0).alias("baseline_avg_connections"),
        F.col("today_ips").alias("today_unique_ips"),
        F.round("avg_ips", 0).alias("baseline_avg_ips"),
        F.col("today_ports").alias("today_unique_ports"),
        F.round("avg_ports", 0).alias("baseline_avg_ports"),
        F.col("today_port_set").alias("ports_used"),
        F.round("z_connections", 2).alias("connection_zscore"),
        F.round("z_ips", 2).alias("unique_ip_zscore"),
        level.alias("severity"),
        sentence(
            "Host ", F.col("host"), " shows anomalous network behavior: ", F.col("today_connections"),
            " connections (baseline: ", F.round("avg_connections", 0), "), ", F.col("today_ips"),
            " unique destinations (baseline: ", F.round("avg_ips", 0), ")",
        ).alias("description"),
    )


def user_clustering(
    df: DataFrame, as_of: AsOf = None, k: int = 4, seed: int | None = None, size_factor: float = 2.0,
    rounds: int = 20,
) -> DataFrame:
    """D-13, by ``cluster_rounds``; a ``seed`` asks for the randomly started k-means of ``pyspark.ml``."""
    features = user_features(df, "user_email", "event_time", as_of)
    if seed is None:
        clustered = cluster_rounds(features, "user_email", k=k, rounds=rounds)
    else:
        clustered = cluster(features, k=k, seed=seed)
    found = cluster_outliers(clustered, size_factor)
    at = as_of_bound(df, "event_time", as_of)
    return found.withColumns(
        {
            "event_time": at,
            "severity": F.lit("MEDIUM"),
            "description": sentence(
                "User ", F.col("user_email"), " belongs to a small behavior cluster of ",
                F.col("cluster_size"), " users",
            ),
        }
    )


def timeseries_anomaly(
    df: DataFrame, as_of: AsOf = None, z: float = 2.0, high: float = 3.0, history: str = "7 days",
    recent: str = "24 hours", **how,
) -> DataFrame:
    """D-14"""
    failures = df.where((F.col("outcome") == "FAILURE") & trailing(df, "event_time", as_of, history))
    series = rolling_zscore(
        failures, "event_time",
        extra={"affected_users": F.count_distinct("user_email"), "source_ips": F.count_distinct("source_ip")},
        **how,
    )
    n, zs = F.col("event_count"), F.col("zscore")
    hits = series.where(
        (F.col("time_bucket") >= as_of_bound(series, "time_bucket", as_of, recent)) & (zs >= z)
    )
    return hits.select(
        F.col("time_bucket").alias("event_time"),
        n.alias("failure_count"),
        F.round("baseline_avg", 1).alias("baseline_avg"),
        F.round("baseline_stddev", 1).alias("baseline_stddev"),
        "affected_users",
        "source_ips",
        F.round(zs, 2).alias("zscore"),
        F.round("pct_change", 1).alias("pct_change"),
        severity_steps(zs, ((high, "HIGH"), (z, "MEDIUM")), "LOW").alias("severity"),
        sentence(
            "Unusual spike in failed authentications: ", n, " failures (baseline: ",
            F.round("baseline_avg", 0), " ±", F.round("baseline_stddev", 0), "), ",
            F.round("pct_change", 0), "% increase",
        ).alias("description"),
    )


def web_beaconing(
    df: DataFrame, as_of: AsOf = None, within: str = "1 day", min_count: int = 101, **how
) -> DataFrame:
    """D-17: more than 100 web connections of one process to one address."""
    hits = threshold(
        df, ["host", "process_name", "destination_ip"], "event_time",
        where=F.col("destination_port").isin(*WEB_PORTS) & ~F.col("process_name").isin(*KNOWN_CLIENTS),
        as_of=as_of, within=within, min_count=min_count, count_as="connection_count",
        first_as="first_connection", last_as="last_connection", **how,
    )
    return hits.withColumns(
        {
            "severity": F.lit("MEDIUM"),
            "description": sentence(
                "Process ", F.col("process_name"), " on host ", F.col("host"), " made ",
                F.col("connection_count"), " web connections to ", F.col("destination_ip"),
            ),
        }
    )


@dataclass(frozen=True)
class Rule:
    """A detection rule: where it reads, how it finds hits, how they map to alerts."""

    table: str
    alert: AlertMap
    severity: str
    find: Callable[..., DataFrame] | None = None
    match: Callable[[], tuple[Column, Column]] | None = None
    rule_id: str | None = None
    rule_name: str | None = None
    version: str = "v1.0"
    text: str = ""
    expected_fpr: float | None = None
    tags: tuple[str, ...] = ()
    enabled: bool = True
    incremental: bool = False

    @property
    def name(self) -> str:
        return self.alert.rule

    def hits(self, df: DataFrame, as_of: AsOf = None, **params) -> DataFrame:
        """All columns of the hits with severity and description."""
        if self.match:
            test, text = self.match()
            return df.where(test).withColumns({"severity": F.lit(self.severity), "description": text})
        return self.find(df, as_of=as_of, **params)


def _rule(table, name, title, technique, tactic, severity, *, find=None, match=None, at="event_time",
          user=None, host=None, ip=None, context=(), identity=(), period=None, **meta) -> Rule:
    alert = AlertMap(name, title, technique, tactic, at, user, host, ip, tuple(context), tuple(identity), period)
    return Rule(table, alert, severity, find=find, match=match, **meta)


HOUR, DAY = 3600, 86_400
_PROCESS = dict(user="user", host="host")

RULES: tuple[Rule, ...] = (
    _rule(
        "sysmon_process", "detect_mimikatz", "Mimikatz Credential Dumping Detected", "T1003.001",
        "Credential Access", "CRITICAL", match=mimikatz, **_PROCESS,
        context=("process_name", "command_line", "parent_process_name", "file_hash_sha256"),
        identity=("process_name", "command_line"),
        rule_id="mimikatz_001", rule_name="Mimikatz Execution", expected_fpr=0.01,
        text="Detects execution of Mimikatz credential dumping tool",
        tags=("credential_theft", "mimikatz", "lsass"),
    ),
    _rule(
        "sysmon_process", "detect_suspicious_powershell", "Suspicious PowerShell Execution",
        "T1059.001", "Execution", "HIGH", match=suspicious_powershell, **_PROCESS,
        context=("process_name", "command_line", "parent_process_name"),
        identity=("process_name", "command_line"),
        rule_id="powershell_001", rule_name="Suspicious PowerShell", version="v1.2", expected_fpr=0.05,
        text="Detects obfuscated PowerShell commands", tags=("powershell", "obfuscation", "execution"),
    ),
    _rule(
        "sysmon_process", "detect_psexec", "PsExec Lateral Movement Detected", "T1570",
        "Lateral Movement", "HIGH", match=psexec, **_PROCESS,
        context=("process_name", "command_line"), identity=("process_name", "command_line"),
        text="Detects lateral movement with PsExec",
    ),
    _rule(
        "okta_auth", "detect_okta_bruteforce", "Okta Brute Force Attack Detected", "T1110",
        "Credential Access", "HIGH", find=okta_bruteforce, period=HOUR, at="first_failure", user="user_email",
        ip="source_ip",
        context=("failure_count", "first_failure", "last_failure", "duration_minutes"),
        rule_id="okta_bruteforce_001", rule_name="Okta Brute Force", expected_fpr=0.10,
        text="Detects brute force authentication attempts in Okta",
        tags=("brute_force", "okta", "authentication"),
    ),
    _rule(
        "windows_auth", "detect_windows_bruteforce", "Windows Brute Force Attack", "T1110.001",
        "Credential Access", "HIGH", find=windows_bruteforce, period=HOUR, at="first_failure", user="user_name",
        host="host", ip="source_ip", context=("failure_count", "first_failure", "last_failure"),
        rule_id="windows_bruteforce_001", rule_name="Windows Brute Force", version="v1.1",
        expected_fpr=0.08, text="Detects Windows logon brute force attempts",
        tags=("brute_force", "windows", "authentication"),
    ),
    _rule(
        "cloudtrail", "detect_aws_api_failures", "Excessive AWS API Failures", "T1078.004",
        "Credential Access", "MEDIUM", find=aws_api_failures, period=HOUR, at="first_failure", user="user_name",
        ip="source_ip",
        context=("service", "error_code", "failure_count", "unique_api_count", "failed_apis", "last_failure"),
        identity=("service", "error_code"), text="Detects bursts of failed cloud API calls",
    ),
    _rule(
        "sysmon_network", "detect_network_scanning", "Network Scanning Activity Detected", "T1046",
        "Discovery", "MEDIUM", find=network_scanning, period=HOUR, at="first_connection", **_PROCESS,
        context=(
            "process_name", "unique_destinations", "total_connections", "unique_ports", "ports_accessed",
            "last_connection",
        ),
        identity=("process_name",), text="Detects connections to many destinations in a short time",
    ),
    _rule(
        "okta_auth", "detect_impossible_travel", "Impossible Travel Detected", "T1078",
        "Initial Access", "HIGH", find=impossible_travel, at="current_login_time", user="user_email",
        ip="current_ip",
        context=(
            "previous_login_time", "time_diff_minutes", "current_country", "previous_country",
            "current_city", "previous_city", "previous_ip",
        ),
        text="Detects logins from two countries within an hour", incremental=True,
    ),
    _rule(
        "cloudtrail", "detect_aws_privilege_escalation", "AWS Privilege Escalation Attempt", "T1098",
        "Privilege Escalation", "CRITICAL", match=aws_privilege_escalation, user="user_name",
        ip="source_ip", context=("event_name", "service", "user_arn", "region", "target_user"),
        identity=("event_id", "event_name"), text="Detects high-risk identity management calls",
    ),
    _rule(
        "okta_auth", "detect_user_behavior_anomaly", "Anomalous User Behavior Detected", "T1078",
        "Initial Access", "MEDIUM", find=user_behavior_anomaly, period=DAY, user="user_email",
        context=(
            "today_login_count", "baseline_avg_logins", "today_unique_ips", "baseline_avg_ips",
            "login_count_zscore", "unique_ip_zscore",
        ),
        rule_id="user_behavior_anomaly_001", rule_name="User Behavior Anomaly (ML)", expected_fpr=0.15,
        text="ML-based detection of anomalous user behavior using statistical analysis and Z-scores",
        tags=("anomaly_detection", "ml", "ueba", "statistical"),
    ),
    _rule(
        "sysmon_process", "detect_rare_process_execution", "Rare Process Execution Detected", "T1204",
        "Execution", "MEDIUM", find=rare_process_execution, **_PROCESS,
        context=(
            "process_name", "command_line", "parent_process_name", "historical_count",
            "rarity_category", "rarity_score",
        ),
        identity=("process_name", "command_line"),
        rule_id="rare_process_execution_001", rule_name="Rare Process Execution (ML)", expected_fpr=0.20,
        text="Detects rarely executed processes using historical frequency analysis",
        tags=("anomaly_detection", "process_analysis", "rarity", "frequency"),
    ),
    _rule(
        "sysmon_network", "detect_network_anomaly", "Anomalous Network Activity Detected", "T1071",
        "Command and Control", "MEDIUM", find=network_anomaly, period=DAY, host="host",
        context=(
            "today_connections", "baseline_avg_connections", "today_unique_ips", "baseline_avg_ips",
            "connection_zscore", "unique_ip_zscore",
        ),
        rule_id="network_anomaly_001", rule_name="Network Traffic Anomaly (ML)", expected_fpr=0.12,
        text="Detects unusual network behavior using baseline statistical analysis",
        tags=("anomaly_detection", "network", "statistical", "c2"),
    ),
    _rule(
        "okta_auth", "detect_user_clustering", "Unusual User Behavior Cluster", "T1078",
        "Initial Access", "MEDIUM", find=user_clustering, period=DAY, user="user_email",
        context=("prediction", "total_logins", "unique_ips", "unique_countries", "failure_rate"),
        rule_id="user_clustering_001", rule_name="User Behavior Clustering (ML)", expected_fpr=0.18,
        text="ML-based clustering using K-Means to detect anomalous user behavior",
        tags=("anomaly_detection", "ml", "clustering", "kmeans", "ueba"),
    ),
    _rule(
        "okta_auth", "detect_timeseries_anomaly", "Authentication Failure Spike Detected", "T1110",
        "Credential Access", "MEDIUM", find=timeseries_anomaly,
        context=(
            "failure_count", "baseline_avg", "baseline_stddev", "affected_users", "source_ips",
            "zscore", "pct_change",
        ),
        rule_id="timeseries_anomaly_001", rule_name="Authentication Spike Detection (ML)",
        expected_fpr=0.10,
        text="Detects unusual spikes in failed authentication attempts using statistical methods",
        tags=("anomaly_detection", "timeseries", "authentication", "statistical"),
    ),
    _rule(
        "sysmon_registry", "detect_registry_run_key", "Registry Run Key Modified", "T1547.001",
        "Persistence", "MEDIUM", match=registry_run_key, **_PROCESS,
        context=("process_name", "registry_path"), identity=("registry_path",),
        text="Detects changes to registry autorun keys",
    ),
    _rule(
        "windows_raw", "detect_event_log_cleared", "Windows Event Log Cleared", "T1070.001",
        "Defense Evasion", "HIGH", match=event_log_cleared, at="TimeCreated", host="Computer",
        context=("EventID",), text="Detects clearing of the security event log",
    ),
    _rule(
        "sysmon_network", "detect_web_beaconing", "Suspicious Outbound Web Traffic", "T1071.001",
        "Command and Control", "MEDIUM", find=web_beaconing, period=HOUR, at="first_connection", host="host",
        context=("process_name", "destination_ip", "connection_count", "last_connection"),
        identity=("process_name", "destination_ip"),
        text="Detects many web connections of an unusual process to one address",
    ),
    _rule(
        "windows_auth", "detect_external_rdp", "Remote Desktop Logon From External Address",
        "T1021.001", "Lateral Movement", "MEDIUM", match=external_rdp, user="user_name", host="host",
        ip="source_ip", context=("logon_type", "workstation", "domain"),
        text="Detects remote desktop logons from outside the internal networks",
    ),
)

BY_NAME = {r.name: r for r in RULES}


def with_params(rule: Rule, **params) -> Rule:
    """The rule with some operator parameters fixed."""
    find = rule.find
    return replace(rule, find=lambda df, as_of=None, **kw: find(df, as_of=as_of, **{**params, **kw}))


def registry(spark: SparkSession, at: AsOf = None, created_by: str = "security_team") -> DataFrame:
    """G-02, SNK-08: one row per rule, small and built from code.

    ``detection_rule`` is the name stored in alerts, on which reports join.
    """
    now = datetime.fromisoformat(str(at)) if at else datetime.now()
    rows = [
        (
            r.rule_id or r.name.removeprefix("detect_") + "_001",
            r.rule_name or r.alert.title,
            r.version,
            f"{r.table}: {r.name}",
            r.text,
            r.severity,
            r.alert.technique,
            r.alert.tactic,
            r.enabled,
            r.expected_fpr,
            now,
            created_by,
            now,
            now,
            list(r.tags),
            r.name,
        )
        for r in RULES
    ]
    return spark.createDataFrame(rows, schemas.RULES)
