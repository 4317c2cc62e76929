"""Log, web and security analytics (keys log_*, web_*, evt_*, sec_*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators.filters import flt_no_pattern, prj_case_map
from fleetwatch.operators.findings import OK, findings
from fleetwatch.plans.ordering import string_list, top_k

# Patterns of the error archive.
FAILURE_PATTERNS = (
    "%Login failed%",
    "%filegroup is full%",
    "%voll ist%",
    "%failed%",
    "%memory allocation failure%",
    "%unable to run%",
    "%terminating a system%",
    "%Dispatcher was unable%",
    "%insufficient system memory%",
)
# Patterns of the log archive and the agent archive.
LOG_PATTERNS = ("%Error%", "%filegroup is full%", "%voll ist%")
AGENT_PATTERNS = ("%Error%", "%Fehler%")

# Engine-log noise (LIKE patterns, escape character '|').
ENGINE_NOISE = (
    "%Using 'dbghelp.dll' version '4.0.5'%",
    "%informational message%no user action is required%",
    "Log was backed up%",
    "Database backed up%",
    "BACKUP DATABASE %",
    "DBCC %",
    "Setting database option RECOVERY to %",
    "This instance of SQL Server has been using a process ID of %",
    "Starting up database%",
    "Software Usage Metrics is enabled.",
    "Authentication mode is MIXED.",
    "All rights reserved.",
    "(c) Microsoft Corporation.",
    "Server process ID is%",
    "System Manufacturer:%",
    "%has been reinitialized%",
    "Logging SQL Server messages in file%",
)
# Agent-log noise (LIKE patterns, escape character '|').
AGENT_NOISE = (
    "|[184|] Job completion for % is being logged to sysjobhistory%",
    "|[177|] Job % has been requested to run by Schedule %",
    "%[177] Die Ausführung von Auftrag % wurde von Zeitplan %",
    "%[184] Der Auftragsabschluss für % wird in %",
    "|[248|] Saving NextRunDate/Times for all updated job schedules...%",
    "|[249|] % job schedule|(s|) saved%",
    "|[182|] Job completion for % is being logged to the eventlog%",
    "|[171|] There are % alert|(s|) in the alert cache%",
    "|[168|] There are 21 job(s) |[0 disabled|] in the job cache%",
    "|[170|] Populating alert cache...%",
    "|[473|] Database Mail profile DBA refreshed.%",
    "|[353|] Mail session started%",
    "|[273|] Mail dispatcher started%",
    "|[174|] Job scheduler engine started |(maximum user worker threads: 200, maximum system worker threads: 100|)%",
    "|[193|] Alert engine started |(using Eventlog Events|)%",
    "|[146|] Request servicer engine started%",
    "|[167|] Populating job cache...%",
    "|[133|] Support engine started%",
    "|[271|] Idle processor poller started%",
)

# Status code of a failed logon and its reason.
FAILURE_REASONS = (
    ("0xC0000064", "Account does not exist"),
    ("0xC000006A", "Wrong password"),
    ("0xC000006D", "Unknown user name or bad password"),
    ("0xC000006E", "Account restriction"),
    ("0xC000006F", "Invalid logon hours"),
    ("0xC000015B", "Logon type not granted"),
    ("0xC0000070", "Account restriction (workstation)"),
    ("0xC0000071", "Password expired"),
    ("0xC0000072", "Account disabled"),
    ("0xC0000133", "Clock difference to domain controller"),
    ("0xC0000193", "Account expired"),
    ("0xC0000224", "Password must be changed"),
    ("0xC0000234", "Account locked"),
    ("0x0", "0x0"),
)

# HTTP status and cause text.
HTTP_CAUSES = (
    (400, "Bad request"),
    (401, "Unknown user agent"),
    (404, "Resource not found"),
    (405, "Method not allowed"),
    (408, "Request timed out"),
    (409, "Conflict"),
    (500, "Server error, many possible causes"),
    (503, "Service unavailable"),
)

# Event ids ignored per host class (last digit of the host name).
SYSTEM_BLOCKED = {c: (137, 7031, 36874, 36887, 36888, 10010, 10016) for c in ("4", "2", "1")}
APPLICATION_BLOCKED = {
    "4": (1008, 2004, 8005),
    "2": (1008, 2004, 8005),
    "1": (257, 1008, 1017, 1022, 1023, 2001, 2004, 3009, 8005),
}
AUDIT_BLOCKED = {
    "4": (1008, 1023, 4625, 4656, 4673, 4957, 5031, 5152, 5157),
    "2": (1008, 1023, 4625, 4656, 4673, 4957, 5031, 5152, 5157),
    "1": (1008, 1023, 4625, 4656, 4673, 4776, 4957, 5031, 5152, 5157),
}


def log_archive_errors(error_log: DataFrame, as_of) -> DataFrame:
    """Yesterday's error and filegroup-full rows."""
    return error_log.filter(
        S.previous_day("log_date", as_of) & S.any_ilike("text", LOG_PATTERNS)
    ).select("server_id", "log_date", "process_info", "text")


def log_archive_failures(error_log: DataFrame, as_of=None) -> DataFrame:
    """Distinct rows of nine failure patterns, of yesterday when ``as_of`` is given."""
    rows = error_log.filter(S.any_ilike("text", FAILURE_PATTERNS))
    if as_of is not None:
        rows = rows.filter(S.previous_day("log_date", as_of))
    return rows.select("server_id", "log_date", "process_info", "text").dropDuplicates()


def log_archive_agent(agent_log: DataFrame, as_of) -> DataFrame:
    return agent_log.filter(
        S.previous_day("log_date", as_of) & S.any_ilike("text", AGENT_PATTERNS)
    ).select("server_id", "log_date", "error_level", "text")


def log_deadlocks(xml_events: DataFrame) -> DataFrame:
    """Time and deadlock graph of each event, newest first; events without a graph keep NULL."""
    graph = F.regexp_extract("payload", r"(?s)(<deadlock>.*</deadlock>|<deadlock .*</deadlock>)", 1)
    return xml_events.select(
        "event_time", F.nullif(graph, F.lit("")).alias("graph")
    ).orderBy(F.col("event_time").desc(), "graph")


def log_pattern_counts(error_log: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Rows per pattern; a row counts for every pattern it matches, unmatched patterns count 0."""
    counts = error_log.agg(
        *[F.count_if(F.col("text").ilike(p)).alias(f"p{i}") for i, p in enumerate(patterns)]
    )
    pairs = F.array(
        *[F.struct(F.lit(p).alias("pattern"), F.col(f"p{i}").alias("n")) for i, p in enumerate(patterns)]
    )
    return counts.select(F.explode(pairs).alias("r")).select("r.pattern", "r.n")


def log_failed_logins(error_log: DataFrame, exclusions: Sequence[str] = ENGINE_NOISE) -> DataFrame:
    """Finding 49: failed logins that are no known noise."""
    rows = flt_no_pattern(error_log.filter(F.col("text").ilike("%Login failed%")), "text", exclusions)
    return findings(
        rows, "49", "Engine error log", severity=OK, current=0, target=1,
        details=S.text(S.stamp("log_date"), " - ", F.col("text")), observed_at="log_date",
    )


def log_agent_errors_filtered(agent_log: DataFrame, exclusions: Sequence[str] = AGENT_NOISE) -> DataFrame:
    """Finding 50: agent errors minus known noise."""
    errors = agent_log.filter(S.any_ilike("text", ["%Error%", "%failed%"]))
    rows = flt_no_pattern(errors, "text", exclusions)
    return findings(
        rows, "50", "Agent error log", severity=OK, current=0, target=1,
        details=S.text(S.stamp("log_date"), " - ", F.col("text")), observed_at="log_date",
    )


def web_status_rows(access_log: DataFrame, causes: Sequence[tuple[int, str]] = HTTP_CAUSES) -> DataFrame:
    """Failed requests with a cause text; 401 depends on the method, 500 on the win32 status."""
    cause = F.lit(None).cast("string")
    for status, words in causes:
        cause = F.when(F.col("sc_status") == status, words).otherwise(cause)
    cause = (
        F.when((F.col("sc_status") == 401) & (F.col("cs_method") == "POST"), "Authentication required")
        .when((F.col("sc_status") == 500) & (F.col("sc_win32_status") == 64), "Network name no longer available")
        .otherwise(cause)
    )
    return access_log.filter(F.col("sc_status").isin([s for s, _ in causes])).withColumn("cause", cause)


def web_status_summary(access_log: DataFrame, status: int = 405) -> DataFrame:
    """First and last time, request count and client list of one status."""
    rows = access_log.filter(F.col("sc_status") == status)
    first, last, requests = rows.agg(F.min("log_time"), F.max("log_time"), F.count(F.lit(1))).first()
    stamp = lambda v: F.lit(None if v is None else str(v)).cast("timestamp_ntz")
    return string_list(rows, [], "c_ip", "ips").select(
        "chunk_no",
        "ips",
        stamp(first).alias("first_time"),
        stamp(last).alias("last_time"),
        F.lit(requests).cast("bigint").alias("requests"),
    )


def web_suspicious_ips(access_log: DataFrame, n: int = 10) -> DataFrame:
    return (
        access_log.filter(F.col("sc_status") == 401)
        .groupBy("c_ip")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > n)
    )


def _event_columns(df: DataFrame) -> DataFrame:
    return df.select("server_id", "time", "log_name", "entry_type", "event_id", "source", "message")


def evt_custom_log(
    os_events: DataFrame, as_of, log_name: str = "Custom", only_weekdays: Sequence[int] | None = None
) -> DataFrame:
    """Custom-log errors of a day and warnings of a week, ids 0-999.

    ``only_weekdays`` (ISO, Monday = 1) restricts the report to runs on those days.
    """
    errors = (F.col("entry_type") == "Error") & (F.col("time") > S.minus(as_of, 1, "DAY"))
    warnings = (F.col("entry_type") == "Warning") & (F.col("time") > S.minus(as_of, 7, "DAY"))
    rows = os_events.filter(
        (F.col("log_name") == log_name) & F.col("event_id").between(0, 999) & (errors | warnings)
    )
    if only_weekdays is not None:
        rows = rows.filter((F.weekday(S.ts(as_of)) + 1).isin(list(only_weekdays)))
    return _event_columns(rows)


def _newest_unblocked(
    os_events: DataFrame, log_name: str, entry_type: str, blocked: Mapping[str, Sequence[int]], as_of, k: int
) -> DataFrame:
    allowed = F.lit(False)
    for host_class, ids in blocked.items():
        allowed = allowed | ((F.col("host_class") == host_class) & ~F.col("event_id").isin(list(ids)))
    rows = os_events.filter(
        (F.col("log_name") == log_name)
        & (F.col("entry_type") == entry_type)
        & (F.col("time") > S.minus(as_of, 1, "DAY"))
        & allowed
    )
    return _event_columns(top_k(rows, ["server_id"], [F.col("time").desc(), F.col("record_id").desc()], k))


def evt_system_errors(os_events: DataFrame, as_of, blocklists=SYSTEM_BLOCKED, k: int = 3) -> DataFrame:
    return _newest_unblocked(os_events, "System", "Error", blocklists, as_of, k)


def evt_application_errors(os_events: DataFrame, as_of, blocklists=APPLICATION_BLOCKED, k: int = 3) -> DataFrame:
    return _newest_unblocked(os_events, "Application", "Error", blocklists, as_of, k)


def evt_audit_failures(os_events: DataFrame, as_of, blocklists=AUDIT_BLOCKED, k: int = 3) -> DataFrame:
    return _newest_unblocked(os_events, "Security", "FailureAudit", blocklists, as_of, k)


def sec_logon_history(os_events: DataFrame, as_of, excluded_users: Sequence[str] = (), hours: int = 1) -> DataFrame:
    """Logon (7001) and logoff (7002) of the last hour by users that match no excluded pattern."""
    user = F.try_element_at(F.col("replacement_strings"), F.lit(2))
    rows = os_events.filter(
        (F.col("source") == "Microsoft-Windows-Winlogon")
        & F.col("event_id").isin(7001, 7002)
        & S.in_last("time", as_of, hours, "HOUR")
    ).select(
        "time",
        F.when(F.col("event_id") == 7001, "Logon").otherwise("Logoff").alias("event"),
        user.alias("user"),
    )
    return rows.filter(~S.any_ilike("user", excluded_users)) if excluded_users else rows


def sec_auth_failures(os_events: DataFrame, reason_map: DataFrame, as_of, hours: int = 1) -> DataFrame:
    """Failed logons (4625) of the last hour with reason texts of status and sub status."""
    part = lambda n: F.try_element_at(F.col("replacement_strings"), F.lit(n))
    rows = os_events.filter(
        (F.col("log_name") == "Security") & (F.col("event_id") == 4625) & S.in_last("time", as_of, hours, "HOUR")
    ).select(
        "time",
        part(6).alias("user"),
        part(14).alias("client"),
        part(20).alias("address"),
        "server_id",
        part(8).alias("_status"),
        part(10).alias("_sub"),
    )
    first = prj_case_map(rows, "_status", reason_map).withColumnRenamed("reason", "_reason1")
    both = prj_case_map(first, "_sub", reason_map).withColumnRenamed("reason", "sub_reason")
    return both.select("time", "user", "client", "address", "server_id", F.col("_reason1").alias("reason"), "sub_reason")
