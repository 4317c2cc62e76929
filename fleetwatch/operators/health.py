"""Health checks (keys hc_*): each returns findings for the violating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators import joins as J
from fleetwatch.operators.aggregates import agg_having_latest_age, agg_size_total
from fleetwatch.operators.findings import CRITICAL, OK, WARN, findings
from fleetwatch.operators.windows import top_peak_sample
from fleetwatch.operators.workload import wait_signal_ratio, wait_top_cause
from fleetwatch.plans.ordering import latest_row, rank_in_group, top_k

# Databases the user-backup check leaves out.
BACKUP_SYSTEM_NAMES = ("master", "msdb", "model", "usage", "distribution", "tempdb")
# System databases whose backup is checked.
BACKUP_CHECKED_SYSTEM = ("master", "msdb", "model")


def hc_patch_level(servers: DataFrame, version_map: DataFrame, as_of, overdue_days: int = 21) -> DataFrame:
    """1.1 installed update level differs from the target; urgent once the target is overdue."""
    bad = servers.join(version_map, "major_version").filter(
        F.col("update_level") != F.col("target_level")
    )
    overdue = F.datediff(S.ts(as_of), "released_at") > overdue_days
    advice = F.when(overdue, "urgent: install ").otherwise("install ")
    return findings(
        bad,
        "1.1",
        "Patch level",
        current=F.col("update_level"),
        target=F.col("target_level"),
        details=S.text(advice, F.col("target_level")),
        observed_at=S.ts(as_of),
    )


def hc_backup_user(backupset: DataFrame, databases: DataFrame, as_of, lo: int = 6, hi: int = 24) -> DataFrame:
    """2.1 full backup of a user database older than ``lo`` hours; critical beyond ``hi`` hours or never."""
    users = databases.filter(~F.lower("database_name").isin(*BACKUP_SYSTEM_NAMES)).select(
        "server_id", "database_name"
    )
    last = agg_having_latest_age(backupset, as_of)
    aged = users.join(last, ["server_id", "database_name"], "left").filter(
        F.col("last_full").isNull() | (F.col("last_full") < S.minus(as_of, lo, "HOUR"))
    )
    in_band = F.col("last_full") > S.minus(as_of, hi, "HOUR")
    return findings(
        aged,
        "2.1",
        "Full backup missing",
        severity=F.when(in_band, WARN).otherwise(CRITICAL),
        scope=F.col("database_name"),
        current=F.col("hours"),
        target=lo,
        details=S.text("last full backup of ", F.col("database_name"), " at ", S.stamp("last_full")),
        observed_at="last_full",
    )


def hc_backup_system(backupset: DataFrame, databases: DataFrame, as_of, hours: int = 72) -> DataFrame:
    """2.2 system database without a full backup in the last ``hours`` hours."""
    system = databases.filter(F.lower("database_name").isin(*BACKUP_CHECKED_SYSTEM)).select(
        "server_id", "database_name"
    )
    aged = system.join(
        agg_having_latest_age(backupset, as_of), ["server_id", "database_name"], "left"
    ).filter(F.col("last_full").isNull() | (F.col("last_full") < S.minus(as_of, hours, "HOUR")))
    return findings(
        aged,
        "2.2",
        "System database backup missing",
        scope=F.col("database_name"),
        current=F.col("hours"),
        target=hours,
        details=S.text("last full backup of ", F.col("database_name"), " at ", S.stamp("last_full")),
        observed_at="last_full",
    )


def _low_volumes(volumes: DataFrame, cond, check_id: str, severity: int, target: str) -> DataFrame:
    rows = (
        volumes.select(
            "server_id",
            "volume_mount_point",
            F.round(F.col("available_bytes") / S.GB, 2).alias("free_gb"),
        )
        .filter(cond)
        .distinct()
    )
    return findings(
        rows,
        check_id,
        "Volume free space",
        severity=severity,
        scope=F.col("volume_mount_point"),
        current=S.fixed("free_gb"),
        target=target,
        details=S.text("volume ", F.col("volume_mount_point"), " has ", S.fixed("free_gb"), " GB free"),
    )


def hc_volume_warn(volumes: DataFrame, lo: float = 2, hi: float = 5) -> DataFrame:
    return _low_volumes(volumes, F.col("free_gb").between(lo, hi), "3.1", WARN, f"> {hi}")


def hc_volume_critical(volumes: DataFrame, gb: float = 2) -> DataFrame:
    return _low_volumes(volumes, F.col("free_gb") < gb, "3.2", CRITICAL, f">= {gb}")


def hc_file_growth(trace: DataFrame, files: DataFrame, volumes: DataFrame, as_of, low_gb: float = 5) -> DataFrame:
    """3.3 automatic growth in the last 24 h on servers where a volume is low."""
    grown = (
        trace.filter(F.col("event_class").between(92, 95) & S.in_last("start_time", as_of, 24, "HOUR"))
        .groupBy("server_id", "database_name", "file_id", "start_time")
        .agg(F.sum(F.col("integer_data") * 8).alias("growth_kb"), F.max("duration").alias("duration"))
        .filter(F.col("growth_kb") > 0)
    )
    low = volumes.filter(F.round(F.col("available_bytes") / S.GB, 2) <= low_gb)
    named = files.select("server_id", "database_name", "file_id", "physical_name")
    rows = J.join_semi_gate(grown.join(named, ["server_id", "database_name", "file_id"]), low, ["server_id"])
    return findings(
        rows,
        "3.3",
        "Data file growth",
        scope=F.col("database_name"),
        current=F.col("growth_kb"),
        details=S.text(
            F.col("physical_name"), " grew by ", F.floor(F.col("growth_kb") / 1024), " MB in ",
            F.floor(F.col("duration") / 1000), " ms",
        ),
        observed_at="start_time",
    )


def _log_rows(error_log: DataFrame, as_of, patterns: Sequence[str], check_id: str, name: str) -> DataFrame:
    rows = error_log.filter(S.since_yesterday("log_date", as_of) & S.any_ilike("text", patterns))
    return findings(rows, check_id, name, scope=F.col("process_info"), details=F.col("text"), observed_at="log_date")


def _log_summary(error_log: DataFrame, as_of, pattern: str, check_id: str, name: str) -> DataFrame:
    """One finding per server and message with count, first and last time inside the window."""
    rows = (
        error_log.filter(S.since_yesterday("log_date", as_of) & F.col("text").ilike(pattern))
        .groupBy("server_id", "text")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("log_date").alias("first_ts"),
            F.max("log_date").alias("last_ts"),
        )
    )
    return findings(
        rows,
        check_id,
        name,
        severity=CRITICAL,
        current=F.col("n"),
        target=0,
        details=S.text(
            F.col("n"), " times between ", S.stamp("first_ts"), " and ", S.stamp("last_ts"), ": ", F.col("text")
        ),
        observed_at="last_ts",
    )


# Check id, name, patterns and whether rows are summarised per message.
LOG_CHECKS = (
    ("4.1", "Login failed", ("%login failed%",), False),
    ("4.2", "Filegroup is full", ("%filegroup is full%", "%voll ist%"), False),
    ("4.3", "Unable to run a system task", ("%SQL Server was unable%",), True),
    ("4.4", "Failed to start", ("%failed to start%",), True),
    ("4.5", "Terminating a system task", ("%terminating a system%",), True),
    ("4.6", "Dispatcher was unable", ("%Dispatcher was unable%",), True),
    ("4.7", "Insufficient memory", ("%insufficient system memory%",), True),
    ("4.8", "Memory allocation failure", ("%memory allocation failure%",), True),
)


def _log_check(error_log: DataFrame, as_of, check_id: str) -> DataFrame:
    _, name, patterns, summarise = next(c for c in LOG_CHECKS if c[0] == check_id)
    if summarise:
        return _log_summary(error_log, as_of, patterns[0], check_id, name)
    return _log_rows(error_log, as_of, patterns, check_id, name)


def hc_login_failed(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.1")


def hc_filegroup_full(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.2")


def hc_system_task(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.3")


def hc_failed_to_start(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.4")


def hc_terminating_task(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.5")


def hc_dispatcher(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.6")


def hc_insufficient_memory(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.7")


def hc_allocation_failure(error_log: DataFrame, as_of) -> DataFrame:
    return _log_check(error_log, as_of, "4.8")


def log_findings(error_log: DataFrame, as_of) -> DataFrame:
    """All log checks in one pass: the row checks, and the summaries from one aggregation."""
    window = S.since_yesterday("log_date", as_of)

    def tagged(checks):
        hit = F.array(
            *[
                F.when(S.any_ilike("text", patterns), F.struct(F.lit(i).alias("check_id"), F.lit(n).alias("check_name")))
                for i, n, patterns, _ in checks
            ]
        )
        return error_log.filter(window).select("server_id", "log_date", "process_info", "text", F.inline(F.array_compact(hit)))

    rows = tagged([c for c in LOG_CHECKS if not c[3]])
    single = findings(rows, F.col("check_id"), F.col("check_name"), scope=F.col("process_info"), details=F.col("text"), observed_at="log_date")
    grouped = (
        tagged([c for c in LOG_CHECKS if c[3]])
        .groupBy("server_id", "check_id", "check_name", "text")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("log_date").alias("first_ts"),
            F.max("log_date").alias("last_ts"),
        )
    )
    summary = findings(
        grouped,
        F.col("check_id"),
        F.col("check_name"),
        severity=CRITICAL,
        current=F.col("n"),
        target=0,
        details=S.text(
            F.col("n"), " times between ", S.stamp("first_ts"), " and ", S.stamp("last_ts"), ": ", F.col("text")
        ),
        observed_at="last_ts",
    )
    return single.unionByName(summary)


def hc_jobs_disabled(jobs: DataFrame, allow: Sequence[str] = ()) -> DataFrame:
    """5.1 disabled jobs outside production, except allowed names."""
    rows = jobs.filter(
        ~F.col("enabled") & ~F.col("name").isin(*allow) & (F.col("environment") != "PRO")
    )
    return findings(
        rows, "5.1", "Job disabled", scope=F.col("name"), details=S.text("job ", F.col("name"), " is disabled")
    )


def hc_agent_errors(agent_log: DataFrame, as_of, ignore: str = "%Fehlerprotokoll%") -> DataFrame:
    """6.1 agent log rows of yesterday other than log rotation."""
    rows = agent_log.filter(S.previous_day("log_date", as_of) & ~F.col("text").ilike(ignore)).select(
        "server_id", "log_date", "text"
    ).distinct()
    return findings(rows, "6.1", "Agent error log", details=F.col("text"), observed_at="log_date")


def hc_jobs_failed(
    jobs: DataFrame, job_history: DataFrame, activity: DataFrame, as_of,
    ignore: Sequence[str] = ("syspolicy_purge_history",),
) -> DataFrame:
    """7.1 newest failure of an enabled job in 24 h with no later success and not running now."""
    timed = job_history.withColumn("run_ts", S.packed_datetime("run_date", "run_time"))
    failed = latest_row(timed.filter(F.col("run_status") == 0), ["job_id"], ["run_ts", "step_id"])
    recent = failed.filter(
        (F.col("run_ts") >= S.minus(as_of, 24, "HOUR")) & (F.col("run_ts") <= S.ts(as_of))
    )
    open_failures = J.join_not_exists_later(recent, timed.filter(F.col("run_status") == 1), "job_id", "run_ts")
    enabled = jobs.filter(F.col("enabled") & ~F.col("name").isin(*ignore)).select("job_id", "server_id", "name")
    rows = J.join_not_exists_open(enabled.join(open_failures, "job_id"), activity)
    return findings(
        rows,
        "7.1",
        "Job failed",
        scope=F.col("name"),
        current=F.col("step_id"),
        details=S.text("job ", F.col("name"), " step ", F.col("step_id"), ": ", F.col("message")),
        observed_at="run_ts",
    )


def hc_mail_failed(mail_items: DataFrame, as_of) -> DataFrame:
    rows = mail_items.filter((F.col("sent_status") == "failed") & S.previous_day("sent_date", as_of))
    return findings(rows, "8.1", "Mail not sent", scope=F.col("mail_id"), observed_at="sent_date")


def _changed(objects: DataFrame, allowed: Sequence[str], as_of, check_id: str, name: str) -> DataFrame:
    rows = objects.filter(~F.col("name").isin(*allowed) & S.previous_day("modified_at", as_of))
    return findings(
        rows, check_id, name, scope=F.col("name"),
        details=S.text(F.col("name"), " changed by ", F.col("modified_by")), observed_at="modified_at",
    )


def hc_mail_account_changed(objects: DataFrame, allowed: Sequence[str], as_of) -> DataFrame:
    return _changed(objects, allowed, as_of, "8.2", "Mail account changed")


def hc_mail_profile_changed(objects: DataFrame, allowed: Sequence[str], as_of) -> DataFrame:
    return _changed(objects, allowed, as_of, "8.3", "Mail profile changed")


def hc_operator_changed(operators: DataFrame, expected: DataFrame) -> DataFrame:
    """8.4 enabled operators other than the expected one of the server."""
    rows = operators.filter("enabled").join(expected, "server_id").filter(
        F.col("name") != F.col("expected_name")
    )
    return findings(rows, "8.4", "Operator changed", scope=F.col("name"), target=F.col("expected_name"))


def trace_error_filter(as_of, min_severity: int = 17, min_duration: int = 15_000_000):
    recent = F.col("start_time") > S.minus(as_of, 24, "HOUR")
    return (
        ((F.col("event_class") == 22) & (F.col("severity") >= min_severity) & recent)
        | (F.col("event_class").isin(92, 93) & recent & (F.col("duration") > min_duration))
        | F.col("event_class").isin(94, 95, 116)
    )


def hc_trace_errors(trace: DataFrame, as_of) -> DataFrame:
    """9.1 logged errors of severity >= 17 in 24 h, slow file growth, and every shrink or consistency check."""
    rows = trace.filter(trace_error_filter(as_of))
    return findings(
        rows,
        "9.1",
        F.when(F.col("event_class") == 22, "Session error").otherwise("Trace event"),
        severity=F.when(F.col("event_class") == 22, WARN).otherwise(OK),
        scope=F.col("database_name"),
        current=F.col("event_class"),
        details=S.text(F.col("application_name"), ": ", F.col("text_data")),
        observed_at="start_time",
    )


def hc_connections_peak(perf: DataFrame, limit: int = 50) -> DataFrame:
    """10.1 peak user connections above the limit, with connection memory at that time."""
    peak = top_peak_sample(perf, "User Connections", "Connection Memory (KB)").filter(
        F.col("peak_value") > limit
    )
    return findings(
        peak,
        "10.1",
        "User connections",
        current=F.col("peak_value"),
        target=limit,
        details=S.text(F.col("peak_value"), " connections, ", F.floor(F.col("companion_value") / 1024), " MB"),
        observed_at="check_date",
    )


# Check id, name, database option and its wrong value.
OPTION_CHECKS = (
    ("10.2", "Auto close enabled", "is_auto_close_on", True),
    ("10.3", "Auto shrink enabled", "is_auto_shrink_on", True),
    ("10.4", "Auto create statistics disabled", "is_auto_create_stats_on", False),
    ("10.5", "Auto update statistics disabled", "is_auto_update_stats_on", False),
    ("10.6", "Asynchronous statistics enabled", "is_auto_update_stats_async_on", True),
)


def option_findings(databases: DataFrame, checks=OPTION_CHECKS) -> DataFrame:
    """Database options with a wrong value, all options in one scan."""
    wrong = F.array(
        *[
            F.when(
                F.col(c) == bad,
                F.struct(F.lit(i).alias("check_id"), F.lit(n).alias("check_name"), F.lit(int(bad)).alias("value")),
            )
            for i, n, c, bad in checks
        ]
    )
    rows = databases.select("server_id", "database_name", F.inline(F.array_compact(wrong)))
    return findings(
        rows,
        F.col("check_id"),
        F.col("check_name"),
        scope=F.col("database_name"),
        current=F.col("value"),
        target=1 - F.col("value"),
    )


def hc_auto_close(databases: DataFrame) -> DataFrame:
    return option_findings(databases, OPTION_CHECKS[0:1])


def hc_auto_shrink(databases: DataFrame) -> DataFrame:
    return option_findings(databases, OPTION_CHECKS[1:2])


def hc_auto_create_stats(databases: DataFrame) -> DataFrame:
    return option_findings(databases, OPTION_CHECKS[2:3])


def hc_auto_update_stats(databases: DataFrame) -> DataFrame:
    return option_findings(databases, OPTION_CHECKS[3:4])


def hc_async_stats(databases: DataFrame) -> DataFrame:
    return option_findings(databases, OPTION_CHECKS[4:5])


def _cpu(cpu_samples: DataFrame, col: str, as_of, limit: int, check_id: str, name: str) -> DataFrame:
    rows = (
        cpu_samples.filter((F.col(col) > limit) & S.in_last("event_time", as_of, 24, "HOUR"))
        .select("server_id", "event_time", col)
        .distinct()
    )
    return findings(rows, check_id, name, current=F.col(col), target=limit, observed_at="event_time")


def hc_cpu_engine(cpu_samples: DataFrame, as_of, limit: int = 70) -> DataFrame:
    return _cpu(cpu_samples, "sql_cpu", as_of, limit, "10.7", "Engine CPU")


def hc_cpu_other(cpu_samples: DataFrame, as_of, limit: int = 70) -> DataFrame:
    return _cpu(cpu_samples, "other_cpu", as_of, limit, "10.8", "Other CPU")


def hc_memory_low(memory_samples: DataFrame, memory_tree: DataFrame, as_of, per_row: int = 1000) -> DataFrame:
    """10.9 newest low-memory sample per server in 24 h, with the memory tree of the server's newest snapshot attached.

    All counters are listed, largest first, ``per_row`` to a finding; a larger tree becomes several findings.
    """
    low = memory_samples.filter(
        (F.col("physical_low") | F.col("virtual_low")) & S.in_last("event_time", as_of, 24, "HOUR")
    )
    newest = latest_row(low, ["server_id"], ["event_time", "sample_id"])
    known = memory_tree.filter(F.col("snapshot_ts") <= S.ts(as_of))
    last = known.groupBy("server_id").agg(F.max("snapshot_ts").alias("snapshot_ts"))
    tree = known.join(last, ["server_id", "snapshot_ts"]).join(newest.select("server_id"), "server_id", "left_semi")
    ranked = rank_in_group(tree, ["server_id"], [F.col("value_mb").desc(), F.col("counter_name")], "_rn")
    chunk = F.floor((F.col("_rn") - 1) / per_row).alias("_chunk")
    listed = ranked.groupBy("server_id", chunk).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("_rn", "counter_name", "value_mb"))),
                lambda x: F.concat(x["counter_name"], F.lit("="), F.format_string("%.2f", x["value_mb"])),
            ),
            "; ",
        ).alias("_tree")
    )
    rows = newest.join(listed, "server_id", "left")
    return findings(
        rows, "10.9", "Memory low", current=F.col("physical_used"), details=F.col("_tree"), observed_at="event_time"
    )


def hc_cpu_pressure(wait_stats: DataFrame, causes: DataFrame, limit: float = 23) -> DataFrame:
    """10.10 signal-wait share above the limit, with the top wait type and its cause."""
    ratio = wait_signal_ratio(wait_stats).filter(F.col("pct") > limit)
    rows = ratio.join(wait_top_cause(wait_stats, causes).drop("pct"), "server_id", "left")
    return findings(
        rows,
        "10.10",
        "CPU pressure",
        current=S.fixed("pct"),
        target=limit,
        details=S.text("top wait ", F.col("wait_type"), ": ", F.col("cause")),
    )


def hc_deadlocks(deadlocks: DataFrame, as_of) -> DataFrame:
    rows = deadlocks.filter(S.in_last("event_time", as_of, 24, "HOUR"))
    return findings(rows, "11.1", "Deadlock", details=F.col("deadlock_graph"), observed_at="event_time")


# Commands of known background activity.
KNOWN_COMMANDS = ("%sp_readrequest%", "%responses from dbmail%", "%sys.dm_os_cluster_nodes%")
# Program name prefix and label.
KNOWN_PROGRAMS = (
    ("SQLPS%", "SQL Server PowerShell cmdlets"),
    ("dbatools%", "dbatools PowerShell module"),
    ("Veeam Agent%", "Veeam Agent for Microsoft Windows"),
)


def hc_unknown_activity(activity: DataFrame, cpu_samples: DataFrame, as_of, limit: int = 30) -> DataFrame:
    """12.1 human activity in 24 h on servers whose other CPU exceeds the limit, known commands excluded."""
    busy = cpu_samples.filter((F.col("other_cpu") > limit) & S.in_last("event_time", as_of, 24, "HOUR"))
    unknown = activity.filter(
        S.in_last("login_time", as_of, 24, "HOUR") & ~S.any_ilike("last_command", KNOWN_COMMANDS)
    )
    label = F.lit("unknown")
    for prefix, known in KNOWN_PROGRAMS:
        label = F.when(F.col("program_name").ilike(prefix), known).otherwise(label)
    rows = J.join_semi_gate(unknown, busy, ["server_id"])
    return findings(
        rows,
        "12.1",
        "Unknown activity",
        scope=F.col("login_name"),
        current=label,
        details=F.col("last_command"),
        observed_at="login_time",
    )


def hc_web_traffic(access_log: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Visitors and megabytes sent per server in the last day (informational)."""
    rows = (
        access_log.filter(S.in_last("log_time", as_of, hours, "HOUR"))
        .groupBy("server_id")
        .agg(F.count(F.lit(1)).alias("hits"), F.sum("bytes_sent").alias("_bytes"))
    )
    return findings(
        rows,
        "web",
        "Web traffic",
        severity=OK,
        achieved=True,
        current=F.col("hits"),
        details=S.text(F.col("hits"), " requests, ", F.floor(F.col("_bytes") / S.MB), " MB sent"),
        observed_at=S.ts(as_of),
    )


def hc_server_summary(servers: DataFrame, files: DataFrame, all_findings: DataFrame) -> DataFrame:
    """Inventory facts per server with its status; ``no problems`` when it has no finding."""
    sizes = agg_size_total(files)
    rollup = all_findings.groupBy("server_id").agg(
        F.max("severity").alias("severity"), F.count_if(F.col("severity") > OK).alias("problems")
    )
    status = F.when(F.col("severity") >= CRITICAL, "RED").when(F.col("severity") == WARN, "YELLOW")
    return (
        servers.select("server_id", "boot_time", "instance_count")
        .join(sizes, "server_id", "left")
        .join(rollup, "server_id", "left")
        .select(
            "server_id",
            "boot_time",
            "instance_count",
            F.coalesce("databases", F.lit(0)).alias("databases"),
            F.coalesce("total_gb", F.lit(0.0)).alias("total_gb"),
            status.otherwise("GREEN").alias("status"),
            F.when(F.col("problems") > 0, S.text(F.col("problems"), " problems"))
            .otherwise("no problems")
            .alias("summary"),
        )
    )


def hc_recent_restart(servers: DataFrame, as_of) -> DataFrame:
    """Uptime of zero whole days."""
    rows = servers.filter(S.in_last("boot_time", as_of, 24, "HOUR"))
    return findings(
        rows, "restart", "Server restarted", details=S.text("restarted at ", S.stamp("boot_time")), observed_at="boot_time"
    )


def hc_disk_free_10gb(volumes: DataFrame, gb: float = 10) -> DataFrame:
    return _low_volumes(volumes, F.col("free_gb") <= gb, "disk", WARN, f"> {gb}")


def hc_low_disk_percent(volumes: DataFrame, pct: float = 20) -> DataFrame:
    """Distinct drives whose free share is at or below the threshold."""
    mb = lambda c: F.floor(F.col(c) / S.MB)
    rows = (
        volumes.select(
            "server_id",
            "volume_mount_point",
            mb("total_bytes").alias("size_mb"),
            mb("available_bytes").alias("free_mb"),
        )
        .distinct()
        .filter(F.col("free_mb") <= F.col("size_mb") * (pct / 100))
        .withColumn("free_pct", F.round(F.col("free_mb") / F.col("size_mb") * 100, 2))
    )
    return findings(
        rows,
        "lowdisk",
        "Low disk space",
        scope=F.col("volume_mount_point"),
        current=S.fixed("free_pct"),
        target=pct,
        details=S.text(F.col("free_mb"), " of ", F.col("size_mb"), " MB free"),
    )


def hc_cert_expiring(certs: DataFrame, as_of, days: int = 30, subject: str | None = None) -> DataFrame:
    limit = F.timestamp_add("DAY", F.lit(days), S.ts(as_of))
    rows = certs.filter((F.col("not_after") >= S.ts(as_of)) & (F.col("not_after") <= limit))
    if subject is not None:
        rows = rows.filter(F.col("subject").ilike(subject))
    return findings(rows, "cert.expiring", "Certificate expires", scope=F.col("subject"), observed_at="not_after")


def hc_cert_expired(certs: DataFrame, as_of) -> DataFrame:
    rows = certs.filter(F.col("not_after") < S.ts(as_of))
    return findings(rows, "cert.expired", "Certificate expired", scope=F.col("subject"), observed_at="not_after")


# Services that may stay stopped.
ALLOWED_STOPPED = ("wuauserv", "RemoteRegistry", "sppsvc")


def hc_service_stopped(services: DataFrame, allow: Sequence[str] = ALLOWED_STOPPED) -> DataFrame:
    auto = (F.col("start_mode") == "Auto") | F.col("start_mode").ilike("%Delay%")
    rows = services.filter(auto & (F.col("state") != "Running") & ~F.col("service_name").isin(*allow))
    return findings(
        rows, "service", "Service not running", scope=F.col("service_name"), current=F.col("state"), target="Running"
    )


def hc_patches_recent(hotfixes: DataFrame, as_of) -> DataFrame:
    """Hotfixes installed after midnight yesterday (informational)."""
    rows = hotfixes.filter(F.col("installed_on") > S.midnight(as_of, 1))
    return findings(
        rows, "patches", "Update history", severity=OK, achieved=True, scope=F.col("hotfix_id"),
        details=F.col("description"), observed_at="installed_on",
    )


def hc_patch_failed(
    os_events: DataFrame, as_of, event_id: int = 20, source: str = "Microsoft-Windows-WindowsUpdateClient"
) -> DataFrame:
    """Newest failed-update event per server, when it lies within a day."""
    updates = os_events.filter(
        (F.col("log_name") == "System") & (F.col("event_id") == event_id) & (F.col("source") == source)
    )
    newest = latest_row(updates, ["server_id"], ["time", "record_id"])
    rows = newest.filter(F.col("time") > S.minus(as_of, 24, "HOUR"))
    return findings(rows, "patch.failed", "Update failed", details=F.col("message"), observed_at="time")
