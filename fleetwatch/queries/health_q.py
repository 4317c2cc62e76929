"""Queries of health checks, log analytics and security analytics."""

# ruff: noqa: E501
from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatch.operators import findings as FD
from fleetwatch.operators import health as H
from fleetwatch.operators import logs as L
from fleetwatch.plans import reports
from fleetwatch.queries.core import CAUSES, CAUSES_SQL, E, O, REASONS_SQL, noise_sql
from fleetwatch.queries.findings_sql import fsql, stamp
from fleetwatch.queries.registry import QUERIES, query
from fleetwatch.session import literal_table
from fleetwatch.queries.roles_sql import AS_OF_EVENTS, AS_OF_ORDERS

YESTERDAY = "TIMESTAMP '2024-01-30'"
TODAY = "TIMESTAMP '2024-01-31'"
DAY24 = f"{E} - INTERVAL 24 HOUR"

VERSIONS = [(10, "SP4", "2023-12-01 00:00:00"), (11, "SP4", "2023-12-01 00:00:00"), (12, "SP3", "2024-01-20 00:00:00"),
            (13, "SP2", "2024-01-20 00:00:00"), (14, "CU22", "2024-01-25 00:00:00")]
VERSIONS_SQL = "(VALUES " + ", ".join(f"({a}, '{b}', TIMESTAMP '{c}')" for a, b, c in VERSIONS) + ") AS m(major_version, target_level, released_at)"


def version_map(t):
    return literal_table(t.spark, VERSIONS, "major_version int, target_level string, released_at string").withColumn(
        "released_at", F.col("released_at").cast("timestamp_ntz")
    )


@query("hc_patch_level", fsql(
    f"v_servers s JOIN {VERSIONS_SQL} ON m.major_version = s.major_version", "1.1", "Patch level", where="update_level <> target_level",
    current="update_level", target="target_level", at=E,
    details=f"concat(CASE WHEN date_diff('day', released_at, {E}) > 21 THEN 'urgent: install ' ELSE 'install ' END, target_level)"))
def _(t):
    return H.hc_patch_level(t("servers"), version_map(t), AS_OF_EVENTS)


LAST_FULL = f"""(SELECT d.server_id, d.database_name, b.last_full, date_diff('hour', b.last_full, {O}) AS hours FROM v_databases d LEFT JOIN (
  SELECT server_id, database_name, MAX(backup_finish_date) AS last_full FROM v_backupset WHERE type = 'D' GROUP BY 1, 2) b
  ON b.server_id = d.server_id AND b.database_name = d.database_name)"""
BACKUP_DETAILS = f"concat('last full backup of ', database_name, ' at ', {stamp('last_full')})"


@query("hc_backup_user", fsql(
    LAST_FULL, "2.1", "Full backup missing", scope="database_name", current="hours", target="6", at="last_full", details=BACKUP_DETAILS,
    severity=f"CASE WHEN last_full > {O} - INTERVAL 24 HOUR THEN 1 ELSE 2 END",
    where=f"database_name NOT IN ('master', 'msdb', 'model', 'usage', 'distribution', 'tempdb') AND (last_full IS NULL OR last_full < {O} - INTERVAL 6 HOUR)"))
def _(t):
    return H.hc_backup_user(t("backupset"), t("databases"), AS_OF_ORDERS)


@query("hc_backup_system", fsql(
    LAST_FULL, "2.2", "System database backup missing", scope="database_name", current="hours", target="72", at="last_full", details=BACKUP_DETAILS,
    where=f"database_name IN ('master', 'msdb', 'model') AND (last_full IS NULL OR last_full < {O} - INTERVAL 72 HOUR)"))
def _(t):
    return H.hc_backup_system(t("backupset"), t("databases"), AS_OF_ORDERS)


FREE = "(SELECT DISTINCT server_id, volume_mount_point, ROUND(available_bytes / 1073741824, 2) AS free_gb FROM v_volumes)"


def volume_sql(check, cond, severity, target):
    return fsql(FREE, check, "Volume free space", where=cond, severity=severity, scope="volume_mount_point", current="printf('%.2f', free_gb)",
                target=f"'{target}'", details="concat('volume ', volume_mount_point, ' has ', printf('%.2f', free_gb), ' GB free')")


@query("hc_volume_warn", volume_sql("3.1", "free_gb BETWEEN 2 AND 5", "1", "> 5"))
def _(t):
    return H.hc_volume_warn(t("volumes"))


@query("hc_volume_critical", volume_sql("3.2", "free_gb < 2", "2", ">= 2"))
def _(t):
    return H.hc_volume_critical(t("volumes"))


@query("hc_disk_free_10gb", volume_sql("disk", "free_gb <= 10", "1", "> 10"))
def _(t):
    return H.hc_disk_free_10gb(t("volumes"))


@query("hc_file_growth", fsql(
    f"""(SELECT g.*, f.physical_name FROM (SELECT server_id, database_name, file_id, start_time, SUM(integer_data * 8) AS growth_kb, MAX(duration) AS duration FROM v_trace
      WHERE event_class BETWEEN 92 AND 95 AND start_time > {DAY24} AND start_time <= {E} GROUP BY 1, 2, 3, 4 HAVING SUM(integer_data * 8) > 0) g
    JOIN v_database_files f USING (server_id, database_name, file_id) WHERE g.server_id IN (SELECT server_id FROM v_volumes WHERE ROUND(available_bytes / 1073741824, 2) <= 5))""",
    "3.3", "Data file growth", scope="database_name", current="CAST(growth_kb AS BIGINT)", at="start_time",
    details="concat(physical_name, ' grew by ', CAST(growth_kb // 1024 AS BIGINT), ' MB in ', duration // 1000, ' ms')"))
def _(t):
    return H.hc_file_growth(t("trace"), t("database_files"), t("volumes"), AS_OF_EVENTS)


def log_rows_sql(check, name, *patterns):
    cond = " OR ".join(f"text ILIKE '{p}'" for p in patterns)
    return fsql("v_error_log", check, name, where=f"log_date >= {YESTERDAY} AND ({cond})", scope="process_info", details="text", at="log_date")


def log_summary_sql(check, name, pattern):
    src = f"(SELECT server_id, text, COUNT(*) AS n, MIN(log_date) AS a, MAX(log_date) AS z FROM v_error_log WHERE log_date >= {YESTERDAY} AND text ILIKE '{pattern}' GROUP BY 1, 2)"
    return fsql(src, check, name, severity="2", current="n", target="0", at="z", details=f"concat(n, ' times between ', {stamp('a')}, ' and ', {stamp('z')}, ': ', text)")


@query("hc_login_failed", log_rows_sql("4.1", "Login failed", "%login failed%"))
def _(t):
    return H.hc_login_failed(t("error_log"), AS_OF_EVENTS)


@query("hc_filegroup_full", log_rows_sql("4.2", "Filegroup is full", "%filegroup is full%", "%voll ist%"))
def _(t):
    return H.hc_filegroup_full(t("error_log"), AS_OF_EVENTS)


for _key, _check, _name, _pattern in (
    ("hc_system_task", "4.3", "Unable to run a system task", "%SQL Server was unable%"),
    ("hc_failed_to_start", "4.4", "Failed to start", "%failed to start%"),
    ("hc_terminating_task", "4.5", "Terminating a system task", "%terminating a system%"),
    ("hc_dispatcher", "4.6", "Dispatcher was unable", "%Dispatcher was unable%"),
    ("hc_insufficient_memory", "4.7", "Insufficient memory", "%insufficient system memory%"),
    ("hc_allocation_failure", "4.8", "Memory allocation failure", "%memory allocation failure%"),
):
    query(_key, log_summary_sql(_check, _name, _pattern))(
        lambda t, check=getattr(H, _key): check(t("error_log"), AS_OF_EVENTS)
    )


@query("hc_jobs_disabled", fsql("v_jobs", "5.1", "Job disabled", where="NOT enabled AND name NOT IN ('job_9') AND environment <> 'PRO'", scope="name", details="concat('job ', name, ' is disabled')"))
def _(t):
    return H.hc_jobs_disabled(t("jobs"), ["job_9"])


@query("hc_agent_errors", fsql(
    f"(SELECT DISTINCT server_id, log_date, text FROM v_agent_log WHERE log_date >= {YESTERDAY} AND log_date < {TODAY} AND text NOT ILIKE '%Fehlerprotokoll%')",
    "6.1", "Agent error log", details="text", at="log_date"))
def _(t):
    return H.hc_agent_errors(t("agent_log"), AS_OF_EVENTS)


@query("hc_jobs_failed", fsql(
    """j""", "7.1", "Job failed", scope="name", current="step_id", details="concat('job ', name, ' step ', step_id, ': ', message)", at="run_ts",
    ctes=f"""WITH h AS (SELECT *, strptime(concat(run_date, lpad(CAST(run_time AS VARCHAR), 6, '0')), '%Y%m%d%H%M%S') AS run_ts FROM v_job_history),
    f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY run_ts DESC, step_id DESC) AS rn FROM h WHERE run_status = 0) WHERE rn = 1),
    j AS (SELECT jb.server_id, jb.name, f.* FROM f JOIN v_jobs jb ON jb.job_id = f.job_id AND jb.enabled AND jb.name <> 'syspolicy_purge_history'
      WHERE f.run_ts >= {DAY24} AND f.run_ts <= {E} AND NOT EXISTS (SELECT 1 FROM h s WHERE s.job_id = f.job_id AND s.run_status = 1 AND s.run_ts > f.run_ts)
      AND NOT EXISTS (SELECT 1 FROM v_job_activity a WHERE a.job_id = f.job_id AND a.stop_execution_date IS NULL
        AND a.session_id = (SELECT MAX(session_id) FROM v_job_activity m WHERE m.job_id = f.job_id)))"""))
def _(t):
    return H.hc_jobs_failed(t("jobs"), t("job_history"), t("job_activity"), AS_OF_EVENTS)


@query("hc_mail_failed", fsql("v_mail_items", "8.1", "Mail not sent", where=f"sent_status = 'failed' AND sent_date >= {YESTERDAY} AND sent_date < {TODAY}", scope="mail_id", at="sent_date"))
def _(t):
    return H.hc_mail_failed(t("mail_items"), AS_OF_EVENTS)


def changed_sql(check, name, allowed):
    return fsql("v_mail_objects", check, name, where=f"name NOT IN ({allowed}) AND modified_at >= {YESTERDAY} AND modified_at < {TODAY}", scope="v_mail_objects.name",
                details="concat(v_mail_objects.name, ' changed by ', modified_by)", at="modified_at").replace("name NOT IN", "v_mail_objects.name NOT IN")


@query("hc_mail_account_changed", changed_sql("8.2", "Mail account changed", "'acct1', 'acct2'"))
def _(t):
    return H.hc_mail_account_changed(t("mail_objects"), ["acct1", "acct2"], AS_OF_EVENTS)


@query("hc_mail_profile_changed", changed_sql("8.3", "Mail profile changed", "'acct7'"))
def _(t):
    return H.hc_mail_profile_changed(t("mail_objects"), ["acct7"], AS_OF_EVENTS)


@query("hc_operator_changed", fsql("(SELECT o.server_id, o.name AS op, o.enabled, e.expected_name FROM v_operators o JOIN v_expected_operator e ON e.server_id = o.server_id)",
                                   "8.4", "Operator changed", where="enabled AND op <> expected_name", scope="op", target="expected_name"))
def _(t):
    return H.hc_operator_changed(t("operators"), t("expected_operator"))


@query("hc_trace_errors", fsql(
    "v_trace", "9.1", "=CASE WHEN event_class = 22 THEN 'Session error' ELSE 'Trace event' END", severity="CASE WHEN event_class = 22 THEN 1 ELSE 0 END",
    scope="database_name", current="event_class", details="concat(application_name, ': ', text_data)", at="start_time",
    where=f"(event_class = 22 AND v_trace.severity >= 17 AND start_time > {DAY24}) OR (event_class IN (92, 93) AND start_time > {DAY24} AND duration > 15000000) OR event_class IN (94, 95, 116)"))
def _(t):
    return H.hc_trace_errors(t("trace"), AS_OF_EVENTS)


PEAK = """(WITH p AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY cntr_value DESC, check_date DESC, sample_id DESC) AS rn FROM v_perf_counters WHERE counter_name = 'User Connections')
SELECT p.server_id, p.cntr_value AS peak, p.check_date, c.cntr_value AS mem FROM p JOIN v_perf_counters c ON c.server_id = p.server_id AND c.sample_id = p.sample_id AND c.counter_name = 'Connection Memory (KB)' WHERE rn = 1)"""


@query("hc_connections_peak", fsql(PEAK, "10.1", "User connections", where="peak > 50", current="peak", target="50", at="check_date", details="concat(peak, ' connections, ', mem // 1024, ' MB')"))
def _(t):
    return H.hc_connections_peak(t("perf_counters"))


for _key, _check, _name, _col, _wrong in (
    ("hc_auto_close", "10.2", "Auto close enabled", "is_auto_close_on", True),
    ("hc_auto_shrink", "10.3", "Auto shrink enabled", "is_auto_shrink_on", True),
    ("hc_auto_create_stats", "10.4", "Auto create statistics disabled", "is_auto_create_stats_on", False),
    ("hc_auto_update_stats", "10.5", "Auto update statistics disabled", "is_auto_update_stats_on", False),
    ("hc_async_stats", "10.6", "Asynchronous statistics enabled", "is_auto_update_stats_async_on", True),
):
    query(_key, fsql("v_databases", _check, _name, where=f"{_col} = {_wrong}", scope="database_name", current=str(int(_wrong)), target=str(int(not _wrong))))(
        lambda t, check=getattr(H, _key): check(t("databases"))
    )


def cpu_sql(check, name, col):
    return fsql(f"(SELECT DISTINCT server_id, event_time, {col} FROM v_cpu_samples WHERE {col} > 70 AND event_time > {DAY24} AND event_time <= {E})", check, name, current=col, target="70", at="event_time")


@query("hc_cpu_engine", cpu_sql("10.7", "Engine CPU", "sql_cpu"))
def _(t):
    return H.hc_cpu_engine(t("cpu_samples"), AS_OF_EVENTS)


@query("hc_cpu_other", cpu_sql("10.8", "Other CPU", "other_cpu"))
def _(t):
    return H.hc_cpu_other(t("cpu_samples"), AS_OF_EVENTS)


@query("hc_memory_low", fsql(
    f"""(WITH low AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY event_time DESC, sample_id DESC) AS rn FROM v_memory_samples
        WHERE (physical_low OR virtual_low) AND event_time > {DAY24} AND event_time <= {E}),
      newest AS (SELECT *, max(snapshot_ts) OVER (PARTITION BY server_id) AS last_ts FROM v_memory_rows WHERE snapshot_ts <= {E}),
      big AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY value_mb DESC, counter_name) AS rn FROM newest WHERE snapshot_ts = last_ts),
      txt AS (SELECT server_id, string_agg(concat(counter_name, '=', printf('%.2f', value_mb)), '; ' ORDER BY rn) AS tree FROM big GROUP BY server_id, (rn - 1) // 1000)
      SELECT low.server_id, physical_used, event_time, tree FROM low LEFT JOIN txt ON txt.server_id = low.server_id WHERE rn = 1)""",
    "10.9", "Memory low", current="physical_used", details="tree", at="event_time"))
def _(t):
    return H.hc_memory_low(t("memory_samples"), t("memory_rows"), AS_OF_EVENTS)


WAIT_SHORT = "(SELECT server_id, wait_type, row_number() OVER (PARTITION BY server_id ORDER BY wait_time_ms DESC, wait_type) AS rn FROM v_wait_stats)"


@query("hc_cpu_pressure", fsql(
    f"""(SELECT r.server_id, r.pct, w.wait_type, COALESCE(c.cause, 'unknown, to be analysed') AS cause FROM (
      SELECT server_id, CAST(SUM(signal_wait_time_ms) AS DOUBLE) * 100 / SUM(wait_time_ms) AS pct FROM v_wait_stats GROUP BY 1) r
      JOIN {WAIT_SHORT} w ON w.server_id = r.server_id AND w.rn = 1 LEFT JOIN {CAUSES_SQL} ON c.wait_type = w.wait_type)""",
    "10.10", "CPU pressure", where="pct > 23", current="printf('%.2f', pct)", target="23", details="concat('top wait ', wait_type, ': ', cause)"))
def _(t):
    return H.hc_cpu_pressure(t("wait_stats"), literal_table(t.spark, CAUSES, "wait_type string, cause string"))


@query("hc_deadlocks", fsql("v_deadlocks", "11.1", "Deadlock", where=f"event_time > {DAY24} AND event_time <= {E}", details="deadlock_graph", at="event_time"))
def _(t):
    return H.hc_deadlocks(t("deadlocks"), AS_OF_EVENTS)


@query("hc_unknown_activity", fsql(
    "v_activity", "12.1", "Unknown activity", scope="login_name", details="last_command", at="login_time",
    current="CASE WHEN program_name ILIKE 'SQLPS%' THEN 'SQL Server PowerShell cmdlets' WHEN program_name ILIKE 'dbatools%' THEN 'dbatools PowerShell module' WHEN program_name ILIKE 'Veeam Agent%' THEN 'Veeam Agent for Microsoft Windows' ELSE 'unknown' END",
    where=f"""login_time > {DAY24} AND login_time <= {E} AND last_command NOT ILIKE '%sp_readrequest%' AND last_command NOT ILIKE '%responses from dbmail%'
      AND last_command NOT ILIKE '%sys.dm_os_cluster_nodes%' AND server_id IN (SELECT server_id FROM v_cpu_samples WHERE other_cpu > 30 AND event_time > {DAY24} AND event_time <= {E})"""))
def _(t):
    return H.hc_unknown_activity(t("activity"), t("cpu_samples"), AS_OF_EVENTS)


@query("hc_web_traffic", fsql(
    f"(SELECT server_id, COUNT(*) AS n, SUM(bytes_sent) AS b FROM v_access_log WHERE log_time > {DAY24} AND log_time <= {E} GROUP BY 1)",
    "web", "Web traffic", severity="0", achieved="TRUE", current="n", details="concat(n, ' requests, ', CAST(b // 1048576 AS BIGINT), ' MB sent')", at=E))
def _(t):
    return H.hc_web_traffic(t("access_log"), AS_OF_EVENTS)


@query("hc_recent_restart", fsql("v_servers", "restart", "Server restarted", where=f"boot_time > {DAY24} AND boot_time <= {E}", details=f"concat('restarted at ', {stamp('boot_time')})", at="boot_time"))
def _(t):
    return H.hc_recent_restart(t("servers"), AS_OF_EVENTS)


@query("hc_low_disk_percent", fsql(
    "(SELECT DISTINCT server_id, volume_mount_point, total_bytes // 1048576 AS s, available_bytes // 1048576 AS f FROM v_volumes)", "lowdisk", "Low disk space",
    where="f <= s * 0.2", scope="volume_mount_point", current="printf('%.2f', ROUND(f / s * 100, 2))", target="20", details="concat(f, ' of ', s, ' MB free')"))
def _(t):
    return H.hc_low_disk_percent(t("volumes"))


@query("hc_cert_expiring", fsql("v_certs", "cert.expiring", "Certificate expires", where=f"not_after >= {O} AND not_after <= {O} + INTERVAL 30 DAY AND subject ILIKE '%campus%'", scope="subject", at="not_after"))
def _(t):
    return H.hc_cert_expiring(t("certs"), AS_OF_ORDERS, subject="%campus%")


@query("hc_cert_expired", fsql("v_certs", "cert.expired", "Certificate expired", where=f"not_after < {O}", scope="subject", at="not_after"))
def _(t):
    return H.hc_cert_expired(t("certs"), AS_OF_ORDERS)


@query("hc_service_stopped", fsql("v_services", "service", "Service not running", where="(start_mode = 'Auto' OR start_mode ILIKE '%delay%') AND state <> 'Running' AND service_name NOT IN ('wuauserv', 'RemoteRegistry', 'sppsvc')",
                                  scope="service_name", current="state", target="'Running'"))
def _(t):
    return H.hc_service_stopped(t("services"))


@query("hc_patches_recent", fsql("v_hotfixes", "patches", "Update history", where=f"installed_on > {YESTERDAY}", severity="0", achieved="TRUE", scope="hotfix_id", details="description", at="installed_on"))
def _(t):
    return H.hc_patches_recent(t("hotfixes"), AS_OF_EVENTS)


@query("hc_patch_failed", fsql(
    "(SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY time DESC, record_id DESC) AS rn FROM v_os_events WHERE log_name = 'System' AND event_id = 20 AND source = 'Microsoft-Windows-WindowsUpdateClient')",
    "patch.failed", "Update failed", where=f"rn = 1 AND time > {DAY24}", details="message", at="time"))
def _(t):
    return H.hc_patch_failed(t("os_events"), AS_OF_EVENTS)


def _mixed(t):
    """Findings of several checks over the same three servers."""
    return FD.union_findings(
        H.hc_login_failed(t("error_log"), AS_OF_EVENTS),
        H.hc_system_task(t("error_log"), AS_OF_EVENTS),
        H.hc_cpu_engine(t("cpu_samples"), AS_OF_EVENTS),
        H.hc_volume_critical(t("volumes")),
    )


MIXED_SQL = " UNION ALL ".join(
    f"SELECT * FROM ({x})" for x in (
        log_rows_sql("4.1", "Login failed", "%login failed%"),
        log_summary_sql("4.3", "Unable to run a system task", "%SQL Server was unable%"),
        cpu_sql("10.7", "Engine CPU", "sql_cpu"),
        volume_sql("3.2", "free_gb < 2", "2", ">= 2"),
    ))


@query("hc_traffic_light", f"""
WITH w AS (SELECT server_id, MAX(severity) AS s FROM ({MIXED_SQL}) GROUP BY 1), f AS (SELECT DISTINCT server_id FROM v_servers UNION SELECT server_id FROM v_databases)
SELECT f.server_id, CASE WHEN s >= 2 THEN 'RED' WHEN s = 1 THEN 'YELLOW' ELSE 'GREEN' END AS status FROM f LEFT JOIN w ON w.server_id = f.server_id""")
def _(t):
    fleet = t("servers").select("server_id").unionByName(t("databases").select("server_id"))
    return FD.hc_traffic_light(_mixed(t), fleet)


@query("hc_server_summary", f"""
WITH m AS ({MIXED_SQL}), w AS (SELECT server_id, MAX(severity) AS s, COUNT(*) FILTER (WHERE severity > 0) AS p FROM m GROUP BY 1),
z AS (SELECT server_id, COUNT(DISTINCT database_name) AS databases, ROUND(SUM(size_pages) * 8 / 1024 / 1024, 2) AS total_gb FROM v_database_files GROUP BY 1)
SELECT s.server_id, boot_time, instance_count, COALESCE(databases, 0) AS databases, COALESCE(total_gb, 0) AS total_gb,
  CASE WHEN w.s >= 2 THEN 'RED' WHEN w.s = 1 THEN 'YELLOW' ELSE 'GREEN' END AS status, CASE WHEN w.p > 0 THEN concat(w.p, ' problems') ELSE 'no problems' END AS summary
FROM v_servers s LEFT JOIN w ON w.server_id = s.server_id LEFT JOIN z ON z.server_id = s.server_id""")
def _(t):
    return H.hc_server_summary(t("servers"), t("database_files"), _mixed(t))


REPORT_ORDER = "severity DESC, name, scope NULLS FIRST, details NULLS FIRST, observed_at NULLS FIRST"


@query("sink_report_rows", f"""
WITH m AS ({MIXED_SQL}), r AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY {REPORT_ORDER}) - 1 AS rn FROM m),
w AS (SELECT server_id, MAX(severity) AS s FROM m GROUP BY 1)
SELECT r.server_id, CASE WHEN s >= 2 THEN 'RED' WHEN s = 1 THEN 'YELLOW' ELSE 'GREEN' END AS status, rn // 1000 AS part_no,
  string_agg(concat(name, ': ', COALESCE(details, '')), chr(10) ORDER BY rn) AS report_text FROM r JOIN w ON w.server_id = r.server_id GROUP BY 1, 2, 3""")
def _(t):
    return FD.sink_report_rows(_mixed(t))


@query("sort_report", f"SELECT * FROM ({MIXED_SQL}) ORDER BY achieved, name, server_id, scope, details")
def _(t):
    from fleetwatch.operators.windows import sort_report

    return sort_report(_mixed(t))


HEALTH_CHECKS = """hc_backup_user hc_backup_system hc_volume_warn hc_volume_critical hc_file_growth hc_login_failed hc_filegroup_full hc_system_task
hc_failed_to_start hc_terminating_task hc_dispatcher hc_insufficient_memory hc_allocation_failure hc_jobs_disabled hc_agent_errors hc_jobs_failed hc_mail_failed
hc_trace_errors hc_connections_peak hc_cpu_engine hc_cpu_other hc_deadlocks hc_unknown_activity hc_web_traffic hc_auto_close hc_auto_shrink
hc_auto_create_stats hc_auto_update_stats hc_async_stats hc_patch_level hc_operator_changed hc_mail_account_changed hc_mail_profile_changed hc_memory_low
hc_cpu_pressure hc_recent_restart hc_disk_free_10gb hc_low_disk_percent hc_cert_expiring hc_cert_expired hc_service_stopped hc_patches_recent
hc_patch_failed""".split()


def health_sql() -> str:
    """All checks at one time, their highest severity per server of the inventory."""
    parts = [QUERIES[k].oracle.replace(O, E).replace("AND name NOT IN ('job_9') ", "").replace(" AND subject ILIKE '%campus%'", "") for k in HEALTH_CHECKS]
    checks = " UNION ALL ".join(f"SELECT server_id, severity FROM ({p})" for p in parts)
    return f"""WITH worst AS (SELECT server_id, MAX(severity) AS s FROM ({checks}) GROUP BY 1)
SELECT d.server_id, CASE WHEN s >= 2 THEN 'RED' WHEN s = 1 THEN 'YELLOW' ELSE 'GREEN' END AS status
FROM (SELECT server_id FROM v_databases UNION SELECT server_id FROM v_servers) d LEFT JOIN worst w ON w.server_id = d.server_id"""


@query("run_health", health_sql())
def _(t):
    """Whole health report from its roles, one status per server."""
    given = {r: t(r) for r in reports.HEALTH_ROLES}
    given |= {"version_map": version_map(t), "causes": literal_table(t.spark, CAUSES, "wait_type string, cause string")}
    return reports.run_health(given, AS_OF_EVENTS, mail_accounts=["acct1", "acct2"], mail_profiles=["acct7"])


# ---- logs ------------------------------------------------------------------
PREV = f"log_date >= {YESTERDAY} AND log_date < {TODAY}"


@query("log_archive_errors", f"SELECT server_id, log_date, process_info, text FROM v_error_log WHERE {PREV} AND (text ILIKE '%Error%' OR text ILIKE '%filegroup is full%' OR text ILIKE '%voll ist%')")
def _(t):
    return L.log_archive_errors(t("error_log"), AS_OF_EVENTS)


ANY_SQL = " OR ".join(f"text ILIKE '{p}'" for p in L.FAILURE_PATTERNS)


@query("log_archive_failures", f"SELECT DISTINCT server_id, log_date, process_info, text FROM v_error_log WHERE {ANY_SQL}")
def _(t):
    return L.log_archive_failures(t("error_log"))


@query("log_archive_agent", f"SELECT server_id, log_date, error_level, text FROM v_agent_log WHERE {PREV} AND (text ILIKE '%Error%' OR text ILIKE '%Fehler%')")
def _(t):
    return L.log_archive_agent(t("agent_log"), AS_OF_EVENTS)


@query("log_pattern_counts", "SELECT p.pattern, COUNT(e.id) AS n FROM (VALUES " + ", ".join(f"('{p}')" for p in L.FAILURE_PATTERNS) + ") AS p(pattern) LEFT JOIN v_error_log e ON e.text ILIKE p.pattern GROUP BY 1")
def _(t):
    return L.log_pattern_counts(t("error_log"), L.FAILURE_PATTERNS)


@query("log_failed_logins", fsql("v_error_log", "49", "Engine error log", severity="0", current="0", target="1", details=f"concat({stamp('log_date')}, ' - ', text)", at="log_date",
                                 where=f"text ILIKE '%Login failed%' AND {noise_sql(L.ENGINE_NOISE)}"))
def _(t):
    return L.log_failed_logins(t("error_log"))


@query("log_agent_errors_filtered", fsql("v_agent_log", "50", "Agent error log", severity="0", current="0", target="1", details=f"concat({stamp('log_date')}, ' - ', text)", at="log_date",
                                         where=f"(text ILIKE '%Error%' OR text ILIKE '%failed%') AND {noise_sql(L.AGENT_NOISE)}"))
def _(t):
    return L.log_agent_errors_filtered(t("agent_log"))


WEB_CASE = "CASE WHEN sc_status = 401 AND cs_method = 'POST' THEN 'Authentication required' WHEN sc_status = 500 AND sc_win32_status = 64 THEN 'Network name no longer available' " + " ".join(
    f"WHEN sc_status = {a} THEN '{b}'" for a, b in L.HTTP_CAUSES) + " END"


@query("web_status_rows", f"SELECT *, {WEB_CASE} AS cause FROM v_access_log WHERE sc_status IN (400, 401, 404, 405, 408, 409, 500, 503)")
def _(t):
    return L.web_status_rows(t("access_log"))


@query("web_status_summary", """
WITH r AS (SELECT * FROM v_access_log WHERE sc_status = 405),
k AS (SELECT c_ip, (row_number() OVER (ORDER BY c_ip) - 1) // 1000 AS chunk_no FROM (SELECT DISTINCT c_ip FROM r))
SELECT chunk_no, string_agg(c_ip, ', ' ORDER BY c_ip) AS ips, (SELECT MIN(log_time) FROM r) AS first_time, (SELECT MAX(log_time) FROM r) AS last_time,
  (SELECT COUNT(*) FROM r) AS requests FROM k GROUP BY 1""")
def _(t):
    return L.web_status_summary(t("access_log"))


@query("web_suspicious_ips", "SELECT c_ip, COUNT(*) AS n FROM v_access_log WHERE sc_status = 401 GROUP BY 1 HAVING COUNT(*) > 4")
def _(t):
    return L.web_suspicious_ips(t("access_log"), 4)


EVT = "server_id, time, log_name, entry_type, event_id, source, message"


@query("evt_custom_log", f"""
SELECT {EVT} FROM v_os_events WHERE log_name = 'Custom' AND event_id BETWEEN 0 AND 999 AND ((entry_type = 'Error' AND time > {E} - INTERVAL 1 DAY) OR (entry_type = 'Warning' AND time > {E} - INTERVAL 7 DAY))""")
def _(t):
    return L.evt_custom_log(t("os_events"), AS_OF_EVENTS)


def newest_sql(log, entry, blocked):
    cond = " OR ".join(f"(host_class = '{c}' AND event_id NOT IN {ids})" for c, ids in blocked.items())
    return f"""SELECT {EVT} FROM (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY time DESC, record_id DESC) AS rn FROM v_os_events
      WHERE log_name = '{log}' AND entry_type = '{entry}' AND time > {E} - INTERVAL 1 DAY AND ({cond})) WHERE rn <= 3"""


@query("evt_system_errors", newest_sql("System", "Error", L.SYSTEM_BLOCKED))
def _(t):
    return L.evt_system_errors(t("os_events"), AS_OF_EVENTS)


@query("evt_application_errors", newest_sql("Application", "Error", L.APPLICATION_BLOCKED))
def _(t):
    return L.evt_application_errors(t("os_events"), AS_OF_EVENTS)


@query("evt_audit_failures", newest_sql("Security", "FailureAudit", L.AUDIT_BLOCKED))
def _(t):
    return L.evt_audit_failures(t("os_events"), AS_OF_EVENTS)


@query("sec_logon_history", f"""
SELECT time, CASE event_id WHEN 7001 THEN 'Logon' ELSE 'Logoff' END AS event, replacement_strings[2] AS "user" FROM v_os_events
WHERE source = 'Microsoft-Windows-Winlogon' AND event_id IN (7001, 7002) AND time > {E} - INTERVAL 72 HOUR AND time <= {E} AND replacement_strings[2] NOT ILIKE '%5' AND replacement_strings[2] NOT ILIKE 'admin%'""")
def _(t):
    return L.sec_logon_history(t("os_events"), AS_OF_EVENTS, ["%5", "admin%"], hours=72)


@query("sec_auth_failures", f"""
SELECT time, replacement_strings[6] AS "user", replacement_strings[14] AS client, replacement_strings[20] AS address, server_id,
  COALESCE((SELECT reason FROM {REASONS_SQL} WHERE lower(code) = lower(replacement_strings[8])), 'Other') AS reason,
  COALESCE((SELECT reason FROM {REASONS_SQL} WHERE lower(code) = lower(replacement_strings[10])), 'Other') AS sub_reason
FROM v_os_events WHERE log_name = 'Security' AND event_id = 4625 AND time > {E} - INTERVAL 240 HOUR AND time <= {E}""")
def _(t):
    return L.sec_auth_failures(t("os_events"), literal_table(t.spark, L.FAILURE_REASONS, "code string, reason string"), AS_OF_EVENTS, hours=240)


