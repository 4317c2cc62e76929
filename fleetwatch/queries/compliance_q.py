"""Queries of compliance rules."""

# ruff: noqa: E501
from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatch.operators import compliance as C
from fleetwatch.operators import compliance_rules as R
from fleetwatch.plans import reports
from fleetwatch.queries.core import E, O
from fleetwatch.queries.findings_sql import fsql, stamp
from fleetwatch.queries.registry import QUERIES, query
from fleetwatch.session import literal_table
from fleetwatch.queries.roles_sql import AS_OF_EVENTS, AS_OF_ORDERS

FINE = f"'{C.FINE}'"


def lit(v) -> str:
    return "NULL" if v is None else ("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v))


def values(rows, alias: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") AS {alias}"


def ver(expr: str) -> str:
    return f"CAST(string_split({expr}, '.') AS INT[])"


TARGETS = values([r for r in R.SETTING_TARGETS if r[3] == "live"], "g(name, target_value, check_id, state, min_version, max_version, applies_to)")
LEVELS = " ".join(f"WHEN setting = 'filestream access level' AND v = {n} THEN '{w}'" for n, w in R.FILESTREAM_LEVELS)
SETTINGS_SQL = fsql(
    f"(SELECT s.server_id, s.name AS setting, s.value_in_use AS v, g.target_value AS tv FROM v_settings s JOIN {TARGETS} ON g.name = s.name "
    f"AND (min_version IS NULL OR {ver('product_version')} >= {ver('min_version')}) AND (max_version IS NULL OR {ver('product_version')} < {ver('max_version')}) "
    "AND (applies_to IS NULL OR applies_to = CASE WHEN is_clustered THEN 'clustered' ELSE 'single' END OR applies_to = CASE WHEN uses_replication THEN 'replicated' ELSE 'unreplicated' END))",
    "settings", "=setting", severity="CASE WHEN v = tv THEN 0 ELSE 1 END", current="v", target="tv", achieved="v = tv",
    details=f"CASE WHEN v = tv THEN {FINE} {LEVELS} ELSE concat('set ', setting, ' to ', tv) END")


def settings(t):
    return C.cmp_settings(t("settings"), C.setting_targets(t.spark))


@query("cmp_settings", SETTINGS_SQL)
def _(t):
    return settings(t)


@query("cmp_cost_threshold", fsql(
    "v_settings", "39", "=v_settings.name", where="v_settings.name = 'cost threshold for parallelism'", severity="CASE WHEN value_in_use >= -5 THEN 0 ELSE 1 END",
    current="value_in_use", target="5", achieved="value_in_use >= -5"))
def _(t):
    return C.cmp_cost_threshold(t("settings"))


def per_server(source, bad, check, name, example="NULL", severity=1):
    src = f"(SELECT server_id, COUNT(*) FILTER (WHERE {bad}) AS n, MIN(CASE WHEN {bad} THEN CAST({example} AS VARCHAR) END) AS e FROM {source} GROUP BY 1)"
    return fsql(src, check, name, severity=f"CASE WHEN n = 0 THEN 0 ELSE {severity} END", current="n", target="0", achieved="n = 0",
                details=f"CASE WHEN n = 0 THEN {FINE} ELSE concat(n, ' violating, first: ', COALESCE(e, 'N/A')) END")


def every_server(role):
    return f"(SELECT DISTINCT server_id FROM v_servers) FULL JOIN v_{role} USING (server_id)"


PRESENCE = [
    C.PresenceRule("24.guest", "No guest grants", "permissions", "grantee_name = 'guest' AND state_desc = 'GRANT'", "database_name"),
    C.PresenceRule("28.sa", "No CONTROL SERVER", "permissions", "permission_name = 'CONTROL SERVER'", "grantee_name", 2),
    C.PresenceRule("71", "No trustworthy database", "databases", "is_trustworthy_on", "database_name"),
    C.PresenceRule("72", "No auto close", "databases", "is_auto_close_on AND database_name <> 'master'", "database_name"),
    C.PresenceRule("99", "Nothing on drive Z", "database_files", "physical_name LIKE 'Z%'", "physical_name"),
]
PRESENCE_SQL = " UNION ALL ".join(f"SELECT * FROM ({per_server(f'(SELECT * FROM {every_server(r.role)})', r.violates, r.check_id, r.name, r.example, r.severity)})" for r in PRESENCE)


def presence(t):
    return C.cmp_presence(PRESENCE, {r: t(r) for r in ("permissions", "databases", "database_files")}, t("servers"))


@query("cmp_presence", PRESENCE_SQL)
def _(t):
    return presence(t)


@query("cmp_version", fsql(
    f"(SELECT s.server_id, s.update_level, COALESCE(m.product, 'unknown') AS product, COALESCE(m.latest, 'unknown') AS latest FROM v_servers s LEFT JOIN {values(R.VERSION_NAMES, 'm(prefix, product, latest)')} ON left(s.product_version, 4) = m.prefix)",
    "10", "=concat('Version: ', product)", severity="0", current="update_level", target="latest", achieved="update_level = latest",
    details=f"CASE WHEN update_level = latest THEN {FINE} ELSE concat('install ', CASE WHEN latest = 'unknown' THEN 'the latest level' ELSE latest END) END"))
def _(t):
    return C.cmp_version(t("servers"))


def _on(suffix):
    return f"COALESCE(BOOL_OR(registry_key ILIKE '%{suffix}' AND value_name = 'Enabled' AND value_data = '1'), FALSE)"


@query("cmp_protocols", fsql(
    f"(SELECT server_id, NOT {_on('np')} AND {_on('sm')} AND {_on('tcp')} AS ok FROM {every_server('registry')} GROUP BY 1)", "20", "Unnecessary protocols", severity="CASE WHEN ok THEN 0 ELSE 1 END",
    current="CASE WHEN ok THEN 0 ELSE 1 END", target="0", achieved="ok", details=f"CASE WHEN ok THEN {FINE} ELSE 'enable only required protocols' END"))
def _(t):
    return C.cmp_protocols(t("registry"), t("servers"))


@query("cmp_admin_login", fsql("v_principals", "21", "Built-in login disabled", where="principal_id = 1", scope="v_principals.name", severity="CASE WHEN is_disabled THEN 0 ELSE 1 END",
                               current="CASE WHEN is_disabled THEN 1 ELSE 0 END", target="1", achieved="is_disabled"))
def _(t):
    return C.cmp_admin_login(t("principals"))


@query("cmp_guest_connect", fsql(
    "(SELECT DISTINCT server_id, database_name FROM v_permissions WHERE grantee_name = 'guest' AND state_desc LIKE 'GRANT%' AND permission_name = 'CONNECT' AND database_name NOT IN ('master', 'tempdb', 'msdb'))",
    "22", "Guest CONNECT", scope="database_name", details="concat('revoke CONNECT from guest in ', database_name)"))
def _(t):
    return C.cmp_guest_connect(t("permissions"))


@query("cmp_orphaned_users", fsql(
    "v_db_users u", "23", "Orphaned user", scope="database_name", details="concat('user ', user_name, ' has no login')",
    where="u.type = 'S' AND user_name NOT IN ('dbo', 'guest', 'INFORMATION_SCHEMA', 'sys', 'MS_DataCollectorInternalUser') AND NOT EXISTS (SELECT 1 FROM v_principals p WHERE p.server_id = u.server_id AND p.sid = u.sid)"))
def _(t):
    return C.cmp_orphaned_users(t("db_users"), t("principals"))


@query("cmp_public_permissions", per_server(
    "(SELECT * FROM v_permissions WHERE grantee_name = 'public' AND state_desc LIKE 'GRANT%')",
    "NOT (state_desc = 'GRANT' AND ((permission_name = 'VIEW ANY DATABASE' AND class_desc = 'SERVER') OR (permission_name = 'CONNECT' AND class_desc = 'ENDPOINT' AND major_id IN (2, 3, 4, 5))))",
    "24", "Public role permissions", "permission_name"))
def _(t):
    return C.cmp_public_permissions(t("permissions"))


HELD = "EXISTS (SELECT 1 FROM v_permissions g WHERE g.server_id = p.server_id AND g.grantee_principal_id = p.principal_id)"


@query("cmp_builtin_groups", fsql("v_principals p", "25", "BUILTIN group login", where=f"p.name LIKE 'BUILTIN%' AND {HELD}", scope="p.name", details="concat('drop ', p.name)"))
def _(t):
    return C.cmp_builtin_groups(t("principals"), t("permissions"))


@query("cmp_local_groups", fsql("v_principals p", "26", "Local group login", where=f"p.type_desc = 'WINDOWS_GROUP' AND starts_with(p.name, p.machine_name) AND {HELD}", scope="p.name", details="concat('drop ', p.name)"))
def _(t):
    return C.cmp_local_groups(t("principals"), t("permissions"))


@query("cmp_proxy_public", fsql("v_proxies x", "27", "Proxy open to public", scope="proxy_name", where="EXISTS (SELECT 1 FROM v_db_users d WHERE d.server_id = x.server_id AND d.sid = x.sid AND d.user_name = 'public')"))
def _(t):
    return C.cmp_proxy_public(t("proxies"), t("db_users"))


@query("cmp_password_expiration", fsql(
    "v_principals p", "28", "Password expiration", scope="p.name", where="""p.type_desc = 'SQL_LOGIN' AND NOT is_expiration_checked AND (
      EXISTS (SELECT 1 FROM v_role_members r WHERE r.server_id = p.server_id AND r.member_principal_id = p.principal_id AND r.role_name = 'sysadmin')
      OR EXISTS (SELECT 1 FROM v_permissions g WHERE g.server_id = p.server_id AND g.grantee_principal_id = p.principal_id AND g.permission_name = 'CONTROL SERVER' AND g.state_desc LIKE 'GRANT%'))"""))
def _(t):
    return C.cmp_password_expiration(t("principals"), t("role_members"), t("permissions"))


@query("cmp_password_policy", per_server("(SELECT * FROM v_principals WHERE type_desc = 'SQL_LOGIN')", "NOT is_policy_checked AND NOT is_disabled", "29", "Password policy", "name"))
def _(t):
    return C.cmp_password_policy(t("principals"))


def _registry_number(name):
    return f"(SELECT server_id, COALESCE(MAX(CASE WHEN value_name = '{name}' THEN CAST(value_data AS INT) END), -1) AS n FROM {every_server('registry')} GROUP BY 1)"


@query("cmp_log_files", fsql(_registry_number("NumErrorLogs"), "30", "Error log files", severity="CASE WHEN n >= 12 THEN 0 ELSE 1 END", current="n", target="12", achieved="n >= 12"))
def _(t):
    return C.cmp_log_files(t("registry"), t("servers"))


@query("cmp_login_audit", fsql(_registry_number("AuditLevel"), "32", "Login auditing", severity="CASE WHEN n = 3 THEN 0 ELSE 1 END", current="n", target="3", achieved="n = 3"))
def _(t):
    return C.cmp_login_audit(t("registry"), t("servers"))


@query("cmp_audit_spec", fsql(
    f"(SELECT server_id, COUNT(DISTINCT action_name) FILTER (WHERE is_enabled AND action_name <> 'OTHER_GROUP') AS n FROM {every_server('audit_details')} GROUP BY 1)", "33", "Audit specification",
    severity="CASE WHEN n = 3 THEN 0 ELSE 1 END", current="n", target="3", achieved="n = 3"))
def _(t):
    return C.cmp_audit_spec(t("audit_details"), t("servers"))


@query("cmp_assemblies", per_server("(SELECT * FROM v_assemblies WHERE is_user_defined)", "permission_set <> 'SAFE_ACCESS'", "34", "Assemblies", "assembly_name"))
def _(t):
    return C.cmp_assemblies(t("assemblies"))


USERDB = "database_name NOT IN ('master', 'msdb', 'model', 'tempdb')"


@query("cmp_symmetric_keys", per_server(f"(SELECT * FROM v_crypto_keys WHERE kind = 'symmetric' AND {USERDB})", "algorithm NOT LIKE 'AES%'", "35", "Symmetric keys", "key_name"))
def _(t):
    return C.cmp_symmetric_keys(t("crypto_keys"))


@query("cmp_asymmetric_keys", per_server(f"(SELECT * FROM v_crypto_keys WHERE kind = 'asymmetric' AND {USERDB})", "key_length < 2048", "36", "Asymmetric keys", "key_name"))
def _(t):
    return C.cmp_asymmetric_keys(t("crypto_keys"))


@query("cmp_toolset_version", fsql(
    f"(SELECT t.server_id, COUNT(DISTINCT CASE WHEN t.version = x.expected THEN t.object_name END) AS n FROM (SELECT * FROM {every_server('toolset')}) t LEFT JOIN {values(R.TOOLSET_EXPECTED, 'x(object_name, expected)')} ON x.object_name = t.object_name GROUP BY 1)",
    "37", "Maintenance objects", severity="CASE WHEN n = 4 THEN 0 ELSE 1 END", current="n", target="4", achieved="n = 4"))
def _(t):
    return C.cmp_toolset_version(t("toolset"), literal_table(t.spark, R.TOOLSET_EXPECTED, "object_name string, expected_version string"), t("servers"))


@query("cmp_parallelism", fsql(
    """(WITH per AS (SELECT server_id, node_id, COUNT(*) AS c FROM v_schedulers WHERE status = 'VISIBLE ONLINE' AND node_id < 64 GROUP BY 1, 2),
       shape AS (SELECT server_id, c, COUNT(*) AS nodes FROM per GROUP BY 1, 2),
       one AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY c DESC) AS rn FROM shape),
       f AS (SELECT s.server_id, o.c, o.nodes, s.cpu_count, s.cpu_count // s.hyperthread_ratio AS phys, s.cpu_count > s.hyperthread_ratio AS ht FROM one o JOIN v_servers s ON s.server_id = o.server_id WHERE rn = 1),
       g AS (SELECT f.server_id, LEAST(CASE WHEN nodes > 1 AND NOT ht THEN c WHEN nodes > 1 THEN nodes // phys WHEN NOT ht THEN cpu_count ELSE phys END, 10) AS tg FROM f)
       SELECT g.server_id, tg, value_in_use AS u, u <> 0 AND ((u = 1 AND tg > 1) OR tg >= u) AS ok FROM g JOIN v_settings v ON v.server_id = g.server_id AND v.name = 'max degree of parallelism')""",
    "38", "Max degree of parallelism", severity="CASE WHEN ok THEN 0 ELSE 1 END", current="u", target="tg", achieved="ok",
    details=f"CASE WHEN u = 0 THEN concat('every processor is used, set to ', tg) WHEN u = 1 AND tg > 1 THEN concat('fine, best set to ', tg) WHEN tg > u THEN concat('best set to ', tg) WHEN tg = u THEN {FINE} ELSE concat('set to at most ', tg) END"))
def _(t):
    return C.cmp_parallelism(t("schedulers"), t("servers"), t("settings"))


EXPECTED_SQL = values([(m, f) for m, fs in R.EXPECTED_FLAGS for f in fs], "x(major, flag)")


@query("cmp_flags_missing", fsql(
    f"(SELECT DISTINCT s.server_id, x.flag FROM v_servers s JOIN {EXPECTED_SQL} ON x.major = s.major_version WHERE NOT EXISTS (SELECT 1 FROM v_flags_enabled e WHERE e.server_id = s.server_id AND e.flag = x.flag))",
    "41", "Trace flag missing", scope="flag", details="concat('enable ', flag)"))
def _(t):
    expected = t("servers").join(C.expected_flags(t.spark), F.col("major_version") == F.col("major"))
    return C.cmp_flags_missing(expected, t("flags_enabled"))


ADVICE_SQL = values([(i, *r) for i, r in enumerate(R.FLAG_ADVICE)], "a(priority, flag, lo, hi, extra, advice)")


@query("cmp_flags_advice", fsql(
    f"""(WITH e AS (SELECT DISTINCT f.server_id, f.flag, s.product_version AS pv, s.edition, s.uses_columnstore AS cs FROM v_flags_enabled f JOIN v_servers s ON s.server_id = f.server_id),
      r AS (SELECT e.server_id, e.flag, a.advice, row_number() OVER (PARTITION BY e.server_id, e.flag ORDER BY a.priority NULLS LAST) AS rn FROM e LEFT JOIN {ADVICE_SQL}
        ON a.flag = e.flag AND (lo IS NULL OR {ver('pv')} >= {ver('lo')}) AND (hi IS NULL OR {ver('pv')} < {ver('hi')})
        AND (extra IS NULL OR (extra = 'express' AND edition LIKE '%Express%') OR (extra = 'not express' AND edition NOT LIKE '%Express%') OR (extra = 'columnstore' AND cs)))
      SELECT * FROM r WHERE rn = 1)""",
    "41.advice", "Trace flag", severity="0", scope="flag", achieved="TRUE", details="COALESCE(advice, 'enabled globally')"))
def _(t):
    return C.cmp_flags_advice(t("flags_enabled"), t("servers"), C.flag_advice(t.spark))


@query("cmp_logins_without_permission", fsql(
    r"""(WITH idle AS (SELECT p.server_id, p.name FROM v_principals p WHERE type_desc <> 'SERVER_ROLE'
        AND NOT EXISTS (SELECT 1 FROM v_login_permissions g WHERE g.server_id = p.server_id AND g.grantee_principal_id = p.principal_id AND g.permission_name <> 'CONNECT SQL')
        AND NOT EXISTS (SELECT 1 FROM v_role_members r WHERE r.server_id = p.server_id AND r.member_principal_id = p.principal_id)
        AND NOT EXISTS (SELECT 1 FROM v_db_users u WHERE u.server_id = p.server_id AND u.sid = p.sid AND u.has_rights)),
      k AS (SELECT *, (row_number() OVER (PARTITION BY server_id ORDER BY name) - 1) // 1000 AS chunk FROM (SELECT DISTINCT server_id, name FROM idle))
      SELECT server_id, chunk, COUNT(*) AS n, string_agg(name, ', ' ORDER BY name) AS names FROM k GROUP BY 1, 2)""",
    "42", "Logins without permissions", scope="chunk", current="n", target="0", details="names"))
def _(t):
    return C.cmp_logins_without_permission(t("principals"), t("login_permissions"), t("role_members"), t("db_users"))


@query("cmp_service_isolation", fsql("(SELECT server_id, service_account, COUNT(*) AS n FROM v_services GROUP BY 1, 2 HAVING COUNT(*) > 1)", "43", "Service account isolation",
                                     scope="service_account", details="concat(n, ' services use ', service_account)"))
def _(t):
    return C.cmp_service_isolation(t("services"))


@query("cmp_job_steps", fsql(
    """(SELECT j.server_id, j.name AS jn, s.step_id, s.step_name, strptime(concat(last_run_date, lpad(CAST(last_run_time AS VARCHAR), 6, '0')), '%Y%m%d%H%M%S') AS w, lpad(CAST(last_run_duration AS VARCHAR), 6, '0') AS d
       FROM v_job_steps s JOIN v_maint_jobs j ON j.job_id = s.job_id WHERE last_run_outcome = 0 AND last_run_date <> 0 AND step_name ILIKE 'ST0%' AND step_name NOT ILIKE '%CHECK_STEPS_ERRORS%' AND j.name ILIKE '%MAINTENANCE_ALL_DATABASES')""",
    "44", "Failed job step", scope="jn", current="step_id", at="w",
    details=f"concat('step ', step_name, ' of ', jn, ' failed on ', {stamp('w')}, ' after ', substr(d, 1, 2), ':', substr(d, 3, 2), ':', substr(d, 5, 2))"))
def _(t):
    return C.cmp_job_steps(t("job_steps"), t("maint_jobs"))


ERRORS_SQL = values([(n, w) for ns, w in R.ERROR_ADVICE for n in ns], "a(error_number, advice)")


@query("cmp_integrity_errors", fsql(
    f"(SELECT c.server_id, c.database_name, c.error_number AS en, COUNT(*) AS n, MAX(end_time) AS z, MAX(a.advice) AS advice FROM v_command_log c LEFT JOIN {ERRORS_SQL} ON a.error_number = c.error_number "
    f"WHERE c.error_number <> 0 AND end_time >= {E} - INTERVAL 7 DAY AND end_time <= {E} GROUP BY 1, 2, 3)",
    "45", "Integrity errors", severity="2", scope="database_name", current="n", target="0", at="z",
    details=f"concat('error ', en, ' ', n, ' times: ', COALESCE(advice, '{R.DEFAULT_ERROR_ADVICE}'))"))
def _(t):
    return C.cmp_integrity_errors(t("command_log"), C.error_advice(t.spark), AS_OF_EVENTS)


@query("cmp_backup_24h", fsql(
    "(SELECT * FROM (SELECT DISTINCT server_id, database_name FROM v_databases WHERE database_name <> 'tempdb') FULL JOIN (SELECT server_id, database_name, MAX(backup_finish_date) AS f FROM v_backupset WHERE type = 'D' GROUP BY 1, 2) USING (server_id, database_name))",
    "47", "Full backup within 24 hours", where=f"(f IS NULL OR f < {O} - INTERVAL 24 HOUR)",
    scope="database_name", current=f"date_diff('hour', f, {O})", target="24", details=f"concat('last full backup at ', {stamp('f')})", at="f"))
def _(t):
    return C.cmp_backup_24h(t("backupset"), t("databases"), AS_OF_ORDERS)


@query("cmp_endpoint_owner", fsql(
    "v_endpoints e", "51", "Endpoint owner", where="principal_id <> 1 AND NOT EXISTS (SELECT 1 FROM v_services s WHERE s.server_id = e.server_id AND s.service_account = e.owner_name)",
    scope="endpoint_name", details="concat(endpoint_name, ' is owned by ', owner_name)"))
def _(t):
    return C.cmp_endpoint_owner(t("endpoints"), t("services"))


@query("cmp_32bit", per_server("v_servers", "edition NOT LIKE '%64%'", "52", "64-bit engine", "edition"))
def _(t):
    return C.cmp_32bit(t("servers"))


@query("cmp_startup_options", per_server("v_registry", "registry_key ILIKE '%MSSQLServer%Parameters' AND value_data = '-x'", "53", "Startup options", "value_data"))
def _(t):
    return C.cmp_startup_options(t("registry"))


@query("cmp_evaluation", fsql("(SELECT server_id, installed_at + INTERVAL 180 DAY AS x FROM v_servers WHERE edition LIKE '%Evaluation%')", "54", "Evaluation edition", details=f"concat('stops on ', {stamp('x')})", at="x"))
def _(t):
    return C.cmp_evaluation(t("servers"))


@query("cmp_memory_limit", fsql(
    "(SELECT s.server_id, v.value_in_use AS u, (s.physical_memory_kb // 1024 - 4096) // s.instance_count AS tg FROM v_servers s JOIN v_settings v ON v.server_id = s.server_id AND v.name = 'max server memory (MB)')",
    "55", "Maximum memory limit", severity="CASE WHEN u <= tg THEN 0 ELSE 1 END", current="u", target="tg", achieved="u <= tg"))
def _(t):
    return C.cmp_memory_limit(t("servers"), t("settings"))


@query("cmp_memory_state", per_server("v_servers", "memory_state <> 'Available physical memory is high'", "56", "External memory conditions", "memory_state"))
def _(t):
    return C.cmp_memory_state(t("servers"))


@query("cmp_trustworthy", per_server("v_databases", "is_trustworthy_on AND database_name <> 'msdb'", "71", "Trustworthy", "database_name"))
def _(t):
    return C.cmp_trustworthy(t("databases"))


@query("cmp_auto_close", fsql("v_databases", "72", "Auto close", severity="CASE WHEN is_auto_close_on THEN 1 ELSE 0 END", scope="database_name", current="CASE WHEN is_auto_close_on THEN 1 ELSE 0 END", target="0", achieved="NOT is_auto_close_on"))
def _(t):
    return C.cmp_auto_close(t("databases"))


@query("cmp_percent_growth", fsql("(SELECT DISTINCT server_id, database_name FROM v_database_files WHERE is_percent_growth)", "73", "Percent file growth", scope="database_name"))
def _(t):
    return C.cmp_percent_growth(t("database_files"))


@query("cmp_single_temp_file", fsql(
    "(SELECT server_id, COUNT(*) AS n FROM v_temp_files WHERE database_name = 'tempdb' AND type_desc = 'ROWS' GROUP BY 1)", "74", "Only one tempdb data file", where="n = 1", current="n"))
def _(t):
    return C.cmp_single_temp_file(t("temp_files"))


@query("cmp_log_files_same_drive", fsql(
    "(SELECT server_id, database_name, upper(left(physical_name, 1)) AS d, COUNT(*) AS n FROM v_database_files WHERE type_desc = 'LOG' AND database_name <> 'tempdb' GROUP BY 1, 2, 3 HAVING COUNT(*) > 1)",
    "75", "Log files on one drive", scope="database_name", current="n", details="concat(n, ' log files on drive ', d)"))
def _(t):
    return C.cmp_log_files_same_drive(t("database_files"))


@query("cmp_uneven_growth", fsql(
    "(SELECT DISTINCT server_id, database_name FROM (SELECT server_id, database_name, data_space_id FROM v_database_files WHERE type_desc = 'ROWS' GROUP BY 1, 2, 3 HAVING COUNT(DISTINCT growth) > 1 OR COUNT(DISTINCT is_percent_growth) > 1))",
    "76", "Uneven file growth", scope="database_name"))
def _(t):
    return C.cmp_uneven_growth(t("database_files"))


@query("cmp_small_growth", fsql("v_database_files", "77", "Small file growth", where="NOT is_percent_growth AND growth = 128 AND size_pages >= 8192", scope="database_name",
                                details="concat(physical_name, ' has ', size_pages * 8 // 1000000, ' GB')"))
def _(t):
    return C.cmp_small_growth(t("database_files"))


@query("cmp_corruption", fsql(
    f"""(SELECT p.server_id, p.database_name, what, COUNT(*) AS n, MAX(event_time) AS z FROM (SELECT *, 'suspect page' AS what FROM v_suspect_pages UNION ALL SELECT *, 'page repaired automatically' FROM v_page_repairs) p
      WHERE event_time >= {E} - INTERVAL 10 DAY AND EXISTS (SELECT 1 FROM v_databases d WHERE d.server_id = p.server_id AND d.database_name = p.database_name) GROUP BY 1, 2, 3)""",
    "78", "Corruption", severity="2", scope="database_name", current="n", details="concat(what, ', ', n, ' times')", at="z"))
def _(t):
    return C.cmp_corruption(t("suspect_pages"), t("page_repairs"), t("databases"), AS_OF_EVENTS)


@query("cmp_files_on_c", fsql(
    "(SELECT DISTINCT server_id, database_name FROM v_database_files WHERE upper(left(physical_name, 1)) = 'C')", "79",
    "=CASE WHEN database_name IN ('master', 'model', 'msdb') THEN 'System database on C' WHEN database_name = 'tempdb' THEN 'Temp database on C' ELSE 'User database on C' END", scope="database_name"))
def _(t):
    return C.cmp_files_on_c(t("database_files"))


@query("cmp_log_fragments", fsql("(SELECT server_id, database_name, COUNT(*) AS n FROM v_log_fragments GROUP BY 1, 2 HAVING COUNT(*) > 999)", "82", "Virtual log files", scope="database_name", current="n", target="200",
                                 details="concat(n, ' virtual log files')"))
def _(t):
    return C.cmp_log_fragments(t("log_fragments"))


@query("cmp_user_tables_in_system", fsql(
    "v_user_tables", "83", "User table in system database", scope="database_name", details=f"concat('table ', table_name, ' created ', {stamp('created_at')})",
    where="database_name IN ('master', 'msdb', 'model') AND NOT is_ms_shipped AND NOT ((database_name IN ('master', 'msdb') AND table_name = 'CommandLog') OR (database_name = 'msdb' AND table_name IN ('Queue', 'QueueDatabase')))"))
def _(t):
    return C.cmp_user_tables_in_system(t("user_tables"), literal_table(t.spark, R.SYSTEM_TABLE_ALLOW, "database_name string, table_name string"))


def slow_sql(check, name, stall, ops, ms):
    return fsql(f"(SELECT DISTINCT f.server_id, upper(left(physical_name, 1)) AS d FROM v_file_stats s JOIN v_database_files f ON f.server_id = s.server_id AND f.database_name = s.database_name AND f.file_id = s.file_id WHERE {ops} > 100000 AND {stall} / ({ops} + 1) > {ms})",
                check, name, scope="d", target=str(ms), details="concat('drive ', d, ' is slow')")


@query("cmp_slow_reads", slow_sql("86", "Slow reads", "io_stall_read_ms", "num_of_reads", 200))
def _(t):
    return C.cmp_slow_reads(t("file_stats"), t("database_files"))


@query("cmp_slow_writes", slow_sql("87", "Slow writes", "io_stall_write_ms", "num_of_writes", 100))
def _(t):
    return C.cmp_slow_writes(t("file_stats"), t("database_files"))


@query("cmp_linked_servers", fsql(
    "(SELECT DISTINCT server_id, linked_name, COALESCE(remote_name = 'sa', FALSE) AS a FROM v_linked WHERE is_linked)", "88", "Linked server", severity="CASE WHEN a THEN 1 ELSE 0 END", scope="linked_name", achieved="NOT a",
    details="CASE WHEN a THEN 'connects as the administrator' ELSE 'check its security configuration' END"))
def _(t):
    return C.cmp_linked_servers(t("linked"))


@query("cmp_stale_statistics", fsql(
    f"(SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY last_updated, table_name, stats_id) AS rn FROM v_stats_dates WHERE row_count > 0 AND last_updated < {E} - INTERVAL 10 DAY)",
    "90", "Statistics out of date", where="rn <= 5", scope="table_name", details=f"concat('statistics ', stats_id, ' updated ', {stamp('last_updated')})", at="last_updated"))
def _(t):
    return C.cmp_stale_statistics(t("stats_dates"), AS_OF_EVENTS)


# ---- all rules ---------------------------------------------------------------
ALL_RULES_SQL = " UNION ALL ".join(f"SELECT * FROM ({q.oracle.replace(O, E)})" for k, q in QUERIES.items() if k.startswith("cmp_"))


def all_rules(t):
    return reports.compliance_findings({r: t(r) for r in reports.COMPLIANCE_ROLES}, AS_OF_EVENTS, PRESENCE)


REPORT_SQL = f"SELECT * FROM ({ALL_RULES_SQL}) ORDER BY achieved, name, server_id, scope, details"


@query("cmp_report", REPORT_SQL)
def _(t):
    return C.cmp_report(all_rules(t))


@query("cmp_score", f"""
SELECT server_id, split_part(check_id, '.', 1) AS section, COUNT(*) FILTER (WHERE achieved) AS achieved_rules, COUNT(*) AS rules,
  CAST(COUNT(*) FILTER (WHERE achieved) AS DOUBLE) * 100 / COUNT(*) AS pct FROM ({ALL_RULES_SQL}) GROUP BY 1, 2""")
def _(t):
    return C.cmp_score(all_rules(t))


@query("run_compliance", REPORT_SQL)
def _(t):
    """The report by its one entry function."""
    return reports.run_compliance({r: t(r) for r in reports.COMPLIANCE_ROLES}, AS_OF_EVENTS, PRESENCE)
