"""Compliance rules (keys cmp_*): current against target, achieved or not."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators import compliance_rules as R
from fleetwatch.operators.aggregates import agg_having_latest_age, agg_two_level
from fleetwatch.operators.findings import CRITICAL, OK, WARN, cmp_report, cmp_score, findings
from fleetwatch.operators.rule_scan import FINE, VIOLATING, Rule, judge, quoted, told
from fleetwatch.plans.ordering import string_list, top_k
from fleetwatch.session import literal_table

__all__ = ["cmp_report", "cmp_score"]


def setting_targets(spark: SparkSession, states: Sequence[str] = ("live",)) -> DataFrame:
    rows = [r for r in R.SETTING_TARGETS if r[3] in states]
    return literal_table(
        spark,
        rows,
        "name string, target_value bigint, check_id int, state string, min_version string, max_version string, "
        "applies_to string",
    )


def cmp_settings(settings: DataFrame, targets: DataFrame) -> DataFrame:
    """Observed value against target per server and setting.

    Version bounds and server conditions of the targets are honoured when the
    settings carry product_version, is_clustered or uses_replication.
    """
    joined = settings.join(targets, "name")
    if "product_version" in settings.columns and "min_version" in targets.columns:
        v = S.version_array("product_version")
        joined = joined.filter(
            (F.col("min_version").isNull() | (v >= S.version_array("min_version")))
            & (F.col("max_version").isNull() | (v < S.version_array("max_version")))
        )
    if "applies_to" in targets.columns:
        flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in settings.columns else F.lit(False)
        clustered, replicated = flag("is_clustered"), flag("uses_replication")
        applies = F.col("applies_to")
        joined = joined.filter(
            applies.isNull()
            | ((applies == "clustered") & clustered)
            | ((applies == "single") & ~clustered)
            | ((applies == "replicated") & replicated)
            | ((applies == "unreplicated") & ~replicated)
        )
    ok = F.col("value_in_use") == F.col("target_value")
    advice = S.text("set ", F.col("name"), " to ", F.col("target_value"))
    for level, words in R.FILESTREAM_LEVELS:
        is_level = (F.col("name") == "filestream access level") & (F.col("value_in_use") == level)
        advice = F.when(is_level, words).otherwise(advice)
    return findings(
        joined,
        "settings",
        F.col("name"),
        severity=F.when(ok, OK).otherwise(WARN),
        current=F.col("value_in_use"),
        target=F.col("target_value"),
        achieved=ok,
        details=F.when(ok, FINE).otherwise(advice),
    )


def cost_threshold_rule(target: int = 5, slack: int = 10) -> Rule:
    return Rule(
        "39", "settings", "cost threshold for parallelism", each=True, where="name = 'cost threshold for parallelism'",
        key={"value": "value_in_use"}, current="{value}", target=str(target),
        achieved=f"cast({{value}} as double) >= {target - slack}",
    )


def cmp_cost_threshold(settings: DataFrame, target: int = 5, slack: int = 10) -> DataFrame:
    """Cost threshold for parallelism may lie up to ``slack`` below its target."""
    return judge([cost_threshold_rule(target, slack)], {"settings": settings})


@dataclass(frozen=True)
class PresenceRule:
    """No row of ``role`` may satisfy ``violates`` (a Spark SQL predicate)."""

    check_id: str
    name: str
    role: str
    violates: str
    example: str
    severity: int = WARN


def _every_server(counted: DataFrame, servers: DataFrame | None) -> DataFrame:
    """Adds the inventory's servers that have no row in a rule's own input; their other columns are NULL."""
    if servers is None:
        return counted
    return servers.select("server_id").distinct().join(counted, "server_id", "full")


def cmp_presence(
    rules: Sequence[PresenceRule], inputs: Mapping[str, DataFrame], servers: DataFrame | None = None
) -> DataFrame:
    """One finding per server and rule with the number of violating rows and one example.

    All rules over the same input share one scan, and all inputs one aggregation. Without an inventory of ``servers``,
    only those with a row in the rule's input are reported.
    """
    return judge(presence_rules(rules), inputs, servers)


def presence_rules(rules: Sequence[PresenceRule]) -> list[Rule]:
    return [
        _per_server(r.check_id, r.role, r.name, r.violates, r.example, level=r.severity, every_server=True) for r in rules
    ]


def _per_server(check_id: str, role: str, name: str, violates: str, example: str, **options) -> Rule:
    """Achieved when no row of the server violates."""
    return Rule(
        check_id, role, name, violates=violates, example=example, current="bad", target="0", achieved="bad = 0",
        details=VIOLATING, **options,
    )


def _violations(rows: DataFrame, check_id: str, name: str, scope=None, details=None, severity=WARN, **kw) -> DataFrame:
    return findings(rows, check_id, name, severity=severity, scope=scope, details=details, **kw)


VERSION = Rule(
    "10", "servers", "Version", each=True, level=OK,
    key={"product": "coalesce(product, 'unknown')", "level": "update_level", "latest": "latest"},
    named="concat('Version: ', {product})", current="{level}", target="coalesce({latest}, 'unknown')",
    achieved="coalesce({level} = {latest}, false)",
    details="CASE WHEN {level} = {latest} THEN '" + FINE + "' "
    "ELSE concat('install ', coalesce({latest}, 'the latest level')) END",
)


def with_product(servers: DataFrame, version_map: DataFrame | None = None) -> DataFrame:
    """Adds ``product`` and ``latest`` patch level of the server's version."""
    if version_map is None:
        version_map = literal_table(servers.sparkSession, R.VERSION_NAMES, "prefix string, product string, latest string")
    prefix = F.substring("product_version", 1, 4)
    return servers.withColumn("_prefix", prefix).join(version_map, F.col("_prefix") == F.col("prefix"), "left")


def cmp_version(servers: DataFrame, version_map: DataFrame | None = None) -> DataFrame:
    """10: product name and whether the patch level is the latest of its version."""
    return judge([VERSION], {"servers": with_product(servers, version_map)})


def _enabled(suffix: str, bit: int) -> str:
    return f"if(registry_key ilike '%{suffix}' AND value_name = 'Enabled' AND value_data = '1', {bit}, 0)"


PROTOCOLS = Rule(
    "20", "registry", "Unnecessary protocols", every_server=True,
    bits=f"{_enabled('np', 1)} + {_enabled('sm', 2)} + {_enabled('tcp', 4)}",
    current="if(bits = 6, 0, 1)", target="0", achieved="bits = 6",
    details=f"if(bits = 6, '{FINE}', 'enable only required protocols')",
)


def cmp_protocols(registry: DataFrame, servers: DataFrame) -> DataFrame:
    """20: named pipes off, shared memory on, tcp on."""
    return judge([PROTOCOLS], {"registry": registry}, servers)


def admin_login_rule(admin_id: int = 1) -> Rule:
    return Rule(
        "21", "principals", "Built-in login disabled", each=True, where=f"principal_id = {admin_id}",
        key={"login": "name", "off": "is_disabled"}, scope="{login}", current="cast(cast({off} as boolean) as int)",
        target="1", achieved="cast({off} as boolean)",
    )


def cmp_admin_login(principals: DataFrame, admin_id: int = 1) -> DataFrame:
    """21: the built-in administrator login (well-known id) is disabled."""
    return judge([admin_login_rule(admin_id)], {"principals": principals})


GUEST_CONNECT = Rule(
    "22", "permissions", "Guest CONNECT", key={"database": "database_name"},
    where="lower(grantee_name) = 'guest' AND startswith(state_desc, 'GRANT') AND permission_name = 'CONNECT' "
    "AND database_name NOT IN ('master', 'tempdb', 'msdb')",
    scope="{database}", details=told(quoted("revoke CONNECT from guest in "), "{database}"),
)


def cmp_guest_connect(permissions: DataFrame) -> DataFrame:
    """22: CONNECT granted to guest outside the system databases."""
    return judge([GUEST_CONNECT], {"permissions": permissions})


def cmp_orphaned_users(db_users: DataFrame, principals: DataFrame) -> DataFrame:
    """23: database users without a login."""
    builtin = ("dbo", "guest", "INFORMATION_SCHEMA", "sys", "MS_DataCollectorInternalUser")
    users = db_users.filter((F.col("type") == "S") & ~F.col("user_name").isin(*builtin) & F.col("sid").isNotNull())
    rows = users.join(principals.select("server_id", "sid").distinct(), ["server_id", "sid"], "left_anti")
    return _violations(
        rows, "23", "Orphaned user", scope=F.col("database_name"),
        details=S.text("user ", F.col("user_name"), " has no login"),
    )


def _default_grant() -> str:
    grants = [
        f"permission_name = {quoted(permission)} AND class_desc = {quoted(kind)}"
        + (f" AND major_id = {obj}" if kind == "ENDPOINT" else "")
        for permission, kind, obj in R.PUBLIC_DEFAULTS
    ]
    return f"state_desc = 'GRANT' AND ({' OR '.join(f'({g})' for g in grants)})"


PUBLIC_PERMISSIONS = _per_server(
    "24", "permissions", "Public role permissions", f"NOT ({_default_grant()})", "permission_name",
    where="lower(grantee_name) = 'public' AND startswith(state_desc, 'GRANT')",
)


def cmp_public_permissions(permissions: DataFrame) -> DataFrame:
    """24: grants to the public role beyond its defaults."""
    return judge([PUBLIC_PERMISSIONS], {"permissions": permissions})


def login_facts(
    principals: DataFrame, permissions: DataFrame | None = None, role_members: DataFrame | None = None
) -> DataFrame:
    """Principals with ``holds`` (any permission) and ``is_admin`` (by role or CONTROL SERVER); each input is read once."""
    key = ["server_id", "principal_id"]
    grants = []
    if permissions is not None:
        control = (F.col("permission_name") == "CONTROL SERVER") & F.col("state_desc").startswith("GRANT")
        grants.append(
            permissions.select(
                "server_id", F.col("grantee_principal_id").alias("principal_id"), F.lit(True).alias("holds"),
                control.alias("is_admin"),
            )
        )
    if role_members is not None:
        grants.append(
            role_members.filter(F.col("role_name") == "sysadmin").select(
                "server_id", F.col("member_principal_id").alias("principal_id"), F.lit(False).alias("holds"),
                F.lit(True).alias("is_admin"),
            )
        )
    if not grants:
        return principals
    held = reduce(DataFrame.union, grants).groupBy(*key).agg(
        F.bool_or("holds").alias("holds"), F.bool_or("is_admin").alias("is_admin")
    )
    return principals.join(held, key, "left")


BUILTIN_GROUPS = Rule(
    "25", "principals", "BUILTIN group login", each=True, where="startswith(name, 'BUILTIN') AND holds",
    key={"login": "name"}, scope="{login}", details=told(quoted("drop "), "{login}"),
)
LOCAL_GROUPS = Rule(
    "26", "principals", "Local group login", each=True,
    where="type_desc = 'WINDOWS_GROUP' AND startswith(name, machine_name) AND holds",
    key={"login": "name"}, scope="{login}", details=told(quoted("drop "), "{login}"),
)
PASSWORD_EXPIRATION = Rule(
    "28", "principals", "Password expiration", each=True, key={"login": "name"}, scope="{login}",
    where="type_desc = 'SQL_LOGIN' AND NOT is_expiration_checked AND is_admin",
)


def cmp_builtin_groups(principals: DataFrame, permissions: DataFrame) -> DataFrame:
    """25: BUILTIN groups that hold permissions."""
    return judge([BUILTIN_GROUPS], {"principals": login_facts(principals, permissions)})


def cmp_local_groups(principals: DataFrame, permissions: DataFrame) -> DataFrame:
    """26: local Windows groups (named after the machine) that hold permissions."""
    return judge([LOCAL_GROUPS], {"principals": login_facts(principals, permissions)})


def cmp_proxy_public(proxies: DataFrame, db_principals: DataFrame) -> DataFrame:
    """27: job proxies the public role may use."""
    public = db_principals.filter(F.lower("user_name") == "public").select("server_id", "sid").distinct()
    rows = proxies.join(public, ["server_id", "sid"], "left_semi")
    return _violations(rows, "27", "Proxy open to public", scope=F.col("proxy_name"))


def cmp_password_expiration(principals: DataFrame, role_members: DataFrame, permissions: DataFrame) -> DataFrame:
    """28: administrators (by role or CONTROL SERVER) without password expiration."""
    return judge([PASSWORD_EXPIRATION], {"principals": login_facts(principals, permissions, role_members)})


PASSWORD_POLICY = _per_server(
    "29", "principals", "Password policy", "NOT is_policy_checked AND NOT is_disabled", "name",
    where="type_desc = 'SQL_LOGIN'",
)


def cmp_password_policy(principals: DataFrame) -> DataFrame:
    """29: enabled logins without a password policy."""
    return judge([PASSWORD_POLICY], {"principals": principals})


def _registry_number(check_id: str, name: str, value_name: str, achieved: str, target: int) -> Rule:
    """Numeric registry value of every server, -1 where it is not set."""
    number = "coalesce(cast(high as bigint), -1)"
    return Rule(
        check_id, "registry", name, every_server=True,
        value=f"if(value_name = {quoted(value_name)}, try_cast(value_data as int), NULL)",
        current=number, target=str(target), achieved=f"{number} {achieved} {target}",
    )


def log_files_rule(at_least: int = 12) -> Rule:
    return _registry_number("30", "Error log files", "NumErrorLogs", ">=", at_least)


def login_audit_rule(level: int = 3) -> Rule:
    return _registry_number("32", "Login auditing", "AuditLevel", "=", level)


def cmp_log_files(registry: DataFrame, servers: DataFrame, at_least: int = 12) -> DataFrame:
    """30: number of kept error logs."""
    return judge([log_files_rule(at_least)], {"registry": registry}, servers)


def cmp_login_audit(registry: DataFrame, servers: DataFrame, level: int = 3) -> DataFrame:
    """32: failed and successful logins are audited."""
    return judge([login_audit_rule(level)], {"registry": registry}, servers)


# Actions an audit must cover.
AUDIT_ACTIONS = ("AUDIT_CHANGE_GROUP", "FAILED_LOGIN_GROUP", "SUCCESSFUL_LOGIN_GROUP")
AUDIT_SPEC = Rule(
    "33", "audit_details", "Audit specification", every_server=True,
    bits="CASE WHEN is_enabled THEN CASE action_name "
    + " ".join(f"WHEN {quoted(a)} THEN {1 << i}" for i, a in enumerate(AUDIT_ACTIONS))
    + " END END",
    current="bit_count(bits)", target=str(len(AUDIT_ACTIONS)), achieved=f"bit_count(bits) = {len(AUDIT_ACTIONS)}",
)


def cmp_audit_spec(audit_details: DataFrame, servers: DataFrame) -> DataFrame:
    """33: change, failed and successful logins are audited; a server without any audit covers none."""
    return judge([AUDIT_SPEC], {"audit_details": audit_details}, servers)


ASSEMBLIES = _per_server(
    "34", "assemblies", "Assemblies", "permission_set <> 'SAFE_ACCESS'", "assembly_name", where="is_user_defined"
)


def cmp_assemblies(assemblies: DataFrame) -> DataFrame:
    """34: user assemblies are SAFE."""
    return judge([ASSEMBLIES], {"assemblies": assemblies})


STRONG_ALGORITHMS = ("AES_128", "AES_192", "AES_256")


def _names(values: Sequence[str]) -> str:
    return "(" + ", ".join(map(quoted, values)) + ")"


def _user_keys(kind: str) -> str:
    return f"kind = '{kind}' AND database_name NOT IN {_names(S.SYSTEM_DATABASES)}"


SYMMETRIC_KEYS = _per_server(
    "35", "crypto_keys", "Symmetric keys", f"algorithm NOT IN {_names(STRONG_ALGORITHMS)}", "key_name",
    where=_user_keys("symmetric"),
)


def asymmetric_keys_rule(bits: int = 2048) -> Rule:
    return _per_server(
        "36", "crypto_keys", "Asymmetric keys", f"key_length < {bits}", "key_name", where=_user_keys("asymmetric")
    )


def cmp_symmetric_keys(keys: DataFrame) -> DataFrame:
    """35: symmetric keys outside system databases use AES."""
    return judge([SYMMETRIC_KEYS], {"crypto_keys": keys})


def cmp_asymmetric_keys(keys: DataFrame, bits: int = 2048) -> DataFrame:
    """36: asymmetric keys outside system databases have at least 2048 bits."""
    return judge([asymmetric_keys_rule(bits)], {"crypto_keys": keys})


def cmp_toolset_version(objects: DataFrame, expected: DataFrame, servers: DataFrame) -> DataFrame:
    """37: every expected object is present at its expected version; a server without objects has none."""
    total = expected.agg(F.count(F.lit(1)).alias("_total"))
    good = objects.join(expected, "object_name", "left").groupBy("server_id").agg(
        F.count_distinct(F.when(F.col("version") == F.col("expected_version"), F.col("object_name"))).alias("_good")
    )
    good = _every_server(good, servers).fillna(0, ["_good"])
    one = F.lit(0).alias("_one")
    good = good.select("*", one).join(total.select("*", one), "_one")
    ok = F.col("_good") == F.col("_total")
    return findings(
        good, "37", "Maintenance objects", severity=F.when(ok, OK).otherwise(WARN), current=F.col("_good"),
        target=F.col("_total"), achieved=ok,
    )


def cmp_parallelism(schedulers: DataFrame, servers: DataFrame, settings: DataFrame, cap: int = 10) -> DataFrame:
    """38: max degree of parallelism against the value derived from CPUs and nodes."""
    online = schedulers.filter((F.col("node_id") < 64) & (F.col("status") == "VISIBLE ONLINE"))
    shape = agg_two_level(online)
    # A server with uneven nodes has several shapes; the one with most CPUs per node decides.
    one = shape.groupBy("server_id").agg(F.max(F.struct("cpus_per_node", "nodes")).alias("_s"))
    facts = one.join(servers.select("server_id", "cpu_count", "hyperthread_ratio"), "server_id").select(
        "server_id",
        F.col("_s.cpus_per_node").alias("cpus_per_node"),
        F.col("_s.nodes").alias("nodes"),
        "cpu_count",
        F.floor(F.col("cpu_count") / F.col("hyperthread_ratio")).alias("physical"),
        (F.col("cpu_count") > F.col("hyperthread_ratio")).alias("ht"),
    )
    raw = (
        F.when((F.col("nodes") > 1) & ~F.col("ht"), F.col("cpus_per_node"))
        .when(F.col("nodes") > 1, F.floor(F.col("nodes") / F.col("physical")))
        .when(~F.col("ht"), F.col("cpu_count"))
        .otherwise(F.col("physical"))
    )
    current = settings.filter(F.col("name") == "max degree of parallelism").select("server_id", "value_in_use")
    rows = facts.withColumn("target", F.least(raw, F.lit(cap)).cast("bigint")).join(current, "server_id")
    used, target = F.col("value_in_use"), F.col("target")
    ok = (used != 0) & (((used == 1) & (target > 1)) | (target >= used))
    advice = (
        F.when(used == 0, S.text("every processor is used, set to ", target))
        .when((used == 1) & (target > 1), S.text("fine, best set to ", target))
        .when(target > used, S.text("best set to ", target))
        .when(target == used, FINE)
        .otherwise(S.text("set to at most ", target))
    )
    return findings(
        rows, "38", "Max degree of parallelism", severity=F.when(ok, OK).otherwise(WARN), current=used,
        target=target, achieved=ok, details=advice,
    )


def expected_flags(spark: SparkSession) -> DataFrame:
    rows = [(major, flag) for major, flags in R.EXPECTED_FLAGS for flag in flags]
    return literal_table(spark, rows, "major int, flag string")


def cmp_flags_missing(expected: DataFrame, enabled: DataFrame) -> DataFrame:
    """41: expected flags that are not enabled, for expected rows (server_id, flag)."""
    rows = expected.select("server_id", "flag").distinct().join(
        enabled.select("server_id", "flag").distinct(), ["server_id", "flag"], "left_anti"
    )
    return _violations(rows, "41", "Trace flag missing", scope=F.col("flag"), details=S.text("enable ", F.col("flag")))


def flag_advice(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(R.FLAG_ADVICE)]
    return literal_table(
        spark,
        rows,
        "priority int, flag string, min_version string, max_version string, extra string, advice string",
    )


def cmp_flags_advice(enabled: DataFrame, servers: DataFrame, advice: DataFrame) -> DataFrame:
    """41: advice per enabled flag; the first rule whose version bounds and condition hold."""
    facts = enabled.select("server_id", "flag").distinct().join(
        servers.select("server_id", "product_version", "edition", "uses_columnstore"), "server_id"
    )
    v = S.version_array("product_version")
    express = F.col("edition").contains("Express")
    holds = (
        (F.col("min_version").isNull() | (v >= S.version_array("min_version")))
        & (F.col("max_version").isNull() | (v < S.version_array("max_version")))
        & (
            F.col("extra").isNull()
            | ((F.col("extra") == "express") & express)
            | ((F.col("extra") == "not express") & ~express)
            | ((F.col("extra") == "columnstore") & F.col("uses_columnstore"))
        )
    )
    first = (
        facts.join(advice, "flag", "left")
        .groupBy("server_id", "flag")
        .agg(F.min(F.when(holds, F.struct("priority", "advice"))).alias("_a"))
    )
    return findings(
        first, "41.advice", "Trace flag", severity=OK, scope=F.col("flag"), achieved=True,
        details=F.coalesce("_a.advice", F.lit("enabled globally")),
    )


def cmp_logins_without_permission(
    principals: DataFrame, permissions: DataFrame, role_members: DataFrame, db_users: DataFrame,
    ignore: Sequence[str] = (r"NT SERVICE\ClusSvc",),
) -> DataFrame:
    """42: logins with no role, no permission beyond CONNECT, and no database rights."""
    key = ["server_id", "principal_id"]
    granted = permissions.filter(F.col("permission_name") != "CONNECT SQL").select(
        "server_id", F.col("grantee_principal_id").alias("principal_id")
    ).distinct()
    members = role_members.select("server_id", F.col("member_principal_id").alias("principal_id")).distinct()
    rights = db_users.filter("has_rights").select("server_id", "sid").distinct()
    idle = (
        principals.filter((F.col("type_desc") != "SERVER_ROLE") & ~F.col("name").isin(*ignore))
        .join(granted, key, "left_anti")
        .join(members, key, "left_anti")
        .join(rights, ["server_id", "sid"], "left_anti")
    )
    lists = string_list(idle, ["server_id"], "name", "names")
    return findings(
        lists, "42", "Logins without permissions", scope=F.col("chunk_no"), current=F.col("n"), target=0,
        details=F.col("names"),
    )


SERVICE_ISOLATION = Rule(
    "43", "services", "Service account isolation", key={"account": "service_account"}, having="n > 1",
    scope="{account}", details=told("n", quoted(" services use "), "{account}"),
)


def cmp_service_isolation(services: DataFrame) -> DataFrame:
    """43: one account used by more than one service."""
    return judge([SERVICE_ISOLATION], {"services": services})


def cmp_job_steps(job_steps: DataFrame, jobs: DataFrame, job_like: str = "%MAINTENANCE_ALL_DATABASES") -> DataFrame:
    """44: failed ST0 steps of the maintenance job, with run time and duration."""
    failed = job_steps.filter(
        (F.col("last_run_outcome") == 0)
        & (F.col("last_run_date") != 0)
        & F.col("step_name").ilike("ST0%")
        & ~F.col("step_name").ilike("%CHECK_STEPS_ERRORS%")
    )
    rows = failed.join(jobs.filter(F.col("name").ilike(job_like)).select("job_id", "server_id", "name"), "job_id")
    when = S.packed_datetime("last_run_date", "last_run_time")
    return findings(
        rows.withColumn("_when", when),
        "44",
        "Failed job step",
        scope=F.col("name"),
        current=F.col("step_id"),
        details=S.text(
            "step ", F.col("step_name"), " of ", F.col("name"), " failed on ", S.stamp("_when"), " after ",
            S.packed_duration("last_run_duration"),
        ),
        observed_at="_when",
    )


def error_advice(spark: SparkSession) -> DataFrame:
    rows = [(n, words) for numbers, words in R.ERROR_ADVICE for n in numbers]
    return literal_table(spark, rows, "error_number int, advice string")


def cmp_integrity_errors(command_log: DataFrame, advice: DataFrame, as_of, days: int = 7) -> DataFrame:
    """45: logged errors of the last days per server, database and error number."""
    recent = command_log.filter(
        (F.col("error_number") != 0)
        & (F.col("end_time") >= S.minus(as_of, days, "DAY"))
        & (F.col("end_time") <= S.ts(as_of))
    )
    grouped = recent.groupBy("server_id", "database_name", "error_number").agg(
        F.count(F.lit(1)).alias("n"), F.max("end_time").alias("last_time")
    )
    rows = grouped.join(advice, "error_number", "left")
    return findings(
        rows,
        "45",
        "Integrity errors",
        severity=CRITICAL,
        scope=F.col("database_name"),
        current=F.col("n"),
        target=0,
        details=S.text(
            "error ", F.col("error_number"), " ", F.col("n"), " times: ",
            F.coalesce("advice", F.lit(R.DEFAULT_ERROR_ADVICE)),
        ),
        observed_at="last_time",
    )


def cmp_backup_24h(backupset: DataFrame, databases: DataFrame, as_of) -> DataFrame:
    """47: no full backup in the past 24 hours, or none at all (tempdb needs none)."""
    keys = ["server_id", "database_name"]
    late = agg_having_latest_age(backupset, as_of, 24)
    full = backupset.filter("type = 'D'").select(*keys).distinct()
    never = databases.filter("database_name <> 'tempdb'").select(*keys).distinct().join(full, keys, "left_anti")
    rows = late.select(*keys, "last_full", "hours").unionByName(never, allowMissingColumns=True)
    return findings(
        rows, "47", "Full backup within 24 hours", scope=F.col("database_name"), current=F.col("hours"), target=24,
        details=S.text("last full backup at ", S.stamp("last_full")), observed_at="last_full",
    )


def cmp_endpoint_owner(endpoints: DataFrame, services: DataFrame) -> DataFrame:
    """51: endpoint owner is neither the administrator nor a service account."""
    accounts = services.select("server_id", F.col("service_account").alias("owner_name")).distinct()
    rows = endpoints.filter(F.col("principal_id") != 1).join(accounts, ["server_id", "owner_name"], "left_anti")
    return _violations(
        rows, "51", "Endpoint owner", scope=F.col("endpoint_name"),
        details=S.text(F.col("endpoint_name"), " is owned by ", F.col("owner_name")),
    )


ENGINE_64BIT = _per_server("52", "servers", "64-bit engine", "NOT contains(edition, '64')", "edition")
STARTUP_OPTIONS = _per_server(
    "53", "registry", "Startup options", "registry_key ilike '%MSSQLServer%Parameters' AND value_data = '-x'", "value_data"
)


def cmp_32bit(servers: DataFrame) -> DataFrame:
    return judge([ENGINE_64BIT], {"servers": servers})


def cmp_startup_options(registry: DataFrame) -> DataFrame:
    return judge([STARTUP_OPTIONS], {"registry": registry})


def evaluation_rule(days: int = 180) -> Rule:
    stops = "cast({stops} as timestamp_ntz)"
    return Rule(
        "54", "servers", "Evaluation edition", each=True, where="contains(edition, 'Evaluation')",
        key={"stops": f"cast(timestampadd(DAY, {days}, installed_at) as timestamp_ntz)"},
        details=told(quoted("stops on "), f"date_format({stops}, 'yyyy-MM-dd HH:mm:ss')"), observed_at=stops,
    )


def cmp_evaluation(servers: DataFrame, days: int = 180) -> DataFrame:
    """54: evaluation editions with their expiry."""
    return judge([evaluation_rule(days)], {"servers": servers})


def cmp_memory_limit(servers: DataFrame, settings: DataFrame, reserve_mb: int = 4096) -> DataFrame:
    """55: max memory leaves the reserve free, shared by all instances of the host."""
    limit = settings.filter(F.col("name") == "max server memory (MB)").select("server_id", "value_in_use")
    target = F.floor((F.floor(F.col("physical_memory_kb") / 1024) - reserve_mb) / F.col("instance_count"))
    rows = servers.join(limit, "server_id").withColumn("target", target.cast("bigint"))
    ok = F.col("value_in_use") <= F.col("target")
    return findings(
        rows, "55", "Maximum memory limit", severity=F.when(ok, OK).otherwise(WARN), current=F.col("value_in_use"),
        target=F.col("target"), achieved=ok,
    )


MEMORY_STATE = _per_server(
    "56", "servers", "External memory conditions", "memory_state <> 'Available physical memory is high'", "memory_state"
)
TRUSTWORTHY = _per_server(
    "71", "databases", "Trustworthy", "is_trustworthy_on AND database_name <> 'msdb'", "database_name"
)
AUTO_CLOSE = Rule(
    "72", "databases", "Auto close", each=True, key={"database": "database_name", "on": "is_auto_close_on"},
    scope="{database}", current="cast(cast({on} as boolean) as int)", target="0", achieved="NOT cast({on} as boolean)",
)
PERCENT_GROWTH = Rule(
    "73", "database_files", "Percent file growth", where="is_percent_growth", key={"database": "database_name"},
    scope="{database}",
)
SINGLE_TEMP_FILE = Rule(
    "74", "temp_files", "Only one tempdb data file", where="database_name = 'tempdb' AND type_desc = 'ROWS'",
    having="n = 1", current="n",
)
DRIVE = "upper(left(physical_name, 1))"
LOG_FILES_SAME_DRIVE = Rule(
    "75", "database_files", "Log files on one drive", where="type_desc = 'LOG' AND database_name <> 'tempdb'",
    key={"database": "database_name", "drive": DRIVE}, having="n > 1", scope="{database}", current="n",
    details=told("n", quoted(" log files on drive "), "{drive}"),
)
UNEVEN_GROWTH = Rule(
    "76", "database_files", "Uneven file growth", where="type_desc = 'ROWS'", once=True,
    key={"database": "database_name", "space": "data_space_id"}, value="growth",
    bits="CASE WHEN is_percent_growth THEN 2 WHEN NOT is_percent_growth THEN 1 END", having="low <> high OR bits = 3",
    scope="{database}",
)
SMALL_GROWTH = Rule(
    "77", "database_files", "Small file growth", each=True,
    where="NOT is_percent_growth AND growth = 128 AND size_pages >= 8192",
    key={"database": "database_name", "file": "physical_name", "gb": "floor(size_pages * 8 / 1000000)"},
    scope="{database}", details=told("{file}", quoted(" has "), "{gb}", quoted(" GB")),
)


def cmp_memory_state(servers: DataFrame) -> DataFrame:
    return judge([MEMORY_STATE], {"servers": servers})


def cmp_trustworthy(databases: DataFrame) -> DataFrame:
    return judge([TRUSTWORTHY], {"databases": databases})


def cmp_auto_close(databases: DataFrame) -> DataFrame:
    return judge([AUTO_CLOSE], {"databases": databases})


def cmp_percent_growth(files: DataFrame) -> DataFrame:
    return judge([PERCENT_GROWTH], {"database_files": files})


def cmp_single_temp_file(files: DataFrame) -> DataFrame:
    """74: exactly one tempdb data file."""
    return judge([SINGLE_TEMP_FILE], {"temp_files": files})


def cmp_log_files_same_drive(files: DataFrame) -> DataFrame:
    """75: more than one log file of a database on one drive."""
    return judge([LOG_FILES_SAME_DRIVE], {"database_files": files})


def cmp_uneven_growth(files: DataFrame) -> DataFrame:
    """76: data files of one filegroup grow by different amounts."""
    return judge([UNEVEN_GROWTH], {"database_files": files})


def cmp_small_growth(files: DataFrame) -> DataFrame:
    """77: 1 MB growth on a file of 64 MB or more."""
    return judge([SMALL_GROWTH], {"database_files": files})


def cmp_corruption(suspect_pages: DataFrame, repairs: DataFrame, databases: DataFrame, as_of, days: int = 10) -> DataFrame:
    """78: suspect or automatically repaired pages in the last days."""
    cols = ["server_id", "database_name", "event_time"]
    found = suspect_pages.select(*cols, F.lit("suspect page").alias("what")).unionByName(
        repairs.select(*cols, F.lit("page repaired automatically").alias("what"))
    )
    recent = found.filter(F.col("event_time") >= S.minus(as_of, days, "DAY"))
    known = databases.select("server_id", "database_name").distinct()
    rows = (
        recent.join(known, ["server_id", "database_name"], "left_semi")
        .groupBy("server_id", "database_name", "what")
        .agg(F.count(F.lit(1)).alias("n"), F.max("event_time").alias("last_time"))
    )
    return _violations(
        rows, "78", "Corruption", scope=F.col("database_name"), current=F.col("n"),
        details=S.text(F.col("what"), ", ", F.col("n"), " times"), severity=CRITICAL, observed_at="last_time",
    )


FILES_ON_C = Rule(
    "79", "database_files", "Database on C", where=f"{DRIVE} = 'C'", key={"database": "database_name"},
    named="CASE WHEN {database} IN ('master', 'model', 'msdb') THEN 'System database on C' "
    "WHEN {database} = 'tempdb' THEN 'Temp database on C' ELSE 'User database on C' END",
    scope="{database}",
)


def cmp_files_on_c(files: DataFrame) -> DataFrame:
    """79, 80, 81: databases with files on drive C, by database class."""
    return judge([FILES_ON_C], {"database_files": files})


def log_fragments_rule(most: int = 999) -> Rule:
    return Rule(
        "82", "log_fragments", "Virtual log files", key={"database": "database_name"}, having=f"n > {most}",
        scope="{database}", current="n", target="200", details=told("n", quoted(" virtual log files")),
    )


def cmp_log_fragments(log_fragments: DataFrame, n: int = 999) -> DataFrame:
    """82: more than 999 virtual log files."""
    return judge([log_fragments_rule(n)], {"log_fragments": log_fragments})


def cmp_user_tables_in_system(tables: DataFrame, allow: DataFrame) -> DataFrame:
    """83, 84, 85: user tables in master, msdb or model other than the allowed ones."""
    users = tables.filter(F.col("database_name").isin("master", "msdb", "model") & ~F.col("is_ms_shipped"))
    rows = users.join(allow, ["database_name", "table_name"], "left_anti")
    return _violations(
        rows, "83", "User table in system database", scope=F.col("database_name"),
        details=S.text("table ", F.col("table_name"), " created ", S.stamp("created_at")),
    )


def _slow(stall: str, ops: str, ms: int, min_ops: int) -> str:
    return f"{ops} > {min_ops} AND {stall} / ({ops} + 1) > {ms}"


def _slow_drives(check_id: str, name: str, ms: int, slow: str) -> Rule:
    return Rule(
        check_id, "slow_files", name, where=slow, key={"drive": DRIVE}, scope="{drive}", target=str(ms),
        details=told(quoted("drive "), "{drive}", quoted(" is slow")),
    )


def slow_reads_rule(ms: int = 200, min_ops: int = 100_000) -> Rule:
    return _slow_drives("86", "Slow reads", ms, _slow("io_stall_read_ms", "num_of_reads", ms, min_ops))


def slow_writes_rule(ms: int = 100, min_ops: int = 100_000) -> Rule:
    return _slow_drives("87", "Slow writes", ms, _slow("io_stall_write_ms", "num_of_writes", ms, min_ops))


def slow_files(file_stats: DataFrame, files: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """File statistics that any of ``rules`` looks at, with the file's path."""
    slow = file_stats.filter(" OR ".join(f"({r.where})" for r in rules))
    key = ["server_id", "database_name", "file_id"]
    return slow.join(files.select(*key, "physical_name"), key)


def cmp_slow_reads(file_stats: DataFrame, files: DataFrame, ms: int = 200, min_ops: int = 100_000) -> DataFrame:
    rules = [slow_reads_rule(ms, min_ops)]
    return judge(rules, {"slow_files": slow_files(file_stats, files, rules)})


def cmp_slow_writes(file_stats: DataFrame, files: DataFrame, ms: int = 100, min_ops: int = 100_000) -> DataFrame:
    rules = [slow_writes_rule(ms, min_ops)]
    return judge(rules, {"slow_files": slow_files(file_stats, files, rules)})


LINKED_SERVERS = Rule(
    "88", "linked", "Linked server", where="is_linked", key={"link": "linked_name", "remote": "remote_name"},
    scope="{link}", achieved="NOT coalesce({remote} = 'sa', false)",
    details="CASE WHEN {remote} = 'sa' THEN 'connects as the administrator' ELSE 'check its security configuration' END",
)


def cmp_linked_servers(linked: DataFrame) -> DataFrame:
    """88: every linked server, flagged when it connects as the administrator."""
    return judge([LINKED_SERVERS], {"linked": linked})


def cmp_stale_statistics(stats: DataFrame, as_of, days: int = 10, k: int = 5) -> DataFrame:
    """90: oldest statistics beyond 10 days, top 5 per server."""
    old = stats.filter((F.col("row_count") > 0) & (F.col("last_updated") < S.minus(as_of, days, "DAY")))
    rows = top_k(old, ["server_id"], [F.col("last_updated"), F.col("table_name"), F.col("stats_id")], k)
    return _violations(
        rows, "90", "Statistics out of date", scope=F.col("table_name"),
        details=S.text("statistics ", F.col("stats_id"), " updated ", S.stamp("last_updated")),
        observed_at="last_updated",
    )
