"""Whole reports: every check is an independent lazy DataFrame, unioned into one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.operators import compliance as C
from fleetwatch.operators import compliance_rules as R
from fleetwatch.operators import health as H
from fleetwatch.operators.findings import cmp_report, hc_traffic_light, union_findings
from fleetwatch.operators.rule_scan import Rule, judge
from fleetwatch.session import literal_table, settled

# (check, its roles in the order of its parameters, whether it takes the time of the report)
HEALTH_CHECKS = (
    (H.hc_patch_level, ("servers", "version_map"), True),
    (H.hc_backup_user, ("backupset", "databases"), True),
    (H.hc_backup_system, ("backupset", "databases"), True),
    (H.hc_volume_warn, ("volumes",), False),
    (H.hc_volume_critical, ("volumes",), False),
    (H.hc_file_growth, ("trace", "database_files", "volumes"), True),
    (H.log_findings, ("error_log",), True),
    (H.hc_jobs_disabled, ("jobs",), False),
    (H.hc_agent_errors, ("agent_log",), True),
    (H.hc_jobs_failed, ("jobs", "job_history", "job_activity"), True),
    (H.hc_mail_failed, ("mail_items",), True),
    (H.hc_operator_changed, ("operators", "expected_operator"), False),
    (H.hc_trace_errors, ("trace",), True),
    (H.hc_connections_peak, ("perf_counters",), False),
    (H.hc_cpu_engine, ("cpu_samples",), True),
    (H.hc_cpu_other, ("cpu_samples",), True),
    (H.hc_memory_low, ("memory_samples", "memory_rows"), True),
    (H.hc_cpu_pressure, ("wait_stats", "causes"), False),
    (H.hc_deadlocks, ("deadlocks",), True),
    (H.hc_unknown_activity, ("activity", "cpu_samples"), True),
    (H.hc_web_traffic, ("access_log",), True),
    (H.option_findings, ("databases",), False),
    (H.hc_recent_restart, ("servers",), True),
    (H.hc_disk_free_10gb, ("volumes",), False),
    (H.hc_low_disk_percent, ("volumes",), False),
    (H.hc_cert_expiring, ("certs",), True),
    (H.hc_cert_expired, ("certs",), True),
    (H.hc_service_stopped, ("services",), False),
    (H.hc_patches_recent, ("hotfixes",), True),
    (H.hc_patch_failed, ("os_events",), True),
)
MAIL_CHECKS = (H.hc_mail_account_changed, H.hc_mail_profile_changed)

COMPLIANCE_RULES = (
    (C.cmp_settings, ("settings", "setting_targets"), False),
    (C.cmp_cost_threshold, ("settings",), False),
    (C.cmp_version, ("servers",), False),
    (C.cmp_protocols, ("registry", "servers"), False),
    (C.cmp_admin_login, ("principals",), False),
    (C.cmp_guest_connect, ("permissions",), False),
    (C.cmp_orphaned_users, ("db_users", "principals"), False),
    (C.cmp_public_permissions, ("permissions",), False),
    (C.cmp_builtin_groups, ("principals", "permissions"), False),
    (C.cmp_local_groups, ("principals", "permissions"), False),
    (C.cmp_proxy_public, ("proxies", "db_users"), False),
    (C.cmp_password_expiration, ("principals", "role_members", "permissions"), False),
    (C.cmp_password_policy, ("principals",), False),
    (C.cmp_log_files, ("registry", "servers"), False),
    (C.cmp_login_audit, ("registry", "servers"), False),
    (C.cmp_audit_spec, ("audit_details", "servers"), False),
    (C.cmp_assemblies, ("assemblies",), False),
    (C.cmp_symmetric_keys, ("crypto_keys",), False),
    (C.cmp_asymmetric_keys, ("crypto_keys",), False),
    (C.cmp_toolset_version, ("toolset", "expected_toolset", "servers"), False),
    (C.cmp_parallelism, ("schedulers", "servers", "settings"), False),
    (C.cmp_flags_missing, ("expected_flags", "flags_enabled"), False),
    (C.cmp_flags_advice, ("flags_enabled", "servers", "flag_advice"), False),
    (C.cmp_logins_without_permission, ("principals", "login_permissions", "role_members", "db_users"), False),
    (C.cmp_service_isolation, ("services",), False),
    (C.cmp_job_steps, ("job_steps", "maint_jobs"), False),
    (C.cmp_integrity_errors, ("command_log", "error_advice"), True),
    (C.cmp_backup_24h, ("backupset", "databases"), True),
    (C.cmp_endpoint_owner, ("endpoints", "services"), False),
    (C.cmp_32bit, ("servers",), False),
    (C.cmp_startup_options, ("registry",), False),
    (C.cmp_evaluation, ("servers",), False),
    (C.cmp_memory_limit, ("servers", "settings"), False),
    (C.cmp_memory_state, ("servers",), False),
    (C.cmp_trustworthy, ("databases",), False),
    (C.cmp_auto_close, ("databases",), False),
    (C.cmp_percent_growth, ("database_files",), False),
    (C.cmp_single_temp_file, ("temp_files",), False),
    (C.cmp_log_files_same_drive, ("database_files",), False),
    (C.cmp_uneven_growth, ("database_files",), False),
    (C.cmp_small_growth, ("database_files",), False),
    (C.cmp_corruption, ("suspect_pages", "page_repairs", "databases"), True),
    (C.cmp_files_on_c, ("database_files",), False),
    (C.cmp_log_fragments, ("log_fragments",), False),
    (C.cmp_user_tables_in_system, ("user_tables", "system_table_allow"), False),
    (C.cmp_slow_reads, ("file_stats", "database_files"), False),
    (C.cmp_slow_writes, ("file_stats", "database_files"), False),
    (C.cmp_linked_servers, ("linked",), False),
    (C.cmp_stale_statistics, ("stats_dates",), True),
)

# Rules that share one scan per role and one aggregation over all roles.
SHARED_RULES = {
    C.cmp_cost_threshold: C.cost_threshold_rule(),
    C.cmp_version: C.VERSION,
    C.cmp_protocols: C.PROTOCOLS,
    C.cmp_admin_login: C.admin_login_rule(),
    C.cmp_guest_connect: C.GUEST_CONNECT,
    C.cmp_public_permissions: C.PUBLIC_PERMISSIONS,
    C.cmp_builtin_groups: C.BUILTIN_GROUPS,
    C.cmp_local_groups: C.LOCAL_GROUPS,
    C.cmp_password_expiration: C.PASSWORD_EXPIRATION,
    C.cmp_password_policy: C.PASSWORD_POLICY,
    C.cmp_log_files: C.log_files_rule(),
    C.cmp_login_audit: C.login_audit_rule(),
    C.cmp_audit_spec: C.AUDIT_SPEC,
    C.cmp_assemblies: C.ASSEMBLIES,
    C.cmp_symmetric_keys: C.SYMMETRIC_KEYS,
    C.cmp_asymmetric_keys: C.asymmetric_keys_rule(),
    C.cmp_service_isolation: C.SERVICE_ISOLATION,
    C.cmp_32bit: C.ENGINE_64BIT,
    C.cmp_startup_options: C.STARTUP_OPTIONS,
    C.cmp_evaluation: C.evaluation_rule(),
    C.cmp_memory_state: C.MEMORY_STATE,
    C.cmp_trustworthy: C.TRUSTWORTHY,
    C.cmp_auto_close: C.AUTO_CLOSE,
    C.cmp_percent_growth: C.PERCENT_GROWTH,
    C.cmp_single_temp_file: C.SINGLE_TEMP_FILE,
    C.cmp_log_files_same_drive: C.LOG_FILES_SAME_DRIVE,
    C.cmp_uneven_growth: C.UNEVEN_GROWTH,
    C.cmp_small_growth: C.SMALL_GROWTH,
    C.cmp_files_on_c: C.FILES_ON_C,
    C.cmp_log_fragments: C.log_fragments_rule(),
    C.cmp_slow_reads: C.slow_reads_rule(),
    C.cmp_slow_writes: C.slow_writes_rule(),
    C.cmp_linked_servers: C.LINKED_SERVERS,
}

# Tables of rules: those of the library, and those that only the caller can give.
LOOKUPS = ("setting_targets", "expected_toolset", "expected_flags", "flag_advice", "error_advice", "system_table_allow")
GIVEN = ("version_map", "causes")


def _roles(checks) -> tuple[str, ...]:
    return tuple(dict.fromkeys(r for _, needs, _ in checks for r in needs if r not in (*LOOKUPS, *GIVEN)))


HEALTH_ROLES = (*_roles(HEALTH_CHECKS), "mail_objects")
COMPLIANCE_ROLES = _roles(COMPLIANCE_RULES)


def _run(checks, roles: Mapping[str, DataFrame], as_of) -> list[DataFrame]:
    return [
        check(*[roles[r] for r in needs], *([as_of] if timed else []))
        for check, needs, timed in checks
        if all(r in roles for r in needs)
    ]


def skipped_checks(roles: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Health checks that ``run_health`` leaves out, each with the roles that are absent."""
    needs = {check.__name__: roles_ for check, roles_, _ in HEALTH_CHECKS} | {m.__name__: ("mail_objects",) for m in MAIL_CHECKS}
    absent = {name: [r for r in wanted if r not in roles] for name, wanted in needs.items()}
    return {name: lacking for name, lacking in absent.items() if lacking}


def skipped_rules(roles: Mapping[str, DataFrame], presence: Sequence[C.PresenceRule] = ()) -> dict[str, list[str]]:
    """Compliance rules that ``run_compliance`` leaves out, each with the roles that are absent."""
    derived = {"expected_flags": "servers"}  # made from another role unless given
    needs = {
        rule.__name__: [derived.get(r, r) if r not in roles else r for r in wanted if r not in LOOKUPS or r in derived]
        for rule, wanted, _ in COMPLIANCE_RULES
    }
    needs |= {f"{rule.check_id} {rule.name}": [rule.role] for rule in presence}
    absent = {name: list(dict.fromkeys(r for r in wanted if r not in roles)) for name, wanted in needs.items()}
    return {name: lacking for name, lacking in absent.items() if lacking}


def health_findings(
    roles: Mapping[str, DataFrame], as_of, mail_accounts: Sequence[str] = (), mail_profiles: Sequence[str] = ()
) -> DataFrame:
    """Findings of all health checks whose roles are given; ``skipped_checks`` names the others.

    ``mail_accounts`` and ``mail_profiles`` are the names that may change without a finding.
    """
    parts = _run(HEALTH_CHECKS, roles, as_of)
    if "mail_objects" in roles:
        allowed = (mail_accounts, mail_profiles)
        parts += [check(roles["mail_objects"], list(a), as_of) for check, a in zip(MAIL_CHECKS, allowed, strict=True)]
    return union_findings(*parts)


def run_health(roles: Mapping[str, DataFrame], as_of, **options) -> DataFrame:
    """Status per server of the database and server inventories given."""
    inventory = [roles[r].select(F.col("server_id").cast("string")) for r in ("databases", "servers") if r in roles]
    found = health_findings(roles, as_of, **options)
    servers = None
    for part in inventory:
        servers = part if servers is None else servers.unionByName(part)
    return hc_traffic_light(found, servers)


def compliance_findings(
    roles: Mapping[str, DataFrame], as_of, presence: Sequence[C.PresenceRule] = ()
) -> DataFrame:
    """Findings of all compliance rules whose roles are given, and of the ``presence`` rules.

    Targets, expected objects and flags, and advice come from the library's rule tables unless ``roles`` brings them.
    Four rules look at the settings, each by its own filter; the settings are written once for all of them.
    """
    spark = next(iter(roles.values())).sparkSession
    if "settings" in roles:
        roles = dict(roles) | {"settings": settled(roles["settings"], "settings")}
    lookups = {
        "setting_targets": C.setting_targets(spark),
        "expected_toolset": literal_table(spark, R.TOOLSET_EXPECTED, "object_name string, expected_version string"),
        "flag_advice": C.flag_advice(spark),
        "error_advice": C.error_advice(spark),
        "system_table_allow": literal_table(spark, R.SYSTEM_TABLE_ALLOW, "database_name string, table_name string"),
    }
    if "servers" in roles:
        matches = F.col("major_version") == F.col("major")
        lookups["expected_flags"] = roles["servers"].join(C.expected_flags(spark), matches)
    given = lookups | dict(roles)
    joined = _run([r for r in COMPLIANCE_RULES if r[0] not in SHARED_RULES], given, as_of)
    # Every rule ends in as many partitions as a shuffle has; each would be a task that carries the plan of all rules.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [union_findings(*joined).coalesce(tasks)] if joined else []
    shared = [SHARED_RULES[r] for r, needs, _ in COMPLIANCE_RULES if r in SHARED_RULES and all(n in roles for n in needs)]
    shared += C.presence_rules([rule for rule in presence if rule.role in roles])
    if shared:
        parts.append(judge(shared, judged := _judged_roles(roles, shared), judged.get("servers")))
    return union_findings(*parts)


def _judged_roles(roles: Mapping[str, DataFrame], rules: Sequence[Rule]) -> dict[str, DataFrame]:
    """The roles with the columns that shared rules need of other roles."""
    judged = dict(roles)
    if C.VERSION in rules:
        judged["servers"] = C.with_product(roles["servers"])
    if "principals" in roles:
        judged["principals"] = C.login_facts(
            roles["principals"],
            roles["permissions"] if C.BUILTIN_GROUPS in rules else None,
            roles["role_members"] if C.PASSWORD_EXPIRATION in rules else None,
        )
    slow = [r for r in rules if r.role == "slow_files"]
    if slow:
        judged["slow_files"] = C.slow_files(roles["file_stats"], roles["database_files"], slow)
    return judged


def run_compliance(roles: Mapping[str, DataFrame], as_of, presence: Sequence[C.PresenceRule] = ()) -> DataFrame:
    """The whole compliance report, rules that are not achieved first; ``skipped_rules`` names those it leaves out."""
    return cmp_report(compliance_findings(roles, as_of, presence))
