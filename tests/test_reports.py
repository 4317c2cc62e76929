"""Servers that lack rows, databases never backed up, reports with roles left out."""

from __future__ import annotations

from datetime import datetime

from fleetwatch.operators import compliance as C
from fleetwatch.plans import reports

REGISTRY = "server_id string, registry_key string, value_name string, value_data string"


def _achieved(df):
    return {r.server_id: (r.current_value, r.achieved) for r in df.collect()}


def test_a_server_without_rows_is_judged(spark):
    servers = spark.createDataFrame([("s1",), ("s2",)], "server_id string")
    registry = spark.createDataFrame([("s1", "k", "NumErrorLogs", "12"), ("s1", "k", "AuditLevel", "3")], REGISTRY)
    assert _achieved(C.cmp_log_files(registry, servers)) == {"s1": ("12", True), "s2": ("-1", False)}
    assert _achieved(C.cmp_login_audit(registry, servers)) == {"s1": ("3", True), "s2": ("-1", False)}
    assert _achieved(C.cmp_protocols(registry, servers)) == {"s1": ("1", False), "s2": ("1", False)}
    audits = spark.createDataFrame(
        [("s1", a, True) for a in C.AUDIT_ACTIONS], "server_id string, action_name string, is_enabled boolean"
    )
    assert _achieved(C.cmp_audit_spec(audits, servers)) == {"s1": ("3", True), "s2": ("0", False)}
    objects = spark.createDataFrame([("s1", "o", "1")], "server_id string, object_name string, version string")
    expected = spark.createDataFrame([("o", "1")], "object_name string, expected_version string")
    assert _achieved(C.cmp_toolset_version(objects, expected, servers)) == {"s1": ("1", True), "s2": ("0", False)}


def test_presence_covers_the_inventory_and_servers_outside_it(spark):
    servers = spark.createDataFrame([("s1",), ("s2",)], "server_id string")
    rows = spark.createDataFrame([("s1", "a", True), ("s3", "b", True)], "server_id string, database_name string, bad boolean")
    rule = C.PresenceRule("1", "none bad", "databases", "bad", "database_name")
    found = _achieved(C.cmp_presence([rule], {"databases": rows}, servers))
    assert found == {"s1": ("1", False), "s2": ("0", True), "s3": ("1", False)}


def test_databases_never_backed_up_are_late(spark):
    schema = "server_id string, database_name string, type string, backup_finish_date timestamp_ntz"
    backups = spark.createDataFrame(
        [
            ("s1", "late", "D", datetime(2024, 1, 1)),
            ("s1", "fresh", "D", datetime(2024, 1, 31)),
            ("s1", "logs", "L", datetime(2024, 1, 31)),
        ],
        schema,
    )
    names = ("late", "fresh", "logs", "new", "tempdb")
    databases = spark.createDataFrame([("s1", n) for n in names], "server_id string, database_name string")
    rows = C.cmp_backup_24h(backups, databases, "2024-01-31 12:00:00").collect()
    assert {r.scope: r.observed_at for r in rows} == {"late": datetime(2024, 1, 1), "logs": None, "new": None}


def test_health_runs_with_the_roles_given(spark):
    servers = spark.createDataFrame([("s1", datetime(2024, 1, 31, 3)), ("s2", datetime(2023, 1, 1))], "server_id string, boot_time timestamp_ntz")
    out = reports.run_health({"servers": servers}, "2024-01-31 12:00:00").collect()
    assert {r.server_id: r.status for r in out} == {"s1": "YELLOW", "s2": "GREEN"}
    skipped = reports.skipped_checks({"servers": servers})
    assert skipped["hc_patch_level"] == ["version_map"]
    assert skipped["hc_mail_account_changed"] == ["mail_objects"]
    assert "hc_recent_restart" not in skipped


def test_rules_left_out_are_named(spark):
    servers = spark.createDataFrame([("s1",)], "server_id string")
    rule = C.PresenceRule(role="jobs", violates="true", example="name", check_id="99", name="x", severity=1)
    left = reports.skipped_rules({"servers": servers}, [rule])
    assert left["cmp_protocols"] == ["registry"] and left["cmp_flags_missing"] == ["flags_enabled"] and left["99 x"] == ["jobs"]
    assert "cmp_version" not in left and "cmp_32bit" not in left
    everything = dict.fromkeys((*reports.COMPLIANCE_ROLES, "jobs"), servers)
    assert reports.skipped_rules(everything, [rule]) == {}


def test_an_aggregate_is_computed_once(spark, tmp_path):
    """Shares of groups: the rows behind them are read once."""
    from fleetwatch.operators.workload import wait_stats

    rows = [(f"s{i % 3}", f"W{i}", 1, i + 1, 1) for i in range(60)]
    spark.createDataFrame(rows, "server_id string, wait_type string, waiting_tasks_count long, wait_time_ms long, signal_wait_time_ms long").write.parquet(
        str(tmp_path / "waits")
    )
    waits = spark.read.parquet(str(tmp_path / "waits"))
    plan = wait_stats(waits)._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "waits") not in plan  # what is left to do starts from the settled groups


def test_the_report_sorts_written_findings_and_reads_settings_once(spark, tmp_path, monkeypatch):
    settings = [(f"s{i}", "allow updates", i % 2) for i in range(4)] + [("s0", "max server memory (MB)", 1)]
    servers = [(f"s{i}", 8 << 20, 1, 1) for i in range(4)]
    roles = {}
    for name, rows, schema in (
        ("settings", settings, "server_id string, name string, value_in_use bigint"),
        ("servers", servers, "server_id string, physical_memory_kb bigint, instance_count bigint, major_version int"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        roles[name] = spark.read.parquet(str(tmp_path / name))
    monkeypatch.setattr(
        reports, "COMPLIANCE_RULES", [r for r in reports.COMPLIANCE_RULES if r[0] in (C.cmp_settings, C.cmp_memory_limit)]
    )
    found = reports.compliance_findings(roles, "2024-01-31 00:00:00")
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert str(tmp_path / "settings") not in plan  # both rules read what was written
    assert "Coalesce" in plan  # no task per rule and partition of its shuffle
    report = reports.run_compliance(roles, "2024-01-31 00:00:00")
    assert str(tmp_path) not in report._jdf.queryExecution().sparkPlan().toString()  # nothing is computed twice for the sort
    rows = [(r.achieved, r.name, r.server_id) for r in report.collect()]
    assert rows == sorted([*[(i % 2 == 0, "allow updates", f"s{i}") for i in range(4)], (True, "Maximum memory limit", "s0")])
