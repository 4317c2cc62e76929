"""Truth tables and boundary values of planning decisions, selections and rules."""

from __future__ import annotations

from itertools import product

import pytest
from pyspark.sql import functions as F

from fleetwatch.operators import compliance as C
from fleetwatch.operators import health as H
from fleetwatch.operators import maintenance as M
from fleetwatch.operators import selectors as SEL
from fleetwatch.operators.retention import purge_cascade, purge_files

AS_OF = "2024-01-31 12:00:00"


def test_include_then_exclude_is_the_difference(spark):
    names = [("master", "S"), ("sales", "U"), ("sales_test", "U"), ("salesXtest", "U"), ("a\\b", "U"), ("tempdb", "S")]
    inv = spark.createDataFrame(names, "name string, database_type string")
    got = {r.name: (r.selected, r.start_position) for r in SEL.sel_name_list(inv, "USER_DATABASES, -sales_test, [MASTER]").collect()}
    assert got == {"master": (True, 28), "sales": (True, 1), "sales_test": (False, 1), "salesXtest": (True, 1), "a\\b": (True, 1)}


def test_underscore_is_literal_in_names(spark):
    inv = spark.createDataFrame([("a_1", "U"), ("ab1", "U")], "name string, database_type string")
    got = {r.name: r.selected for r in SEL.sel_name_list(inv, "a_%").collect()}
    assert got == {"a_1": True, "ab1": False}


def test_object_names_need_three_parts():
    assert SEL.split_object_name("[my.db].dbo.t") == ("my.db", "dbo", "t", "%")
    with pytest.raises(ValueError):
        SEL.split_object_name("dbo.t")


@pytest.mark.parametrize("level, group", [(4.999, "Low"), (5.0, "Medium"), (29.999, "Medium"), (30.0, "High")])
def test_fragmentation_levels(spark, level, group):
    df = spark.createDataFrame([(level,)], "small_pct double")
    assert M.mnt_fragmentation_group(df).first().fragmentation_group == group


def test_action_truth_table(spark):
    actions = ("A", "B")
    rows = [(g, a, b, p, paused) for g, a, b, p, paused in product(("Low", "Medium", "High"), (True, False), (True, False), (999, 1000), (True, False))]
    df = spark.createDataFrame(rows, "fragmentation_group string, can_a boolean, can_b boolean, page_count int, is_paused boolean")
    preferred = {"Low": (), "Medium": ("A", "B"), "High": ("B",)}
    allowed = {"A": F.col("can_a"), "B": F.col("can_b")}
    for r in M.mnt_action_decision(df, preferred, allowed, resume_action="R").collect():
        can = {"A": r.can_a, "B": r.can_b}
        fits = [x for x in preferred[r.fragmentation_group] if can[x]] if r.page_count >= 1000 else []
        assert r.action == ("R" if r.is_paused else (fits or [None])[0]), r
    assert actions == ("A", "B")


def test_backup_type_truth_table(spark):
    rows = list(product(("master", "db"), ("FULL", "SIMPLE"), (None, 1), (None, 1), (10, 60), (True, False, None)))
    df = spark.createDataFrame(
        rows, "database_name string, recovery_model string, log_lsn int, differential_base_lsn int, modified_pages int, base_is_snapshot boolean"
    ).withColumn("allocated_pages", F.lit(100))
    for kind in ("LOG", "DIFF", "FULL"):
        for r in M.bkp_type_switch(df, kind, 60).collect():
            want = kind
            if want == "LOG" and r.recovery_model == "FULL" and r.log_lsn is None and r.database_name != "master":
                want = "DIFF"
            if want == "DIFF" and (
                r.database_name == "master" or r.differential_base_lsn is None or r.modified_pages >= 60 or r.base_is_snapshot
            ):
                want = "FULL"
            assert r.effective_type == want, r


@pytest.mark.parametrize("size, files", [(None, 2), (0, 2), (1, 2), (2 * 1048576, 2), (2 * 1048576 + 2, 4), (10**12, 64)])
def test_file_count(spark, size, files):
    df = spark.createDataFrame([(size,)], "backup_bytes bigint")
    assert M.bkp_file_count(df, 2, max_file_mb=1).first().files == files


@pytest.mark.parametrize("rows, mods, due", [(1000, 1000, True), (1000, 999, True), (4_000_000, 63_246, True), (4_000_000, 63_245, False), (0, 0, False)])
def test_statistics_change_rule(spark, rows, mods, due):
    df = spark.createDataFrame([(1, rows, mods)], "index_type int, row_count bigint, modification_counter bigint")
    assert M.mnt_stats_decision(df, pct=50).first().refresh is due


def test_time_budget_starts_work_below_the_limit(spark):
    plan = spark.createDataFrame([("s", 1, 60), ("s", 2, 60), ("s", 3, 60)], "server_id string, plan_order bigint, est_seconds bigint")
    got = [r.start_allowed for r in M.mnt_time_budget(plan, 120).orderBy("plan_order").collect()]
    assert got == [True, True, False]


def test_every_server_has_its_own_plan_and_budget(spark):
    from fleetwatch.plans.maintenance import mnt_plan

    rows = [(s, f"db_{i}", "U", i, 3600) for s in ("s1", "s2", None) for i in range(4)]
    dbs = spark.createDataFrame(rows, "server_id string, database_name string, database_type string, database_size bigint, est_seconds bigint")
    got = mnt_plan(dbs, "USER_DATABASES", "SIZE_DESC", 7200).collect()
    for server in ("s1", "s2", None):
        own = sorted((r.plan_order, r.database_name, r.start_allowed) for r in got if r.server_id == server)
        assert own == [(1, "db_3", True), (2, "db_2", True), (3, "db_1", False), (4, "db_0", False)]


@pytest.mark.parametrize("gb, warn, critical", [(1.99, 0, 1), (2.0, 1, 0), (5.0, 1, 0), (5.01, 0, 0)])
def test_volume_bands(spark, gb, warn, critical):
    df = spark.createDataFrame([("s", "d", "V:", 10**12, int(gb * 1073741824 + 0.5))], "server_id string, database_name string, volume_mount_point string, total_bytes bigint, available_bytes bigint")
    assert (H.hc_volume_warn(df).count(), H.hc_volume_critical(df).count()) == (warn, critical)


@pytest.mark.parametrize("finished, severity", [("2024-01-31 07:00:00", None), ("2024-01-31 05:59:59", 1), ("2024-01-30 12:00:00", 2), (None, 2)])
def test_user_backup_age(spark, finished, severity):
    dbs = spark.createDataFrame([("s", "db")], "server_id string, database_name string")
    rows = [("s", "db", "D", finished)] if finished else []
    sets = spark.createDataFrame(rows, "server_id string, database_name string, type string, backup_finish_date string").withColumn(
        "backup_finish_date", F.col("backup_finish_date").cast("timestamp_ntz")
    )
    got = [r.severity for r in H.hc_backup_user(sets, dbs, AS_OF).collect()]
    assert got == ([] if severity is None else [severity])


@pytest.mark.parametrize("at, hit", [("2024-01-30 12:00:00", 0), ("2024-01-30 12:00:01", 1), ("2024-01-31 12:00:00", 1), ("2024-01-31 12:00:01", 0)])
def test_trailing_window_is_half_open(spark, at, hit):
    df = spark.createDataFrame([("s", at, 71, 0)], "server_id string, event_time string, sql_cpu int, other_cpu int").withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    assert H.hc_cpu_engine(df, AS_OF).count() == hit


def test_log_report_equals_single_checks(spark):
    texts = ["Login failed for x", "filegroup is full", "Platte voll ist", "SQL Server was unable", "failed to start", "nothing", "insufficient system memory", None]
    log = spark.createDataFrame([("s", "2024-01-31 01:00:00", "p", t) for t in texts], "server_id string, log_date string, process_info string, text string").withColumn("log_date", F.col("log_date").cast("timestamp_ntz"))
    singles = [f(log, AS_OF) for f in (H.hc_login_failed, H.hc_filegroup_full, H.hc_system_task, H.hc_failed_to_start, H.hc_terminating_task, H.hc_dispatcher, H.hc_insufficient_memory, H.hc_allocation_failure)]
    want = sorted(str(r.asDict()) for s in singles for r in s.collect())
    assert sorted(str(r.asDict()) for r in H.log_findings(log, AS_OF).collect()) == want


def test_empty_inputs_give_no_findings(spark):
    waits = spark.createDataFrame([], "server_id string, wait_type string, waiting_tasks_count bigint, wait_time_ms bigint, signal_wait_time_ms bigint")
    causes = spark.createDataFrame([], "wait_type string, cause string")
    assert H.hc_cpu_pressure(waits, causes).count() == 0


def test_flag_advice_respects_versions(spark):
    servers = spark.createDataFrame([("old", "9.0.1", "x", False), ("new", "13.0.4001.0", "x", True)], "server_id string, product_version string, edition string, uses_columnstore boolean")
    flags = spark.createDataFrame([("old", "1118"), ("new", "1118"), ("new", "834"), ("old", "12345")], "server_id string, flag string")
    got = {(r.server_id, r.scope): r.details for r in C.cmp_flags_advice(flags, servers, C.flag_advice(spark)).collect()}
    assert got == {
        ("old", "1118"): "enabled globally",
        ("new", "1118"): "no effect, remove",
        ("new", "834"): "not together with columnstore, remove",
        ("old", "12345"): "enabled globally",
    }


def test_presence_lists_every_rule(spark):
    df = spark.createDataFrame([("s", True), ("s", None), ("t", False)], "server_id string, bad boolean")
    rules = [C.PresenceRule("1", "one", "r", "bad", "'x'"), C.PresenceRule("2", "two", "r", "FALSE", "'y'")]
    got = {(r.server_id, r.check_id): (r.current_value, r.achieved) for r in C.cmp_presence(rules, {"r": df}).collect()}
    assert got == {("s", "1"): ("1", False), ("t", "1"): ("0", True), ("s", "2"): ("0", True), ("t", "2"): ("0", True)}


def _purge(spark, enabled=True, days=30):
    roots = spark.createDataFrame([(1, "2023-01-01"), (2, "2024-01-30"), (3, "2023-01-01")], "execution_id bigint, created_time string").withColumn("created_time", F.col("created_time").cast("timestamp_ntz"))
    tables = {
        "event_message_context": spark.createDataFrame([(10,), (20,), (10,)], "event_message_id bigint"),
        "event_messages": spark.createDataFrame([(10, 1), (20, 2)], "event_message_id bigint, operation_id bigint"),
        "executions": roots,
        "operations": spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "operation_id bigint, start_time string"),
    }
    out = purge_cascade(tables, roots, AS_OF, days, enabled, partial=True)
    return {n: (r.counts.first().kept_count, r.counts.first().deleted_count, r.kept.count()) for n, r in out.items()}


def test_purge_cascade(spark):
    assert _purge(spark) == {"event_message_context": (1, 2, 1), "event_messages": (1, 1, 1), "executions": (1, 2, 1), "operations": (2, 1, 2)}


def test_purge_names_the_tables_it_lacks(spark):
    roots = spark.createDataFrame([(1, "2020-01-01 00:00:00")], "execution_id bigint, created_time string")
    with pytest.raises(ValueError, match="operation_permissions"):
        purge_cascade({"executions": roots}, roots, AS_OF, 30)


@pytest.mark.parametrize(
    "item, form, parts",
    [
        ("db1.fg", "filegroups", ("db1", "fg")), ("[my.db].[f g]", "filegroups", ("my.db", "f g")), ("ALL_FILEGROUPS", "filegroups", ("%", "%")),
        ("a.b.c", "objects", ("a", "b", "c")), ("all_objects", "objects", ("%",) * 3), ("a.b.c", "indexes", ("a", "b", "c", "%")), ("a.b.c.d", "indexes", ("a", "b", "c", "d")),
    ],
)
def test_object_names_of_all_forms(item, form, parts):
    from fleetwatch.operators.selectors import split_object_name

    assert split_object_name(item, form) == parts


@pytest.mark.parametrize("item, form", [("a", "filegroups"), ("a.b.c", "filegroups"), ("a.b", "objects"), ("a.b.c.d", "objects"), ("a.b", "indexes")])
def test_object_names_with_the_wrong_number_of_parts(item, form):
    from fleetwatch.operators.selectors import split_object_name

    with pytest.raises(ValueError):
        split_object_name(item, form)


@pytest.mark.parametrize("enabled, days", [(False, 30), (True, 0)])
def test_purge_is_off_unless_enabled(spark, enabled, days):
    assert all(deleted == 0 for _, deleted, _ in _purge(spark, enabled, days).values())


def test_purge_file_names(spark):
    rows = [("/x/a_b_c.txt", "2023-12-31"), ("/x/ab.txt", "2023-01-01"), ("/x/a_b_c.txt2", "2023-01-01"), ("/x/a_b_d.txt", "2024-01-01")]
    listing = spark.createDataFrame(rows, "path string, modified_at string").withColumn("modified_at", F.col("modified_at").cast("timestamp_ntz"))
    assert [(r.path, r.age_days) for r in purge_files(listing, "*_*_*.txt", AS_OF, 30).collect()] == [("/x/a_b_c.txt", 31)]
