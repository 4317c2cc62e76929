"""Two servers that share database names, and changes that move NULLs."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetwatch.operators import aggregates, export, joins, maintenance, retention, windows, workload
from fleetwatch.operators.health import hc_memory_low, hc_trace_errors

BACKUP = "server_id string, database_name string, type string, is_damaged boolean, last_lsn long, backup_start_date timestamp_ntz"
CHAIN = "server_id string, database_name string, base_lsn long, backup_type string"


def test_cutoff_comes_from_the_own_server(spark):
    backups = spark.createDataFrame(
        [("s1", "sales", "D", False, 5, datetime(2024, 1, 1)), ("s2", "sales", "D", False, 5, datetime(2024, 1, 28))], BACKUP
    )
    chains = spark.createDataFrame([("s1", "sales", 9, "LOG"), ("s2", "sales", 9, "LOG"), ("s3", "sales", 9, "LOG")], CHAIN)
    out = retention.retention_cutoff(chains, backups, "2024-02-01 00:00:00", 48)
    assert {r.server_id: r.cutoff for r in out.collect()} == {"s1": datetime(2024, 1, 1), "s2": datetime(2024, 1, 28), "s3": None}


def test_checks_are_per_server(spark):
    schema = "id long, server_id string, database_name string, command_type string, error_number int, start_time timestamp_ntz"
    log = spark.createDataFrame(
        [(1, "s1", "sales", "DBCC_CHECKDB", 0, datetime(2024, 1, 1)), (2, "s2", "sales", "DBCC_CHECKDB", 7, datetime(2024, 1, 2))], schema
    )
    inventory = log.select("server_id", "database_name")
    good = {r.server_id: r.last_good for r in maintenance.chk_last_good(log, inventory).collect()}
    assert good == {"s1": datetime(2024, 1, 1), "s2": None}
    failed = maintenance.bkp_failed_latest(log, "DBCC_CHECKDB").collect()
    assert [(r.server_id, r.names) for r in failed] == [("s2", "sales")]


def test_moved_null_is_a_change(spark, tmp_path):
    schema = "id long, a int, b int"
    base = export.export_full(spark.createDataFrame([(1, None, 7), (2, 1, 1)], schema), str(tmp_path / "base"))
    now = spark.createDataFrame([(1, 7, None), (2, 1, 1)], schema)
    out = spark.read.parquet(export.export_diff(now, base, ["id"], str(tmp_path / "diff")))
    assert [(r.id, r.change) for r in out.collect()] == [(1, "U")]
    assert export.export_verify(now, base).first().ok is False
    assert export.export_verify(spark.read.parquet(base), base).first().ok is True


def test_trace_text_is_whole(spark):
    schema = (
        "event_class int, severity int, duration long, start_time timestamp_ntz, database_name string, application_name string, "
        "text_data string, server_id string, object_name string, error int, login_name string, host_name string, file_name string"
    )
    row = (22, 20, 1, datetime(2024, 1, 31), "db", "app", "x" * 900, "s1", None, 1, None, None, None)
    out = hc_trace_errors(spark.createDataFrame([row], schema), "2024-01-31 01:00:00").collect()
    assert "x" * 900 in out[0].details


SETS = "server_id string, backup_set_id long, database_name string, type string, backup_start_date timestamp_ntz, backup_finish_date timestamp_ntz"
FILES = "server_id string, backup_set_id long, file_type string, file_size long"


def test_backups_of_two_servers_stay_apart(spark):
    day, later = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 10)
    sets = spark.createDataFrame([("s1", 1, "sales", "D", day, later), ("s2", 1, "sales", "D", day, later)], SETS)
    files = spark.createDataFrame([("s1", 1, "D", 10 << 20), ("s2", 1, "D", 40 << 20)], FILES)
    assert sorted((r.server_id, r.file_size >> 20) for r in joins.join_inner_history(sets, files).collect()) == [("s1", 10), ("s2", 40)]
    speed = aggregates.agg_throughput(sets, files).collect()
    assert sorted((r.server_id, r.mb_per_sec) for r in speed) == [("s1", 1.0), ("s2", 4.0)]
    months = aggregates.agg_monthly_average_pivot(sets, files, "2024-01-31 00:00:00").collect()
    assert sorted((r.server_id, r.m0) for r in months) == [("s1", 10.0), ("s2", 40.0)]
    log = spark.createDataFrame(
        [(1, "s1", "sales", "DBCC_CHECKDB", day, later), (2, "s2", "sales", "DBCC_CHECKDB", day, later)],
        "id long, server_id string, database_name string, command_type string, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    checks = workload.integrity_check_speed(log, sets, files, "2024-01-31 00:00:00").collect()
    assert sorted((r.server_id, r.size_mb, r.mb_per_sec) for r in checks) == [("s1", 10.0, 1.0), ("s2", 40.0, 4.0)]


def test_index_runs_stay_on_their_server(spark):
    day = datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [("s1", "sales", "ix", "ALTER_INDEX", day, datetime(2024, 1, 1, 0, 1)), ("s2", "sales", "ix", "ALTER_INDEX", day, datetime(2024, 1, 1, 1))],
        "server_id string, database_name string, index_name string, command_type string, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    sizes = spark.createDataFrame([("s1", "t", "ix", 128), ("s2", "t", "ix", 256)], "server_id string, table_name string, index_name string, used_pages long")
    cost = workload.index_maintenance_cost(log, sizes).collect()
    assert sorted((r.server_id, r.mb, r.max_seconds) for r in cost) == [("s1", 1.0, 60), ("s2", 2.0, 3600)]


def test_memory_tree_is_the_newest_snapshot_and_whole(spark):
    samples = spark.createDataFrame(
        [("s1", 1, 100, True, False, datetime(2024, 1, 31))],
        "server_id string, sample_id long, physical_used long, physical_low boolean, virtual_low boolean, event_time timestamp_ntz",
    )
    rows = [("s1", datetime(2024, 1, 30), f"c{i:02}", float(i)) for i in range(20)]
    rows += [("s1", datetime(2024, 1, 29), "c00", 9.0), ("s1", datetime(2024, 2, 2), "c00", 9.0), ("s2", datetime(2024, 1, 30), "c00", 9.0)]
    tree = spark.createDataFrame(rows, "server_id string, snapshot_ts timestamp_ntz, counter_name string, value_mb double")
    whole = [f"c{i:02}={i}.00" for i in reversed(range(20))]
    assert [r.details for r in hc_memory_low(samples, tree, "2024-01-31 01:00:00").collect()] == ["; ".join(whole)]
    parts = hc_memory_low(samples, tree, "2024-01-31 01:00:00", per_row=8).collect()
    assert sorted(r.details for r in parts) == sorted("; ".join(whole[i : i + 8]) for i in (0, 8, 16))


def test_space_and_top_lists_are_per_server(spark):
    use = spark.createDataFrame(
        [(s, "sales", f"t{i}", 10 * n + i, i, i) for n, s in enumerate(("s1", "s2")) for i in range(5)],
        "server_id string, database_name string, object_name string, index_lock_promotion_count long, page_lock_wait_count long, leaf_allocation_count long",
    )
    top = [(s, f"t{i}") for s in ("s1", "s2") for i in (2, 3, 4)]
    assert sorted((r.server_id, r.object_name) for r in windows.top_lock_escalations(use).collect()) == top
    missing = spark.createDataFrame([("s2", "sales", "t4")], "server_id string, database_name string, object_name string")
    waits = windows.top_page_lock_waits(use, missing).collect()
    assert sorted((r.server_id, r.object_name) for r in waits) == top
    assert [(r.server_id, r.object_name) for r in waits if r.missing_index == "Y"] == [("s2", "t4")]
    space = spark.createDataFrame(
        [("s1", "sales", 8, 4), ("s2", "sales", 8, 2)],
        "server_id string, database_name string, allocated_extent_page_count long, modified_extent_page_count long",
    )
    assert sorted((r.server_id, r.change_pct) for r in aggregates.agg_extent_totals(space).collect()) == [("s1", 50.0), ("s2", 25.0)]
    pages = spark.createDataFrame([("s1", "t", "U", 5), ("s2", "t", "U", 6)], "server_id string, object_name string, type_desc string, free_space_in_bytes long")
    assert sorted((r.server_id, r.pages) for r in aggregates.agg_free_space_share(pages).collect()) == [("s1", 1), ("s2", 1)]


def test_ids_of_two_servers_do_not_meet(spark):
    units = spark.createDataFrame([("s1", 1, 1, 1, 4), ("s2", 1, 1, 2, 4)], "server_id string, allocation_unit_id long, container_id long, type int, used_pages long")
    parts = spark.createDataFrame([("s1", 1, 1, 5, 1), ("s2", 1, 9, 6, 1)], "server_id string, partition_id long, hobt_id long, object_id long, index_id long")
    owned = joins.join_disjunctive(units, parts)
    assert sorted((r.server_id, r.object_id) for r in owned.collect()) == [("s1", 5), ("s2", 6)]
    pages = spark.createDataFrame([("s1", 1, 5), ("s2", 1, 6), ("s2", 1, 6)], "server_id string, allocation_unit_id long, free_space_in_bytes long")
    objects = spark.createDataFrame([("s1", 5, "a", "U", False), ("s2", 6, "b", "U", False), ("s2", 5, "c", "U", False)],
                                    "server_id string, object_id long, object_name string, type_desc string, is_ms_shipped boolean")
    cache = workload.cache_free_space(pages, units, parts, objects).collect()
    assert sorted((r.server_id, r.object_name, r.pages) for r in cache) == [("s1", "a", 1), ("s2", "b", 2)]
    stats = spark.createDataFrame(
        [("s1", 1, "t", 1000, 900), ("s2", 1, "t", 1000, 900), ("s2", 1, "u", 2000, 1900)],
        "server_id string, schema_id int, table_name string, row_count long, modification_counter long",
    )
    indexes = spark.createDataFrame([("s1", "1.t", True), ("s2", "1.t", False), ("s2", "1.t", False)], "server_id string, object_id string, is_clustered boolean")
    columns = spark.createDataFrame([("s1", "1.t"), ("s1", "1.t"), ("s2", "1.u")], "server_id string, object_id string")
    stale = workload.stale_stats_tables(stats, indexes, columns).collect()
    assert sorted((r.server_id, r.table_name, r.no_of_occurrences, r.clustered_heap, r.index_count, r.column_count) for r in stale) == [
        ("s1", "t", 1, "Clustered", 1, 2), ("s2", "t", 2, "Heap", 1, 0), ("s2", "u", 2, "Indexed View", 0, 1),
    ]
    one = workload.stale_stats_tables(*[d.filter("server_id = 's1'").drop("server_id") for d in (stats, indexes, columns)])
    assert [(r.table_name, r.no_of_occurrences) for r in one.collect()] == [("t", 1)] and "server_id" not in one.columns


def test_a_server_in_one_table_only_raises(spark):
    with pytest.raises(ValueError, match="server_id"):
        joins.own_keys(["x"], spark.range(1).withColumn("server_id", F.lit("s")), spark.range(1))
