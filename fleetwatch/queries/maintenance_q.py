"""Queries of retention, maintenance planning and exports."""

# ruff: noqa: E501
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fleetwatch.operators import export as X
from fleetwatch.operators import maintenance as M
from fleetwatch.operators import retention as RT
from fleetwatch.plans.maintenance import mnt_plan
from fleetwatch.queries.core import ASOF_SQL, E, O
from fleetwatch.queries.registry import query
from fleetwatch.queries.roles_sql import AS_OF_EVENTS, AS_OF_ORDERS
from fleetwatch.session import work_path

# ---- retention -------------------------------------------------------------
PURGE_TABLES = {
    "event_message_context": "message_context",
    "event_messages": "event_messages",
    "executable_statistics": "executable_statistics",
    "execution_data_statistics": "data_statistics",
    "execution_component_phases": "component_phases",
    "execution_data_taps": "data_taps",
    "execution_parameter_values": "parameter_values",
    "execution_property_override_values": "override_values",
    "executions": "executions",
    "operation_messages": "operation_messages",
    "extended_operation_info": "operation_info",
    "operation_os_sys_info": "sys_info",
    "validations": "validations",
    "operation_permissions": "operation_permissions",
    "operations": "operations",
}
EXPIRED = f"(SELECT DISTINCT execution_id FROM v_executions WHERE created_time < {O} - INTERVAL 365 DAY)"


def _counts(table, view, gone):
    return f"SELECT '{table}' AS table_name, COUNT(*) FILTER (WHERE NOT ({gone})) AS kept_count, COUNT(*) FILTER (WHERE {gone}) AS deleted_count FROM {view}"


PURGE_SQL = " UNION ALL ".join((
    _counts("event_message_context", "v_message_context", f"event_message_id IN (SELECT event_message_id FROM v_event_messages WHERE operation_id IN {EXPIRED})"),
    _counts("event_messages", "v_event_messages", f"operation_id IN {EXPIRED}"),
    _counts("executable_statistics", "v_executable_statistics", f"execution_id IN {EXPIRED}"),
    _counts("execution_data_statistics", "v_data_statistics", f"execution_id IN {EXPIRED}"),
    _counts("execution_component_phases", "v_component_phases", f"execution_id IN {EXPIRED}"),
    _counts("execution_data_taps", "v_data_taps", f"execution_id IN {EXPIRED}"),
    _counts("execution_property_override_values", "v_override_values", f"execution_id IN {EXPIRED}"),
    _counts("operation_messages", "v_operation_messages", f"operation_id IN {EXPIRED}"),
    _counts("extended_operation_info", "v_operation_info", f"operation_id IN {EXPIRED}"),
    _counts("operation_os_sys_info", "v_sys_info", f"operation_id IN {EXPIRED}"),
    _counts("validations", "v_validations", f"validation_id IN {EXPIRED}"),
    _counts("operation_permissions", "v_operation_permissions", f"object_id IN {EXPIRED}"),
    _counts("execution_parameter_values", "v_parameter_values", f"execution_id IN {EXPIRED}"),
    _counts("executions", "v_executions", f"execution_id IN {EXPIRED}"),
    _counts("operations", "v_operations", f"operation_id IN {EXPIRED} AND start_time IS NOT NULL"),
))


@query("purge_cascade", PURGE_SQL)
def _(t):
    result = RT.purge_cascade({n: t(r) for n, r in PURGE_TABLES.items()}, t("executions"), AS_OF_ORDERS, 365)
    return reduce(lambda a, b: a.unionByName(b), [r.counts for r in result.values()])


@query("purge_parent_guard", f"SELECT * FROM v_operations WHERE NOT (operation_id IN {EXPIRED} AND start_time IS NOT NULL)")
def _(t):
    expired = RT.expired_keys(t("executions"), AS_OF_ORDERS, 365)
    return RT.purge_parent_guard(t("operations"), expired, "operation_id", "start_time")


@query("purge_history", f"SELECT id, database_name, command_type, start_time FROM v_command_log WHERE date_diff('day', start_time, {E}) <= 10")
def _(t):
    log = t("command_log").select("id", "database_name", "command_type", "start_time")
    return RT.purge_history(log, "start_time", AS_OF_EVENTS, 10)


@query("purge_files", f"""
SELECT path, date_diff('day', modified_at, {O}) AS age_days FROM v_listing WHERE regexp_matches(path, '/[^/]*_[^/]*_[^/]*\\.txt$') AND date_diff('day', modified_at, {O}) > 30
UNION ALL SELECT path, date_diff('day', modified_at, {O}) AS age_days FROM v_listing WHERE path LIKE '%.sqlaudit' AND date_diff('day', modified_at, {O}) > 60""".replace("\\\\", "\\"))
def _(t):
    text = RT.purge_files(t("listing"), "*_*_*.txt", AS_OF_ORDERS, 30)
    return text.unionByName(RT.purge_files(t("listing"), "*.sqlaudit", AS_OF_ORDERS, 60))


@query("retention_cutoff", ASOF_SQL + f"""
SELECT server_id, database_name, backup_type, CASE WHEN backup_type <> 'LOG' THEN {O} - INTERVAL 48 HOUR WHEN latest_safe IS NOT NULL THEN LEAST(latest_safe, {O} - INTERVAL 48 HOUR) END AS cutoff FROM safe""")
def _(t):
    return RT.retention_cutoff(t("log_chains"), t("backupset"), AS_OF_ORDERS, 48)


# ---- planning --------------------------------------------------------------
INV_SQL = """
WITH inv AS (SELECT table_name, partition_id, CAST(SUM(file_rows) AS BIGINT) AS "rows", CAST(SUM(file_bytes) AS BIGINT) AS bytes, COUNT(*) AS files,
  CAST(COUNT(*) FILTER (WHERE file_bytes < 20000000) AS DOUBLE) * 100 / COUNT(*) AS small_pct FROM v_table_files GROUP BY 1, 2)
"""


@query("mnt_inventory", INV_SQL + "SELECT * FROM inv")
def _(t):
    return M.mnt_inventory(t("table_files"))


GROUP = "CASE WHEN small_pct >= 30 THEN 'High' WHEN small_pct >= 5 THEN 'Medium' ELSE 'Low' END"


@query("mnt_fragmentation_group", INV_SQL + f"SELECT *, {GROUP} AS fragmentation_group FROM inv")
def _(t):
    return M.mnt_fragmentation_group(M.mnt_inventory(t("table_files")))


@query("mnt_action_decision", f"""
WITH o AS (SELECT *, {GROUP} AS g, NOT on_read_only_filegroup AND NOT is_memory_optimized AND index_type BETWEEN 1 AND 5 AS off,
    NOT on_read_only_filegroup AND NOT is_memory_optimized AND NOT is_columnstore AND online_edition AND ((index_type = 1 AND NOT is_image_text AND (NOT is_new_lob OR NOT is_filestream)) OR index_type = 2) AS onl
  FROM v_index_objects)
SELECT index_name, g AS fragmentation_group, CASE WHEN is_paused THEN 'INDEX_REBUILD_ONLINE' WHEN page_count < 1000 OR page_count > 4800 THEN NULL
  WHEN g = 'Medium' THEN CASE WHEN off AND (allow_page_locks OR index_type = 5) THEN 'INDEX_REORGANIZE' WHEN onl THEN 'INDEX_REBUILD_ONLINE' WHEN off THEN 'INDEX_REBUILD_OFFLINE' END
  WHEN g = 'High' THEN CASE WHEN onl THEN 'INDEX_REBUILD_ONLINE' WHEN off THEN 'INDEX_REBUILD_OFFLINE' END END AS action FROM o""")
def _(t):
    grouped = M.mnt_fragmentation_group(t("index_objects"))
    return M.mnt_action_decision(grouped, allowed=M.index_actions_allowed(14), max_size=4800).select("index_name", "fragmentation_group", "action")


@query("mnt_stats_decision", """
SELECT 'plain' AS mode, stats_id, COALESCE(index_type IN (1, 2, 3, 4, 7), TRUE) AS refresh FROM v_stats_objects
UNION ALL SELECT 'modified', stats_id, index_type IS NOT NULL AND index_type IN (1, 2, 3, 4, 7) AND modification_counter > 0 FROM v_stats_objects
UNION ALL SELECT 'percent', stats_id, index_type IS NULL AND ((row_count > 0 AND modification_counter * 100 / row_count >= 20) OR (modification_counter > 0 AND modification_counter >= sqrt(row_count * 1000))) FROM v_stats_objects""")
def _(t):
    st = t("stats_objects")
    parts = [("plain", M.mnt_stats_decision(st)), ("modified", M.mnt_stats_decision(st, "INDEX", True)), ("percent", M.mnt_stats_decision(st, "COLUMNS", pct=20))]
    return reduce(lambda a, b: a.unionByName(b), [d.select(F.lit(n).alias("mode"), "stats_id", "refresh") for n, d in parts])


@query("mnt_time_budget", """
WITH p AS (SELECT server_id, database_name, est_seconds, row_number() OVER (PARTITION BY server_id ORDER BY database_size DESC, database_name) AS plan_order FROM v_databases)
SELECT *, CAST(SUM(est_seconds) OVER w AS BIGINT) AS used_seconds, SUM(est_seconds) OVER w - est_seconds < 7200 AS start_allowed FROM p WINDOW w AS (PARTITION BY server_id ORDER BY plan_order)""")
def _(t):
    plan = M.mnt_plan_order(t("databases").select("server_id", "database_name", "est_seconds", "database_size"), "SIZE_DESC").drop("database_size")
    return M.mnt_time_budget(plan, 7200)


@query("mnt_plan", f"""
WITH s AS (SELECT server_id, database_name, database_size, est_seconds, CAST(1 AS BIGINT) AS start_position FROM v_databases WHERE database_name NOT IN ('master', 'msdb', 'model', 'tempdb') AND database_name NOT ILIKE '%7'),
p AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY database_size, database_name) AS plan_order FROM s)
SELECT server_id, database_name, database_size, est_seconds, plan_order, SUM(est_seconds) OVER (PARTITION BY server_id ORDER BY plan_order) - est_seconds < 7200 AS start_allowed FROM p""")
def _(t):
    return mnt_plan(t("databases"), "USER_DATABASES,-%7", "SIZE_ASC", 7200).select("server_id", "database_name", "database_size", "est_seconds", "plan_order", "start_allowed")


BKP = "server_id, database_name"


@query("bkp_eligible", f"""
SELECT 'FULL' AS backup_type, {BKP}, reason IS NULL AS eligible, reason FROM (SELECT *, CASE WHEN state_desc <> 'ONLINE' THEN 'not online' WHEN user_access = 'SINGLE_USER' AND NOT is_accessible THEN 'single user'
  WHEN is_in_standby THEN 'standby' WHEN availability_group IS NOT NULL AND COALESCE(replica_role <> 'PRIMARY', TRUE) THEN 'not primary replica' WHEN is_read_only THEN 'read only' END AS reason FROM v_databases)
UNION ALL
SELECT 'DIFF', {BKP}, reason IS NULL, reason FROM (SELECT *, CASE WHEN state_desc <> 'ONLINE' THEN 'not online' WHEN user_access = 'SINGLE_USER' AND NOT is_accessible THEN 'single user'
  WHEN is_in_standby THEN 'standby' WHEN differential_base_lsn IS NULL THEN 'no differential base' WHEN database_name = 'master' THEN 'master needs a full backup'
  WHEN availability_group IS NOT NULL AND COALESCE(replica_role <> 'PRIMARY', TRUE) THEN 'not primary replica' END AS reason FROM v_databases)
UNION ALL
SELECT 'LOG', {BKP}, reason IS NULL, reason FROM (SELECT *, CASE WHEN state_desc <> 'ONLINE' THEN 'not online' WHEN user_access = 'SINGLE_USER' AND NOT is_accessible THEN 'single user'
  WHEN is_in_standby THEN 'standby' WHEN recovery_model = 'SIMPLE' THEN 'simple recovery' WHEN log_lsn IS NULL THEN 'no log chain' WHEN database_name = 'master' THEN 'master needs a full backup'
  WHEN availability_group IS NOT NULL AND NOT is_preferred_replica THEN 'not preferred replica' WHEN log_shipping_role = 'PRIMARY' THEN 'log shipped'
  WHEN NOT (log_mb_since_backup >= 100 OR log_mb_since_backup IS NULL OR date_diff('second', last_log_backup, {E}) >= 7200 OR last_log_backup IS NULL) THEN 'log backup not due' END AS reason FROM v_databases)""")
def _(t):
    d = t("databases")
    parts = {
        "FULL": M.bkp_eligible(d, "FULL", AS_OF_EVENTS, updateability="READ_WRITE"),
        "DIFF": M.bkp_eligible(d, "DIFF", AS_OF_EVENTS),
        "LOG": M.bkp_eligible(d, "LOG", AS_OF_EVENTS, min_log_mb=100, min_seconds=7200),
    }
    cols = ["server_id", "database_name", "eligible", "reason"]
    return reduce(lambda a, b: a.unionByName(b), [p.select(F.lit(n).alias("backup_type"), *cols) for n, p in parts.items()])


NO_BASE = "(database_name = 'master' OR differential_base_lsn IS NULL OR modified_pages * 100 / allocated_pages >= 60 OR base_is_snapshot)"


@query("bkp_type_switch", f"""
SELECT 'LOG' AS backup_type, {BKP}, CASE WHEN recovery_model IN ('FULL', 'BULK_LOGGED') AND log_lsn IS NULL AND database_name <> 'master' THEN CASE WHEN {NO_BASE} THEN 'FULL' ELSE 'DIFF' END ELSE 'LOG' END AS effective_type FROM v_databases
UNION ALL SELECT 'DIFF', {BKP}, CASE WHEN {NO_BASE} THEN 'FULL' ELSE 'DIFF' END FROM v_databases
UNION ALL SELECT 'FULL', {BKP}, 'FULL' FROM v_databases""")
def _(t):
    d = t("databases")
    return reduce(lambda a, b: a.unionByName(b), [
        M.bkp_type_switch(d, k, 60).select(F.lit(k).alias("backup_type"), "server_id", "database_name", "effective_type") for k in ("LOG", "DIFF", "FULL")
    ])


@query("bkp_file_count", f"""
SELECT 'by_size' AS mode, {BKP}, CASE WHEN backup_bytes IS NULL OR backup_bytes = 0 THEN 4 ELSE LEAST(backup_bytes // 4 // 1048576000 + CASE WHEN backup_bytes // 4 % 1048576000 = 0 THEN 0 ELSE 1 END, 16) * 4 END AS files FROM v_databases
UNION ALL SELECT 'fixed', {BKP}, CASE WHEN backup_bytes IS NULL OR backup_bytes >= 20971520000 THEN 8 ELSE 2 END FROM v_databases
UNION ALL SELECT 'plain', {BKP}, 2 FROM v_databases""")
def _(t):
    d = t("databases")
    parts = {"by_size": M.bkp_file_count(d, 4, 1000), "fixed": M.bkp_file_count(d, 2, number_of_files=8, min_size_mb=20000), "plain": M.bkp_file_count(d, 2)}
    return reduce(lambda a, b: a.unionByName(b), [p.select(F.lit(n).alias("mode"), "server_id", "database_name", "files") for n, p in parts.items()])


@query("bkp_failed_latest", """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY server_id, database_name ORDER BY id DESC) AS rn FROM v_command_log WHERE command_type = 'DBCC_CHECKDB'),
k AS (SELECT server_id, database_name, (row_number() OVER (PARTITION BY server_id ORDER BY database_name) - 1) // 1000 AS chunk_no FROM n WHERE rn = 1 AND error_number <> 0)
SELECT server_id, chunk_no, string_agg(database_name, ',' ORDER BY database_name) AS names, COUNT(*) AS n FROM k GROUP BY 1, 2""")
def _(t):
    return M.bkp_failed_latest(t("command_log"), "DBCC_CHECKDB")


@query("chk_last_good", """
SELECT d.server_id, d.database_name, g.last_good FROM (SELECT DISTINCT server_id, database_name FROM v_databases) d LEFT JOIN (
  SELECT server_id, database_name, MAX(start_time) AS last_good FROM v_command_log WHERE command_type = 'DBCC_CHECKDB' AND error_number = 0 GROUP BY 1, 2) g
  ON g.server_id = d.server_id AND g.database_name = d.database_name""")
def _(t):
    return M.chk_last_good(t("command_log"), t("databases"))


@query("chk_eligible", """
SELECT server_id, database_name, r AS replicas, state_desc = 'ONLINE' AND NOT (user_access = 'SINGLE_USER' AND NOT is_accessible)
  AND COALESCE(replica_role IS NULL OR replica_role = 'PRIMARY' OR (replica_role = 'SECONDARY' AND secondary_connections = 'ALL'), FALSE)
  AND (availability_group IS NULL OR r = 'ALL' OR COALESCE(replica_role = r, FALSE) OR (r = 'PREFERRED_BACKUP_REPLICA' AND is_preferred_replica)) AS check_eligible
FROM v_databases, (VALUES ('ALL'), ('PRIMARY'), ('SECONDARY'), ('PREFERRED_BACKUP_REPLICA')) AS m(r)""")
def _(t):
    parts = [
        M.chk_eligible(t("databases"), r).select("server_id", "database_name", F.lit(r).alias("replicas"), "check_eligible")
        for r in ("ALL", "PRIMARY", "SECONDARY", "PREFERRED_BACKUP_REPLICA")
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("cmd_outcome", """
SELECT command_type, CASE WHEN error_number IS NULL THEN 'Not Executed' WHEN error_number = 0 THEN 'Succeeded' ELSE 'Failed' END AS status, COUNT(*) AS n,
  CAST(SUM(date_diff('second', start_time, end_time)) AS BIGINT) AS total_seconds,
  concat('00:', lpad(CAST(MAX(date_diff('second', start_time, end_time)) // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(MAX(date_diff('second', start_time, end_time)) % 60 AS VARCHAR), 2, '0')) AS longest
FROM v_command_log GROUP BY 1, 2""")
def _(t):
    return M.cmd_outcome(t("command_log"))


@query("mnt_queue_progress", """
SELECT queue_id, COUNT(*) FILTER (WHERE start_time IS NULL) AS pending, COUNT(*) FILTER (WHERE start_time IS NOT NULL AND end_time IS NULL) AS running,
  COUNT(*) FILTER (WHERE end_time IS NOT NULL) AS done, MIN(start_time) FILTER (WHERE end_time IS NULL) AS oldest_start FROM v_queue GROUP BY 1""")
def _(t):
    return M.mnt_queue_progress(t("queue"))


@query("export_layout", """
WITH p AS (SELECT server_id, database_name, CASE WHEN database_type = 'S' THEN 'FULL' ELSE 'DIFF' END AS bt, is_read_only AS part, CAST(1 + start_position * 2 AS INT) AS files FROM v_databases),
r AS (SELECT *, unnest(generate_series(1, files)) AS no, concat(bt, CASE WHEN part THEN '_PARTIAL' ELSE '' END) AS kind FROM p)
SELECT database_name, CAST(no AS INT) AS file_no, concat(server_id, '$i1/', database_name, '/', kind, '/', server_id, '$i1_', database_name, '_', kind, '_20240131_000000_',
  CASE WHEN files >= 10 THEN lpad(CAST(no AS VARCHAR), 2, '0') ELSE CAST(no AS VARCHAR) END, '.bak') AS path FROM r""")
def _(t):
    plan = t("databases").select(
        "server_id", F.lit("i1").alias("instance_name"), "database_name", F.when(F.col("database_type") == "S", "FULL").otherwise("DIFF").alias("backup_type"),
        F.col("is_read_only").alias("partial"), F.lit(False).alias("copy_only"), (1 + F.col("start_position") * 2).cast("int").alias("files"), F.lit("bak").alias("extension"),
    )
    return M.export_layout(plan, as_of=AS_OF_EVENTS).select("database_name", "file_no", "path")


# ---- jobs that write -------------------------------------------------------
@query("export_full", "SELECT * FROM orders")
def _(t):
    path = X.export_full(t.table("orders"), work_path(t.spark, "full"))
    return t.spark.read.schema(t.table("orders").schema).parquet(path)


def _changed_orders(t):
    """The orders after a day of work: one status updated, cheap orders gone, big ones re-keyed."""
    o = t.table("orders")
    return (
        o.filter("o_totalprice >= 20000")
        .withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")))
        .withColumn("o_orderkey", F.when(F.col("o_totalprice") > 400000, -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")))
    )


@query("export_diff", """
WITH n AS (SELECT CASE WHEN o_totalprice > 400000 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS st, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 20000)
SELECT COALESCE(n.k, o.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'I' WHEN n.k IS NULL THEN 'D' ELSE 'U' END AS change FROM n FULL JOIN orders o ON o.o_orderkey = n.k
WHERE o.o_orderkey IS NULL OR n.k IS NULL OR n.st <> o.o_orderstatus""")
def _(t):
    base = X.export_full(t.table("orders"), work_path(t.spark, "base"))
    path = X.export_diff(_changed_orders(t), base, ["o_orderkey"], work_path(t.spark, "diff"))
    return t.spark.read.schema("o_orderkey bigint, change string").parquet(path)


@query("export_log", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
def _(t):
    since = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    path = X.export_log(t.table("events"), "ts", since, work_path(t.spark, "log"))
    return t.spark.read.schema(t.table("events").schema).parquet(path)


@query("export_verify", "SELECT 'same' AS copy, COUNT(*) AS \"rows\", TRUE AS ok FROM orders UNION ALL SELECT 'changed', COUNT(*), FALSE FROM orders WHERE o_totalprice >= 20000")
def _(t):
    path = X.export_full(t.table("orders"), work_path(t.spark, "verify"))
    same = X.export_verify(t.table("orders"), path).withColumn("copy", F.lit("same"))
    changed = X.export_verify(_changed_orders(t), path).withColumn("copy", F.lit("changed"))
    return same.unionByName(changed).select("copy", "rows", "ok")


@query("mnt_compact", """
SELECT year(l_shipdate) AS partition_id, COUNT(*) AS rows_written, TRUE AS fewer_files FROM lineitem GROUP BY 1""")
def _(t):
    """Many small files per ship year, rewritten; sizes are given as 10,000 bytes a row."""
    path = work_path(t.spark, "compact-table")
    t.table("lineitem").withColumn("ship_year", F.year("l_shipdate")).repartition(16).write.partitionBy("ship_year").parquet(path)
    before = X.list_files(t.spark, path, "lineitem", "ship_year")
    sizes = before.groupBy("partition_id").agg((F.sum("file_rows") * 10_000).alias("bytes"))
    written = X.mnt_compact(t.spark, path, "ship_year", sizes, target_bytes=40_000_000)
    after = X.list_files(t.spark, path, "lineitem", "ship_year").groupBy("partition_id").agg(F.count(F.lit(1)).alias("files_after"))
    return written.join(after, "partition_id").select("partition_id", "rows_written", (F.col("files_after") < 16).alias("fewer_files"))


@query("mnt_analyze", "SELECT 'orders' AS table_name, 'UPDATE_STATISTICS' AS command_type, 0 AS error_number, COUNT(*) AS row_count, COUNT(DISTINCT o_orderstatus) AS distinct_status FROM orders")
def _(t):
    """Statistics of an external table over a copy of the orders."""
    spark = t.spark
    path = X.export_full(t.table("orders"), work_path(spark, "analyze"))
    table = "analyze_" + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE TABLE {table} (o_orderkey BIGINT, o_orderstatus STRING) USING parquet LOCATION '{path}'")
    log = X.mnt_analyze(spark, table, ["o_orderstatus"])
    detail = {r[0].strip(): r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    column = {r[0].strip(): r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table} o_orderstatus").collect()}
    rows = int(detail["Statistics"].split(",")[1].split()[0])
    distinct = int(column["distinct_count"])
    spark.sql(f"DROP TABLE {table}")
    return spark.createDataFrame(
        [("orders", log[0]["command_type"], log[0]["error_number"], rows, distinct)],
        "table_name string, command_type string, error_number int, row_count bigint, distinct_status bigint",
    )


@query("chk_integrity", """
SELECT 'readable' AS "check", 0 AS violations UNION ALL SELECT 'not_null:l_orderkey', COUNT(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'range:l_quantity', COUNT(*) FILTER (WHERE l_quantity NOT BETWEEN 1 AND 40) FROM lineitem
UNION ALL SELECT 'unique:l_orderkey,l_linenumber', COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'foreign_key:l_orderkey', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def _(t):
    return X.chk_integrity(
        t.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_orderkey"], {"l_quantity": (1, 40)},
        [("l_orderkey", t.table("orders").filter("o_orderstatus <> 'P'"), "o_orderkey")],
    )
