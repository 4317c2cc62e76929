"""Queries of filters, selectors, joins, aggregates, windows, top-k, sets and scalars."""

# ruff: noqa: E501
from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatch.operators import aggregates as A
from fleetwatch.operators import filters as FL
from fleetwatch.operators import joins as J
from fleetwatch.operators import logs as L
from fleetwatch.operators import scalars as SC
from fleetwatch.operators import selectors as SEL
from fleetwatch.operators import windows as W
from fleetwatch.operators import workload as WL
from fleetwatch.queries.registry import query
from fleetwatch.session import literal_table
from fleetwatch.queries.roles_sql import AS_OF_EVENTS, AS_OF_ORDERS

E = f"TIMESTAMP '{AS_OF_EVENTS}'"
O = f"TIMESTAMP '{AS_OF_ORDERS}'"  # noqa: E741
SYS = "('master', 'msdb', 'model', 'tempdb')"
BENIGN = [f"view_{n}" for n in range(10)]
BENIGN_SQL = "(" + ", ".join(f"'{b}'" for b in BENIGN) + ")"
CAUSES = [("error_1", "failed requests"), ("click_3", "user input"), ("purchase_5", "payment provider")]
CAUSES_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in CAUSES) + ") AS c(wait_type, cause)"


# ---- filters ---------------------------------------------------------------
@query("flt_exclusion_list", f"SELECT * FROM v_wait_stats WHERE wait_type NOT IN {BENIGN_SQL} AND wait_time_ms >= 1")
def _(t):
    return FL.flt_exclusion_list(t("wait_stats"), "wait_type", BENIGN, "wait_time_ms", 1)


@query("flt_trailing_window", f"SELECT * FROM v_cpu_samples WHERE event_time > {E} - INTERVAL 24 HOUR AND event_time <= {E}")
def _(t):
    return FL.flt_trailing_window(t("cpu_samples"), "event_time", AS_OF_EVENTS)


@query("flt_previous_calendar_day", "SELECT * FROM v_agent_log WHERE log_date >= TIMESTAMP '2024-01-30' AND log_date < TIMESTAMP '2024-01-31'")
def _(t):
    return FL.flt_previous_calendar_day(t("agent_log"), "log_date", AS_OF_EVENTS)


@query("flt_since_yesterday_midnight", "SELECT * FROM v_error_log WHERE log_date >= TIMESTAMP '2024-01-30'")
def _(t):
    return FL.flt_since_yesterday_midnight(t("error_log"), "log_date", AS_OF_EVENTS)


@query("flt_trailing_year", f"SELECT * FROM v_backupset WHERE backup_start_date BETWEEN {O} - INTERVAL 1 YEAR AND {O}")
def _(t):
    return FL.flt_trailing_year(t("backupset"), "backup_start_date", AS_OF_ORDERS)


ANY_SQL = " OR ".join(f"text ILIKE '{p}'" for p in L.FAILURE_PATTERNS)


@query("flt_any_pattern", f"SELECT * FROM v_error_log WHERE {ANY_SQL}")
def _(t):
    return FL.flt_any_pattern(t("error_log"), "text", L.FAILURE_PATTERNS)


def noise_sql(patterns, column="text"):
    return " AND ".join(f"NOT {column} ILIKE '" + p.replace("'", "''") + "' ESCAPE '|'" for p in patterns)


@query("flt_no_pattern", f"SELECT * FROM v_error_log WHERE {noise_sql(L.ENGINE_NOISE)}")
def _(t):
    return FL.flt_no_pattern(t("error_log"), "text", L.ENGINE_NOISE)


@query("flt_id_blocklist", """
SELECT server_id, host_class, record_id, event_id FROM v_os_events
WHERE (host_class IN ('4', '2') AND event_id NOT IN (1008, 2004, 8005))
   OR (host_class = '1' AND event_id NOT IN (257, 1008, 1017, 1022, 1023, 2001, 2004, 3009, 8005))""")
def _(t):
    return FL.flt_id_blocklist(t("os_events"), "host_class", "event_id", L.APPLICATION_BLOCKED).select(
        "server_id", "host_class", "record_id", "event_id"
    )


@query("flt_system_objects", f"SELECT * FROM v_backupset WHERE database_name NOT IN {SYS}")
def _(t):
    return FL.flt_system_objects(t("backupset"), "database_name")


@query("flt_range_band", "SELECT * FROM v_volumes WHERE ROUND(available_bytes / 1073741824, 2) BETWEEN 2 AND 5")
def _(t):
    return FL.flt_range_band(t("volumes"), F.round(F.col("available_bytes") / 1073741824, 2), 2, 5)


# ---- selectors and labels --------------------------------------------------
@query("sel_name_list", r"""
WITH m AS (
  SELECT *, database_type = 'U' AS m1, name ILIKE 'db\_1%' ESCAPE '\' AS x15, name = 'master' AS m23, name ILIKE '%7' AS x32 FROM v_names WHERE name <> 'tempdb')
SELECT name, database_type, in_availability_group, (m1 OR m23) AND NOT (x15 OR x32) AS selected,
  CAST(CASE WHEN m1 THEN 1 WHEN m23 THEN 23 END AS BIGINT) AS start_position FROM m""")
def _(t):
    return SEL.sel_name_list(t("names"), "USER_DATABASES,-db_1%,[master],-%7")


@query("sel_object_list", r"""
WITH m AS (
  SELECT *, (db = 'db_10' AND schema ILIKE 's%' AND object ILIKE '%') AS i1,
    (db ILIKE 'db\_2%' ESCAPE '\' AND schema = 's1' AND "index" ILIKE 'ix\_1%' ESCAPE '\') AS i15, (schema = 's2') AS x32 FROM v_object_names)
SELECT db, schema, object, "index", COALESCE((COALESCE(i1, FALSE) OR COALESCE(i15, FALSE)) AND NOT x32, FALSE) AS selected,
  CAST(CASE WHEN i1 THEN 1 WHEN i15 THEN 12 END AS BIGINT) AS start_position FROM m""")
def _(t):
    return SEL.sel_object_list(t("object_names"), "db_10.s%.%,db_2%.s1.%.ix_1%,-%.s2.%.%")


@query("sel_filegroup_list", r"""
WITH m AS (
  SELECT DISTINCT db, schema AS filegroup FROM v_object_names),
k AS (SELECT *, db ILIKE 'db\_1%' ESCAPE '\' AS i1, db = 'db_20' AND filegroup = 's1' AS i2, filegroup = 's3' AS x FROM m)
SELECT db, filegroup, (i1 OR i2) AND NOT x AS selected, CAST(CASE WHEN i1 THEN 1 WHEN i2 THEN 9 END AS BIGINT) AS start_position FROM k""")
def _(t):
    groups = t("object_names").select("db", F.col("schema").alias("filegroup")).distinct()
    return SEL.sel_object_list(groups, "db_1%.%,[db_20].[s1],-%.s3", form="filegroups")


@query("sel_check_objects", r"""
WITH m AS (SELECT DISTINCT db, schema, object FROM v_object_names),
k AS (SELECT *, db = 'master' AND object ILIKE 't\_1%' ESCAPE '\' AS x FROM m)
SELECT db, schema, object, NOT x AS selected, CAST(1 AS BIGINT) AS start_position FROM k""")
def _(t):
    objects = t("object_names").select("db", "schema", "object").distinct()
    return SEL.sel_object_list(objects, "ALL_OBJECTS,-master.%.t_1%", form="objects")


@query("sel_missing_names", """
SELECT string_agg(n, ', ' ORDER BY n) AS missing_names FROM (VALUES ('db_7'), ('nowhere'), ('lost'), ('db_9')) AS w(n)
WHERE lower(n) NOT IN (SELECT lower(name) FROM v_names)""")
def _(t):
    return SEL.sel_missing_names(t("names"), "USER_DATABASES,db_7,[nowhere],-lost,db_9,x%")


REASONS_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in L.FAILURE_REASONS) + ") AS r(code, reason)"


@query("prj_case_map", f"""
SELECT a.*, COALESCE(r.reason, 'Other') AS reason FROM v_auth_failures a LEFT JOIN {REASONS_SQL} ON lower(a.sub_status) = lower(r.code)""")
def _(t):
    return FL.prj_case_map(t("auth_failures"), "sub_status", literal_table(t.spark, L.FAILURE_REASONS, "code string, reason string"))


@query("prj_environment", """
WITH n AS (SELECT event_id, concat(CASE event_id % 4 WHEN 0 THEN 'ELVDEV' WHEN 1 THEN 'elvref' WHEN 2 THEN 'xPRO' ELSE 'host' END, CAST(user_id AS STRING)) AS name FROM events)
SELECT event_id, name, CASE WHEN name ILIKE '%DEV%' THEN 'DEV' WHEN name ILIKE '%REF%' THEN 'REF' WHEN name ILIKE '%PRO%' THEN 'PRO'
  WHEN right(name, 1) IN ('1', '2', '4') THEN concat('HOST', right(name, 1)) ELSE 'OTHER' END AS environment FROM n""")
def _(t):
    prefix = F.expr("CASE event_id % 4 WHEN 0 THEN 'ELVDEV' WHEN 1 THEN 'elvref' WHEN 2 THEN 'xPRO' ELSE 'host' END")
    n = t.table("events").select("event_id", F.concat(prefix, F.col("user_id").cast("string")).alias("name"))
    return FL.prj_environment(n, "name")


@query("prj_bool_label", "SELECT *, CASE WHEN alloc_unit_name IS NULL THEN 'Y' ELSE 'N' END AS flag FROM v_log_records")
def _(t):
    return FL.prj_bool_label(t("log_records"), F.col("alloc_unit_name").isNull())


@query("prj_safe_name", r"""SELECT conv_id, turn, rtrim(regexp_replace(text, '[\\/:*?"<>|]', '', 'g')) AS safe_name FROM conversations""")
def _(t):
    return FL.prj_safe_name(t.table("conversations"), "text").select("conv_id", "turn", "safe_name")


# ---- joins -----------------------------------------------------------------
@query("join_inner_history", """
SELECT b.server_id, b.database_name, b.type, f.file_type, f.file_size, b.backup_start_date, b.backup_finish_date
FROM v_backupset b JOIN v_backupfile f USING (server_id, backup_set_id)""")
def _(t):
    return J.join_inner_history(t("backupset"), t("backupfile"))


@query("join_three_way", """
WITH newest AS (SELECT server_id, database_name, max(struct_pack(d := backup_start_date, b := backup_set_id)).b AS backup_set_id FROM v_backupset WHERE type = 'D' GROUP BY 1, 2),
sizes AS (SELECT server_id, database_name, CAST(SUM(file_size) AS BIGINT) AS file_size FROM newest JOIN v_backupfile USING (server_id, backup_set_id) WHERE file_type = 'D' GROUP BY 1, 2)
SELECT c.id, server_id, database_name, s.file_size, date_diff('second', c.start_time, c.end_time) AS seconds FROM v_command_log c JOIN sizes s USING (server_id, database_name)""")
def _(t):
    return J.join_three_way(t("command_log"), t("backupset"), t("backupfile"))


@query("join_multi_key", """
SELECT server_id, tb.table_name, index_name, pg.used_pages, c.command FROM v_plain_indexes ix
JOIN (SELECT p.server_id, p.object_id, p.index_id, CAST(SUM(a.used_pages) AS BIGINT) AS used_pages FROM v_partitions p JOIN v_allocation a ON p.server_id = a.server_id AND p.partition_id = a.container_id GROUP BY 1, 2, 3) pg
  USING (server_id, object_id, index_id)
JOIN (SELECT * FROM v_plain_tables WHERE NOT is_ms_shipped) tb USING (server_id, object_id)
JOIN (SELECT DISTINCT server_id, index_name, command FROM v_command_log) c USING (server_id, index_name)""")
def _(t):
    return J.join_multi_key(t("plain_indexes"), t("partitions"), t("allocation"), t("plain_tables"), t("command_log"))


@query("join_left_flag", """
SELECT o.*, CASE WHEN m.object_name IS NULL THEN 'N' ELSE 'Y' END AS flag FROM v_index_operational o
LEFT JOIN (SELECT DISTINCT server_id, database_name, object_name FROM v_missing_index) m USING (server_id, database_name, object_name)""")
def _(t):
    return J.join_left_flag(t("index_operational"), t("missing_index"), ["server_id", "database_name", "object_name"])


@query("join_disjunctive", """
SELECT a.*, p.* EXCLUDE (server_id) FROM v_allocation a JOIN v_partitions p
  ON a.server_id = p.server_id AND ((a.container_id = p.hobt_id AND a.type IN (1, 3)) OR (a.container_id = p.partition_id AND a.type = 2))""")
def _(t):
    return J.join_disjunctive(t("allocation"), t("partitions"))


@query("join_lateral_detail", """
SELECT f.server_id, f.database_name, f.file_id, f.physical_name, f.size_pages, d.num_of_reads FROM v_database_files f, LATERAL (
  SELECT num_of_reads FROM v_file_stats s WHERE s.server_id = f.server_id AND s.database_name = f.database_name AND s.file_id = f.file_id) d""")
def _(t):
    keys = ["server_id", "database_name", "file_id"]
    base = t("database_files").select(*keys, "physical_name", "size_pages")
    return J.join_lateral_detail(base, t("file_stats").select(*keys, "num_of_reads"), keys)


@query("join_latest_per_key", """
SELECT job_id, step_id, run_status, run_date, run_time, message FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY run_date DESC, run_time DESC, step_id DESC, message DESC) AS rn FROM v_job_history) WHERE rn = 1""")
def _(t):
    return J.join_latest_per_key(t("job_history"), "job_id", ["run_date", "run_time", "step_id", "message"])


@query("join_left_anti", "SELECT * FROM v_databases d WHERE NOT EXISTS (SELECT 1 FROM v_backupset b WHERE b.server_id = d.server_id AND b.database_name = d.database_name)")
def _(t):
    return J.join_left_anti(t("databases"), t("backupset"), ["server_id", "database_name"]).select(*t("databases").columns)


@query("join_not_exists_later", """
SELECT f.job_id, f.event_id, f.ts FROM (SELECT user_id AS job_id, event_id, ts FROM events WHERE event_type = 'error') f
WHERE NOT EXISTS (SELECT 1 FROM events s WHERE s.user_id = f.job_id AND s.event_type = 'purchase' AND s.ts > f.ts)""")
def _(t):
    e = t.table("events").select(F.col("user_id").alias("job_id"), "event_id", "ts", "event_type")
    return J.join_not_exists_later(
        e.filter("event_type = 'error'").drop("event_type"), e.filter("event_type = 'purchase'"), "job_id", "ts"
    )


@query("join_not_exists_open", """
SELECT * FROM v_jobs j WHERE NOT EXISTS (SELECT 1 FROM v_job_activity a WHERE a.job_id = j.job_id AND a.stop_execution_date IS NULL
  AND a.session_id = (SELECT MAX(session_id) FROM v_job_activity m WHERE m.job_id = j.job_id))""")
def _(t):
    return J.join_not_exists_open(t("jobs"), t("job_activity"))


@query("join_semi_gate", f"""
SELECT * FROM v_activity WHERE server_id IN (SELECT server_id FROM v_cpu_samples WHERE other_cpu > 96 AND event_time > {E} - INTERVAL 24 HOUR)""")
def _(t):
    busy = FL.flt_trailing_window(t("cpu_samples"), "event_time", AS_OF_EVENTS).filter("other_cpu > 96")
    return J.join_semi_gate(t("activity"), busy, ["server_id"])


@query("join_cross_constant", """
SELECT g.*, p.parent_id, p.id FROM v_grants g, (VALUES (1221, 1220), (1111, 1110)) AS p(id, parent_id)""")
def _(t):
    return J.join_cross_constant(t("grants"), [(1221, 1220), (1111, 1110)], ["id", "parent_id"])


NORMAL_SQL = r"""
WITH norm AS (
  SELECT server_id, snapshot_ts,
    CASE WHEN object_name LIKE '%Memory Manager%' THEN 'Memory Manager' WHEN object_name LIKE '%Buffer Manager%' THEN 'Buffer Manager'
         WHEN object_name LIKE '%Plan Cache%' THEN 'Plan Cache' ELSE 'Cursor' END AS object_name,
    regexp_replace(counter_name, ' pages| \(KB\)| \(MB\)', '', 'gi') AS counter_name, instance_name, cntr_value,
    split_part(counter_name, ' ', 1) AS short_name,
    CASE WHEN counter_name ILIKE '%pages' THEN cntr_value / 128 ELSE cntr_value / 1024 END AS value_mb
  FROM v_memory_counters),
kept AS (
  SELECT * FROM norm o WHERE NOT (object_name = 'Buffer Manager' AND EXISTS (SELECT 1 FROM norm n WHERE n.object_name = 'Memory Manager'
    AND n.server_id = o.server_id AND n.snapshot_ts = o.snapshot_ts AND n.short_name = o.short_name))),
renamed AS (
  SELECT k.server_id, k.snapshot_ts, CASE WHEN k.object_name = 'Buffer Manager' THEN 'Memory Manager' ELSE k.object_name END AS object_name,
    CASE WHEN k.object_name = 'Buffer Manager' AND m.new_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM kept x WHERE x.object_name = 'Memory Manager'
      AND x.server_id = k.server_id AND x.snapshot_ts = k.snapshot_ts AND x.counter_name = m.new_name) THEN m.new_name ELSE k.counter_name END AS counter_name,
    k.instance_name, k.cntr_value, k.short_name, k.value_mb
  FROM kept k LEFT JOIN (VALUES ('Free', 'Free Memory'), ('Database', 'Database Cache Memory'), ('Stolen', 'Stolen Server Memory'),
    ('Reserved', 'Reserved Server Memory'), ('Foreign', 'Foreign Node Memory')) AS m(old_name, new_name) ON m.old_name = k.counter_name),
nodes AS (
  SELECT server_id, snapshot_ts, CASE WHEN object_name = 'Plan Cache' AND instance_name <> '_Total' THEN 1226 WHEN object_name = 'Plan Cache' THEN 1225
      WHEN object_name = 'Cursor' THEN 1222 WHEN counter_name = 'Target Server Memory' THEN 1000 WHEN counter_name = 'Total Server Memory' THEN 1200
      WHEN counter_name = 'Maximum Workspace Memory' THEN 1100 WHEN counter_name = 'Granted Workspace Memory' THEN 1110
      WHEN counter_name = 'Stolen Server Memory' THEN 1220 WHEN counter_name IN ('Database Cache Memory', 'Free Memory') THEN 1210
      WHEN short_name IN ('Connection', 'Lock', 'Optimizer', 'SQL') THEN 1222 WHEN short_name = 'Reserved' THEN 1112 END AS id,
    CASE WHEN object_name = 'Plan Cache' AND instance_name <> '_Total' THEN instance_name WHEN object_name = 'Plan Cache' THEN concat('Plan ', counter_name)
      ELSE counter_name END AS counter_name, value_mb FROM renamed),
base AS (
  SELECT server_id, snapshot_ts, id, CASE id WHEN 1226 THEN 1225 WHEN 1225 THEN 1220 WHEN 1222 THEN 1220 WHEN 1200 THEN 1000 WHEN 1100 THEN 1000
      WHEN 1110 THEN 1100 WHEN 1220 THEN 1200 WHEN 1210 THEN 1200 WHEN 1112 THEN 1110 END AS parent_id, counter_name, value_mb FROM nodes WHERE id IS NOT NULL
  UNION ALL
  SELECT server_id, snapshot_ts, p.id, p.parent_id, 'Used Workspace Memory', CAST(SUM(used_memory_kb) AS DOUBLE) / 1024
  FROM v_grants, (VALUES (1221, 1220), (1111, 1110)) AS p(id, parent_id) GROUP BY 1, 2, 3, 4),
tree AS (
  SELECT * FROM base UNION ALL
  SELECT server_id, snapshot_ts, 1222, 1220, '<Other Memory Clerks>',
    SUM(CASE WHEN id = 1220 THEN value_mb END) - SUM(CASE WHEN parent_id = 1220 THEN value_mb END)
  FROM base GROUP BY 1, 2 HAVING SUM(CASE WHEN parent_id = 1220 THEN value_mb END) IS NOT NULL)
"""


def _norm(t):
    return WL.normalise_counters(t("memory_counters"))


@query("join_drop_superseded", NORMAL_SQL + " SELECT server_id, snapshot_ts, object_name, counter_name, instance_name, value_mb FROM kept")
def _(t):
    return J.join_drop_superseded(_norm(t)).select("server_id", "snapshot_ts", "object_name", "counter_name", "instance_name", "value_mb")


@query("join_rename_map", NORMAL_SQL + " SELECT server_id, snapshot_ts, object_name, counter_name, instance_name, value_mb FROM renamed")
def _(t):
    names = literal_table(t.spark, WL.COUNTER_RENAMES, "old_name string, new_name string")
    return J.join_rename_map(J.join_drop_superseded(_norm(t)), names).select(
        "server_id", "snapshot_ts", "object_name", "counter_name", "instance_name", "value_mb"
    )


@query("join_not_in_null_safe", """
SELECT server_id, index_name, table_name, used_pages FROM v_index_sizes z WHERE index_name IS NOT NULL AND index_name NOT IN (
  SELECT index_name FROM v_command_log l WHERE l.server_id = z.server_id AND index_name IS NOT NULL AND command_type = 'BACKUP_DATABASE' AND error_number = 3201)""")
def _(t):
    # A NULL among the excluded names must not empty the result.
    logged = t("command_log").filter("command_type = 'BACKUP_DATABASE'").withColumn(
        "index_name", F.expr("CASE WHEN error_number = 3201 THEN index_name END")
    )
    return J.join_not_in_null_safe(t("index_sizes"), logged, "index_name")


@query("join_update_from", """
SELECT d.server_id, d.database_name, CASE WHEN b.database_name IS NULL THEN d.start_position ELSE b.n END AS start_position
FROM v_databases d LEFT JOIN (SELECT database_name, COUNT(*) AS n FROM v_backupset GROUP BY 1) b USING (database_name)""")
def _(t):
    target = t("databases").select("server_id", "database_name", "start_position")
    updates = t("backupset").groupBy("database_name").agg(F.count(F.lit(1)).alias("start_position"))
    return J.join_update_from(target, updates, ["database_name"], ["start_position"])


@query("join_scalar_counts", """
WITH g AS (SELECT DISTINCT server_id, concat(CAST(schema_id AS STRING), '.', table_name) AS object_id FROM v_table_stats)
SELECT server_id, object_id, (SELECT COUNT(*) FROM v_stat_indexes i WHERE i.server_id = g.server_id AND i.object_id = g.object_id) AS index_count,
  (SELECT COUNT(*) FROM v_stat_columns c WHERE c.server_id = g.server_id AND c.object_id = g.object_id) AS column_count FROM g""")
def _(t):
    tables = t("table_stats").select("server_id", F.concat_ws(".", F.col("schema_id").cast("string"), "table_name").alias("object_id")).distinct()
    return J.join_scalar_counts(tables, t("stat_indexes"), t("stat_columns"))


ASOF_SQL = """
WITH safe AS (
  SELECT c.server_id, c.database_name, c.base_lsn, c.backup_type, MAX(b.backup_start_date) AS latest_safe FROM v_log_chains c LEFT JOIN v_backupset b
    ON b.server_id = c.server_id AND b.database_name = c.database_name AND NOT b.is_damaged AND (b.type IN ('D', 'I') OR (b.type = 'L' AND b.last_lsn < c.base_lsn))
  GROUP BY 1, 2, 3, 4)
"""


@query("join_asof_state", ASOF_SQL + "SELECT * FROM safe")
def _(t):
    return J.join_asof_state(t("log_chains"), t("backupset"))


# ---- aggregates ------------------------------------------------------------
FULL_SQL = f"""
WITH full_files AS (
  SELECT b.server_id, b.database_name, b.backup_start_date, b.backup_finish_date, f.file_size FROM v_backupset b JOIN v_backupfile f USING (server_id, backup_set_id)
  WHERE b.type = 'D' AND f.file_type = 'D' AND b.database_name NOT IN {SYS} AND b.backup_start_date BETWEEN {O} - INTERVAL 1 YEAR AND {O})
"""
PIVOT_SQL = FULL_SQL + "SELECT server_id, database_name, " + ", ".join(
    f"ROUND(CAST(SUM(file_size) FILTER (WHERE m = {m}) AS DOUBLE) / COUNT(*) FILTER (WHERE m = {m}) / 1048576, 1) AS m{m}" for m in range(13)
) + f" FROM (SELECT *, date_diff('month', backup_start_date, {O}) AS m FROM full_files) GROUP BY 1, 2"
SPEED_SQL = FULL_SQL + """
SELECT server_id, database_name, size_mb, seconds, CASE WHEN seconds = 0 THEN NULL ELSE CAST(SUM(file_size) AS DOUBLE) / COUNT(*) / 1048576 / seconds END AS mb_per_sec
FROM (SELECT server_id, database_name, ROUND(file_size / 1048576, 1) AS size_mb, date_diff('second', backup_start_date, backup_finish_date) AS seconds, file_size FROM full_files)
GROUP BY 1, 2, 3, 4"""


@query("agg_monthly_average_pivot", PIVOT_SQL)
def _(t):
    return A.agg_monthly_average_pivot(t("backupset"), t("backupfile"), AS_OF_ORDERS)


@query("backup_size_pivot", PIVOT_SQL)
def _(t):
    return WL.backup_size_pivot(t("backupset"), t("backupfile"), AS_OF_ORDERS)


@query("agg_throughput", SPEED_SQL)
def _(t):
    return A.agg_throughput(t("backupset"), t("backupfile"), AS_OF_ORDERS)


@query("backup_speed", SPEED_SQL)
def _(t):
    return WL.backup_speed(t("backupset"), t("backupfile"), AS_OF_ORDERS)


@query("agg_free_space_share", """
SELECT server_id, object_name, type_desc, COUNT(*) AS pages, COUNT(*) * 8 / 1024 AS mb, SUM(free_space_in_bytes) / 1048576 AS free_mb,
  ROUND((SUM(free_space_in_bytes) / 1048576) / (COUNT(*) * 8 / 1024) * 100, 2) AS free_pct FROM v_buffer_pages GROUP BY 1, 2, 3""")
def _(t):
    return A.agg_free_space_share(t("buffer_pages"))


COST_SQL = f"""
WITH runs AS (SELECT server_id, index_name, command_type AS command, MAX(date_diff('second', start_time, end_time)) AS seconds FROM v_command_log
  WHERE command_type LIKE '%INDEX%' AND database_name NOT IN {SYS} GROUP BY 1, 2, 3)
SELECT server_id, z.table_name, index_name, r.command, SUM(z.used_pages) * 8 / 1024 AS mb, MAX(r.seconds) AS max_seconds
FROM v_index_sizes z JOIN runs r USING (server_id, index_name) GROUP BY 1, 2, 3, 4"""


@query("agg_record_duration", """
SELECT server_id, z.table_name, index_name, r.command, SUM(z.used_pages) * 8 / 1024 AS mb, MAX(r.seconds) AS max_seconds
FROM v_index_sizes z JOIN (SELECT server_id, index_name, command_type AS command, SUM(date_diff('second', start_time, end_time))::BIGINT AS seconds FROM v_command_log GROUP BY 1, 2, 3) r USING (server_id, index_name) GROUP BY 1, 2, 3, 4""")
def _(t):
    from fleetwatch.functions.semantics import seconds_between

    runs = t("command_log").groupBy("server_id", "index_name", F.col("command_type").alias("command")).agg(
        F.sum(seconds_between("start_time", "end_time")).alias("seconds")
    )
    return A.agg_record_duration(t("index_sizes").join(runs, ["server_id", "index_name"]))


@query("index_maintenance_cost", COST_SQL)
def _(t):
    return WL.index_maintenance_cost(t("command_log"), t("index_sizes"))


RATIO_SQL = """SELECT server_id, schema_id, table_name, MAX(row_count) AS row_count, MAX(modification_counter) AS mods, COUNT(*) AS stat_count FROM v_table_stats
GROUP BY 1, 2, 3 HAVING MAX(row_count) > 500 AND MAX(modification_counter) > MAX(row_count) * 0.2 + 500"""


@query("agg_having_ratio", RATIO_SQL)
def _(t):
    return A.agg_having_ratio(t("table_stats"))


@query("agg_having_latest_age", f"""
SELECT server_id, database_name, MAX(backup_finish_date) AS last_full, date_diff('hour', MAX(backup_finish_date), {O}) AS hours FROM v_backupset WHERE type = 'D'
GROUP BY 1, 2 HAVING MAX(backup_finish_date) < {O} - INTERVAL 24 HOUR AND MAX(backup_finish_date) > {O} - INTERVAL 240 HOUR""")
def _(t):
    return A.agg_having_latest_age(t("backupset"), AS_OF_ORDERS, 24, 240)


@query("agg_having_distinct", """
SELECT server_id, database_name, data_space_id FROM v_database_files WHERE type_desc = 'ROWS' GROUP BY 1, 2, 3
HAVING COUNT(DISTINCT growth) > 1 OR COUNT(DISTINCT is_percent_growth) > 1""")
def _(t):
    return A.agg_having_distinct(t("database_files").filter("type_desc = 'ROWS'"), ["server_id", "database_name", "data_space_id"], ["growth", "is_percent_growth"])


@query("agg_having_multi", "SELECT server_id, service_account, COUNT(*) AS n FROM v_services GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(t):
    return A.agg_having_multi(t("services"), ["server_id", "service_account"])


VARCHAR_SQL = """SELECT server_id, schema_name, table_name, COUNT(*) FILTER (WHERE type_name = 'varchar' AND max_length = 255) AS num_cols FROM v_type_columns GROUP BY 1, 2, 3
HAVING COUNT(*) FILTER (WHERE type_name = 'varchar' AND max_length = 255) > 1"""


@query("agg_conditional_count", VARCHAR_SQL)
def _(t):
    return A.agg_conditional_count(t("type_columns"))


@query("wide_varchar_tables", VARCHAR_SQL)
def _(t):
    return WL.wide_varchar_tables(t("type_columns"))


SIGNAL_SQL = "SELECT server_id, CAST(SUM(signal_wait_time_ms) AS DOUBLE) * 100 / SUM(wait_time_ms) AS pct FROM v_wait_stats GROUP BY 1"


@query("agg_ratio_of_sums", SIGNAL_SQL)
def _(t):
    return A.agg_ratio_of_sums(t("wait_stats"), "signal_wait_time_ms", "wait_time_ms")


@query("wait_signal_ratio", SIGNAL_SQL)
def _(t):
    return WL.wait_signal_ratio(t("wait_stats"))


@query("agg_coalesced_category", "SELECT server_id, COALESCE(alloc_unit_name, operation) AS category, CAST(SUM(record_length) AS BIGINT) AS bytes FROM v_log_records GROUP BY 1, 2")
def _(t):
    return A.agg_coalesced_category(t("log_records"))


@query("log_write_share", """
WITH g AS (SELECT server_id, COALESCE(alloc_unit_name, operation) AS category, CAST(SUM(record_length) AS BIGINT) AS bytes FROM v_log_records GROUP BY 1, 2)
SELECT *, CAST(bytes AS DOUBLE) * 100 / SUM(bytes) OVER (PARTITION BY server_id) AS pct FROM g""")
def _(t):
    return WL.log_write_share(t("log_records"))


@query("agg_distinct_rows", "SELECT DISTINCT server_id, database_name FROM v_volumes")
def _(t):
    return A.agg_distinct_rows(t("volumes"), ["server_id", "database_name"])


@query("agg_dedupe_group_all", "SELECT DISTINCT server_id, process_info, text FROM v_error_log")
def _(t):
    return A.agg_dedupe_group_all(t("error_log").select("server_id", "process_info", "text"))


@query("agg_string_list", """
WITH k AS (SELECT *, (row_number() OVER (PARTITION BY server_id ORDER BY database_name) - 1) // 1000 AS chunk_no FROM (SELECT DISTINCT server_id, database_name FROM v_backupset))
SELECT server_id, chunk_no, string_agg(database_name, ', ' ORDER BY database_name) AS names, COUNT(*) AS n FROM k GROUP BY 1, 2""")
def _(t):
    return A.agg_string_list(t("backupset"), ["server_id"], "database_name")


OCC = ("%SQL Server was unable%", "%failed to start%", "%terminating a system%")


@query("agg_occurrence_summary", "SELECT p.pattern, COUNT(*) AS n, MIN(log_date) AS first_ts, MAX(log_date) AS last_ts FROM v_error_log JOIN (VALUES "
       + ", ".join(f"('{p}')" for p in OCC) + ") AS p(pattern) ON text ILIKE p.pattern GROUP BY 1")
def _(t):
    return A.agg_occurrence_summary(t("error_log"), OCC)


@query("agg_count_over_threshold", "SELECT c_ip, COUNT(*) AS n FROM v_access_log WHERE sc_status >= 400 GROUP BY 1 HAVING COUNT(*) > 10")
def _(t):
    return A.agg_count_over_threshold(t("access_log").filter("sc_status >= 400"), "c_ip", 10)


@query("agg_extent_totals", """
SELECT server_id, database_name, CAST(SUM(allocated_extent_page_count) AS BIGINT) AS allocated, CAST(SUM(modified_extent_page_count) AS BIGINT) AS modified,
  CAST(SUM(modified_extent_page_count) AS DOUBLE) / SUM(allocated_extent_page_count) * 100 AS change_pct FROM v_extents GROUP BY 1, 2""")
def _(t):
    return A.agg_extent_totals(t("extents"))


@query("agg_two_level", """
SELECT server_id, c AS cpus_per_node, COUNT(*) AS nodes FROM (SELECT server_id, node_id, COUNT(*) AS c FROM v_schedulers GROUP BY 1, 2) GROUP BY 1, 2""")
def _(t):
    return A.agg_two_level(t("schedulers"))


def _tree(t):
    return WL.memory_tree(t("memory_counters"), t("grants"))


TREE_COLS = "server_id, snapshot_ts, id, parent_id, counter_name, ROUND(value_mb, 3) AS value_mb"


def _tree_out(df):
    return df.withColumn("value_mb", F.round("value_mb", 3))


@query("agg_residual", NORMAL_SQL + f" SELECT {TREE_COLS} FROM tree WHERE counter_name = '<Other Memory Clerks>'")
def _(t):
    return _tree_out(_tree(t)).filter("counter_name = '<Other Memory Clerks>'")


@query("memory_tree", NORMAL_SQL + f" SELECT {TREE_COLS} FROM tree")
def _(t):
    return _tree_out(_tree(t))


@query("memory_history", NORMAL_SQL + f" SELECT server_id, snapshot_ts, id, counter_name, ROUND(value_mb, 3) AS value_mb, {E} AS point_of_time FROM tree WHERE counter_name IN ("
       + ", ".join(f"'{n}'" for n in WL.MEMORY_TREE_NAMES) + ")")
def _(t):
    return _tree_out(WL.memory_history(_tree(t), AS_OF_EVENTS))


@query("agg_size_total", """
SELECT server_id, COUNT(DISTINCT database_name) AS databases, ROUND(SUM(size_pages) * 8 / 1024 / 1024, 2) AS total_gb FROM v_database_files GROUP BY 1""")
def _(t):
    return A.agg_size_total(t("database_files"))


# ---- sets ------------------------------------------------------------------
@query("set_union_all", """
SELECT server_id, database_name, event_time, 'suspect' AS what FROM v_suspect_pages UNION ALL SELECT server_id, database_name, event_time, NULL FROM v_page_repairs""")
def _(t):
    return A.set_union_all(t("suspect_pages").withColumn("what", F.lit("suspect")), t("page_repairs"))


@query("set_union_distinct", "SELECT server_id, database_name FROM v_suspect_pages UNION SELECT server_id, database_name FROM v_page_repairs")
def _(t):
    cols = ["server_id", "database_name"]
    return A.set_union_distinct(t("suspect_pages").select(*cols), t("page_repairs").select(*cols))


@query("set_difference", "SELECT server_id, database_name FROM v_databases EXCEPT SELECT server_id, database_name FROM v_suspect_pages")
def _(t):
    cols = ["server_id", "database_name"]
    return A.set_difference(t("databases").select(*cols), t("suspect_pages").select(*cols))


# ---- windows and top-k -----------------------------------------------------
@query("win_share_of_total", "SELECT *, CAST(wait_time_ms AS DOUBLE) * 100 / SUM(wait_time_ms) OVER (PARTITION BY server_id) AS pct FROM v_wait_stats")
def _(t):
    return W.win_share_of_total(t("wait_stats"), "wait_time_ms")


@query("win_rank_desc", "SELECT server_id, event_id, bytes_sent, row_number() OVER (PARTITION BY server_id ORDER BY bytes_sent DESC, event_id) AS rn FROM v_access_log")
def _(t):
    return W.win_rank_desc(t("access_log").select("server_id", "event_id", "bytes_sent"), "bytes_sent", "event_id")


@query("win_latest_per_partition", """
SELECT database_name, id, command_type, start_time, error_number FROM (SELECT *, row_number() OVER (PARTITION BY database_name ORDER BY id DESC) AS rn FROM v_command_log) WHERE rn = 1""")
def _(t):
    return W.win_latest_per_partition(t("command_log").select("database_name", "id", "command_type", "start_time", "error_number"), "database_name", ["id"])


@query("win_directory_number", """
WITH d AS (SELECT *, row_number() OVER (PARTITION BY mirror ORDER BY id) AS dir_no, COUNT(*) OVER (PARTITION BY mirror) AS dirs FROM v_directories),
s AS (SELECT *, 3000 // dirs AS per_dir FROM d)
SELECT mirror, id, directory_path, dir_no, unnest(generate_series((dir_no - 1) * per_dir + 1, dir_no * per_dir)) AS file_no FROM s WHERE per_dir >= 1""")
def _(t):
    return W.win_directory_number(t("directories"), 3000)


@query("win_total_rows", "SELECT *, COUNT(*) OVER (PARTITION BY server_id) AS n FROM v_wait_stats")
def _(t):
    return W.win_total_rows(t("wait_stats"))


def _plan(t):
    return t("databases").select("server_id", "database_name", "database_size", "log_size", "start_position", "last_good_check", "est_seconds")


PLAN_COLS = "server_id, database_name, database_size, log_size, start_position, last_good_check, est_seconds"


@query("win_plan_order", f"SELECT {PLAN_COLS}, row_number() OVER (PARTITION BY server_id ORDER BY database_size DESC, database_name) AS plan_order FROM v_databases")
def _(t):
    return W.win_plan_order(_plan(t), "SIZE_DESC")


@query("mnt_plan_order", f"SELECT {PLAN_COLS}, row_number() OVER (PARTITION BY server_id ORDER BY last_good_check ASC NULLS FIRST, database_name) AS plan_order FROM v_databases")
def _(t):
    from fleetwatch.operators.maintenance import mnt_plan_order

    return mnt_plan_order(_plan(t), "DATABASE_LAST_GOOD_CHECK_ASC")


@query("win_object_order", """
SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY resumable DESC, start_position, schema_name, object_name, (index_type IS NULL), index_type, index_name, statistics_name, partition_number) AS plan_order
FROM v_plan_objects""")
def _(t):
    return W.win_object_order(t("plan_objects"))


SPEC = "INDEX_REORGANIZE, INDEX_REBUILD_ONLINE,INDEX_REBUILD_OFFLINE"


@query("win_action_priority", """
WITH p AS (SELECT p_partkey, concat(p_brand, ', ', p_type, ',', p_name) AS spec FROM part)
SELECT p_partkey, CAST(i AS BIGINT) AS priority, regexp_replace(string_split(spec, ',')[i], '\\s+', '', 'g') AS action
FROM (SELECT *, unnest(generate_series(1, len(string_split(spec, ',')))) AS i FROM p)""".replace("\\\\", "\\"))
def _(t):
    p = t.table("part").select("p_partkey", F.concat("p_brand", F.lit(", "), "p_type", F.lit(","), "p_name").alias("spec"))
    return W.win_action_priority(p, "spec", "p_partkey")


@query("win_min_position", "SELECT name, MIN(start_position) AS start_position FROM (SELECT database_name AS name, o_orderkey % 1000 + 5 AS start_position FROM (SELECT *, concat('db_', CAST(o_custkey AS STRING)) AS database_name FROM orders)) GROUP BY 1")
def _(t):
    m = t.table("orders").select(F.concat(F.lit("db_"), F.col("o_custkey").cast("string")).alias("name"), (F.col("o_orderkey") % 1000 + 5).alias("start_position"))
    return W.win_min_position(m)


@query("win_last_in_list", "SELECT server_id, backup_set_id, file_number, file_size, file_number = MAX(file_number) OVER (PARTITION BY server_id, backup_set_id) AS is_last FROM v_backupfile")
def _(t):
    return W.win_last_in_list(t("backupfile").select("server_id", "backup_set_id", "file_number", "file_size"), "backup_set_id", "file_number")


def _topk_sql(value, k, extra=""):
    return f"SELECT * {extra} FROM (SELECT *, row_number() OVER (PARTITION BY server_id, database_name ORDER BY {value} DESC, object_name) AS rn FROM v_index_operational) o WHERE rn <= {k}"


@query("top_lock_escalations", _topk_sql("index_lock_promotion_count", 3))
def _(t):
    return W.top_lock_escalations(t("index_operational"))


@query("top_page_lock_waits", _topk_sql("page_lock_wait_count", 3, ", CASE WHEN EXISTS (SELECT 1 FROM v_missing_index m WHERE m.server_id = o.server_id AND m.database_name = o.database_name AND m.object_name = o.object_name) THEN 'Y' ELSE 'N' END AS missing_index"))
def _(t):
    return W.top_page_lock_waits(t("index_operational"), t("missing_index"))


@query("top_page_splits", _topk_sql("leaf_allocation_count", 10))
def _(t):
    return W.top_page_splits(t("index_operational"))


@query("top_processes", """
SELECT 'cpu' AS metric, * FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY cpu DESC, process_id) AS rn FROM v_processes) WHERE rn <= 3
UNION ALL
SELECT 'memory' AS metric, * FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY working_set DESC, process_id) AS rn FROM v_processes) WHERE rn <= 3""")
def _(t):
    p = t("processes")
    by_cpu = W.top_processes(p, "cpu").withColumn("metric", F.lit("cpu"))
    return by_cpu.unionByName(W.top_processes(p, "working_set").withColumn("metric", F.lit("memory")))


@query("top_peak_sample", """
WITH p AS (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY cntr_value DESC, check_date DESC, sample_id DESC) AS rn FROM v_perf_counters WHERE counter_name = 'User Connections')
SELECT p.server_id, p.cntr_value AS peak_value, p.check_date, c.cntr_value AS companion_value FROM p
LEFT JOIN v_perf_counters c ON c.server_id = p.server_id AND c.sample_id = p.sample_id AND c.counter_name = 'Connection Memory (KB)' WHERE rn = 1""")
def _(t):
    return W.top_peak_sample(t("perf_counters"), "User Connections", "Connection Memory (KB)")


@query("top_latest_n", """
SELECT server_id, event_time, deadlock_graph, rn FROM (SELECT *, row_number() OVER (PARTITION BY server_id ORDER BY event_time DESC, deadlock_graph DESC) AS rn FROM v_deadlocks) WHERE rn <= 5""")
def _(t):
    return W.top_latest_n(t("deadlocks"), "event_time", 5, "deadlock_graph")


# ---- scalars ---------------------------------------------------------------
@query("fn_between_delimiters", "SELECT conv_id, turn, text, split_part(text, ':', 2) AS parsed FROM v_messages WHERE text LIKE '%:%:%'")
def _(t):
    return SC.fn_between_delimiters(t("messages"), "text")


@query("fn_first_word", "SELECT conv_id, turn, substring(text, 1, strpos(text, ' ')) AS first_word FROM v_messages")
def _(t):
    return SC.fn_first_word(t("messages"), "text").drop("text")


@query("fn_string_cleanup", r"SELECT server_id, snapshot_ts, counter_name, regexp_replace(rtrim(counter_name), ' pages| \(KB\)| \(MB\)', '', 'gi') AS cleaned FROM v_memory_counters")
def _(t):
    return SC.fn_string_cleanup(t("memory_counters"), "counter_name").select("server_id", "snapshot_ts", "counter_name", "cleaned")


@query("fn_split_list", """
SELECT record_id, CAST(i AS BIGINT) AS pos, string_split(l, ',')[i] AS item FROM (
  SELECT record_id, l, unnest(generate_series(1, len(string_split(l, ',')))) AS i FROM (SELECT record_id, array_to_string(replacement_strings, ',') AS l FROM v_os_events))""")
def _(t):
    e = t("os_events").select("record_id", F.array_join("replacement_strings", ",").alias("l"))
    return SC.fn_split_list(e, "l").drop("l")


@query("fn_parse_name", """
WITH n AS (SELECT p_partkey, concat(CASE WHEN p_size % 3 = 0 THEN 'srv1.' ELSE '' END, CASE WHEN p_size % 2 = 0 THEN '[db].' ELSE 'db2.' END, 'dbo.', p_brand) AS name FROM part)
SELECT p_partkey, name, string_split(replace(replace(name, '[', ''), ']', ''), '.')[-1] AS object_part, string_split(replace(replace(name, '[', ''), ']', ''), '.')[-2] AS schema_part,
  string_split(replace(replace(name, '[', ''), ']', ''), '.')[-3] AS database_part, string_split(replace(replace(name, '[', ''), ']', ''), '.')[-4] AS server_part FROM n""")
def _(t):
    n = t.table("part").select("p_partkey", F.expr("concat(CASE WHEN p_size % 3 = 0 THEN 'srv1.' ELSE '' END, CASE WHEN p_size % 2 = 0 THEN '[db].' ELSE 'db2.' END, 'dbo.', p_brand)").alias("name"))
    return SC.fn_parse_name(n, "name")


@query("fn_template", """
SELECT database_name, concat(server_id, '/', database_name, '/', CASE WHEN database_type = 'S' THEN 'FULL' ELSE 'LOG_COPY_ONLY' END, '/', database_name, '_2024W05.bak') AS path
FROM v_databases""")
def _(t):
    from fleetwatch.functions.semantics import ts

    tokens = {
        "ServerName": F.col("server_id"),
        "InstanceName": F.lit(None).cast("string"),
        "DatabaseName": F.col("database_name"),
        "BackupType": F.when(F.col("database_type") == "S", "FULL").otherwise("LOG"),
        "Partial": F.lit(""),
        "CopyOnly": F.when(F.col("database_type") != "S", "COPY_ONLY"),
        "FileExtension": F.lit("bak"),
        **SC.time_tokens(ts(AS_OF_EVENTS)),
    }
    template = "{ServerName}${InstanceName}{DirectorySeparator}{DatabaseName}{DirectorySeparator}{BackupType}_{Partial}_{CopyOnly}{DirectorySeparator}{DatabaseName}_{Year}W{Week}_{Partial}.{FileExtension}"
    return SC.fn_template(t("databases"), template, tokens).select("database_name", "path")


@query("fn_unit_conversion", "SELECT server_id, snapshot_ts, counter_name, cntr_value, CASE WHEN counter_name ILIKE '%pages' THEN cntr_value / 128 WHEN counter_name ILIKE '%(KB)' THEN cntr_value / 1024 ELSE CAST(cntr_value AS DOUBLE) END AS value_mb FROM v_memory_counters")
def _(t):
    return SC.fn_unit_conversion(t("memory_counters"), "counter_name", "cntr_value").select("server_id", "snapshot_ts", "counter_name", "cntr_value", "value_mb")


@query("fn_packed_datetime", """
SELECT job_id, last_run_date, last_run_time, CASE WHEN last_run_date <> 0 THEN strptime(concat(last_run_date, lpad(CAST(last_run_time AS VARCHAR), 6, '0')), '%Y%m%d%H%M%S') END AS run_ts FROM v_job_steps""")
def _(t):
    return SC.fn_packed_datetime(t("job_steps").select("job_id", "last_run_date", "last_run_time"), "last_run_date", "last_run_time")


@query("fn_packed_duration", """
SELECT job_id, last_run_duration, concat(substr(d, 1, 2), ':', substr(d, 3, 2), ':', substr(d, 5, 2)) AS duration FROM (
  SELECT job_id, last_run_duration, lpad(CAST(last_run_duration AS VARCHAR), 6, '0') AS d FROM v_job_steps)""")
def _(t):
    return SC.fn_packed_duration(t("job_steps").select("job_id", "last_run_duration"), "last_run_duration")


@query("fn_datediff_boundary", f"""
SELECT backup_set_id, date_diff('second', backup_start_date, backup_finish_date) AS ss, date_diff('minute', backup_start_date, backup_finish_date) AS mi,
  date_diff('hour', backup_finish_date, {O}) AS hh, date_diff('day', backup_finish_date, {O}) AS dd, date_diff('month', backup_finish_date, {O}) AS mm FROM v_backupset""")
def _(t):
    from fleetwatch.functions.semantics import ts

    b = t("backupset").select("backup_set_id", "backup_start_date", "backup_finish_date")
    for unit, out, lo, hi in (
        ("SECOND", "ss", "backup_start_date", "backup_finish_date"),
        ("MINUTE", "mi", "backup_start_date", "backup_finish_date"),
        ("HOUR", "hh", "backup_finish_date", ts(AS_OF_ORDERS)),
        ("DAY", "dd", "backup_finish_date", ts(AS_OF_ORDERS)),
        ("MONTH", "mm", "backup_finish_date", ts(AS_OF_ORDERS)),
    ):
        b = SC.fn_datediff_boundary(b, unit, lo, hi, out)
    return b.drop("backup_start_date", "backup_finish_date")


@query("fn_elapsed_label", """
SELECT o_orderkey, concat(CASE WHEN x >= 86400 THEN concat(x // 86400, '.') ELSE '' END, lpad(CAST(x % 86400 // 3600 AS VARCHAR), 2, '0'), ':',
  lpad(CAST(x % 3600 // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(x % 60 AS VARCHAR), 2, '0')) AS elapsed FROM (SELECT o_orderkey, (o_orderkey * 37) AS x FROM orders)""")
def _(t):
    return SC.fn_elapsed_label(t.table("orders").select("o_orderkey", (F.col("o_orderkey") * 37).alias("x")), "x").drop("x")


@query("fn_boot_time", f"SELECT server_id, {E} - to_seconds(ms_ticks // 1000) AS boot_time FROM v_servers")
def _(t):
    return SC.fn_boot_time(t("servers").select("server_id", "ms_ticks"), "ms_ticks", AS_OF_EVENTS).drop("ms_ticks")


@query("fn_message_format", "SELECT server_id, database_name, concat('database ', database_name, ' has ', database_size, ' bytes') AS message FROM v_databases")
def _(t):
    d = t("databases").select("server_id", "database_name", "database_size")
    return SC.fn_message_format(d, "database %s has %d bytes", ["database_name", "database_size"]).drop("database_size")


@query("fn_localised_date", "SELECT o_orderkey, concat(dayname(o_orderdate), ', ', day(o_orderdate), '. ', monthname(o_orderdate), ' ', year(o_orderdate)) AS long_date FROM orders")
def _(t):
    return SC.fn_localised_date(t.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("fn_version_compare", """
SELECT server_id, product_version, CAST(string_split(product_version, '.') AS INT[]) >= [11, 0, 7001, 0] AS at_least FROM v_servers""")
def _(t):
    v = t("servers").select("server_id", "product_version", F.lit("11.0.7001.0").alias("other"))
    return SC.fn_version_compare(v, "product_version", "other").drop("other")


@query("fn_null_handling", "SELECT COALESCE(NULLIF(alloc_unit_name, ''), NULLIF(operation, '')) AS first_known, record_length FROM v_log_records")
def _(t):
    return SC.fn_null_handling(t("log_records"), ["alloc_unit_name", "operation"]).select("first_known", "record_length")


@query("fn_xml_extract", "SELECT event_time, CAST(regexp_extract(deadlock_graph, 'id=\"([0-9]+)\"', 1) AS VARCHAR) AS extracted FROM v_deadlocks")
def _(t):
    return SC.fn_xml_extract(t("deadlocks"), "deadlock_graph", "deadlock/@id").select("event_time", "extracted")


@query("fn_xml_build", "SELECT index_name, concat('{\"page_count\":', page_count, ',\"index_type\":', index_type, '}') AS extended_info FROM v_index_objects")
def _(t):
    return SC.fn_xml_build(t("index_objects"), ["page_count", "index_type"]).select("index_name", "extended_info")


@query("fn_drive_letter", "SELECT file_id, upper(left(physical_name, 1)) AS drive FROM v_database_files")
def _(t):
    return SC.fn_drive_letter(t("database_files"), "physical_name").select("file_id", "drive")


# ---- workload --------------------------------------------------------------
@query("wait_stats", f"""
SELECT server_id, wait_type, wait_time_ms / 1000 AS wait_seconds, waiting_tasks_count AS tasks, CAST(wait_time_ms AS DOUBLE) * 100 / SUM(wait_time_ms) OVER (PARTITION BY server_id) AS pct
FROM v_wait_stats WHERE wait_type NOT IN {BENIGN_SQL} AND wait_time_ms >= 1""")
def wait_stats_query(t):
    return WL.wait_stats(t("wait_stats"), BENIGN)


TOP_WAIT_SQL = f"""
WITH w AS (SELECT *, CAST(wait_time_ms AS DOUBLE) * 100 / SUM(wait_time_ms) OVER (PARTITION BY server_id) AS pct,
  row_number() OVER (PARTITION BY server_id ORDER BY wait_time_ms DESC, wait_type) AS rn FROM v_wait_stats WHERE wait_type NOT IN {BENIGN_SQL})
"""


@query("wait_top_cause", TOP_WAIT_SQL + f"SELECT w.server_id, w.wait_type, wait_time_ms / 1000 AS seconds, pct, COALESCE(c.cause, 'unknown, to be analysed') AS cause FROM w LEFT JOIN {CAUSES_SQL} ON c.wait_type = w.wait_type WHERE rn = 1")
def _(t):
    return WL.wait_top_cause(t("wait_stats"), literal_table(t.spark, CAUSES, "wait_type string, cause string"), BENIGN)


@query("integrity_check_speed", f"""
WITH newest AS (SELECT server_id, database_name, max(struct_pack(d := backup_start_date, b := backup_set_id)).b AS backup_set_id FROM v_backupset WHERE type = 'D'
  AND backup_start_date BETWEEN {O} - INTERVAL 1 YEAR AND {O} GROUP BY 1, 2),
sizes AS (SELECT server_id, database_name, CAST(SUM(file_size) AS BIGINT) AS file_size FROM newest JOIN v_backupfile USING (server_id, backup_set_id) WHERE file_type = 'D' GROUP BY 1, 2),
r AS (SELECT server_id, database_name, s.file_size, date_diff('second', c.start_time, c.end_time) AS seconds FROM v_command_log c JOIN sizes s USING (server_id, database_name)
  WHERE c.command_type = 'DBCC_CHECKDB' AND c.database_name NOT IN {SYS})
SELECT server_id, database_name, ROUND(file_size / 1048576, 1) AS size_mb, seconds, COUNT(*) AS runs, CASE WHEN seconds = 0 THEN NULL ELSE file_size / 1048576 / seconds END AS mb_per_sec
FROM r GROUP BY server_id, database_name, file_size, seconds""")
def _(t):
    return WL.integrity_check_speed(t("command_log"), t("backupset"), t("backupfile"), AS_OF_ORDERS)


@query("cache_free_space", """
WITH own AS (SELECT a.server_id, a.allocation_unit_id, p.object_id FROM v_allocation a JOIN v_partitions p
  ON a.server_id = p.server_id AND ((a.container_id = p.hobt_id AND a.type IN (1, 3)) OR (a.container_id = p.partition_id AND a.type = 2)))
SELECT server_id, o.object_name, o.type_desc, COUNT(*) AS pages, COUNT(*) * 8 / 1024 AS mb, SUM(b.free_space_in_bytes) / 1048576 AS free_mb,
  ROUND((SUM(b.free_space_in_bytes) / 1048576) / (COUNT(*) * 8 / 1024) * 100, 2) AS free_pct
FROM v_buffer_pages b JOIN own USING (server_id, allocation_unit_id) JOIN v_objects o USING (server_id, object_id) WHERE NOT o.is_ms_shipped GROUP BY object_id, 1, 2, 3""")
def _(t):
    return WL.cache_free_space(t("buffer_pages"), t("allocation"), t("partitions"), t("objects"))


@query("index_usage", "SELECT *, user_seeks + user_scans + user_lookups = 0 AND user_updates > 0 AS unused FROM v_index_usage")
def _(t):
    return WL.index_usage(t("index_usage"))


@query("stale_stats_tables", f"""
WITH g AS (SELECT *, concat(CAST(schema_id AS STRING), '.', table_name) AS object_id FROM ({RATIO_SQL})),
c AS (SELECT server_id, object_id, MAX(CAST(is_clustered AS INT)) AS c, COUNT(*) AS n FROM v_stat_indexes GROUP BY 1, 2)
SELECT g.server_id, schema_id, table_name, g.object_id, COUNT(*) OVER (PARTITION BY g.server_id) AS no_of_occurrences, CASE c.c WHEN 1 THEN 'Clustered' WHEN 0 THEN 'Heap' ELSE 'Indexed View' END AS clustered_heap,
  CASE WHEN c.c = 0 THEN COALESCE(c.n, 0) - 1 ELSE COALESCE(c.n, 0) END AS index_count, (SELECT COUNT(*) FROM v_stat_columns k WHERE k.server_id = g.server_id AND k.object_id = g.object_id) AS column_count, stat_count, row_count, mods
FROM g LEFT JOIN c ON c.server_id = g.server_id AND c.object_id = g.object_id""")
def _(t):
    return WL.stale_stats_tables(t("table_stats"), t("stat_indexes"), t("stat_columns"))


@query("volume_free_space", "SELECT DISTINCT server_id, database_name, volume_mount_point, available_bytes // 1048576 AS free_mb FROM v_volumes")
def _(t):
    return WL.volume_free_space(t("volumes"))


@query("temp_file_layout", """
SELECT f.server_id, file_id, physical_name, size_pages, even_size FROM v_database_files f LEFT JOIN (
  SELECT server_id, MIN(size_pages) = MAX(size_pages) AS even_size FROM v_database_files WHERE database_name = 'tempdb' AND type_desc = 'ROWS' GROUP BY 1) e ON e.server_id = f.server_id
WHERE f.database_name = 'tempdb'""")
def _(t):
    return WL.temp_file_layout(t("database_files"))


@query("sharepoint_exclusion", """
WITH d AS (SELECT DISTINCT d.server_id, d.database_name FROM v_databases d WHERE database_name <> 'tempdb' AND NOT EXISTS (SELECT 1 FROM v_properties p
  WHERE p.server_id = d.server_id AND p.database_name = d.database_name AND p.property_name = 'isSharePointDatabase' AND p.property_value = '1')),
r AS (SELECT *, (row_number() OVER (PARTITION BY server_id ORDER BY database_name) - 1) // 1000 AS chunk_no FROM d)
SELECT server_id, chunk_no, string_agg(database_name, ', ' ORDER BY database_name) AS names, COUNT(*) AS n FROM r GROUP BY 1, 2""")
def _(t):
    return WL.sharepoint_exclusion(t("databases"), t("properties"))
