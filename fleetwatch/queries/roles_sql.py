"""Role views over the driver tables, in SQL that Spark and DuckDB both accept.

``{table}`` names a driver table.  Every view reads its whole tables; modulo
expressions only map keys to names, they never drop rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-08-02 00:00:00"

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def i(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def srv(expr: str) -> str:
    return f"concat('srv', {s(expr)})"


def db(expr: str) -> str:
    """Database name of a number; the first four are system databases."""
    return (
        f"CASE {expr} WHEN 0 THEN 'master' WHEN 1 THEN 'msdb' WHEN 2 THEN 'model' "
        f"WHEN 3 THEN 'tempdb' ELSE concat('db_', {s(expr)}) END"
    )


EV_SRV = srv("user_id % 3")
EV_DB = db("user_id % 50")
EV_DBSRV = srv("(user_id % 50) % 3")
PRODUCT = (
    "CASE {k} % 6 WHEN 0 THEN '10.0.6000.29' WHEN 1 THEN '11.0.7001.0' WHEN 2 THEN '12.0.5000.0' "
    "WHEN 3 THEN '13.0.4001.0' WHEN 4 THEN '14.0.3356.20' ELSE '9.0.5000.0' END"
)

ROLE_SQL: dict[str, str] = {
    "wait_stats": f"""
SELECT {EV_SRV} AS server_id, concat(event_type, '_', {s('user_id % 10')}) AS wait_type,
  {i('COUNT(*)')} AS waiting_tasks_count,
  {i('SUM(CAST(ROUND(value * 1000) AS BIGINT))')} AS wait_time_ms,
  {i('SUM(CASE WHEN event_id % 4 = 0 THEN CAST(ROUND(value * 1000) AS BIGINT) ELSE 0 END)')} AS signal_wait_time_ms
FROM {{events}} GROUP BY 1, 2""",
    "cpu_samples": f"""
SELECT {EV_SRV} AS server_id, ts AS event_time, CAST(FLOOR(value) AS INT) % 101 AS sql_cpu,
  CAST((user_id * 7) % 101 AS INT) AS other_cpu FROM {{events}}""",
    "memory_samples": f"""
SELECT {EV_SRV} AS server_id, event_id AS sample_id, {i('ROUND(value * 10)')} AS physical_used,
  user_id % 10 = 0 AS physical_low, (event_type = 'error' AND user_id % 4 = 0) AS virtual_low, ts AS event_time
FROM {{events}}""",
    "memory_counters": f"""
SELECT {srv('CAST(FLOOR(user_id / 15) AS BIGINT) % 3')} AS server_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS snapshot_ts,
  CASE WHEN user_id % 15 IN (4, 5, 6) THEN 'SQLServer:Buffer Manager' WHEN user_id % 15 IN (11, 12) THEN 'SQLServer:Plan Cache'
       WHEN user_id % 15 = 13 THEN 'SQLServer:Cursor Manager by Type' ELSE 'SQLServer:Memory Manager' END AS object_name,
  CASE user_id % 15 WHEN 0 THEN 'Target Server Memory (KB)' WHEN 1 THEN 'Total Server Memory (KB)'
       WHEN 2 THEN 'Maximum Workspace Memory (KB)' WHEN 3 THEN 'Granted Workspace Memory (KB)'
       WHEN 4 THEN 'Database pages' WHEN 5 THEN 'Free pages' WHEN 6 THEN 'Stolen pages'
       WHEN 7 THEN 'Stolen Server Memory (KB)' WHEN 8 THEN 'Connection Memory (KB)' WHEN 9 THEN 'Lock Memory (KB)'
       WHEN 10 THEN 'SQL Cache Memory (KB)' WHEN 11 THEN 'Cache Pages' WHEN 12 THEN 'Cache Pages'
       WHEN 13 THEN 'Cursor memory usage' ELSE 'Reserved Server Memory (KB)' END AS counter_name,
  CASE user_id % 15 WHEN 11 THEN 'SQL Plans' WHEN 12 THEN '_Total' WHEN 13 THEN '_Total' ELSE '' END AS instance_name,
  {i('SUM(CAST(ROUND(value * 1000) AS BIGINT))')} AS cntr_value
FROM {{events}} GROUP BY 1, 2, 3, 4, 5""",
    "grants": f"""
SELECT {srv('CAST(FLOOR(user_id / 15) AS BIGINT) % 3')} AS server_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS snapshot_ts,
  user_id AS used_memory_kb FROM {{events}}""",
    "memory_rows": f"""
SELECT {EV_SRV} AS server_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS snapshot_ts,
  concat(event_type, ' ', {s('user_id % 10')}) AS counter_name,
  CAST(SUM(CAST(ROUND(value) AS BIGINT)) AS DOUBLE) AS value_mb FROM {{events}} GROUP BY 1, 2, 3""",
    "error_log": f"""
SELECT event_id AS id, {EV_SRV} AS server_id, ts AS log_date, concat('spid', {s('user_id')}) AS process_info,
  CASE event_id % 11
    WHEN 0 THEN concat('Login failed for user ''u', {s('user_id')}, '''')
    WHEN 1 THEN 'Could not allocate space because the filegroup is full'
    WHEN 2 THEN 'SQL Server was unable to run a new system task'
    WHEN 3 THEN 'Endpoint failed to start'
    WHEN 4 THEN 'Server is terminating a system or background task'
    WHEN 5 THEN 'Dispatcher was unable to create new thread'
    WHEN 6 THEN 'There is insufficient system memory in resource pool'
    WHEN 7 THEN 'Memory allocation failure during connection establishment'
    WHEN 8 THEN 'Log was backed up'
    WHEN 9 THEN 'This is an informational message only, no user action is required'
    ELSE concat('Error: 9002, Severity: 17, State: ', {s('user_id')}) END AS text
FROM {{events}}""",
    "agent_log": f"""
SELECT {EV_SRV} AS server_id, ts AS log_date, {s('event_id % 3')} AS error_level,
  CASE event_id % 5 WHEN 0 THEN concat('[184] Job completion for ', {s('user_id')}, ' is being logged to sysjobhistory')
    WHEN 1 THEN 'Error: step failed' WHEN 2 THEN 'Fehler beim Starten' WHEN 3 THEN 'Neues Fehlerprotokoll'
    ELSE concat('[182] Job completion for error ', {s('user_id')}, ' is being logged to the eventlog') END AS text
FROM {{events}}""",
    "backupset": f"""
SELECT o_orderkey AS backup_set_id, {srv('(o_custkey % 50) % 3')} AS server_id, {db('o_custkey % 50')} AS database_name,
  CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' ELSE 'L' END AS type,
  o_orderdate AS backup_start_date,
  o_orderdate + (CAST(o_orderkey % 3600 AS INT)) * INTERVAL '1' SECOND AS backup_finish_date,
  o_orderkey % 97 = 0 AS is_damaged, o_orderkey AS last_lsn
FROM {{orders}}""",
    "backupfile": f"""
SELECT {srv('(o_custkey % 50) % 3')} AS server_id, l_orderkey AS backup_set_id, l_linenumber AS file_number,
  CASE l_returnflag WHEN 'A' THEN 'D' WHEN 'N' THEN 'L' ELSE 'F' END AS file_type,
  {i('FLOOR(l_extendedprice * 1000)')} AS file_size
FROM {{lineitem}} LEFT JOIN {{orders}} ON o_orderkey = l_orderkey""",
    "command_log": f"""
SELECT event_id AS id, {EV_DBSRV} AS server_id, {EV_DB} AS database_name, concat('ix_', {s('user_id')}) AS index_name,
  CASE event_type WHEN 'click' THEN 'ALTER_INDEX' WHEN 'view' THEN 'UPDATE_STATISTICS'
    WHEN 'purchase' THEN 'BACKUP_DATABASE' ELSE 'DBCC_CHECKDB' END AS command_type,
  concat('run ', event_type) AS command,
  ts AS start_time, ts + (CAST(FLOOR(value) AS INT)) * INTERVAL '1' SECOND AS end_time,
  CASE WHEN event_type = 'error' THEN CASE WHEN user_id % 2 = 0 THEN 8928 ELSE 1222 END
    WHEN event_type = 'purchase' AND event_id % 10 = 0 THEN 3201 ELSE 0 END AS error_number
FROM {{events}}""",
    "jobs": f"""
SELECT DISTINCT {EV_SRV} AS server_id, user_id AS job_id, concat('job_', {s('user_id')}) AS name, user_id % 9 <> 0 AS enabled,
  CASE user_id % 4 WHEN 0 THEN 'DEV' WHEN 1 THEN 'REF' WHEN 2 THEN 'PRO' ELSE 'OTHER' END AS environment FROM {{events}}""",
    "job_history": f"""
SELECT user_id AS job_id, CAST(event_id % 5 + 1 AS INT) AS step_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS run_status,
  CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) AS run_date,
  CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS INT) AS run_time, concat('failed at ', {s('event_id')}) AS message
FROM {{events}}""",
    "job_activity": """
SELECT user_id AS job_id, event_id % 7 AS session_id,
  CASE WHEN event_type = 'click' AND user_id % 5 = 0 THEN NULL ELSE ts END AS stop_execution_date FROM {events}""",
    "volumes": f"""
SELECT {srv('s_nationkey % 3')} AS server_id, {db('s_suppkey % 50')} AS database_name, concat('V', {s('s_suppkey')}, ':') AS volume_mount_point,
  {i('107374182400')} AS total_bytes, {i('FLOOR(ABS(s_acctbal) * 10737418)')} AS available_bytes FROM {{supplier}}""",
    "index_operational": f"""
SELECT {srv('l_suppkey % 3')} AS server_id, {db('l_suppkey % 50')} AS database_name, concat('t_', {s('l_partkey')}) AS object_name, {i('COUNT(*)')} AS leaf_allocation_count,
  {i('SUM(CAST(l_quantity AS BIGINT))')} AS page_lock_wait_count,
  {i("SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)")} AS index_lock_promotion_count
FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "missing_index": f"""
SELECT {srv('l_suppkey % 3')} AS server_id, {db('l_suppkey % 50')} AS database_name, concat('t_', {s('l_partkey')}) AS object_name FROM {{lineitem}}
WHERE CAST(ROUND(l_discount * 100) AS INT) >= 9""",
    "index_usage": f"""
SELECT concat('t_', {s('p_partkey')}) AS object_name, {db('p_partkey % 50')} AS database_name, p_brand AS index_name,
  {i('p_partkey % 4')} AS user_seeks, {i('p_partkey % 3')} AS user_scans, {i('p_partkey % 2')} AS user_lookups,
  {i('p_size')} AS user_updates FROM {{part}}""",
    "table_stats": f"""
SELECT {srv('p_partkey % 3')} AS server_id, CAST(p_size % 4 AS INT) AS schema_id, concat('t_', {s('p_partkey % 500')}) AS table_name, p_partkey AS stats_id,
  {i('p_size * 100')} AS row_count, {i('(p_partkey % 37) * 100')} AS modification_counter FROM {{part}}""",
    "stat_indexes": f"""
SELECT {srv('p_partkey % 3')} AS server_id, concat({s('p_size % 4')}, '.t_', {s('p_partkey % 500')}) AS object_id, p_partkey % 5 = 0 AS is_clustered FROM {{part}}""",
    "stat_columns": f"""
SELECT {srv('l_partkey % 3')} AS server_id, concat({s('l_linenumber % 4')}, '.t_', {s('l_partkey % 500')}) AS object_id, l_orderkey AS column_id FROM {{lineitem}}""",
    "type_columns": f"""
SELECT {srv('p_partkey % 3')} AS server_id, concat('s', {s('p_size % 4')}) AS schema_name, concat('t_', {s('p_partkey % 500')}) AS table_name,
  CASE WHEN p_size % 3 = 0 THEN 'int' ELSE 'varchar' END AS type_name, CASE p_size % 2 WHEN 0 THEN 255 ELSE 50 END AS max_length
FROM {{part}}""",
    "settings": f"""
SELECT {srv('l_suppkey')} AS server_id, {PRODUCT.format(k='l_suppkey')} AS product_version, l_suppkey % 4 = 0 AS is_clustered,
  l_suppkey % 5 = 0 AS uses_replication,
  CASE l_partkey % 13 WHEN 0 THEN 'xp_cmdshell' WHEN 1 THEN 'clr enabled' WHEN 2 THEN 'default trace enabled'
    WHEN 3 THEN 'backup compression default' WHEN 4 THEN 'Ole Automation Procedures' WHEN 5 THEN 'remote access'
    WHEN 6 THEN 'max degree of parallelism' WHEN 7 THEN 'max server memory (MB)' WHEN 8 THEN 'cost threshold for parallelism'
    WHEN 9 THEN 'remote admin connections' WHEN 10 THEN 'scan for startup procs' WHEN 11 THEN 'filestream access level'
    ELSE 'locks' END AS name,
  CASE l_partkey % 13 WHEN 6 THEN {i('l_suppkey % 12')} WHEN 7 THEN {i('4096 + (l_suppkey % 40) * 1024')}
    WHEN 8 THEN {i('l_suppkey % 9 - 8')} WHEN 11 THEN {i('l_suppkey % 4')}
    ELSE {i('(l_suppkey * (l_partkey % 13 + 1)) % 2')} END AS value_in_use,
  COUNT(*) AS samples
FROM {{lineitem}} GROUP BY 1, 2, 3, 4, 5, 6""",
    "principals": f"""
SELECT {srv('c_custkey % 3')} AS server_id, c_custkey AS principal_id, concat('s', {s('c_custkey')}) AS sid,
  CASE c_custkey % 20 WHEN 0 THEN concat('BUILTIN/g', {s('c_custkey')}) WHEN 1 THEN concat('HOST', {s('c_custkey % 3')}, '/g', {s('c_custkey')})
    ELSE c_name END AS name,
  concat('HOST', {s('c_custkey % 3')}) AS machine_name,
  CASE WHEN c_custkey % 20 < 2 THEN 'WINDOWS_GROUP' WHEN c_mktsegment = 'MACHINERY' THEN 'SERVER_ROLE' ELSE 'SQL_LOGIN' END AS type_desc,
  c_acctbal < 0 AS is_disabled, c_custkey % 7 <> 0 AS is_policy_checked, c_custkey % 4 <> 0 AS is_expiration_checked
FROM {{customer}}""",
    "permissions": f"""
SELECT {srv('o_custkey % 3')} AS server_id, {db('o_custkey % 50')} AS database_name, o_custkey AS grantee_principal_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'guest' WHEN 1 THEN 'public' ELSE concat('u', {s('o_custkey')}) END AS grantee_name,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CONTROL SERVER' WHEN '2-HIGH' THEN 'VIEW ANY DATABASE' WHEN '3-MEDIUM' THEN 'CONNECT'
    ELSE 'CONNECT SQL' END AS permission_name,
  CASE o_orderstatus WHEN 'P' THEN 'DENY' ELSE 'GRANT' END AS state_desc,
  CASE o_orderkey % 3 WHEN 0 THEN 'SERVER' ELSE 'ENDPOINT' END AS class_desc, {i('o_orderkey % 7')} AS major_id
FROM {{orders}}""",
    "login_permissions": f"""
SELECT {srv('(p_partkey * 2) % 3')} AS server_id, p_partkey * 2 AS grantee_principal_id,
  CASE WHEN p_size % 5 = 0 THEN 'CONNECT SQL' ELSE 'VIEW SERVER STATE' END AS permission_name, 'GRANT' AS state_desc FROM {{part}}""",
    "role_members": f"""
SELECT {srv('(s_suppkey * 7) % 3')} AS server_id, CASE WHEN s_nationkey % 2 = 0 THEN 'sysadmin' ELSE 'reader' END AS role_name,
  s_suppkey * 7 AS member_principal_id FROM {{supplier}}""",
    "db_users": f"""
SELECT {srv('c_custkey % 3')} AS server_id, {db('c_custkey % 50')} AS database_name,
  CASE c_custkey % 10 WHEN 0 THEN 'public' ELSE concat('user', {s('c_custkey')}) END AS user_name,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'R' ELSE 'S' END AS type,
  CASE WHEN c_custkey % 11 = 0 THEN concat('lost', {s('c_custkey')}) ELSE concat('s', {s('c_custkey')}) END AS sid,
  c_custkey % 6 = 0 AS has_rights FROM {{customer}}""",
    "proxies": f"""
SELECT {srv('(s_suppkey * 5) % 3')} AS server_id, concat('proxy', {s('s_suppkey')}) AS proxy_name, concat('s', {s('s_suppkey * 5')}) AS sid
FROM {{supplier}}""",
    "registry": f"""
SELECT {srv('l_suppkey')} AS server_id,
  CASE l_linenumber WHEN 1 THEN 'net/np' WHEN 2 THEN 'net/sm' WHEN 3 THEN 'net/tcp' WHEN 6 THEN 'MSSQLServer/Parameters' ELSE 'MSSQLServer' END AS registry_key,
  CASE l_linenumber WHEN 4 THEN 'NumErrorLogs' WHEN 5 THEN 'AuditLevel' WHEN 6 THEN 'SQLArg3' WHEN 7 THEN 'Other' ELSE 'Enabled' END AS value_name,
  CASE l_linenumber WHEN 1 THEN {s('l_suppkey % 2')} WHEN 4 THEN {s('6 + l_suppkey % 12')} WHEN 5 THEN {s('l_suppkey % 4')}
    WHEN 6 THEN CASE WHEN l_suppkey % 5 = 0 THEN '-x' ELSE '-d' END ELSE '1' END AS value_data,
  COUNT(*) AS samples
FROM {{lineitem}} GROUP BY 1, 2, 3, 4""",
    "audit_details": f"""
SELECT {srv('user_id')} AS server_id, CASE event_type WHEN 'click' THEN 'AUDIT_CHANGE_GROUP' WHEN 'view' THEN 'FAILED_LOGIN_GROUP'
    WHEN 'purchase' THEN 'SUCCESSFUL_LOGIN_GROUP' ELSE 'OTHER_GROUP' END AS action_name, value > 120 AS is_enabled FROM {{events}}""",
    "assemblies": f"""
SELECT {srv('p_partkey % 100')} AS server_id, concat('asm', {s('p_partkey')}) AS assembly_name, p_size % 2 = 0 AS is_user_defined,
  CASE WHEN p_size > 46 THEN 'UNSAFE_ACCESS' ELSE 'SAFE_ACCESS' END AS permission_set FROM {{part}}""",
    "crypto_keys": f"""
SELECT {srv('p_partkey % 100')} AS server_id, {db('p_partkey % 50')} AS database_name, concat('key', {s('p_partkey')}) AS key_name,
  CASE WHEN p_size % 2 = 0 THEN 'symmetric' ELSE 'asymmetric' END AS kind,
  CASE WHEN p_size < 5 THEN 'TRIPLE_DES' ELSE 'AES_256' END AS algorithm, CASE WHEN p_size < 6 THEN 1024 ELSE 2048 END AS key_length
FROM {{part}}""",
    "toolset": f"""
SELECT {srv('l_suppkey')} AS server_id, CASE l_linenumber WHEN 1 THEN 'CommandExecute' WHEN 2 THEN 'DatabaseBackup'
    WHEN 3 THEN 'DatabaseIntegrityCheck' WHEN 4 THEN 'IndexOptimize' ELSE 'Other' END AS object_name,
  CASE WHEN l_suppkey % 3 = 0 AND l_linenumber = 1 THEN '2018-01-01 00:00:00' ELSE '2020-01-26 14:06:53' END AS version FROM {{lineitem}}""",
    "schedulers": f"""
SELECT DISTINCT {srv('l_suppkey')} AS server_id, l_linenumber * 10 + l_partkey % 3 AS scheduler_id,
  CASE WHEN l_suppkey % 2 = 0 THEN 0 ELSE l_linenumber % 2 END AS node_id,
  CASE WHEN l_linenumber = 7 THEN 'HIDDEN ONLINE' ELSE 'VISIBLE ONLINE' END AS status FROM {{lineitem}}""",
    "servers": f"""
SELECT {srv('s_suppkey')} AS server_id, {PRODUCT.format(k='s_suppkey')} AS product_version,
  CASE s_suppkey % 6 WHEN 0 THEN 10 WHEN 1 THEN 11 WHEN 2 THEN 12 WHEN 3 THEN 13 WHEN 4 THEN 14 ELSE 9 END AS major_version,
  CASE s_suppkey % 5 WHEN 0 THEN 'RTM' WHEN 1 THEN 'SP2' WHEN 2 THEN 'CU21' WHEN 3 THEN 'SP3' ELSE 'SP4' END AS update_level,
  CASE s_suppkey % 7 WHEN 0 THEN 'Evaluation Edition (64-bit)' WHEN 1 THEN 'Express Edition' ELSE 'Enterprise Edition (64-bit)' END AS edition,
  {i('8 * (1 + s_suppkey % 4)')} AS cpu_count, {i('8 * (1 + s_suppkey % 2)')} AS hyperthread_ratio,
  {i('(8 + s_suppkey % 64) * 1048576')} AS physical_memory_kb, {i('1 + s_suppkey % 3')} AS instance_count,
  CASE WHEN s_suppkey % 8 = 0 THEN 'Available physical memory is low' ELSE 'Available physical memory is high' END AS memory_state,
  TIMESTAMP '2023-08-01 00:00:00' + CAST(s_suppkey % 100 AS INT) * INTERVAL '1' DAY AS installed_at,
  TIMESTAMP '2024-01-31 00:00:00' - CAST(s_suppkey % 300 AS INT) * INTERVAL '1' HOUR AS boot_time,
  {i('s_suppkey * 3600123')} AS ms_ticks, s_suppkey % 2 = 0 AS uses_columnstore, {srv('s_suppkey % 3')} AS fleet_id
FROM {{supplier}}""",
    "flags_enabled": f"""
SELECT {srv('l_suppkey')} AS server_id, CASE l_partkey % 8 WHEN 0 THEN '3226' WHEN 1 THEN '7745' WHEN 2 THEN '1118' WHEN 3 THEN '4199'
    WHEN 4 THEN '8649' WHEN 5 THEN '2371' WHEN 6 THEN '834' ELSE '8017' END AS flag FROM {{lineitem}} """,
    "services": f"""
SELECT {srv('p_partkey % 100')} AS server_id, concat('svc', {s('p_partkey')}) AS service_name, concat('acct', {s('p_partkey % 700')}) AS service_account,
  CASE p_size % 3 WHEN 0 THEN 'Auto' WHEN 1 THEN 'Manual' ELSE 'Auto (Delayed)' END AS start_mode,
  CASE p_size % 5 WHEN 0 THEN 'Stopped' ELSE 'Running' END AS state FROM {{part}}""",
    "job_steps": f"""
SELECT user_id AS job_id, CAST(event_id % 5 + 1 AS INT) AS step_id,
  CASE event_id % 5 WHEN 4 THEN 'ST05: CHECK_STEPS_ERRORS' WHEN 3 THEN 'FINAL' ELSE concat('ST0', {s('event_id % 5 + 1')}, ': RUN') END AS step_name,
  CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS last_run_outcome,
  CASE WHEN event_id % 13 = 0 THEN 0 ELSE CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INT) END AS last_run_date,
  CAST(hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS INT) AS last_run_time,
  CAST((event_id % 3) * 10000 + (event_id % 60) * 100 + user_id % 60 AS INT) AS last_run_duration FROM {{events}}""",
    "maint_jobs": f"""
SELECT DISTINCT {EV_SRV} AS server_id, user_id AS job_id,
  CASE WHEN user_id % 2 = 0 THEN concat('JB_', {s('user_id')}, '_MAINTENANCE_ALL_DATABASES') ELSE concat('JB_', {s('user_id')}) END AS name
FROM {{events}}""",
    "endpoints": f"""
SELECT {srv('c_custkey % 100')} AS server_id, concat('ep', {s('c_custkey')}) AS endpoint_name, c_custkey AS principal_id,
  concat('acct', {s('c_custkey')}) AS owner_name FROM {{customer}}""",
    "databases": f"""
SELECT {srv('c_custkey % 3')} AS server_id, {db('c_custkey')} AS database_name,
  c_custkey % 13 = 0 AS is_auto_close_on, c_custkey % 17 = 0 AS is_auto_shrink_on, c_custkey % 19 <> 0 AS is_auto_create_stats_on,
  c_custkey % 23 <> 0 AS is_auto_update_stats_on, c_custkey % 29 = 0 AS is_auto_update_stats_async_on, c_custkey % 31 = 0 AS is_trustworthy_on,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'SIMPLE' WHEN 'MACHINERY' THEN 'BULK_LOGGED' ELSE 'FULL' END AS recovery_model,
  CASE WHEN c_custkey % 37 = 0 THEN 'OFFLINE' ELSE 'ONLINE' END AS state_desc,
  CASE WHEN c_custkey % 12 = 0 THEN 'SINGLE_USER' ELSE 'MULTI_USER' END AS user_access, c_custkey % 24 <> 0 AS is_accessible,
  c_custkey % 41 = 0 AS is_in_standby, c_custkey % 5 = 0 AS is_read_only,
  CASE WHEN c_custkey % 4 = 0 THEN 'ag1' ELSE NULL END AS availability_group,
  CASE c_custkey % 12 WHEN 0 THEN 'PRIMARY' WHEN 4 THEN 'SECONDARY' ELSE NULL END AS replica_role,
  c_custkey % 8 = 0 AS is_preferred_replica, CASE c_custkey % 16 WHEN 0 THEN 'ALL' WHEN 4 THEN 'NO' ELSE NULL END AS secondary_connections,
  CASE WHEN c_custkey % 15 = 0 THEN 'PRIMARY' ELSE NULL END AS log_shipping_role,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey * 10 END AS log_lsn,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey * 9 END AS differential_base_lsn, c_custkey % 14 = 0 AS base_is_snapshot,
  {i('1000 + c_custkey')} AS allocated_pages, {i('(c_custkey * 37) % 1000')} AS modified_pages,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE {i('c_custkey % 300')} END AS log_mb_since_backup,
  TIMESTAMP '2024-01-31 00:00:00' - CAST(c_custkey % 500 AS INT) * INTERVAL '1' MINUTE AS last_log_backup,
  CASE WHEN c_custkey % 20 = 0 THEN {i('0')} WHEN c_custkey % 21 = 0 THEN NULL ELSE {i('ROUND(ABS(c_acctbal) * 10000000)')} END AS backup_bytes,
  {i('ROUND(c_acctbal * 100)')} AS database_size, {i('c_custkey % 97')} AS log_size, {i('c_custkey % 7')} AS start_position,
  CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + CAST(c_custkey % 600 AS INT) * INTERVAL '1' HOUR END AS last_good_check,
  {i('c_custkey % 100')} AS est_seconds,
  CASE WHEN c_custkey < 3 THEN 'S' ELSE 'U' END AS database_type
FROM {{customer}}""",
    "database_files": f"""
SELECT {srv('(p_partkey % 50) % 3')} AS server_id, {db('p_partkey % 50')} AS database_name, p_partkey AS file_id,
  CASE WHEN p_size % 5 = 0 THEN 'LOG' ELSE 'ROWS' END AS type_desc,
  concat(CASE p_size % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'D' WHEN 2 THEN 'e' ELSE 'F' END, ':/data/f', {s('p_partkey')}) AS physical_name,
  {i('p_size * 1024')} AS size_pages, CASE WHEN p_size % 3 = 0 THEN 128 ELSE 8192 END AS growth,
  p_size % 7 = 0 AS is_percent_growth, CAST(p_size % 2 AS INT) AS data_space_id
FROM {{part}}""",
    "temp_files": f"""
SELECT {srv('p_partkey % 1100')} AS server_id, 'tempdb' AS database_name, p_partkey AS file_id,
  CASE WHEN p_size % 5 = 0 THEN 'LOG' ELSE 'ROWS' END AS type_desc, concat('D:/temp/f', {s('p_partkey')}) AS physical_name,
  {i('p_size * 1024')} AS size_pages FROM {{part}}""",
    "suspect_pages": f"""
SELECT {srv('user_id % 3')} AS server_id, {db('user_id')} AS database_name, ts AS event_time FROM {{events}}""",
    "page_repairs": f"""
SELECT {srv('(user_id * 2) % 3')} AS server_id, {db('user_id * 2')} AS database_name, ts AS event_time FROM {{events}}""",
    "log_fragments": f"""
SELECT {srv('(l_suppkey % 50) % 3')} AS server_id, {db('l_suppkey % 50')} AS database_name, l_orderkey AS fragment_id FROM {{lineitem}}""",
    "user_tables": f"""
SELECT {srv('p_partkey % 100')} AS server_id, {db('p_partkey % 50')} AS database_name,
  CASE p_size % 10 WHEN 0 THEN 'CommandLog' WHEN 1 THEN 'Queue' ELSE concat('t', {s('p_partkey')}) END AS table_name,
  p_size % 2 = 0 AS is_ms_shipped, TIMESTAMP '2020-01-01 00:00:00' + CAST(p_partkey AS INT) * INTERVAL '1' HOUR AS created_at FROM {{part}}""",
    "file_stats": f"""
SELECT {srv('(p_partkey % 50) % 3')} AS server_id, {db('p_partkey % 50')} AS database_name, p_partkey AS file_id,
  {i('p_partkey * 1000')} AS num_of_reads, {i('p_partkey * 1000 * p_size * 5')} AS io_stall_read_ms,
  {i('p_partkey * 900')} AS num_of_writes, {i('p_partkey * 900 * p_size * 3')} AS io_stall_write_ms FROM {{part}}""",
    "linked": f"""
SELECT {srv('s_nationkey')} AS server_id, concat('link', {s('s_suppkey')}) AS linked_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'sa' WHEN 1 THEN NULL ELSE 'app' END AS remote_name, s_suppkey % 4 <> 0 AS is_linked FROM {{supplier}}""",
    "stats_dates": f"""
SELECT {srv('p_partkey % 3')} AS server_id, concat('t_', {s('p_partkey % 500')}) AS table_name, p_partkey AS stats_id, {i('p_size % 9')} AS row_count,
  TIMESTAMP '2024-01-31 00:00:00' - CAST(p_size AS INT) * INTERVAL '1' DAY AS last_updated FROM {{part}}""",
    "perf_counters": f"""
SELECT {EV_SRV} AS server_id, event_id AS sample_id, ts AS check_date, 'User Connections' AS counter_name, {i('FLOOR(value)')} AS cntr_value FROM {{events}}
UNION ALL
SELECT {EV_SRV}, event_id, ts, 'Connection Memory (KB)', {i('user_id * 2048 + event_id')} FROM {{events}}""",
    "processes": f"""
SELECT {srv('user_id % 3')} AS host, event_id AS process_id, event_type AS process_name, {i('ROUND(value * 100)')} AS cpu,
  {i('(event_id * 7919) % 100003')} AS working_set FROM {{events}}""",
    "trace": f"""
SELECT {EV_DBSRV} AS server_id, {EV_DB} AS database_name, user_id AS file_id,
  CASE event_id % 8 WHEN 0 THEN 22 WHEN 1 THEN 92 WHEN 2 THEN 93 WHEN 3 THEN 94 WHEN 4 THEN 95 WHEN 5 THEN 116 ELSE 46 END AS event_class,
  CAST(event_id % 25 AS INT) AS severity, ts AS start_time, {i('ROUND(value * 1000000)')} AS duration, {i('FLOOR(value)')} AS integer_data,
  concat('app', {s('user_id % 4')}) AS application_name, concat('text of ', {s('event_id')}) AS text_data FROM {{events}}""",
    "os_events": f"""
SELECT {EV_SRV} AS server_id, CASE user_id % 4 WHEN 0 THEN '4' WHEN 1 THEN '2' WHEN 2 THEN '1' ELSE '7' END AS host_class,
  event_id AS record_id, ts AS time,
  CASE event_type WHEN 'click' THEN 'System' WHEN 'view' THEN 'Application' WHEN 'purchase' THEN 'Security' ELSE 'Custom' END AS log_name,
  CASE event_id % 3 WHEN 0 THEN 'Error' WHEN 1 THEN 'Warning' ELSE 'FailureAudit' END AS entry_type,
  CAST(CASE CAST(FLOOR(event_id / 3) AS BIGINT) % 9 WHEN 0 THEN 20 WHEN 1 THEN 7001 WHEN 2 THEN 7002 WHEN 3 THEN 4625 WHEN 4 THEN 137 WHEN 5 THEN 1008
    WHEN 6 THEN 500 WHEN 7 THEN 9999 ELSE 1022 END AS INT) AS event_id,
  CASE CAST(FLOOR(event_id / 3) AS BIGINT) % 9 WHEN 0 THEN 'Microsoft-Windows-WindowsUpdateClient' WHEN 1 THEN 'Microsoft-Windows-Winlogon'
    WHEN 2 THEN 'Microsoft-Windows-Winlogon' ELSE 'App' END AS source,
  concat('message ', {s('event_id')}) AS message,
  split(concat('a,user', {s('user_id')}, ',c,d,e,u', {s('user_id')}, ',g,', CASE user_id % 3 WHEN 0 THEN '0xc000006d' ELSE '0xC000006E' END, ',i,',
    CASE user_id % 4 WHEN 0 THEN '0xC0000064' WHEN 1 THEN '0xC000006A' ELSE '0xDEAD' END, ',k,l,m,client', {s('user_id % 7')},
    ',o,p,q,r,s,10.0.0.', {s('user_id')}), ',') AS replacement_strings
FROM {{events}}""",
    "auth_failures": """
SELECT event_id, ts AS time_generated, user_id, CASE event_id % 5 WHEN 0 THEN '0xc0000064' WHEN 1 THEN '0xC000006A'
  WHEN 2 THEN '0xC0000234' WHEN 3 THEN '0xC0000071' ELSE '0xDEAD' END AS sub_status FROM {events}""",
    "access_log": f"""
SELECT {EV_SRV} AS server_id, event_id, ts AS log_time, concat('10.0.0.', {s('user_id')}) AS c_ip,
  CASE WHEN event_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS cs_method,
  CASE event_type WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 401 ELSE 404 END
    WHEN 'signup' THEN CASE WHEN event_id % 4 = 0 THEN 405 ELSE 200 END ELSE 200 END AS sc_status,
  CASE WHEN user_id % 3 = 0 THEN 64 ELSE 0 END AS sc_win32_status, {i('ROUND(value * 100)')} AS bytes_sent FROM {{events}}""",
    "mail_items": f"""
SELECT {EV_SRV} AS server_id, event_id AS mail_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'sent' END AS sent_status, ts AS sent_date FROM {{events}}""",
    "mail_objects": f"""
SELECT {EV_SRV} AS server_id, concat('acct', {s('user_id')}) AS name, ts AS modified_at, concat('u', {s('event_id % 9')}) AS modified_by FROM {{events}}""",
    "operators": f"""
SELECT {srv('c_custkey % 100')} AS server_id, concat('op', {s('c_custkey')}) AS name, c_custkey % 3 = 0 AS enabled FROM {{customer}}""",
    "expected_operator": "SELECT server_id, MIN(name) AS expected_name FROM v_operators WHERE enabled GROUP BY server_id",
    "certs": f"""
SELECT {srv('o_custkey % 3')} AS server_id, concat('CN=', CASE o_custkey % 4 WHEN 0 THEN 'campus' ELSE 'other' END, {s('o_orderkey')}) AS subject,
  o_orderdate + INTERVAL '45' DAY AS not_after FROM {{orders}}""",
    "activity": f"""
SELECT {EV_SRV} AS server_id, ts AS login_time, concat('login', {s('user_id')}) AS login_name,
  CASE user_id % 4 WHEN 0 THEN 'SQLPS (x)' WHEN 1 THEN 'dbatools 1.0' WHEN 2 THEN 'Veeam Agent 5' ELSE 'other' END AS program_name,
  CASE event_id % 5 WHEN 0 THEN 'exec SP_READREQUEST' WHEN 1 THEN 'select * from sys.dm_os_cluster_nodes' ELSE concat('select ', {s('event_id')}) END AS last_command
FROM {{events}}""",
    "deadlocks": f"""
SELECT {EV_SRV} AS server_id, ts AS event_time, concat('<deadlock id="', {s('event_id')}, '"/>') AS deadlock_graph FROM {{events}}""",
    "hotfixes": f"""
SELECT {EV_SRV} AS server_id, concat('KB', {s('event_id')}) AS hotfix_id, 'Security-Update' AS description, ts AS installed_on FROM {{events}}""",
    "extents": f"""
SELECT {srv('(l_suppkey % 50) % 3')} AS server_id, {db('l_suppkey % 50')} AS database_name, {i('l_quantity')} AS allocated_extent_page_count,
  CASE WHEN l_returnflag = 'R' THEN {i('l_quantity')} ELSE {i('0')} END AS modified_extent_page_count FROM {{lineitem}}""",
    "buffer_pages": f"""
SELECT {srv('l_partkey % 7')} AS server_id, l_partkey AS allocation_unit_id, {i('l_quantity * 100')} AS free_space_in_bytes, concat('t_', {s('l_partkey % 300')}) AS object_name,
  'USER_TABLE' AS type_desc FROM {{lineitem}}""",
    "allocation": f"""
SELECT {srv('p_partkey % 7')} AS server_id, p_partkey AS allocation_unit_id, p_partkey AS container_id, CAST(p_size % 4 AS INT) AS type, {i('p_size * 3')} AS used_pages FROM {{part}}""",
    "partitions": f"""
SELECT {srv('p_partkey % 7')} AS server_id, p_partkey AS partition_id, p_partkey + 7 AS hobt_id, p_partkey % 300 AS object_id, p_partkey % 5 AS index_id FROM {{part}}""",
    "objects": f"""
SELECT DISTINCT {srv('p_partkey % 7')} AS server_id, p_partkey % 300 AS object_id, concat('t_', {s('p_partkey % 300')}) AS object_name, 'USER_TABLE' AS type_desc,
  (p_partkey % 300) % 10 = 0 AS is_ms_shipped FROM {{part}}""",
    "plain_indexes": f"""
SELECT DISTINCT {srv('p_partkey % 7')} AS server_id, p_partkey % 300 AS object_id, p_partkey % 5 AS index_id, concat('ix_', {s('p_partkey % 150')}) AS index_name FROM {{part}}""",
    "plain_tables": f"""
SELECT DISTINCT {srv('p_partkey % 7')} AS server_id, p_partkey % 300 AS object_id, concat('t_', {s('p_partkey % 300')}) AS table_name, (p_partkey % 300) % 10 = 0 AS is_ms_shipped FROM {{part}}""",
    "index_sizes": f"""
SELECT {srv('p_partkey % 3')} AS server_id, concat('t_', {s('p_partkey % 400')}) AS table_name, concat('ix_', {s('p_partkey % 150')}) AS index_name, {i('p_size * 3')} AS used_pages FROM {{part}}""",
    "log_records": f"""
SELECT {EV_SRV} AS server_id, CASE WHEN event_type = 'signup' THEN NULL ELSE concat(event_type, '.', {s('user_id % 20')}) END AS alloc_unit_name,
  concat('LOP_', {s('event_id % 3')}) AS operation, {i('ROUND(value)')} AS record_length FROM {{events}}""",
    "plan_objects": f"""
SELECT {srv('p_partkey % 3')} AS server_id, concat('s', {s('p_size % 4')}) AS schema_name, concat('t_', {s('p_partkey % 500')}) AS object_name,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size % 4 AS INT) END AS index_type,
  concat('ix_', {s('p_partkey')}) AS index_name, concat('st_', {s('p_partkey')}) AS statistics_name, CAST(p_size % 3 AS INT) AS partition_number,
  p_partkey % 11 = 0 AS resumable, {i('p_partkey % 6')} AS start_position FROM {{part}}""",
    "index_objects": f"""
SELECT concat('ix_', {s('p_partkey')}) AS index_name, CAST(p_partkey % 6 + 1 AS INT) AS index_type, p_size % 11 = 0 AS on_read_only_filegroup,
  p_partkey % 13 = 0 AS is_memory_optimized, p_partkey % 3 <> 0 AS allow_page_locks, p_partkey % 4 = 0 AS is_partition, p_partkey % 7 = 0 AS is_image_text,
  p_partkey % 9 = 0 AS is_new_lob, p_partkey % 10 = 0 AS is_filestream, p_partkey % 6 + 1 IN (5, 6) AS is_columnstore, p_partkey % 2 = 0 AS online_edition,
  {i('p_size * 100')} AS page_count, CAST((p_partkey * 7) % 100 AS DOUBLE) AS small_pct, p_partkey % 17 = 0 AS is_paused FROM {{part}}""",
    "stats_objects": f"""
SELECT p_partkey AS stats_id, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_partkey % 8 AS INT) END AS index_type, {i('p_size * 100')} AS row_count,
  {i('(p_partkey % 37) * 30')} AS modification_counter FROM {{part}}""",
    "table_files": f"""
SELECT concat('t_', {s('l_suppkey % 20')}) AS table_name, year(l_shipdate) AS partition_id,
  concat({s('l_orderkey')}, '-', {s('l_linenumber')}) AS file_name, {i('FLOOR(l_extendedprice * 1000)')} AS file_bytes,
  {i('l_quantity')} AS file_rows FROM {{lineitem}}""",
    "executions": "SELECT o_orderkey AS execution_id, o_orderdate AS created_time FROM {orders}",
    "event_messages": "SELECT l_orderkey * 10 + l_linenumber AS event_message_id, l_orderkey AS operation_id, l_shipdate AS message_time FROM {lineitem}",
    "message_context": "SELECT l_orderkey * 10 + l_linenumber AS event_message_id, l_partkey AS context_id FROM {lineitem}",
    "operations": """
SELECT o_orderkey AS operation_id, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderdate END AS start_time FROM {orders}""",
    "parameter_values": "SELECT l_orderkey AS execution_id, l_linenumber AS parameter_no, l_partkey AS parameter_value FROM {lineitem}",
    "executable_statistics": "SELECT l_orderkey AS execution_id, l_suppkey AS executable_id FROM {lineitem}",
    "data_statistics": "SELECT l_orderkey AS execution_id, CAST(l_quantity AS BIGINT) AS rows_sent FROM {lineitem}",
    "component_phases": "SELECT l_orderkey + 1 AS execution_id, l_linenumber AS phase_id FROM {lineitem}",
    "data_taps": "SELECT o_orderkey AS execution_id, o_custkey AS tap_id FROM {orders}",
    "override_values": "SELECT o_orderkey * 2 AS execution_id, o_custkey AS property_id FROM {orders}",
    "operation_messages": "SELECT l_orderkey AS operation_id, l_partkey AS message_id FROM {lineitem}",
    "operation_info": "SELECT o_orderkey AS operation_id, o_custkey AS info_id FROM {orders}",
    "sys_info": "SELECT o_orderkey + 3 AS operation_id, o_custkey AS memory_kb FROM {orders}",
    "validations": "SELECT o_orderkey * 3 AS validation_id, o_custkey AS object_id FROM {orders}",
    "operation_permissions": "SELECT o_custkey AS object_id, o_orderkey AS permission_id FROM {orders}",
    "queue": """
SELECT user_id % 5 AS queue_id, CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS start_time,
  CASE WHEN event_type IN ('click', 'view') THEN ts ELSE NULL END AS end_time FROM {events}""",
    "messages": f"SELECT conv_id, turn, concat('Msg:', role, ' ', {s('conv_id')}, ':tail') AS text FROM {{conversations}}",
    "listing": f"""
SELECT concat('/backup/', {s('o_custkey % 50')}, '/', CASE o_orderkey % 3 WHEN 0 THEN 'log_a_' WHEN 1 THEN 'audit' ELSE 'x_y_' END, {s('o_orderkey')},
  CASE o_orderkey % 3 WHEN 1 THEN '.sqlaudit' ELSE '.txt' END) AS path, o_orderdate AS modified_at FROM {{orders}}""",
    "counters": f"""
SELECT {EV_SRV} AS server_id, event_type AS key, event_id AS reading_id, ts AS reading_time, {i('ROUND(value * 100)')} AS counter_value FROM {{events}}""",
    "logins": f"SELECT concat('u', {s('user_id')}) AS \"user\", ts AS event_time FROM {{events}}",
    "names": f"""
SELECT DISTINCT {db('user_id')} AS name, CASE WHEN user_id < 3 THEN 'S' ELSE 'U' END AS database_type, user_id % 9 = 0 AS in_availability_group FROM {{events}}""",
    "object_names": f"""
SELECT {db('p_partkey % 50')} AS db, concat('s', {s('p_size % 4')}) AS schema, concat('t_', {s('p_partkey')}) AS object,
  CASE WHEN p_size % 6 = 0 THEN NULL ELSE concat('ix_', {s('p_partkey % 20')}) END AS index FROM {{part}}""",
    "properties": f"""
SELECT {srv('c_custkey % 3')} AS server_id, {db('c_custkey')} AS database_name,
  CASE WHEN c_custkey % 2 = 0 THEN 'isSharePointDatabase' ELSE 'other' END AS property_name, {s('c_custkey % 3')} AS property_value FROM {{customer}}""",
    "log_chains": f"""
SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN 'srv9' ELSE concat('srv', CAST((c_custkey % 50) % 3 AS STRING)) END AS server_id, {db('c_custkey % 50')} AS database_name, c_custkey * 10 AS base_lsn,
  CASE WHEN c_custkey % 2 = 0 THEN 'LOG' ELSE 'FULL' END AS backup_type FROM {{customer}}""",
    "directories": f"""
SELECT {i('s_nationkey % 2')} AS mirror, s_suppkey AS id, concat('/backup/', {s('s_suppkey')}) AS directory_path FROM {{supplier}}""",
}

_REF = re.compile(r"\bv_([a-z_0-9]+)\b")


def with_roles(sql: str) -> str:
    """Prepend the role views a statement names, dependencies first, as common table expressions."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _REF.findall(text):
            if name in ROLE_SQL and name not in ordered:
                visit(ROLE_SQL[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"v_{n} AS ({ROLE_SQL[n].strip()})" for n in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def bind(sql: str, name_of: Callable[[str], str]) -> str:
    for table in TABLES:
        if "{" + table + "}" in sql:
            sql = sql.replace("{" + table + "}", name_of(table))
    return sql


def duckdb_sql(sql: str) -> str:
    return bind(with_roles(sql), lambda table: table)


def spark_sql(sql: str, name_of: Callable[[str], str]) -> str:
    return bind(with_roles(sql), name_of).replace('"user"', "user")
