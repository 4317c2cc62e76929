"""Workload and capacity analytics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators import aggregates as A
from fleetwatch.operators import joins as J
from fleetwatch.operators.filters import flt_exclusion_list, flt_system_objects
from fleetwatch.operators.scalars import fn_first_word, fn_string_cleanup, fn_unit_conversion
from fleetwatch.operators.windows import win_share_of_total
from fleetwatch.plans.ordering import string_list, top_k, with_group_total
from fleetwatch.session import literal_table, settled

# Background wait types of the wait report.
BENIGN_WAITS = """
BROKER_EVENTHANDLER BROKER_RECEIVE_WAITFOR BROKER_TASK_STOP BROKER_TO_FLUSH BROKER_TRANSMITTER
CHECKPOINT_QUEUE CHKPT CLR_AUTO_EVENT CLR_MANUAL_EVENT CLR_SEMAPHORE DBMIRROR_DBM_EVENT
DBMIRROR_DBM_MUTEX DBMIRROR_EVENTS_QUEUE DBMIRROR_WORKER_QUEUE DBMIRRORING_CMD DIRTY_PAGE_POLL
DISPATCHER_QUEUE_SEMAPHORE EXECSYNC FSAGENT FT_IFTS_SCHEDULER_IDLE_WAIT FT_IFTSHC_MUTEX
HADR_CLUSAPI_CALL HADR_FILESTREAM_IOMGR_IOCOMPLETION HADR_LOGCAPTURE_WAIT
HADR_NOTIFICATION_DEQUEUE HADR_TIMER_TASK HADR_WORK_QUEUE LAZYWRITER_SLEEP LOGMGR_QUEUE
MEMORY_ALLOCATION_EXT ONDEMAND_TASK_QUEUE PREEMPTIVE_HADR_LEASE_MECHANISM
PREEMPTIVE_OS_AUTHENTICATIONOPS PREEMPTIVE_OS_AUTHORIZATIONOPS PREEMPTIVE_OS_COMOPS
PREEMPTIVE_OS_CREATEFILE PREEMPTIVE_OS_CRYPTOPS PREEMPTIVE_OS_DEVICEOPS PREEMPTIVE_OS_FILEOPS
PREEMPTIVE_OS_GENERICOPS PREEMPTIVE_OS_LIBRARYOPS PREEMPTIVE_OS_PIPEOPS
PREEMPTIVE_OS_QUERYREGISTRY PREEMPTIVE_OS_VERIFYTRUST PREEMPTIVE_OS_WAITFORSINGLEOBJECT
PREEMPTIVE_OS_WRITEFILEGATHER PREEMPTIVE_SP_SERVER_DIAGNOSTICS PREEMPTIVE_XE_GETTARGETSTATE
PWAIT_ALL_COMPONENTS_INITIALIZED PWAIT_DIRECTLOGCONSUMER_GETNEXT QDS_ASYNC_QUEUE
QDS_CLEANUP_STALE_QUERIES_TASK_MAIN_LOOP_SLEEP QDS_PERSIST_TASK_MAIN_LOOP_SLEEP
QDS_SHUTDOWN_QUEUE REDO_THREAD_PENDING_WORK REQUEST_FOR_DEADLOCK_SEARCH RESOURCE_QUEUE
SERVER_IDLE_CHECK SLEEP_BPOOL_FLUSH SLEEP_DBSTARTUP SLEEP_DCOMSTARTUP SLEEP_MASTERDBREADY
SLEEP_MASTERMDREADY SLEEP_MASTERUPGRADED SLEEP_MSDBSTARTUP SLEEP_SYSTEMTASK SLEEP_TASK
SP_SERVER_DIAGNOSTICS_SLEEP SQLTRACE_BUFFER_FLUSH SQLTRACE_INCREMENTAL_FLUSH_SLEEP
SQLTRACE_WAIT_ENTRIES UCS_SESSION_REGISTRATION WAIT_FOR_RESULTS WAIT_XTP_CKPT_CLOSE
WAIT_XTP_HOST_WAIT WAIT_XTP_OFFLINE_CKPT_NEW_LOG WAIT_XTP_RECOVERY WAITFOR WAITFOR_TASKSHUTDOWN
XE_TIMER_EVENT XE_DISPATCHER_WAIT XE_LIVE_TARGET_TVF
""".split()

# Background wait types of the pressure check's shorter list.
BENIGN_WAITS_SHORT = """
CLR_SEMAPHORE SP_SERVER_DIAGNOSTICS_SLEEP QDS_PERSIST_TASK_MAIN_LOOP_SLEEP DIRTY_PAGE_POLL
BROKER_EVENTHANDLER BROKER_RECEIVE_WAITFOR HADR_FILESTREAM_IOMGR_IOCOMPLETION LAZYWRITER_SLEEP
RESOURCE_QUEUE SLEEP_TASK SLEEP_SYSTEMTASK SQLTRACE_BUFFER_FLUSH WAITFOR LOGMGR_QUEUE
CHECKPOINT_QUEUE REQUEST_FOR_DEADLOCK_SEARCH XE_TIMER_EVENT BROKER_TO_FLUSH BROKER_TASK_STOP
CLR_MANUAL_EVENT CLR_AUTO_EVENT DISPATCHER_QUEUE_SEMAPHORE FT_IFTS_SCHEDULER_IDLE_WAIT
XE_DISPATCHER_WAIT XE_DISPATCHER_JOIN
""".split()

# Memory-tree counters kept in the history.
MEMORY_TREE_NAMES = (
    "Target Server Memory",
    "Maximum Workspace Memory",
    "Total Server Memory",
    "Database Cache Memory",
    "Free Memory",
    "Stolen Server Memory",
    "<Other Memory Clerks>",
    "SQL Cache Memory",
    "Lock Memory",
    "Connection Memory",
    "Cursor memory usage",
    "SQL Plans",
    "Object Plans",
    "Bound Trees",
    "Extended Stored Procedures",
    "Temporary Tables & Table Variables",
)

# Memory-manager counters the tree reads.
MEMORY_MANAGER_COUNTERS = (
    "Granted Workspace Memory (KB)",
    "Maximum Workspace Memory (KB)",
    "Memory Grants Outstanding",
    "Memory Grants Pending",
    "Target Server Memory (KB)",
    "Total Server Memory (KB)",
    "Connection Memory (KB)",
    "Lock Memory (KB)",
    "Optimizer Memory (KB)",
    "SQL Cache Memory (KB)",
    "Free Memory (KB)",
    "Reserved Server Memory (KB)",
    "Database Cache Memory (KB)",
    "Stolen Server Memory (KB)",
)

# Old and new counter name.
COUNTER_RENAMES = (
    ("Free", "Free Memory"),
    ("Database", "Database Cache Memory"),
    ("Stolen", "Stolen Server Memory"),
    ("Reserved", "Reserved Server Memory"),
    ("Foreign", "Foreign Node Memory"),
)


def wait_stats(waits: DataFrame, benign: Iterable[str] = BENIGN_WAITS) -> DataFrame:
    """Seconds, tasks and share of the server's wait time per wait type, benign types removed."""
    kept = flt_exclusion_list(waits, "wait_type", benign, "wait_time_ms", 1)
    return win_share_of_total(kept, "wait_time_ms", once=True).select(
        "server_id",
        "wait_type",
        (F.col("wait_time_ms") / 1000).alias("wait_seconds"),
        F.col("waiting_tasks_count").alias("tasks"),
        "pct",
    )


def wait_top_cause(
    waits: DataFrame, causes: DataFrame, benign: Iterable[str] = BENIGN_WAITS_SHORT
) -> DataFrame:
    """Largest wait per server with its cause text."""
    kept = flt_exclusion_list(waits, "wait_type", benign)
    top = (
        kept.groupBy("server_id")
        .agg(
            F.sum("wait_time_ms").alias("_total"),
            F.min(F.struct((-F.col("wait_time_ms")).alias("minus"), "wait_type")).alias("_top"),
        )
        .select("server_id", F.col("_top.wait_type").alias("wait_type"), (-F.col("_top.minus")).alias("_ms"), "_total")
    )
    return top.join(causes, "wait_type", "left").select(
        "server_id",
        "wait_type",
        (F.col("_ms") / 1000).alias("seconds"),
        F.try_divide(F.col("_ms").cast("double") * 100, F.col("_total")).alias("pct"),
        F.coalesce("cause", F.lit("unknown, to be analysed")).alias("cause"),
    )


def wait_signal_ratio(waits: DataFrame) -> DataFrame:
    return A.agg_ratio_of_sums(waits, "signal_wait_time_ms", "wait_time_ms")


def backup_size_pivot(backupset: DataFrame, backupfile: DataFrame, as_of) -> DataFrame:
    return A.agg_monthly_average_pivot(backupset, backupfile, as_of)


def backup_speed(backupset: DataFrame, backupfile: DataFrame, as_of) -> DataFrame:
    return A.agg_throughput(backupset, backupfile, as_of)


def integrity_check_speed(
    command_log: DataFrame, backupset: DataFrame, backupfile: DataFrame, as_of
) -> DataFrame:
    """Check seconds and MB/s of each database against the size of its newest full backup."""
    checks = flt_system_objects(
        command_log.filter(F.col("command_type") == "DBCC_CHECKDB"), "database_name"
    )
    recent = backupset.filter(S.trailing_year("backup_start_date", as_of))
    rows = J.join_three_way(checks, recent, backupfile)
    return rows.groupBy("server_id", "database_name", "file_size", "seconds").agg(
        F.count(F.lit(1)).alias("runs")
    ).select(
        "server_id",
        "database_name",
        F.round(F.col("file_size") / S.MB, 1).alias("size_mb"),
        "seconds",
        "runs",
        F.try_divide(F.col("file_size") / S.MB, F.col("seconds")).alias("mb_per_sec"),
    )


def index_maintenance_cost(command_log: DataFrame, indexes: DataFrame) -> DataFrame:
    """Index size against its longest maintenance run on the same server."""
    key = J.own_keys(["index_name"], command_log, indexes)
    runs = (
        flt_system_objects(command_log.filter(F.col("command_type").contains("INDEX")), "database_name")
        .groupBy(*key, F.col("command_type").alias("command"))
        .agg(F.max(S.seconds_between("start_time", "end_time")).alias("seconds"))
    )
    sizes = indexes.groupBy("table_name", *key).agg(F.sum("used_pages").alias("used_pages"))
    return A.agg_record_duration(sizes.join(runs, key))


def cache_free_space(
    buffer_pages: DataFrame, allocation: DataFrame, partitions: DataFrame, objects: DataFrame
) -> DataFrame:
    """Buffer-cache pages and free share per user object.

    Pages are counted per allocation unit before the joins, so the largest table
    meets the others as one row per allocation unit.
    """
    unit = J.own_keys(["allocation_unit_id"], buffer_pages, allocation, partitions, objects)
    owner = J.own_keys(["object_id"], allocation, objects)
    per_unit = buffer_pages.groupBy(*unit).agg(
        F.count(F.lit(1)).alias("_pages"), F.sum("free_space_in_bytes").alias("_free")
    )
    owned = J.join_disjunctive(allocation, partitions).select(*unit, "object_id")
    users = objects.filter(~F.col("is_ms_shipped")).select(*owner, "object_name", "type_desc")
    return (
        per_unit.join(owned, unit)
        .join(users, owner)
        .groupBy(*owner, "object_name", "type_desc")
        .agg(F.sum("_pages").alias("pages"), F.sum("_free").alias("_bytes"))
        .withColumn("mb", F.col("pages") * 8 / 1024)
        .withColumn("free_mb", F.col("_bytes") / S.MB)
        .withColumn("free_pct", F.round(F.col("free_mb") / F.col("mb") * 100, 2))
        .drop("_bytes", "object_id")
    )


def log_write_share(log_records: DataFrame) -> DataFrame:
    return win_share_of_total(A.agg_coalesced_category(log_records), "bytes", once=True)


def index_usage(usage: DataFrame) -> DataFrame:
    """Reads and writes per index; unused when nothing reads an index that is written."""
    reads = F.col("user_seeks") + F.col("user_scans") + F.col("user_lookups")
    return usage.withColumn("unused", (reads == 0) & (F.col("user_updates") > 0))


def stale_stats_tables(table_stats: DataFrame, indexes: DataFrame, columns: DataFrame) -> DataFrame:
    """Tables that need a statistics update, with kind, counts, and how many the server has."""
    grouped = settled(
        A.agg_having_ratio(table_stats).withColumn(
            "object_id", F.concat_ws(".", F.col("schema_id").cast("string"), "table_name")
        ),
        "stale",
    )
    key = J.own_keys(["object_id"], grouped, indexes, columns)
    alike = J.own_keys(["_all"], grouped)
    grouped = with_group_total(grouped.withColumn("_all", F.lit(0)), alike, F.count(F.lit(1)), "no_of_occurrences")
    counted = J.join_scalar_counts(grouped, indexes, columns)
    clustered = indexes.groupBy(*key).agg(F.max(F.col("is_clustered").cast("int")).alias("_c"))
    kind = F.when(F.col("_c") == 1, "Clustered").when(F.col("_c") == 0, "Heap").otherwise("Indexed View")
    return counted.join(clustered, key, "left").select(
        *J.own_keys(["schema_id"], grouped),
        "table_name",
        "object_id",
        "no_of_occurrences",
        kind.alias("clustered_heap"),
        F.when(F.col("_c") == 0, F.col("index_count") - 1).otherwise(F.col("index_count")).alias("index_count"),
        "column_count",
        "stat_count",
        "row_count",
        "mods",
    )


def volume_free_space(volumes: DataFrame) -> DataFrame:
    """Distinct database, volume and free MB, least free first."""
    return (
        volumes.select(
            "server_id",
            "database_name",
            "volume_mount_point",
            F.floor(F.col("available_bytes") / S.MB).alias("free_mb"),
        )
        .distinct()
        .orderBy("free_mb", "server_id", "database_name", "volume_mount_point")
    )


def wide_varchar_tables(columns: DataFrame) -> DataFrame:
    return A.agg_conditional_count(columns)


def temp_file_layout(database_files: DataFrame, database: str = "tempdb") -> DataFrame:
    """Files of one database per server, with a flag that all data files have the same size."""
    files = database_files.filter(F.col("database_name") == database)
    even = (
        files.filter(F.col("type_desc") == "ROWS")
        .groupBy("server_id")
        .agg((F.min("size_pages") == F.max("size_pages")).alias("even_size"))
    )
    return files.select("server_id", "file_id", "physical_name", "size_pages").join(even, "server_id", "left")


def normalise_counters(memory_counters: DataFrame) -> DataFrame:
    """Short object names, cleaned counter names and MB values of raw memory counters."""
    named = memory_counters
    known = "Memory Manager|Buffer Manager|Plan Cache|Buffer Node|Memory Node|Cursor"
    kind = F.nullif(F.regexp_extract("object_name", f"({known})", 1), F.lit(""))
    raw_name = F.rtrim("counter_name")
    page_like = raw_name.ilike("% pages") | raw_name.ilike("%Node Memory (KB)%") | (
        raw_name == "Page life expectancy"
    )
    wanted = (
        (kind.isin("Buffer Node", "Buffer Manager", "Memory Node", "Plan Cache") & page_like)
        | ((kind == "Memory Manager") & raw_name.isin(*MEMORY_MANAGER_COUNTERS))
        | ((kind == "Cursor") & (raw_name == "Cursor memory usage") & (F.col("instance_name") == "_Total"))
    )
    named = named.filter(wanted).withColumn("object_name", kind).withColumn(
        "counter_name",
        F.when(raw_name == "Cursor memory usage", "Cursor memory usage (KB)").otherwise(raw_name),
    )
    short = fn_first_word(named, "counter_name", "short_name").withColumn("short_name", F.rtrim("short_name"))
    valued = fn_unit_conversion(short, "counter_name", "cntr_value", "value_mb")
    return fn_string_cleanup(valued, "counter_name", "counter_name")


# Tree node id and parent id of each counter group.
TREE_IDS = {
    "root": (1000, None),
    "total": (1200, 1000),
    "workspace": (1100, 1000),
    "granted": (1110, 1100),
    "cache": (1210, 1200),
    "stolen": (1220, 1200),
    "reserved": (1112, 1110),
    "clerk": (1222, 1220),
    "plan": (1225, 1220),
    "plan_item": (1226, 1225),
}


def _tree_node():
    """(id, parent_id, label) of a normalised counter row, or NULL when it is not part of the tree."""
    o, c, i, w = (F.col(x) for x in ("object_name", "counter_name", "instance_name", "short_name"))
    mm = o == "Memory Manager"
    plan = (o == "Plan Cache") & (c == "Cache")

    def node(slot, label=c):
        number, parent = TREE_IDS[slot]
        return F.struct(
            F.lit(number).alias("id"), F.lit(parent).cast("int").alias("parent_id"), label.alias("label")
        )

    return (
        F.when(plan & (i != "_Total"), node("plan_item", i))
        .when(plan & (i == "_Total"), node("plan", F.concat(F.lit("Plan "), c)))
        .when(o == "Cursor", node("clerk"))
        .when(mm & (c == "Target Server Memory"), node("root"))
        .when(mm & (c == "Total Server Memory"), node("total"))
        .when(mm & (c == "Maximum Workspace Memory"), node("workspace"))
        .when(mm & (c == "Granted Workspace Memory"), node("granted"))
        .when(mm & (c == "Stolen Server Memory"), node("stolen"))
        .when(mm & c.isin("Database Cache Memory", "Free Memory"), node("cache"))
        .when(mm & w.isin("Connection", "Lock", "Optimizer", "SQL"), node("clerk"))
        .when(mm & (w == "Reserved"), node("reserved"))
    )


def memory_tree(memory_counters: DataFrame, grants: DataFrame) -> DataFrame:
    """Five-level memory tree per server and snapshot with a residual row for other clerks."""
    keys = ["server_id", "snapshot_ts"]
    renames = literal_table(memory_counters.sparkSession, COUNTER_RENAMES, "old_name string, new_name string")
    counters = J.join_rename_map(J.join_drop_superseded(normalise_counters(memory_counters)), renames)
    # inline() evaluates the node once per row and drops rows without one.
    nodes = counters.select(*keys, "value_mb", F.inline(F.array_compact(F.array(_tree_node())))).select(
        *keys, "id", "parent_id", F.col("label").alias("counter_name"), "value_mb"
    )
    used = grants.groupBy(*keys).agg((F.sum("used_memory_kb").cast("double") / 1024).alias("value_mb"))
    workspace = J.join_cross_constant(used, [(1221, 1220), (1111, 1110)], ["id", "parent_id"]).select(
        *keys, "id", "parent_id", F.lit("Used Workspace Memory").alias("counter_name"), "value_mb"
    )
    return A.agg_residual(nodes.unionByName(workspace), 1220, 1222)


def memory_history(tree: DataFrame, as_of) -> DataFrame:
    """The kept counters with their time point, ready to append."""
    return tree.filter(F.col("counter_name").isin(*MEMORY_TREE_NAMES)).select(
        "server_id", "snapshot_ts", "id", "counter_name", "value_mb", S.ts(as_of).alias("point_of_time")
    )


def sharepoint_exclusion(
    databases: DataFrame, properties: DataFrame, sep: str = ", "
) -> DataFrame:
    """Names of all databases but tempdb that carry no exclusion property, as delimited lists."""
    flagged = properties.filter(
        (F.col("property_name") == "isSharePointDatabase") & (F.col("property_value") == "1")
    )
    rest = J.join_left_anti(
        databases.filter(F.col("database_name") != "tempdb"), flagged, ["server_id", "database_name"]
    )
    return string_list(rest, ["server_id"], "database_name", "names", sep)
