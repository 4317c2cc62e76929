"""Declared schemas of the input roles; readers never infer a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DDL = {
    "wait_stats": "server_id string, wait_type string, waiting_tasks_count bigint, wait_time_ms bigint, "
    "signal_wait_time_ms bigint",
    "cpu_samples": "server_id string, event_time timestamp_ntz, sql_cpu int, other_cpu int",
    "memory_samples": "server_id string, sample_id bigint, physical_used bigint, physical_low boolean, "
    "virtual_low boolean, event_time timestamp_ntz",
    "memory_counters": "server_id string, snapshot_ts timestamp_ntz, object_name string, counter_name string, "
    "instance_name string, cntr_value bigint",
    "error_log": "id bigint, server_id string, log_date timestamp_ntz, process_info string, text string",
    "agent_log": "server_id string, log_date timestamp_ntz, error_level string, text string",
    "backupset": "server_id string, backup_set_id bigint, database_name string, type string, "
    "backup_start_date timestamp_ntz, backup_finish_date timestamp_ntz, is_damaged boolean, last_lsn bigint",
    "backupfile": "server_id string, backup_set_id bigint, file_number int, file_type string, file_size bigint",
    "command_log": "id bigint, server_id string, database_name string, index_name string, command_type string, "
    "command string, start_time timestamp_ntz, end_time timestamp_ntz, error_number int, error_message string",
    "jobs": "server_id string, job_id bigint, name string, enabled boolean, environment string",
    "job_history": "job_id bigint, step_id int, run_status int, run_date int, run_time int, message string",
    "volumes": "server_id string, database_name string, volume_mount_point string, total_bytes bigint, "
    "available_bytes bigint",
    "trace": "server_id string, database_name string, file_id bigint, event_class int, severity int, "
    "start_time timestamp_ntz, duration bigint, integer_data bigint, application_name string, text_data string",
    "os_events": "server_id string, host_class string, record_id bigint, time timestamp_ntz, log_name string, "
    "entry_type string, event_id int, source string, message string, replacement_strings array<string>",
    "access_log": "date string, time string, s_ip string, cs_method string, cs_uri_stem string, c_ip string, "
    "user_agent string, referer string, sc_status int, sc_win32_status int",
    "findings": "server_id string, check_id string, scope string, severity int, name string, "
    "current_value string, target_value string, achieved boolean, details string, observed_at timestamp_ntz",
}

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(ddl: str) -> T.StructType:
    """Schema of a column list, built without a running session."""
    fields = (f.strip().split(" ", 1) for f in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


ROLES: dict[str, T.StructType] = {name: _schema(ddl) for name, ddl in _DDL.items()}


def src_snapshot(spark: SparkSession, path: str, role: str) -> DataFrame:
    """Collected snapshot of a role; unknown columns are not read, filters reach the files."""
    return spark.read.schema(ROLES[role]).parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; missing ones become NULL, extras are dropped."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (
                F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def src_optional_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The DataFrame plus every column of the schema it lacks, as NULL."""
    present = {c.lower() for c in df.columns}
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name.lower() not in present}
    )


def src_union_databases(dfs: dict[str, DataFrame]) -> DataFrame:
    """One table of all databases; columns a database lacks become NULL."""
    parts = [df.withColumn("database_name", F.lit(name)) for name, df in dfs.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
