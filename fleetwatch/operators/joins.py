"""Join shapes (keys join_*).

No side is broadcast by hint: Spark broadcasts a side only after checking its
size, and adaptive execution splits hot keys of the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.plans.ordering import latest_row, running_max
from fleetwatch.session import settled


def own_keys(names: Sequence[str], *tables: DataFrame) -> list[str]:
    """``names`` behind server_id: ids and names repeat from server to server.

    Tables of one server may all leave it out; if only some have it, rows of many servers would meet, so that raises ValueError.
    """
    named = ["server_id" in t.columns for t in tables]
    if any(named) and not all(named):
        raise ValueError(f"server_id is missing in one of the tables joined on {', '.join(names)}")
    return [*["server_id"] * all(named), *names]


def join_inner_history(backupset: DataFrame, backupfile: DataFrame) -> DataFrame:
    return backupset.join(backupfile, own_keys(["backup_set_id"], backupset, backupfile)).select(
        "server_id",
        "database_name",
        "type",
        "file_type",
        "file_size",
        "backup_start_date",
        "backup_finish_date",
    )


def join_three_way(command_log: DataFrame, backupset: DataFrame, backupfile: DataFrame) -> DataFrame:
    """One row per check run with the data size of the database's newest full backup.

    Pairing every run with every backup would emit all pairs of a database; the
    newest full backup gives the size the run is judged by.
    """
    newest = (
        backupset.filter(F.col("type") == "D")
        .groupBy("server_id", "database_name")
        .agg(F.max(F.struct("backup_start_date", "backup_set_id")).alias("_b"))
        .select("server_id", "database_name", F.col("_b.backup_set_id").alias("backup_set_id"))
    )
    sizes = (
        newest.join(backupfile.filter(F.col("file_type") == "D"), own_keys(["backup_set_id"], newest, backupfile))
        .groupBy("server_id", "database_name")
        .agg(F.sum("file_size").alias("file_size"))
    )
    checks = command_log.select(
        "id", "server_id", "database_name", S.seconds_between("start_time", "end_time").alias("seconds")
    )
    return checks.join(sizes, ["server_id", "database_name"]).select(
        "id", "server_id", "database_name", "file_size", "seconds"
    )


def join_multi_key(
    indexes: DataFrame,
    partitions: DataFrame,
    allocation: DataFrame,
    tables: DataFrame,
    command_log: DataFrame,
) -> DataFrame:
    """index x partitions x allocation x tables x logged command, one row per index and command."""
    container = allocation.withColumnRenamed("container_id", "partition_id")
    place = own_keys(["object_id", "index_id"], indexes, partitions)
    pages = (
        partitions.join(container, own_keys(["partition_id"], partitions, allocation))
        .groupBy(*place)
        .agg(F.sum("used_pages").alias("used_pages"))
    )
    key = own_keys(["index_name"], indexes, command_log)
    logged = command_log.select(*key, "command").distinct()
    return (
        indexes.join(pages, place)
        .join(tables.filter(~F.col("is_ms_shipped")), own_keys(["object_id"], indexes, tables))
        .join(logged, key)
        .select(*own_keys(["table_name"], indexes, tables), "index_name", "used_pages", "command")
    )


def join_left_flag(left: DataFrame, right: DataFrame, keys: Sequence[str], out: str = "flag") -> DataFrame:
    hit = right.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (
        left.join(hit, list(keys), "left")
        .withColumn(out, F.when(F.col("_hit").isNull(), "N").otherwise("Y"))
        .drop("_hit")
    )


def join_disjunctive(allocation: DataFrame, partitions: DataFrame) -> DataFrame:
    """(container = hobt and type in 1, 3) or (container = partition and type = 2), on one server.

    Two equi-joins instead of one OR condition, which would be a nested loop.
    """
    server = own_keys([], allocation, partitions)

    def held(types: Sequence[int], container: str) -> DataFrame:
        keyed = partitions.withColumn("container_id", F.col(container))
        joined = allocation.filter(F.col("type").isin(*types)).join(keyed, [*server, "container_id"])
        return joined.select(*allocation.columns, *[c for c in partitions.columns if c not in server])

    return held((1, 3), "hobt_id").unionByName(held((2,), "partition_id"))


def join_lateral_detail(base: DataFrame, detail: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.join(detail, list(keys))


def join_latest_per_key(history: DataFrame, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return latest_row(history, keys, order_cols)


def join_left_anti(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def join_not_in_null_safe(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Rows of ``a`` with a known value that ``b`` lacks on the same server; NULLs in ``b`` do not empty the result."""
    key = own_keys([col], a, b)
    present = b.select(*key).filter(F.col(col).isNotNull()).distinct()
    return a.filter(F.col(col).isNotNull()).join(present, key, "left_anti")


def join_not_exists_later(failures: DataFrame, successes: DataFrame, key: str, ts: str) -> DataFrame:
    """Failures with no later success: compare with the newest success per key."""
    last_ok = successes.groupBy(key).agg(F.max(ts).alias("_last_ok"))
    return (
        failures.join(last_ok, key, "left")
        .filter(F.col("_last_ok").isNull() | (F.col("_last_ok") <= F.col(ts)))
        .drop("_last_ok")
    )


def join_not_exists_open(jobs: DataFrame, activity: DataFrame) -> DataFrame:
    """Jobs that have no unfinished run in their latest session."""
    newest = activity.groupBy("job_id").agg(
        F.max(
            F.struct("session_id", F.col("stop_execution_date").isNull().cast("int").alias("is_open"))
        ).alias("_s")
    )
    running = newest.filter(F.col("_s.is_open") == 1).select("job_id")
    return jobs.join(running, "job_id", "left_anti")


def join_semi_gate(a: DataFrame, gate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key occurs in ``gate``; the distinct gate keys are settled first."""
    return a.join(settled(gate.select(*keys).distinct(), "gate"), list(keys), "left_semi")


def join_cross_constant(a: DataFrame, rows: Sequence[tuple], schema: Sequence[str]) -> DataFrame:
    """Every row once per constant row, as an explode of literals instead of a cross join."""
    literals = F.array(
        *[F.struct(*[F.lit(v).alias(n) for n, v in zip(schema, row, strict=True)]) for row in rows]
    )
    return a.withColumn("_c", F.explode(literals)).select(*a.columns, "_c.*")


def _snapshot():
    """Counters of one server and snapshot: a handful of rows, whatever the fleet's size."""
    return Window.partitionBy("server_id", "snapshot_ts")


_OLD = ("Buffer Manager", "Buffer Node")


def join_rename_map(counters: DataFrame, map_df: DataFrame) -> DataFrame:
    """Old-generation buffer counters take their new name unless the server reports the new one."""
    is_old = F.coalesce(F.col("object_name").isin(*_OLD), F.lit(False))
    present = F.collect_set(F.when(F.col("object_name") == "Memory Manager", F.col("counter_name"))).over(_snapshot())
    mapped = counters.withColumn("_present", present).join(
        map_df, F.col("counter_name") == F.col("old_name"), "left"
    )
    rename = is_old & F.col("new_name").isNotNull() & ~F.array_contains("_present", F.col("new_name"))
    return mapped.withColumns(
        {
            "counter_name": F.when(rename, F.col("new_name")).otherwise(F.col("counter_name")),
            "object_name": F.when(is_old, F.replace("object_name", F.lit("Buffer"), F.lit("Memory"))).otherwise(
                F.col("object_name")
            ),
        }
    ).select(*counters.columns)


def join_drop_superseded(counters: DataFrame) -> DataFrame:
    """Drop old-generation rows whose new-generation twin (Buffer -> Memory, same short name) exists."""
    key = lambda o: F.concat_ws("|", o, F.col("short_name"))
    reported = F.collect_set(key(F.col("object_name"))).over(_snapshot())
    twin = key(F.replace("object_name", F.lit("Buffer"), F.lit("Memory")))
    gone = F.col("object_name").isin(*_OLD) & F.array_contains("_reported", twin)
    return (
        counters.withColumn("_reported", reported)
        .filter(~F.coalesce(gone, F.lit(False)))
        .drop("_reported")
    )


def join_update_from(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Target with ``cols`` replaced where an update row exists (keys unique in updates)."""
    u = updates.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in cols]
    )
    out = target.join(u, list(keys), "left")
    for c in cols:
        out = out.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)))
    return out.select(*target.columns)


def join_scalar_counts(tables: DataFrame, indexes: DataFrame, columns: DataFrame) -> DataFrame:
    key = own_keys(["object_id"], tables, indexes, columns)
    n_index = indexes.groupBy(*key).agg(F.count(F.lit(1)).alias("index_count"))
    n_column = columns.groupBy(*key).agg(F.count(F.lit(1)).alias("column_count"))
    return (
        tables.join(n_index, key, "left")
        .join(n_column, key, "left")
        .fillna(0, ["index_count", "column_count"])
    )


def join_asof_state(logs: DataFrame, base_backups: DataFrame) -> DataFrame:
    """Per log-chain row (server_id, database_name, base_lsn): start of the newest safe base backup.

    Safe: undamaged, and a full or differential backup, or a log backup that ends
    before the chain's base.  Log ends and chain rows share one running maximum
    along the log position, so no pairs are formed.
    """
    ok = base_backups.filter(~F.col("is_damaged"))
    full = (
        ok.filter(F.col("type").isin("D", "I"))
        .groupBy("server_id", "database_name")
        .agg(F.max("backup_start_date").alias("_base"))
    )
    ends = (
        ok.filter(F.col("type") == "L")
        .groupBy("server_id", "database_name", F.col("last_lsn").alias("_lsn"))
        .agg(F.max("backup_start_date").alias("_start"))
    )
    points = logs.select("server_id", "database_name", F.col("base_lsn").alias("_lsn")).distinct()
    # At equal positions the chain row sorts first: only strictly earlier ends count.
    line = ends.withColumn("_kind", F.lit(1)).unionByName(
        points.withColumn("_kind", F.lit(0)).withColumn("_start", F.lit(None).cast("timestamp_ntz"))
    )
    running = running_max(line, ["server_id", "database_name"], "_lsn", "_kind", "_start", "_log")
    chain = running.filter(F.col("_kind") == 0).select(
        "server_id", "database_name", F.col("_lsn").alias("base_lsn"), "_log"
    )
    return (
        logs.join(full, ["server_id", "database_name"], "left")
        .join(chain, ["server_id", "database_name", "base_lsn"], "left")
        .withColumn("latest_safe", F.greatest("_base", "_log"))
        .drop("_base", "_log")
    )
