"""Maintenance and snapshot planning as decisions over inventory DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators.scalars import fn_template, time_tokens
from fleetwatch.operators.windows import win_plan_order
from fleetwatch.plans.ordering import latest_row, running_sum, string_list

SMALL_FILE_BYTES = 20_000_000


def mnt_inventory(listing: DataFrame, small_bytes: int = SMALL_FILE_BYTES) -> DataFrame:
    """Rows, bytes, files and share of small files per table partition."""
    return listing.groupBy("table_name", "partition_id").agg(
        F.sum("file_rows").alias("rows"),
        F.sum("file_bytes").alias("bytes"),
        F.count(F.lit(1)).alias("files"),
        (
            F.count_if(F.col("file_bytes") < small_bytes).cast("double") * 100 / F.count(F.lit(1))
        ).alias("small_pct"),
    )


def mnt_fragmentation_group(inv: DataFrame, l1: float = 5, l2: float = 30, level: str = "small_pct") -> DataFrame:
    group = F.when(F.col(level) >= l2, "High").when(F.col(level) >= l1, "Medium").when(F.col(level) < l1, "Low")
    return inv.withColumn("fragmentation_group", group)


def index_actions_allowed(version: int = 14) -> dict[str, Column]:
    """Which index actions an object's attributes permit."""
    c = F.col
    writable = ~c("on_read_only_filegroup") & ~F.coalesce(c("is_memory_optimized"), F.lit(False))
    disk_index = writable & c("index_type").isin(1, 2, 3, 4, 5)
    plain = (c("index_type") == 1) & ~c("is_image_text")
    online = (
        (plain & ~c("is_new_lob"))
        | ((c("index_type") == 2) & ~c("is_new_lob"))
        | (plain & ~c("is_filestream") & F.lit(version >= 11))
        | ((c("index_type") == 2) & F.lit(version >= 11))
    )
    return {
        "INDEX_REORGANIZE": disk_index & (c("allow_page_locks") | (c("index_type") == 5)),
        "INDEX_REBUILD_OFFLINE": disk_index,
        "INDEX_REBUILD_ONLINE": writable
        & (~c("is_partition") | F.lit(version >= 12))
        & online
        & (~c("is_columnstore") | F.lit(version < 11))
        & c("online_edition"),
    }


# Preferred actions per fragmentation group.
PREFERRED_ACTIONS = {
    "Low": (),
    "Medium": ("INDEX_REORGANIZE", "INDEX_REBUILD_ONLINE", "INDEX_REBUILD_OFFLINE"),
    "High": ("INDEX_REBUILD_ONLINE", "INDEX_REBUILD_OFFLINE"),
}


def mnt_action_decision(
    inv: DataFrame,
    preferred: Mapping[str, Sequence[str]] = PREFERRED_ACTIONS,
    allowed: Mapping[str, Column] | None = None,
    min_size: int = 1000,
    max_size: int | None = None,
    size_col: str = "page_count",
    resume_action: str = "INDEX_REBUILD_ONLINE",
) -> DataFrame:
    """First preferred action of the row's group that the row allows; NULL when nothing fits.

    Preferences are parameters, so the decision is one row-wise expression
    without a join.
    """
    choice = F.lit(None).cast("string")
    for group, actions in preferred.items():
        in_group = F.col("fragmentation_group") == group
        first = F.lit(None).cast("string")
        for action in reversed(actions):
            can = F.lit(True) if allowed is None else F.coalesce(allowed[action], F.lit(False))
            first = F.when(can, action).otherwise(first)
        choice = F.when(in_group, first).otherwise(choice)
    fits = (F.col(size_col) >= min_size) | F.lit(min_size == 0)
    if max_size is not None:
        fits = fits & (F.col(size_col) <= max_size)
    decided = F.when(fits, choice)
    if "is_paused" in inv.columns:
        decided = F.when(F.col("is_paused"), resume_action).otherwise(decided)
    return inv.withColumn("action", decided)


def mnt_stats_decision(
    stats: DataFrame, mode: str = "ALL", only_modified: bool = False, pct: float | None = None
) -> DataFrame:
    """Refresh flag per statistics object.

    mode: ALL, INDEX or COLUMNS.  Without further options everything of the mode
    is refreshed; ``only_modified`` needs a change; ``pct`` needs that share of
    rows changed, or sqrt(1000 * rows) changes.
    """
    is_index = F.col("index_type").isNotNull()
    index_ok = F.col("index_type").isin(1, 2, 3, 4, 7)
    in_mode = {"ALL": ~is_index | index_ok, "INDEX": is_index & index_ok, "COLUMNS": ~is_index}[mode]
    mods, rows = F.col("modification_counter"), F.col("row_count")
    due = F.lit(not only_modified and pct is None)
    if only_modified:
        due = due | (mods > 0)
    if pct is not None:
        share = F.try_divide(mods.cast("double") * 100, rows)
        due = due | F.coalesce(share >= pct, F.lit(False))
        due = due | ((mods > 0) & (mods >= F.sqrt(rows.cast("double") * 1000)))
    return stats.withColumn("refresh", F.coalesce(in_mode & due, F.lit(False)))


def mnt_plan_order(plan: DataFrame, mode: str = "LIST") -> DataFrame:
    return win_plan_order(plan, mode)


def mnt_time_budget(plan: DataFrame, seconds: float, cost: str = "est_seconds") -> DataFrame:
    """Work may start while the time used by earlier work on the same server is below the limit."""
    used = running_sum(plan, ["server_id"], ["plan_order"], cost, "used_seconds")
    return used.withColumn("start_allowed", (F.col("used_seconds") - F.col(cost)) < seconds)


def bkp_eligible(
    databases: DataFrame,
    backup_type: str,
    as_of=None,
    *,
    copy_only: bool = False,
    override_preference: bool = False,
    updateability: str = "ALL",
    exclude_log_shipped: bool = True,
    min_log_mb: float | None = None,
    min_seconds: int | None = None,
) -> DataFrame:
    """Backup eligibility and the first reason against it."""
    c = F.col
    is_log, is_diff, is_full = (backup_type == t for t in ("LOG", "DIFF", "FULL"))
    in_group = c("availability_group").isNotNull()
    not_primary = F.coalesce(c("replica_role") != "PRIMARY", F.lit(True))
    not_preferred = ~F.coalesce(c("is_preferred_replica"), F.lit(False))
    against: list[tuple[Column, str]] = [
        (c("state_desc") != "ONLINE", "not online"),
        ((c("user_access") == "SINGLE_USER") & ~c("is_accessible"), "single user"),
        (c("is_in_standby"), "standby"),
    ]
    if is_log:
        against += [
            (c("recovery_model") == "SIMPLE", "simple recovery"),
            (c("log_lsn").isNull(), "no log chain"),
        ]
    if is_diff:
        against.append((c("differential_base_lsn").isNull(), "no differential base"))
    if not is_full:
        against.append((c("database_name") == "master", "master needs a full backup"))
    if is_diff or (is_full and not copy_only):
        against.append((in_group & not_primary, "not primary replica"))
    if is_log and copy_only:
        against.append((in_group & not_primary, "not primary replica"))
    if (is_full and copy_only and not override_preference) or (is_log and not copy_only and not override_preference):
        against.append((in_group & not_preferred, "not preferred replica"))
    if is_log and exclude_log_shipped:
        against.append((c("log_shipping_role") == "PRIMARY", "log shipped"))
    if updateability == "READ_WRITE":
        against.append((c("is_read_only"), "read only"))
    if updateability == "READ_ONLY":
        against.append((~c("is_read_only"), "read write"))
    if is_log and min_log_mb is not None and min_seconds is not None:
        due = (
            (c("log_mb_since_backup") >= min_log_mb)
            | c("log_mb_since_backup").isNull()
            | (S.seconds_between("last_log_backup", S.ts(as_of)) >= min_seconds)
            | c("last_log_backup").isNull()
        )
        against.append((~due, "log backup not due"))
    reason = F.lit(None).cast("string")
    for cond, words in reversed(against):
        reason = F.when(cond, words).otherwise(reason)
    return databases.withColumn("reason", reason).withColumn("eligible", F.col("reason").isNull())


def bkp_type_switch(databases: DataFrame, backup_type: str, pct: float | None = None) -> DataFrame:
    """Type to run: LOG without chain becomes DIFF; DIFF without usable base becomes FULL."""
    c = F.col
    kind: Column = F.lit(backup_type)
    no_chain = c("recovery_model").isin("FULL", "BULK_LOGGED") & c("log_lsn").isNull() & (c("database_name") != "master")
    kind = F.when((kind == "LOG") & no_chain, "DIFF").otherwise(kind)
    changed = F.lit(False)
    if pct is not None:
        change = F.try_divide(c("modified_pages").cast("double") * 100, c("allocated_pages"))
        changed = F.coalesce(change >= pct, F.lit(False))
    no_base = (
        (c("database_name") == "master")
        | c("differential_base_lsn").isNull()
        | changed
        | F.coalesce(c("base_is_snapshot"), F.lit(False))
    )
    return databases.withColumn("effective_type", F.when((kind == "DIFF") & no_base, "FULL").otherwise(kind))


def bkp_file_count(
    databases: DataFrame,
    directories: int,
    max_file_mb: int | None = None,
    number_of_files: int | None = None,
    min_size_mb: int | None = None,
    max_files: int = 64,
    size_col: str = "backup_bytes",
) -> DataFrame:
    """Files per backup from its size, the largest file size and the directory count.

    An unknown size, or one below a byte per directory, falls back to one file per directory.
    """
    size = F.col(size_col)
    dirs = F.lit(directories)
    if number_of_files == 1 or (number_of_files and min_size_mb is None):
        files: Column = F.lit(number_of_files)
    elif number_of_files:
        files = F.when(size.isNull() | (size >= min_size_mb * S.MB), number_of_files).otherwise(dirs)
    elif max_file_mb is None:
        files = dirs
    else:
        per_dir = F.ceil(F.floor(size / dirs) / F.lit(max_file_mb * S.MB))
        files = F.when(size.isNull() | (size < dirs), dirs).otherwise(
            F.least(per_dir, F.lit(max_files // directories)) * dirs
        )
    return databases.withColumn("files", files.cast("bigint"))


def bkp_failed_latest(command_log: DataFrame, command_type: str) -> DataFrame:
    """Databases whose newest logged command of the type failed, as one list per server for a retry."""
    newest = latest_row(
        command_log.filter(F.col("command_type") == command_type).select("server_id", "database_name", "id", "error_number"),
        ["server_id", "database_name"],
        ["id"],
    )
    return string_list(newest.filter(F.col("error_number") != 0), ["server_id"], "database_name", "names", ",")


def chk_last_good(command_log: DataFrame, inventory: DataFrame) -> DataFrame:
    """Last error-free check per server and database of the inventory; never checked gives NULL."""
    good = (
        command_log.filter((F.col("command_type") == "DBCC_CHECKDB") & (F.col("error_number") == 0))
        .groupBy("server_id", "database_name")
        .agg(F.max("start_time").alias("last_good"))
    )
    return inventory.select("server_id", "database_name").distinct().join(good, ["server_id", "database_name"], "left")


def chk_eligible(databases: DataFrame, replicas: str = "ALL") -> DataFrame:
    """Databases an integrity check may read: online, reachable, and on a replica that allows it.

    ``replicas`` is ALL, PRIMARY, SECONDARY or PREFERRED_BACKUP_REPLICA; a
    secondary must be readable by all connections.
    """
    role = F.col("replica_role")
    reachable = (F.col("state_desc") == "ONLINE") & ~(
        (F.col("user_access") == "SINGLE_USER") & ~F.col("is_accessible")
    )
    readable = role.isNull() | (role == "PRIMARY") | (
        (role == "SECONDARY") & (F.col("secondary_connections") == "ALL")
    )
    wanted = {
        "ALL": F.lit(True),
        "PRIMARY": role == "PRIMARY",
        "SECONDARY": role == "SECONDARY",
        "PREFERRED_BACKUP_REPLICA": F.col("is_preferred_replica"),
    }[replicas]
    chosen = F.col("availability_group").isNull() | F.coalesce(wanted, F.lit(False))
    return databases.withColumn(
        "check_eligible", F.coalesce(reachable & readable, F.lit(False)) & chosen
    )


def cmd_outcome(command_log: DataFrame) -> DataFrame:
    """Runs, longest duration and share of all runs per command type and outcome."""
    status = (
        F.when(F.col("error_number").isNull(), "Not Executed")
        .when(F.col("error_number") == 0, "Succeeded")
        .otherwise("Failed")
    )
    seconds = S.seconds_between("start_time", "end_time")
    return (
        command_log.groupBy("command_type", status.alias("status"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(seconds).alias("total_seconds"),
            F.max(seconds).alias("_longest"),
        )
        .withColumn("longest", S.elapsed_label("_longest"))
        .drop("_longest")
    )


def mnt_queue_progress(queue: DataFrame) -> DataFrame:
    """Pending, running and done items and the oldest start of running work per queue."""
    started, ended = F.col("start_time").isNotNull(), F.col("end_time").isNotNull()
    return queue.groupBy("queue_id").agg(
        F.count_if(~started).alias("pending"),
        F.count_if(started & ~ended).alias("running"),
        F.count_if(ended).alias("done"),
        F.min(F.when(started & ~ended, F.col("start_time"))).alias("oldest_start"),
    )


def export_layout(
    plan: DataFrame,
    template: str = (
        "{ServerName}${InstanceName}{DirectorySeparator}{DatabaseName}{DirectorySeparator}"
        "{BackupType}_{Partial}_{CopyOnly}{DirectorySeparator}"
        "{ServerName}${InstanceName}_{DatabaseName}_{BackupType}_{Partial}_{CopyOnly}_"
        "{Year}{Month}{Day}_{Hour}{Minute}{Second}_{FileNumber}.{FileExtension}"
    ),
    as_of=None,
    separator: str = "/",
) -> DataFrame:
    """One path per plan row and file number.

    Plan columns: server_id, instance_name, database_name, backup_type, partial,
    copy_only, files, extension.
    """
    safe = F.rtrim(F.regexp_replace("database_name", r'[\\/:*?"<>|]', ""))
    tokens = {
        "ServerName": F.col("server_id"),
        "InstanceName": F.col("instance_name"),
        "DatabaseName": safe,
        "BackupType": F.col("backup_type"),
        "Partial": F.when(F.col("partial"), "PARTIAL"),
        "CopyOnly": F.when(F.col("copy_only"), "COPY_ONLY"),
        "FileExtension": F.col("extension"),
        **time_tokens(S.ts(as_of)),
    }
    # The path is built once per plan row; only the file number differs per file.
    filled = fn_template(plan, template, tokens, "path", separator)
    rows = filled.withColumn("file_no", F.explode(F.sequence(F.lit(1), F.col("files"))))
    number = F.when(F.col("files") >= 10, F.lpad(F.col("file_no").cast("string"), 2, "0")).otherwise(
        F.col("file_no").cast("string")
    )
    return rows.withColumn("path", F.replace("path", F.lit("{FileNumber}"), number))
