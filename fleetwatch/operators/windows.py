"""Window-style operators (keys win_*) and top-k reports (keys top_*, sort_report)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.operators.joins import join_left_flag, own_keys
from fleetwatch.operators.selectors import parse_list
from fleetwatch.plans.ordering import latest_row, rank_in_group, top_k, with_group_total


def win_share_of_total(df: DataFrame, value: str, out: str = "pct", once: bool = False) -> DataFrame:
    """100 * value / total of the server; ``once``: the rows are an aggregate, to be computed once."""
    total = with_group_total(df, ["server_id"], F.sum(value), "_total", once)
    share = F.try_divide(F.col(value).cast("double") * 100, F.col("_total"))
    return total.withColumn(out, share).drop("_total")


def win_rank_desc(df: DataFrame, value: str, key: str) -> DataFrame:
    return rank_in_group(df, ["server_id"], [F.col(value).desc(), F.col(key).asc()], "rn")


def win_latest_per_partition(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return latest_row(df, keys, order)


def win_directory_number(dirs: DataFrame, files: int) -> DataFrame:
    """Number the directories of each mirror and spread ``files`` file numbers evenly over them.

    A directory list is a parameter-sized table per mirror; the numbering still
    goes through range partitions.
    """
    numbered = rank_in_group(dirs, ["mirror"], ["id"], "dir_no")
    counted = with_group_total(numbered, ["mirror"], F.count(F.lit(1)), "_dirs")
    per_dir = F.floor(F.lit(files) / F.col("_dirs"))
    return (
        counted.filter(per_dir >= 1)
        .withColumn("file_no", F.explode(F.sequence((F.col("dir_no") - 1) * per_dir + 1, F.col("dir_no") * per_dir)))
        .drop("_dirs")
    )


def win_total_rows(df: DataFrame, groups: Sequence[str] = ("server_id",)) -> DataFrame:
    return with_group_total(df, list(groups), F.count(F.lit(1)), "n")


# Order modes of a plan: column and direction, then the name as tie-breaker.
PLAN_MODES = {
    "LIST": ("start_position", True),
    "NAME_ASC": ("database_name", True),
    "NAME_DESC": ("database_name", False),
    "SIZE_ASC": ("database_size", True),
    "SIZE_DESC": ("database_size", False),
    "LOG_SIZE_SINCE_LAST_LOG_BACKUP_ASC": ("log_size", True),
    "LOG_SIZE_SINCE_LAST_LOG_BACKUP_DESC": ("log_size", False),
    "DATABASE_LAST_GOOD_CHECK_ASC": ("last_good_check", True),
    "DATABASE_LAST_GOOD_CHECK_DESC": ("last_good_check", False),
    "REPLICA_LAST_GOOD_CHECK_ASC": ("last_command", True),
    "REPLICA_LAST_GOOD_CHECK_DESC": ("last_command", False),
}


def plan_sort(mode: str) -> list[Column]:
    name, asc = PLAN_MODES[mode]
    first = F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last()
    return [first] if name == "database_name" else [first, F.col("database_name").asc()]


def win_plan_order(inventory: DataFrame, mode: str = "LIST") -> DataFrame:
    """Position of each database in the work plan of its server."""
    return rank_in_group(inventory, ["server_id"], plan_sort(mode), "plan_order")


def win_object_order(objects: DataFrame) -> DataFrame:
    """Work order within a server: resumable first, then list position, schema, object, indexes before statistics, and so on."""
    order = [
        F.coalesce(F.col("resumable"), F.lit(False)).desc(),
        F.col("start_position").asc(),
        F.col("schema_name").asc(),
        F.col("object_name").asc(),
        F.col("index_type").isNull().asc(),
        F.col("index_type").asc(),
        F.col("index_name").asc(),
        F.col("statistics_name").asc(),
        F.col("partition_number").asc(),
    ]
    return rank_in_group(objects, ["server_id"], order, "plan_order")


def win_action_priority(df: DataFrame, spec_col: str, group_col: str, delimiter: str = ",") -> DataFrame:
    """group, priority, action for each element of a delimited preference list."""
    items = F.split(F.regexp_replace(F.col(spec_col), r"\s+", ""), delimiter)
    return (
        df.select(group_col, F.posexplode(items).alias("_pos", "action"))
        .filter(F.col("action") != "")
        .select(group_col, (F.col("_pos") + 1).cast("bigint").alias("priority"), "action")
    )


def win_min_position(matches: DataFrame) -> DataFrame:
    return matches.groupBy("name").agg(F.min("start_position").alias("start_position"))


def win_last_in_list(files: DataFrame, group: str = "database_name", order: str = "file_no") -> DataFrame:
    """Mark the last file of each list by comparing with the group's largest number."""
    last = with_group_total(files, own_keys([group], files), F.max(order), "_last")
    return last.withColumn("is_last", F.col(order) == F.col("_last")).drop("_last")


def top_lock_escalations(index_operational: DataFrame, k: int = 3) -> DataFrame:
    order = [F.col("index_lock_promotion_count").desc(), F.col("object_name").asc()]
    return top_k(index_operational, own_keys(["database_name"], index_operational), order, k)


def top_page_lock_waits(index_operational: DataFrame, missing: DataFrame, k: int = 3) -> DataFrame:
    order = [F.col("page_lock_wait_count").desc(), F.col("object_name").asc()]
    top = top_k(index_operational, own_keys(["database_name"], index_operational), order, k)
    return join_left_flag(top, missing, own_keys(["database_name", "object_name"], top, missing), "missing_index")


def top_page_splits(index_operational: DataFrame, k: int = 10) -> DataFrame:
    order = [F.col("leaf_allocation_count").desc(), F.col("object_name").asc()]
    return top_k(index_operational, own_keys(["database_name"], index_operational), order, k)


def top_processes(processes: DataFrame, metric: str, k: int = 3) -> DataFrame:
    return top_k(processes, ["host"], [F.col(metric).desc(), F.col("process_id").asc()], k)


def top_peak_sample(perf: DataFrame, counter: str, companion: str) -> DataFrame:
    """Per server the highest value of ``counter`` and the companion counter at that time."""
    peak = (
        perf.filter(F.col("counter_name") == counter)
        .groupBy("server_id")
        .agg(
            F.max(F.struct("cntr_value", F.struct("check_date", "sample_id").alias("at"))).alias("_p")
        )
        .select(
            "server_id",
            F.col("_p.cntr_value").alias("peak_value"),
            F.col("_p.at.check_date").alias("check_date"),
            F.col("_p.at.sample_id").alias("sample_id"),
        )
    )
    other = perf.filter(F.col("counter_name") == companion).select(
        "server_id", "sample_id", F.col("cntr_value").alias("companion_value")
    )
    return peak.join(other, ["server_id", "sample_id"], "left").drop("sample_id")


def top_latest_n(df: DataFrame, ts: str, n: int, tie: str, groups: Sequence[str] = ("server_id",)) -> DataFrame:
    return top_k(df, list(groups), [F.col(ts).desc(), F.col(tie).desc()], n)


def sort_report(findings: DataFrame) -> DataFrame:
    """Not achieved first, then by rule name: a range-partitioned global sort."""
    return findings.orderBy("achieved", "name", "server_id", "scope", "details")


__all__ = [n for n in dir() if n.startswith(("win_", "top_"))] + ["sort_report", "plan_sort", "parse_list"]
