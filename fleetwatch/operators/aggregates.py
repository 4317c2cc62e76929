"""Aggregations (keys agg_*) and set operations (keys set_*)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators.filters import flt_system_objects, flt_trailing_year
from fleetwatch.operators.joins import join_inner_history, own_keys
from fleetwatch.plans.ordering import string_list


def full_data_files(backupset: DataFrame, backupfile: DataFrame, as_of=None) -> DataFrame:
    """Data files of full backups of user databases, optionally of the trailing year."""
    sets = flt_system_objects(backupset.filter(F.col("type") == "D"), "database_name")
    if as_of is not None:
        sets = flt_trailing_year(sets, "backup_start_date", as_of)
    return join_inner_history(sets, backupfile.filter(F.col("file_type") == "D"))


def agg_monthly_average_pivot(
    backupset: DataFrame, backupfile: DataFrame, as_of, months: int = 12
) -> DataFrame:
    """Mean full-backup size (MB) per server and database, one column per month ago."""
    rows = full_data_files(backupset, backupfile, as_of).withColumn(
        "months_ago", S.datediff_boundary("MONTH", "backup_start_date", S.ts(as_of))
    )
    mean = F.sum("file_size").cast("double") / F.count("file_size") / S.MB
    return (
        rows.groupBy("server_id", "database_name")
        .pivot("months_ago", list(range(months + 1)))
        .agg(F.round(mean, 1))
        .select("server_id", "database_name", *[F.col(str(m)).alias(f"m{m}") for m in range(months + 1)])
    )


def agg_throughput(backupset: DataFrame, backupfile: DataFrame, as_of=None) -> DataFrame:
    """Size, duration and MB/s per server, database and backup; zero seconds gives NULL."""
    rows = full_data_files(backupset, backupfile, as_of).select(
        "server_id",
        "database_name",
        F.round(F.col("file_size") / S.MB, 1).alias("size_mb"),
        S.seconds_between("backup_start_date", "backup_finish_date").alias("seconds"),
        "file_size",
    )
    return rows.groupBy("server_id", "database_name", "size_mb", "seconds").agg(
        F.try_divide(
            F.sum("file_size").cast("double") / F.count("file_size") / S.MB, F.col("seconds")
        ).alias("mb_per_sec")
    )


def agg_free_space_share(buffer_pages: DataFrame) -> DataFrame:
    """Buffer-cache pages and free space per object."""
    return (
        buffer_pages.groupBy(*own_keys(["object_name", "type_desc"], buffer_pages))
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum("free_space_in_bytes").alias("_free"),
        )
        .withColumn("mb", F.col("pages") * 8 / 1024)
        .withColumn("free_mb", F.col("_free") / S.MB)
        .withColumn("free_pct", F.round(F.col("free_mb") / F.col("mb") * 100, 2))
        .drop("_free")
    )


def agg_record_duration(rows: DataFrame) -> DataFrame:
    """Size and longest run per table, index and command (and server, where the rows name it)."""
    return rows.groupBy(*own_keys(["table_name"], rows), "index_name", "command").agg(
        (F.sum("used_pages") * 8 / 1024).alias("mb"), F.max("seconds").alias("max_seconds")
    )


def agg_having_ratio(
    table_stats: DataFrame, min_rows: int = 500, frac: float = 0.2, base: int = 500
) -> DataFrame:
    """Tables whose largest modification counter exceeds frac * rows + base."""
    return (
        table_stats.groupBy(*own_keys(["schema_id", "table_name"], table_stats))
        .agg(
            F.max("row_count").alias("row_count"),
            F.max("modification_counter").alias("mods"),
            F.count(F.lit(1)).alias("stat_count"),
        )
        .filter((F.col("row_count") > min_rows) & (F.col("mods") > F.col("row_count") * frac + base))
    )


def agg_having_latest_age(
    backupset: DataFrame, as_of, min_hours: int | None = None, max_hours: int | None = None
) -> DataFrame:
    """Newest full backup per database whose age lies in (min_hours, max_hours)."""
    out = (
        backupset.filter(F.col("type") == "D")
        .groupBy("server_id", "database_name")
        .agg(F.max("backup_finish_date").alias("last_full"))
        .withColumn("hours", S.datediff_boundary("HOUR", "last_full", S.ts(as_of)))
    )
    if min_hours is not None:
        out = out.filter(F.col("last_full") < S.minus(as_of, min_hours, "HOUR"))
    if max_hours is not None:
        out = out.filter(F.col("last_full") > S.minus(as_of, max_hours, "HOUR"))
    return out


def agg_having_distinct(df: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Groups with more than one distinct value in any of ``cols``."""
    differs = reduce(lambda a, b: a | b, [F.min(c) != F.max(c) for c in cols])
    return df.groupBy(*group).agg(differs.alias("_differs")).filter("_differs").drop("_differs")


def agg_having_multi(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def agg_conditional_count(columns: DataFrame, type_name: str = "varchar", length: int = 255) -> DataFrame:
    """Tables with more than one column of the given type and length."""
    hit = (F.lower("type_name") == type_name) & (F.col("max_length") == length)
    return (
        columns.groupBy(*own_keys(["schema_name", "table_name"], columns))
        .agg(F.count_if(hit).alias("num_cols"))
        .filter(F.col("num_cols") > 1)
    )


def agg_ratio_of_sums(df: DataFrame, num: str, den: str) -> DataFrame:
    return df.groupBy("server_id").agg(
        F.try_divide(F.sum(num).cast("double") * 100, F.sum(den)).alias("pct")
    )


def agg_coalesced_category(log_records: DataFrame) -> DataFrame:
    return log_records.groupBy(
        "server_id", F.coalesce("alloc_unit_name", "operation").alias("category")
    ).agg(F.sum("record_length").alias("bytes"))


def agg_distinct_rows(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols).distinct()


def agg_dedupe_group_all(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def agg_string_list(df: DataFrame, group: Sequence[str], col: str, sep: str = ", ") -> DataFrame:
    return string_list(df, list(group), col, "names", sep)


def agg_occurrence_summary(log: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Count, first and last time per pattern; one pass over the log for all patterns."""
    hits = F.array_compact(F.array(*[F.when(F.col("text").ilike(p), F.lit(p)) for p in patterns]))
    return (
        log.select("log_date", F.explode(hits).alias("pattern"))
        .groupBy("pattern")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("log_date").alias("first_ts"),
            F.max("log_date").alias("last_ts"),
        )
    )


def agg_count_over_threshold(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > n)


def agg_extent_totals(space: DataFrame) -> DataFrame:
    return (
        space.groupBy(*own_keys(["database_name"], space))
        .agg(
            F.sum("allocated_extent_page_count").alias("allocated"),
            F.sum("modified_extent_page_count").alias("modified"),
        )
        .withColumn("change_pct", F.try_divide(F.col("modified").cast("double"), F.col("allocated")) * 100)
    )


def agg_two_level(schedulers: DataFrame) -> DataFrame:
    """Schedulers per node, then nodes per scheduler count."""
    per_node = schedulers.groupBy("server_id", "node_id").agg(F.count(F.lit(1)).alias("cpus_per_node"))
    return per_node.groupBy("server_id", "cpus_per_node").agg(F.count(F.lit(1)).alias("nodes"))


def agg_residual(
    tree: DataFrame, parent_id: int, residual_id: int, name: str = "<Other Memory Clerks>"
) -> DataFrame:
    """Tree plus one row per server: the parent's value minus the sum of its children."""
    keys = ["server_id", "snapshot_ts"]
    rest = tree.groupBy(*keys).agg(
        F.sum(F.when(F.col("id") == parent_id, F.col("value_mb"))).alias("_parent"),
        F.sum(F.when(F.col("parent_id") == parent_id, F.col("value_mb"))).alias("_children"),
    )
    other = rest.filter(F.col("_children").isNotNull()).select(
        *keys,
        F.lit(residual_id).alias("id"),
        F.lit(parent_id).alias("parent_id"),
        F.lit(name).alias("counter_name"),
        (F.col("_parent") - F.col("_children")).alias("value_mb"),
    )
    return tree.unionByName(other)


def agg_size_total(files: DataFrame) -> DataFrame:
    """Number of databases and total size (8 KB pages to GB) per server."""
    per_db = files.groupBy("server_id", "database_name").agg(F.sum("size_pages").alias("_p"))
    return per_db.groupBy("server_id").agg(
        F.count(F.lit(1)).alias("databases"),
        F.round(F.sum("_p") * 8 / 1024 / 1024, 2).alias("total_gb"),
    )


def set_union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def set_union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def set_difference(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Distinct rows of ``expected`` that ``present`` lacks."""
    return expected.subtract(present)
