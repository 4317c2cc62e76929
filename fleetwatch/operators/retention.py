"""Retention and purge (keys purge_*, retention_cutoff).

Purges return the kept rows and the deleted count; a caller writes the kept
rows to a new path.  Nothing is deleted in place.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators.joins import join_asof_state


@dataclass(frozen=True)
class PurgeResult:
    """Kept rows and a one-row DataFrame (table_name, kept_count, deleted_count)."""

    kept: DataFrame
    counts: DataFrame


# The tables that hang on an execution, children first: table, its key to the parent, the parent, and the
# parent's column that the key refers to.
CASCADE_KEYS = (
    ("event_message_context", "event_message_id", "event_messages", "event_message_id"),
    ("event_messages", "operation_id", "executions", "execution_id"),
    ("executable_statistics", "execution_id", "executions", "execution_id"),
    ("execution_data_statistics", "execution_id", "executions", "execution_id"),
    ("execution_component_phases", "execution_id", "executions", "execution_id"),
    ("execution_data_taps", "execution_id", "executions", "execution_id"),
    ("execution_parameter_values", "execution_id", "executions", "execution_id"),
    ("execution_property_override_values", "execution_id", "executions", "execution_id"),
    ("executions", "execution_id", None, "execution_id"),
    ("operation_messages", "operation_id", "executions", "execution_id"),
    ("extended_operation_info", "operation_id", "executions", "execution_id"),
    ("operation_os_sys_info", "operation_id", "executions", "execution_id"),
    ("validations", "validation_id", "executions", "execution_id"),
    ("operation_permissions", "object_id", "executions", "execution_id"),
    ("operations", "operation_id", "executions", "execution_id"),
)


def expired_keys(roots: DataFrame, as_of, days: int, enabled: bool = True) -> DataFrame:
    """Keys older than the retention; none unless purging is enabled and days > 0."""
    old = F.col("created_time") < S.minus(as_of, days, "DAY")
    return roots.filter(old & F.lit(bool(enabled and days > 0))).select("execution_id").distinct()


def _split(name: str, table: DataFrame, expired: DataFrame, key: str, guard=None) -> PurgeResult:
    gone = expired.withColumnRenamed("execution_id", key).withColumn("_gone", F.lit(True))
    marked = table.join(gone, key, "left").withColumn(
        "_gone", F.coalesce("_gone", F.lit(False)) & (F.lit(True) if guard is None else guard)
    )
    counts = marked.agg(
        F.count_if(~F.col("_gone")).alias("kept_count"), F.count_if(F.col("_gone")).alias("deleted_count")
    ).select(F.lit(name).alias("table_name"), "kept_count", "deleted_count")
    return PurgeResult(marked.filter(~F.col("_gone")).select(*table.columns), counts)


def purge_cascade(
    tables: Mapping[str, DataFrame], roots: DataFrame, as_of, days: int, enabled: bool = True, partial: bool = False
) -> dict[str, PurgeResult]:
    """Remove expired executions and everything that hangs on them.

    The frontier of expired keys is carried from parent to child along ``CASCADE_KEYS``: a table's expired rows give the
    keys that its children are matched with, read before that table itself is reduced.  Each table is one left join with
    its parent's frontier.  All tables must be given unless ``partial``; then those absent stay as they are.
    """
    absent = [name for name, *_ in CASCADE_KEYS if name not in tables]
    if absent and not partial:
        raise ValueError(f"tables not given: {', '.join(absent)}")
    edges = {name: edge for name, *edge in CASCADE_KEYS}

    def frontier(parent: str | None, column: str) -> DataFrame:
        """Values of the parent's column in its expired rows; the expired executions at the top."""
        if parent in (None, "executions"):
            return expired_keys(roots, as_of, days, enabled)
        key, above, referred = edges[parent]
        gone = frontier(above, referred).withColumnRenamed("execution_id", key)
        return tables[parent].join(gone, key, "left_semi").select(F.col(column).alias("execution_id")).distinct()

    guard = {"operations": F.col("start_time").isNotNull()}
    return {
        name: _split(name, tables[name], frontier(parent, column), key, guard.get(name))
        for name, key, parent, column in CASCADE_KEYS
        if name in tables and (parent in (None, "executions") or parent in tables)
    }


def purge_parent_guard(parents: DataFrame, expired: DataFrame, key: str, start_col: str) -> DataFrame:
    """Kept parents: not expired, or never started."""
    gone = expired.select(F.col("execution_id").alias("_k")).distinct()
    return parents.join(gone, (F.col(key) == F.col("_k")) & F.col(start_col).isNotNull(), "left_anti")


def purge_history(df: DataFrame, ts: str, as_of, days: int = 30) -> DataFrame:
    """Kept history: at most ``days`` day boundaries old."""
    return df.filter(S.datediff_boundary("DAY", ts, S.ts(as_of)) <= days)


def purge_files(listing: DataFrame, pattern: str, as_of, days: int = 30) -> DataFrame:
    """Candidate files by name pattern (``*`` and ``?``) older than ``days`` days."""
    name = F.element_at(F.split("path", "/"), -1)
    age = S.datediff_boundary("DAY", "modified_at", S.ts(as_of))
    return listing.filter(name.rlike(fnmatch.translate(pattern)) & (age > days)).select(
        "path", age.alias("age_days")
    )


def delete_files(candidates: DataFrame, apply: bool = False) -> DataFrame:
    """Delete candidates; only with ``apply=True``.  Adds ``deleted`` and ``outcome``.

    Paths are addresses that pyarrow knows (``file:``, plain paths, object stores); each is removed where its task runs,
    so nothing is collected.  ``outcome`` is ``kept`` without ``apply``, else ``deleted``, ``not found``, ``not a file`` or
    the error's text.  A retried task finds files that its first attempt removed: they count as ``not found``.
    """
    if not apply:
        return candidates.withColumns({"deleted": F.lit(False), "outcome": F.lit("kept")})

    def remove(batches):
        from pyarrow import fs

        for pdf in batches:
            told = []
            for path in pdf["path"]:
                try:
                    store, place = fs.FileSystem.from_uri(path)
                    kind = store.get_file_info(place).type
                    if kind == fs.FileType.NotFound:
                        told.append("not found")
                    elif kind != fs.FileType.File:
                        told.append("not a file")
                    else:
                        store.delete_file(place)
                        told.append("deleted")
                except (OSError, ValueError) as error:
                    told.append(str(error))
            yield pdf.assign(deleted=[t == "deleted" for t in told], outcome=told)

    return candidates.mapInPandas(remove, "path string, age_days bigint, deleted boolean, outcome string")


def retention_cutoff(plans: DataFrame, base_backups: DataFrame, as_of, hours: int) -> DataFrame:
    """Clean-up cut-off per plan row: the earlier of as_of - hours and the newest safe base backup.

    Log plans without a known safe base have no cut-off and are skipped.
    """
    by_age = S.minus(as_of, hours, "HOUR")
    state = join_asof_state(plans, base_backups)
    return state.select(
        "server_id",
        "database_name",
        "backup_type",
        F.when(
            F.col("backup_type") == "LOG",
            F.when(F.col("latest_safe").isNotNull(), F.least(F.col("latest_safe"), by_age)),
        )
        .otherwise(by_age)
        .alias("cutoff"),
    )
