"""Jobs that write or verify tables: compaction, statistics, exports, checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.operators.aggregates import agg_having_multi
from fleetwatch.plans.ordering import running_sum
from fleetwatch.session import settled, work_path


def list_files(spark: SparkSession, path: str, table_name: str, partition_col: str) -> DataFrame:
    """Listing rows (table, partition, file, bytes, rows) of a partitioned Parquet table."""
    meta = spark.read.parquet(path).select(
        F.col(partition_col).alias("partition_id"),
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_size").alias("file_bytes"),
    )
    return meta.groupBy("partition_id", "file_name").agg(
        F.max("file_bytes").alias("file_bytes"), F.count(F.lit(1)).alias("file_rows")
    ).withColumn("table_name", F.lit(table_name))


def _chosen(partition_col: str, ids: Sequence) -> Column:
    """Literal condition on the partition column, so that other partitions are not even listed for the scan."""
    known = [i for i in ids if i is not None]
    hit = F.col(partition_col).isin(known) if known else F.lit(False)
    return hit | F.col(partition_col).isNull() if len(known) < len(ids) else hit


def stage_compact(
    spark: SparkSession, path: str, partition_col: str, inventory: DataFrame, target_bytes: int = 256 << 20
) -> str | None:
    """Write the partitions of ``inventory`` (partition_id, bytes) anew, beside the old files, and return the staging folder.

    A partition of b bytes becomes ceil(b / target_bytes) files with equal numbers of rows in their old order.  The new
    file of a row follows from its old file and place, so every new file is written whole by one task, and a large
    partition by many.  The folder, hidden below the table, holds the new files and a manifest of what to move in and
    what to drop; the table itself is unchanged until ``finish_compact``.  None if the inventory names no partition of
    the table.
    """
    ids = [r.partition_id for r in inventory.select("partition_id").distinct().collect()]
    if not ids:
        return None
    chosen = inventory.groupBy(F.col("partition_id").alias("_pid")).agg(F.sum("bytes").alias("bytes"))
    data = spark.read.parquet(path).filter(_chosen(partition_col, ids))
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    listed = settled(
        data.select(F.col(partition_col).alias("partition_id"), *at).groupBy("partition_id", "_file")
        .agg(F.count(F.lit(1)).alias("file_rows")), "compact-files",
    )
    wanted = F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("bigint")
    sizes = listed.groupBy("partition_id").agg(F.sum("file_rows").alias("rows"))
    sizes = sizes.join(chosen, F.col("partition_id").eqNullSafe(F.col("_pid"))).drop("_pid")
    sizes = sizes.withColumn("files", F.least(F.greatest(wanted, F.lit(1)), "rows"))
    sizes = settled(running_sum(sizes, [], ["partition_id"], "files", "_to"), "compact-partitions")
    total = sizes.agg(F.max("_to")).first()[0]
    if total is None:
        return None
    sizes = sizes.withColumnRenamed("partition_id", "_pid")
    before = running_sum(listed, ["partition_id"], ["_file"], "file_rows", "_rows_to")
    places = settled(
        before.join(sizes, F.col("partition_id").eqNullSafe(F.col("_pid")))
        .select("_file", (F.col("_rows_to") - F.col("file_rows")).alias("_from"), "rows", "files", (F.col("_to") - F.col("files")).alias("_first")),
        "compact-places",
    )
    name = f"_compact-{uuid.uuid4().hex}"
    staging = f"{path.rstrip('/')}/{name}"
    number = F.expr("_first + (_from + _row) * files div rows").cast("int")
    (
        data.select("*", *at).join(places, "_file")
        .repartitionById(total, number)
        .sortWithinPartitions(partition_col, "_file", "_row")
        .select(*data.columns)
        .write.partitionBy(partition_col)
        .parquet(f"{staging}/files")
    )
    new = spark.read.schema(data.schema).parquet(f"{staging}/files")
    new = new.groupBy(F.col(partition_col).alias("partition_id"), F.col("_metadata.file_path").alias("source")).agg(
        F.count(F.lit(1)).alias("file_rows")
    )
    add = new.select(
        "partition_id", F.lit("add").alias("action"), "source",
        F.replace("source", F.lit(f"/{name}/files/"), F.lit("/")).alias("target"), "file_rows",
    )
    drop = listed.select(
        "partition_id", F.lit("drop").alias("action"), F.col("_file").alias("source"), F.lit(None).cast("string").alias("target"), "file_rows"
    )
    add.unionByName(drop).write.parquet(f"{staging}/manifest")
    return staging


def _move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moves new files in and drops old ones; done steps are passed over, so the task can run again."""
    there = lambda store, place: store.get_file_info(place).type != fs.FileType.NotFound
    for batch in batches:
        for action, source, target in zip(batch["action"], batch["source"], batch["target"], strict=True):
            store, place = fs.FileSystem.from_uri(source)
            if action == "drop":
                if there(store, place):
                    store.delete_file(place)
                continue
            new = fs.FileSystem.from_uri(target)[1]
            if not there(store, new):
                store.move(place, new)
        yield batch[["action"]]


def finish_compact(spark: SparkSession, path: str, staging: str) -> DataFrame:
    """Put the staged files of ``stage_compact`` in place of the old ones, and return the rows written per partition.

    Partition by partition, new files are renamed into the table before the old ones are dropped: what is interrupted
    loses no row, and is completed by calling this again.  Until then readers may see rows of a partition twice.
    """
    manifest = spark.read.parquet(f"{staging}/manifest")
    steps = manifest.repartition("partition_id").sortWithinPartitions("partition_id", "action")
    steps.mapInPandas(_move, "action string").groupBy("action").count().collect()
    spark.catalog.refreshByPath(path)
    return manifest.filter("action = 'add'").groupBy("partition_id").agg(F.sum("file_rows").alias("rows_written"))


def mnt_compact(
    spark: SparkSession, path: str, partition_col: str, inventory: DataFrame, target_bytes: int = 256 << 20
) -> DataFrame:
    """Rewrite the partitions of ``inventory`` (partition_id, bytes) into files of about ``target_bytes``.

    The new files are complete in a hidden folder below the table before any old file goes; see ``stage_compact`` and
    ``finish_compact``, which also completes an interrupted swap.  The folder's manifest stays as the record of the run.
    Returns the number of rows written per partition.
    """
    staging = stage_compact(spark, path, partition_col, inventory, target_bytes)
    if staging is None:
        none = spark.read.parquet(path).select(F.col(partition_col).alias("partition_id"), F.lit(0).cast("bigint").alias("rows_written"))
        return none.filter(F.lit(False))
    return finish_compact(spark, path, staging)


def mnt_analyze(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> list[dict]:
    """Refresh table (and column) statistics; returns command-log rows."""
    command = f"ANALYZE TABLE {table} COMPUTE STATISTICS"
    if columns:
        command += " FOR COLUMNS " + ", ".join(columns)
    number, message = 0, None
    try:
        spark.sql(command)
    except Exception as error:  # the audit log records the failure of one command
        number, message = 1, str(error)
    return [
        {
            "object_name": table,
            "command": command,
            "command_type": "UPDATE_STATISTICS",
            "error_number": number,
            "error_message": message,
        }
    ]


def export_full(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path


def _row_hash(columns: Sequence[str]):
    """Hash of the values and of which of them are NULL, which the value hash skips."""
    names = sorted(columns)
    return F.xxhash64(*[F.col(c) for c in names], *[F.col(c).isNull() for c in names])


def export_diff(df: DataFrame, base_path: str, keys: Sequence[str], path: str) -> str:
    """Rows inserted, updated or deleted since the full export, with ``change`` I, U or D."""
    base = df.sparkSession.read.schema(df.schema).parquet(base_path)
    rest = [c for c in df.columns if c not in keys]
    whole = F.struct(F.lit(True), *[F.col(c) for c in rest])
    now = df.withColumn("_now", whole)
    old = base.select(*keys, whole.alias("_old"))
    joined = now.join(old, list(keys), "full")
    change = (
        F.when(F.col("_old").isNull(), "I")
        .when(F.col("_now").isNull(), "D")
        .when(~F.col("_now").eqNullSafe(F.col("_old")), "U")
    )
    joined.withColumn("change", change).filter("change IS NOT NULL").drop("_now", "_old").write.parquet(path)
    return path


def export_log(df: DataFrame, watermark: str, since, path: str) -> str:
    """Rows appended after the last exported watermark value."""
    df.filter(F.col(watermark) > since).write.parquet(path)
    return path


def table_digest(df: DataFrame) -> DataFrame:
    """Row count and an order-insensitive hash (sum of row hashes)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_row_hash(df.columns).cast("decimal(38,0)")).alias("hash")
    )


def export_verify(df: DataFrame, path: str) -> DataFrame:
    """Compare a DataFrame with its export: rows, hash, ok."""
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    both = table_digest(df).withColumn("_side", F.lit(0)).unionByName(
        table_digest(written).withColumn("_side", F.lit(1))
    )
    mine = lambda c: F.max(F.when(F.col("_side") == 0, F.col(c)))
    other = lambda c: F.max(F.when(F.col("_side") == 1, F.col(c)))
    return both.agg(
        mine("rows").alias("rows"),
        mine("hash").alias("hash"),
        (mine("rows").eqNullSafe(other("rows")) & mine("hash").eqNullSafe(other("hash"))).alias("ok"),
    )


def chk_integrity(
    df: DataFrame,
    keys: Sequence[str],
    not_null: Sequence[str] = (),
    ranges: Mapping[str, tuple] | None = None,
    foreign_keys: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """check, violations: readable rows, NULLs, value ranges, key uniqueness, foreign keys.

    NULL and range checks share one scan; the key check counts the surplus rows
    of repeated keys.
    """
    names = [("readable", F.lit(False))]
    names += [(f"not_null:{c}", F.col(c).isNull()) for c in not_null]
    names += [(f"range:{c}", ~F.col(c).between(lo, hi)) for c, (lo, hi) in (ranges or {}).items()]
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("violations")) for i, (n, _) in enumerate(names)]
    )
    parts = [counts.select(F.explode(pairs).alias("r")).select("r.*")]
    repeated = agg_having_multi(df, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    parts.append(repeated.select(F.lit("unique:" + ",".join(keys)).alias("check"), "violations"))
    for column, parent, parent_key in foreign_keys:
        known = parent.select(F.col(parent_key).alias(column)).distinct()
        missing = df.filter(F.col(column).isNotNull()).join(known, column, "left_anti")
        parts.append(
            missing.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(f"foreign_key:{column}").alias("check"), "violations"
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)
