"""Append sinks (keys sink_*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatch.functions import semantics as S
from fleetwatch.sources.roles import ROLES, conform


def sink_findings(findings: DataFrame, path: str, as_of) -> None:
    """Append rule outcomes below a ``run_date`` partition."""
    (
        findings.withColumn("run_date", S.ts(as_of).cast("date"))
        .write.mode("append")
        .partitionBy("run_date")
        .parquet(path)
    )


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return None


def sink_archive_append(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append only rows whose keys the archive lacks, so a repeated run adds nothing."""
    rows = df.dropDuplicates(list(keys))
    archive = _existing(df.sparkSession, path, df.schema)
    if archive is not None:
        a = rows.alias("a")
        b = archive.select(*[F.col(k).alias(f"_{k}") for k in keys])
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"_{k}"))
        rows = a.join(b, cond, "left_anti")
    rows.write.mode("append").parquet(path)


def sink_command_log(spark: SparkSession, rows: Sequence[dict], path: str) -> None:
    """Append audit rows of executed commands (one per command, written by the driver)."""
    schema = ROLES["command_log"]
    ordered = [tuple(r.get(f.name) for f in schema) for r in rows]
    spark.createDataFrame(ordered, schema).write.mode("append").parquet(path)


def sink_memory_history(history: DataFrame, path: str) -> None:
    history.write.mode("append").parquet(path)


def sink_conformed(df: DataFrame, path: str, role: str) -> None:
    conform(df, ROLES[role]).write.mode("append").parquet(path)
