"""Readers of exported logs and events (keys src_*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.sources.roles import ROLES

_LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?)\s+(\S+)\s+(.*)$"


def parse_error_log(lines: DataFrame) -> DataFrame:
    """``value`` lines to (log_date, process_info, text); continuation lines have a NULL date."""
    part = lambda n: F.nullif(F.regexp_extract("value", _LOG_LINE, n), F.lit(""))
    when = part(1)
    return lines.select(
        when.try_cast("timestamp_ntz").alias("log_date"),
        part(2).alias("process_info"),
        F.when(when.isNull(), F.col("value")).otherwise(part(3)).alias("text"),
    )


def src_text_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_error_log(spark.read.text(path))


def src_access_log(spark: SparkSession, path: str) -> DataFrame:
    """Blank-delimited web log; ``#`` header and comment lines are skipped, ``-`` means NULL."""
    return (
        spark.read.schema(ROLES["access_log"])
        .option("sep", " ")
        .option("comment", "#")
        .option("nullValue", "-")
        .csv(path)
    )


def parse_event_xml(lines: DataFrame, object_pattern: str = "%deadlock%") -> DataFrame:
    """One XML event per line to (event_time, payload), filtered by event name.

    Name and time are attributes of the start tag, so no document is parsed for
    the rows the filter drops.
    """
    attribute = lambda a: F.regexp_extract("value", rf'<event\b[^>]*?\s{a}="([^"]*)"', 1)
    stamp = F.replace(attribute("timestamp"), F.lit("Z"), F.lit(""))
    return lines.filter(attribute("name").ilike(object_pattern)).select(
        stamp.try_cast("timestamp_ntz").alias("event_time"), F.col("value").alias("payload")
    )


def src_event_xml(spark: SparkSession, path: str, object_pattern: str = "%deadlock%") -> DataFrame:
    return parse_event_xml(spark.read.text(path), object_pattern)


def src_trace(
    spark: SparkSession,
    path: str,
    classes: Sequence[int] = (22, 92, 93, 94, 95, 116),
    min_severity: int = 17,
    min_duration: int = 15_000_000,
) -> DataFrame:
    """Exported trace rows of all rollover files of a directory.

    Errors below the severity and growth events below the duration are left
    out.
    """
    return spark.read.schema(ROLES["trace"]).parquet(path).filter(
        F.col("event_class").isin(list(classes))
        & ((F.col("event_class") != 22) | (F.col("severity") >= min_severity))
        & (~F.col("event_class").isin(92, 93) | (F.col("duration") > min_duration))
    )


TICKS_TO_EPOCH = 62135596800


def parse_hotfixes(lines: DataFrame) -> DataFrame:
    """Blank-delimited inventory lines to (kb, description, hotfix_id, installed_on).

    The date is M/d/yyyy text, or hexadecimal ticks (100 ns since year 1).
    """
    line = F.col("value")
    for two, one in (("Security Update", "Security-Update"), ("NT AUTHORITY", "NT-AUTHORITY")):
        line = F.replace(line, F.lit(two), F.lit(one))
    parts = F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")
    at = lambda i: F.try_element_at(parts, F.lit(i + 1))
    ticks = F.conv(at(5), 16, 10).try_cast("bigint")
    from_ticks = F.timestamp_seconds(F.floor(ticks / 10_000_000) - TICKS_TO_EPOCH).cast("timestamp_ntz")
    day = F.when(at(5).like("%/%/%"), F.try_to_timestamp(at(5), F.lit("M/d/yyyy")).cast("timestamp_ntz")).otherwise(
        F.date_trunc("DAY", from_ticks).cast("timestamp_ntz")
    )
    return lines.filter(F.trim("value") != "").select(
        at(0).alias("kb"), at(2).alias("description"), at(3).alias("hotfix_id"), day.alias("installed_on")
    )


def src_hotfix_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_hotfixes(spark.read.text(path))


def src_event_export(spark: SparkSession, path: str) -> DataFrame:
    """Exported operating-system events, one JSON object per line."""
    return spark.read.schema(ROLES["os_events"]).json(path)


def src_file_listing(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"))
    )



