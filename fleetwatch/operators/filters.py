"""Row filters and derived labels (keys flt_*, prj_*)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S


def flt_exclusion_list(
    df: DataFrame, key: str, names: Iterable[str], value_col: str | None = None, min_value: int = 1
) -> DataFrame:
    """Drop rows whose key is in a constant list; keep values of at least ``min_value``."""
    keep = ~F.col(key).isin(list(names))
    if value_col is not None:
        keep = keep & (F.col(value_col) >= min_value)
    return df.filter(keep)


def flt_trailing_window(df: DataFrame, ts: str, as_of, hours: int = 24) -> DataFrame:
    return df.filter(S.in_last(ts, as_of, hours, "HOUR"))


def flt_previous_calendar_day(df: DataFrame, ts: str, as_of) -> DataFrame:
    return df.filter(S.previous_day(ts, as_of))


def flt_since_yesterday_midnight(df: DataFrame, ts: str, as_of) -> DataFrame:
    return df.filter(S.since_yesterday(ts, as_of))


def flt_trailing_year(df: DataFrame, ts: str, as_of) -> DataFrame:
    return df.filter(S.trailing_year(ts, as_of))


def flt_any_pattern(df: DataFrame, col: str, patterns: Iterable[str]) -> DataFrame:
    return df.filter(S.any_ilike(col, patterns))


def flt_no_pattern(df: DataFrame, col: str, patterns: Iterable[str], escape: str = "|") -> DataFrame:
    """Keep rows that match none of the LIKE patterns.

    All patterns become one regular expression, so the test stays a plain filter
    on the scan instead of a nested-loop join with the pattern table.
    """
    patterns = list(patterns)
    if not patterns:
        return df
    regex = S.any_like_regex(patterns, escape)
    return df.filter(~F.coalesce(F.col(col).rlike(regex), F.lit(False)))


def flt_id_blocklist(
    df: DataFrame, host_class_col: str, id_col: str, blocklists: Mapping[str, Sequence[int]]
) -> DataFrame:
    """Keep rows of the listed host classes whose id is not blocked for that class."""
    keep = F.lit(False)
    for host_class, ids in blocklists.items():
        keep = keep | ((F.col(host_class_col) == host_class) & ~F.col(id_col).isin(list(ids)))
    return df.filter(keep)


def flt_system_objects(
    df: DataFrame, name_col: str, names: Sequence[str] = S.SYSTEM_DATABASES
) -> DataFrame:
    return df.filter(~F.lower(name_col).isin([n.lower() for n in names]))


def flt_range_band(df: DataFrame, col: str | Column, lo, hi) -> DataFrame:
    return df.filter(S.col(col).between(lo, hi))


def prj_case_map(df: DataFrame, code_col: str, map_df: DataFrame, default: str = "Other") -> DataFrame:
    """Attach ``reason`` from a (code, reason) lookup; codes compare case-insensitively."""
    lookup = map_df.select(F.lower("code").alias("_code"), F.col("reason").alias("_reason"))
    return (
        df.join(lookup, F.lower(F.col(code_col)) == F.col("_code"), "left")
        .withColumn("reason", F.coalesce("_reason", F.lit(default)))
        .drop("_code", "_reason")
    )


def prj_environment(df: DataFrame, name_col: str) -> DataFrame:
    """DEV / REF / PRO from the instance name, else host class 1, 2 or 4 from its last digit."""
    name = F.upper(F.col(name_col))
    last = F.right(F.col(name_col), F.lit(1))
    env = (
        F.when(name.contains("DEV"), "DEV")
        .when(name.contains("REF"), "REF")
        .when(name.contains("PRO"), "PRO")
        .when(last.isin("1", "2", "4"), F.concat(F.lit("HOST"), last))
        .otherwise("OTHER")
    )
    return df.withColumn("environment", env)


def prj_bool_label(df: DataFrame, expr: Column, out: str = "flag") -> DataFrame:
    return df.withColumn(out, F.when(expr, "Y").otherwise("N"))


def prj_safe_name(df: DataFrame, col: str, out: str = "safe_name") -> DataFrame:
    """Name without the characters a path must not contain."""
    return df.withColumn(out, F.rtrim(F.regexp_replace(F.col(col), r'[\\/:*?"<>|]', "")))
