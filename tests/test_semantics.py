"""Cases where the plain Spark function would give another answer."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators import scalars as SC
from fleetwatch.operators.aggregates import agg_throughput


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


@pytest.mark.parametrize(
    "unit, a, b, want",
    [
        ("HOUR", "2024-01-01 00:59:00", "2024-01-01 01:01:00", 1),
        ("MINUTE", "2024-01-01 00:00:59", "2024-01-01 00:01:00", 1),
        ("DAY", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("MONTH", "2023-12-31 00:00:00", "2024-01-01 00:00:00", 1),
        ("MONTH", "2024-01-01 00:00:00", "2024-01-31 00:00:00", 0),
        ("SECOND", "2024-01-01 00:00:00", "2024-01-01 00:00:05", 5),
    ],
)
def test_datediff_counts_boundaries(spark, unit, a, b, want):
    assert one(spark, S.datediff_boundary(unit, S.ts(a), S.ts(b))) == want


def test_packed_datetime_zero_is_never(spark):
    df = spark.createDataFrame([(20240131, 93005), (0, 0), (20240131, 0)], "d int, t int")
    got = [r.x for r in df.select(S.packed_datetime("d", "t").alias("x")).collect()]
    assert got == [datetime(2024, 1, 31, 9, 30, 5), None, datetime(2024, 1, 31)]


def test_durations(spark):
    assert one(spark, S.packed_duration(F.lit(10203))) == "01:02:03"
    assert one(spark, S.elapsed_label(F.lit(59))) == "00:00:59"
    assert one(spark, S.elapsed_label(F.lit(90061))) == "1.01:01:01"


def test_versions_compare_as_numbers(spark):
    df = spark.createDataFrame([("9.0", "13.0"), ("13.0.5026.0", "13.0.5026.0"), ("14.0", "9.9")], "a string, b string")
    assert [r.at_least for r in SC.fn_version_compare(df, "a", "b").collect()] == [False, True, True]


@pytest.mark.parametrize(
    "pattern, text, want",
    [
        ("%login FAILED%", "xx Login failed for u", True),
        ("Log was backed up%", "Log was backed up.", True),
        ("Log was backed up%", "The Log was backed up", False),
        ("%end", "the end", True),
        ("%end", "the end.", False),
        ("a_c", "abc", True),
        ("|[184|] Job % done%", "[184] Job x done now", True),
        ("100|%", "100%", True),
        ("100|%", "1000", False),
        ("%a%b%", "xa\ny b", True),
        ("exact", "exact", True),
        ("exact", "exact\n", False),
    ],
)
def test_like_patterns_as_search(spark, pattern, text, want):
    assert one(spark, F.lit(text).rlike(S.any_like_regex([pattern, "never-matches"]))) is want


def test_zero_seconds_give_null_speed(spark):
    sets = spark.createDataFrame(
        [("s", 1, "db", "D", datetime(2024, 1, 1), datetime(2024, 1, 1), False)],
        "server_id string, backup_set_id bigint, database_name string, type string, "
        "backup_start_date timestamp_ntz, backup_finish_date timestamp_ntz, is_damaged boolean",
    )
    files = spark.createDataFrame([("s", 1, "D", 1048576)], "server_id string, backup_set_id bigint, file_type string, file_size bigint")
    assert agg_throughput(sets, files).first().mb_per_sec is None


def test_template_closes_gaps_and_keeps_names(spark):
    df = spark.createDataFrame([("s1", None, "my__db", "FULL", None)], "s string, i string, d string, t string, c string")
    tokens = {"S": F.col("s"), "I": F.col("i"), "D": F.col("d"), "T": F.col("t"), "C": F.col("c")}
    got = SC.fn_template(df, "{S}${I}{DirectorySeparator}{D}{DirectorySeparator}{T}_{C}.{T}", tokens).first().path
    assert got == "s1/my__db/FULL.FULL"


def test_between_delimiters_needs_two(spark):
    df = spark.createDataFrame([("a:b:c",), ("a:b",), ("::",), ("x",)], "t string")
    assert [r.parsed for r in SC.fn_between_delimiters(df, "t").collect()] == ["b", ""]
