"""Expressions and small helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def id_remainder(col: Column, divisor: int) -> Column:
    """crc32 of the id's text modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % divisor


def uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values alone, so reruns and retries agree."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11)).cast("double") / float(1 << 53)


def where_computed(df: DataFrame, condition: Column) -> DataFrame:
    """Filters by columns that were costly to compute, without computing them again.

    A plain filter is pushed below the projections and carries a copy of every expression behind its columns with it. A
    filter that also reads the partition's number stays above.
    """
    return df.withColumn("#partition", F.spark_partition_id()).where(condition & (F.col("#partition") >= 0)).drop("#partition")
