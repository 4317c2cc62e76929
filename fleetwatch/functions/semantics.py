"""Column helpers for semantics that differ from Spark's defaults.

Timestamps are zone-less (``timestamp_ntz``); every operator takes ``as_of``
instead of reading the wall clock.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

GB = 1073741824
MB = 1048576

SYSTEM_DATABASES = ("master", "msdb", "model", "tempdb")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts(as_of) -> Column:
    """Pinned clock as a foldable literal, so filters on it reach the scan."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def minus(as_of, amount: int, unit: str) -> Column:
    return F.timestamp_add(unit, F.lit(-amount), ts(as_of)).cast("timestamp_ntz")


def midnight(as_of, days_ago: int = 0) -> Column:
    day = F.date_trunc("DAY", ts(as_of)).cast("timestamp_ntz")
    return F.timestamp_add("DAY", F.lit(-days_ago), day).cast("timestamp_ntz")


def in_last(c, as_of, amount: int, unit: str) -> Column:
    """(as_of - amount, as_of]"""
    return (col(c) > minus(as_of, amount, unit)) & (col(c) <= ts(as_of))


def previous_day(c, as_of) -> Column:
    """[midnight yesterday, midnight today)"""
    return (col(c) >= midnight(as_of, 1)) & (col(c) < midnight(as_of))


def since_yesterday(c, as_of) -> Column:
    return col(c) >= midnight(as_of, 1)


def trailing_year(c, as_of) -> Column:
    low = F.timestamp_add("YEAR", F.lit(-1), ts(as_of)).cast("timestamp_ntz")
    return col(c).between(low, ts(as_of))


def datediff_boundary(unit: str, start, end) -> Column:
    """Number of ``unit`` boundaries crossed from start to end (not elapsed units)."""
    start, end = col(start), col(end)
    unit = unit.upper()
    if unit == "MONTH":
        months = lambda c: F.year(c) * 12 + F.month(c)
        return (months(end) - months(start)).cast("bigint")
    if unit == "DAY":
        return F.datediff(end, start).cast("bigint")
    return F.timestamp_diff(unit, F.date_trunc(unit, start), F.date_trunc(unit, end))


def seconds_between(start, end) -> Column:
    return datediff_boundary("SECOND", start, end)


def like_to_regex(pattern: str, escape: str = "|") -> str:
    """Regular expression (for a search) equal to a LIKE pattern with an escape character."""
    start = "" if pattern.startswith("%") else r"\A"
    end = "" if pattern.endswith("%") and not pattern.endswith(escape + "%") else r"\z"
    body = pattern.strip("%") if not start and not end else pattern
    if start and not end:
        body = pattern.rstrip("%")
    elif end and not start:
        body = pattern.lstrip("%")
    out, i = [], 0
    while i < len(body):
        ch = body[i]
        if ch == escape and i + 1 < len(body):
            out.append(re.escape(body[i + 1]))
            i += 1
        elif ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        else:
            out.append(re.escape(ch))
        i += 1
    return start + "".join(out) + end


def any_like_regex(patterns: Iterable[str], escape: str = "|") -> str:
    """One case-insensitive expression for a whole pattern list."""
    return "(?isu)" + "|".join(like_to_regex(p, escape) for p in patterns)


def any_ilike(c, patterns: Iterable[str]) -> Column:
    """True when any case-insensitive LIKE pattern matches; the text is read once for all patterns."""
    patterns = list(patterns)
    if not patterns:
        return F.lit(False)
    if len(patterns) == 1:
        return col(c).ilike(patterns[0])
    return col(c).rlike(any_like_regex(patterns, escape="\\"))


def version_array(c) -> Column:
    """Dotted version text as array<int>, which compares numerically part by part."""
    return F.transform(F.split(col(c), r"\."), lambda x: x.try_cast("int"))


def packed_datetime(date_col, time_col) -> Column:
    """yyyymmdd + hhmmss integers to a timestamp; date 0 means never."""
    text = F.concat(
        F.lpad(col(date_col).cast("string"), 8, "0"), F.lpad(col(time_col).cast("string"), 6, "0")
    )
    parsed = F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
    return F.when(col(date_col) != 0, parsed)


def packed_duration(c) -> Column:
    """hhmmss integer to 'hh:mm:ss'."""
    t = F.lpad(col(c).cast("string"), 6, "0")
    return F.concat_ws(":", F.substring(t, 1, 2), F.substring(t, 3, 2), F.substring(t, 5, 2))


def elapsed_label(seconds) -> Column:
    """[d.]hh:mm:ss"""
    s = col(seconds).cast("bigint")
    days = F.floor(s / 86400)
    rest = s - days * 86400
    clock = F.format_string(
        "%02d:%02d:%02d",
        F.floor(rest / 3600),
        F.floor((rest % 3600) / 60),
        (rest % 60).cast("bigint"),
    )
    return F.when(days > 0, F.concat(days.cast("string"), F.lit("."), clock)).otherwise(clock)


def stamp(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def text(*parts) -> Column:
    """Message text from literals and columns; NULL parts print as 'N/A'."""
    cols = [
        F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("N/A")) for p in parts
    ]
    return F.concat(*cols)


def drive_letter(c) -> Column:
    return F.upper(F.left(col(c), F.lit(1)))


def fixed(c) -> Column:
    """Decimal text with two places."""
    return F.format_string("%.2f", col(c).cast("double"))
