"""Scalar functions as DataFrame operators (keys fn_*): each adds one column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S


def fn_between_delimiters(df: DataFrame, col: str, d: str = ":", out: str = "parsed") -> DataFrame:
    """Text between the first and the second delimiter; rows with fewer delimiters are dropped."""
    enough = F.instr(F.substring_index(col, d, 2), d) > 0
    two = F.length(F.col(col)) > F.length(F.substring_index(col, d, 2))
    return df.filter(enough & two).withColumn(out, F.split_part(F.col(col), F.lit(d), F.lit(2)))


def fn_first_word(df: DataFrame, col: str, out: str = "first_word") -> DataFrame:
    """Text up to and including the first blank; empty when there is no blank."""
    at = F.instr(F.col(col), " ")
    return df.withColumn(out, F.substring(F.col(col), F.lit(1), at))


def fn_string_cleanup(df: DataFrame, col: str, out: str = "cleaned") -> DataFrame:
    """Trailing blanks and unit suffixes removed from a counter name."""
    return df.withColumn(out, F.regexp_replace(F.rtrim(F.col(col)), r"(?i) pages| \((?:KB|MB)\)", ""))


def fn_split_list(df: DataFrame, col: str, d: str = ",") -> DataFrame:
    """One row per list item with its 1-based position."""
    return df.select(
        *df.columns, F.posexplode(F.split(F.col(col), S.re.escape(d))).alias("_p", "item")
    ).select(*df.columns, (F.col("_p") + 1).cast("bigint").alias("pos"), "item")


def fn_parse_name(df: DataFrame, col: str) -> DataFrame:
    """object, schema, database and server part of a dotted name, counted from the right."""
    parts = F.split(F.translate(F.col(col), "[]", ""), r"\.")
    names = ("object_part", "schema_part", "database_part", "server_part")
    return df.withColumns({n: F.try_element_at(parts, F.lit(-i)) for i, n in enumerate(names, 1)})


def fn_template(
    df: DataFrame, template: str, tokens: Mapping[str, Column], out: str = "path", separator: str = "/"
) -> DataFrame:
    """Fill ``{Token}`` placeholders.

    Tokens without a value are cut out first and the joints they leave are
    closed; only then are values filled in, so names keep their own separators.
    """
    c: Column = F.lit(template.replace("{DirectorySeparator}", "/").replace("\\", "/"))
    values = {t: F.nullif(v.cast("string"), F.lit("")) for t, v in tokens.items()}
    for token, value in values.items():
        mark = "{" + token + "}"
        c = F.replace(c, F.lit(mark), F.when(value.isNull(), "").otherwise(mark))
    for joint, closed in (
        (r"[_$]*_[_$]*", "_"),
        (r"[-$]*-[-$]*", "-"),
        (r"[_$-]*/[_$/-]*", "/"),
        (r"[_$-]+(?=\.\{)", ""),
        (r"^[_$/-]+|[_$/-]+$", ""),
    ):
        c = F.regexp_replace(c, joint, closed)
    c = F.replace(c, F.lit("/"), F.lit(separator))
    for token, value in values.items():
        c = F.replace(c, F.lit("{" + token + "}"), F.coalesce(value, F.lit("")))
    return df.withColumn(out, c)


def time_tokens(ts: Column) -> dict[str, Column]:
    """Date and time tokens, week number included."""
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    return {
        "Year": F.year(ts),
        "Month": pad(F.month(ts)),
        "Day": pad(F.dayofmonth(ts)),
        "Week": pad(F.weekofyear(ts)),
        "Hour": pad(F.hour(ts)),
        "Minute": pad(F.minute(ts)),
        "Second": pad(F.second(ts)),
    }


def fn_unit_conversion(df: DataFrame, name_col: str, value_col: str, out: str = "value_mb") -> DataFrame:
    """Pages (8 KB) and KB to MB by the counter name's suffix."""
    v = F.col(value_col).cast("double")
    name = F.col(name_col)
    return df.withColumn(
        out,
        F.when(name.ilike("%pages"), v / 128).when(name.ilike("%(KB)"), v / 1024).otherwise(v),
    )


def fn_packed_datetime(df: DataFrame, date_col: str, time_col: str, out: str = "run_ts") -> DataFrame:
    return df.withColumn(out, S.packed_datetime(date_col, time_col))


def fn_packed_duration(df: DataFrame, col: str, out: str = "duration") -> DataFrame:
    return df.withColumn(out, S.packed_duration(col))


def fn_datediff_boundary(df: DataFrame, unit: str, a, b, out: str = "diff") -> DataFrame:
    return df.withColumn(out, S.datediff_boundary(unit, a, b))


def fn_elapsed_label(df: DataFrame, seconds: str, out: str = "elapsed") -> DataFrame:
    return df.withColumn(out, S.elapsed_label(seconds))


def fn_boot_time(df: DataFrame, ticks: str, as_of, out: str = "boot_time") -> DataFrame:
    """as_of minus milliseconds since start, in whole seconds."""
    whole = F.floor(F.col(ticks) / 1000).cast("int")
    return df.withColumn(out, F.timestamp_add("SECOND", -whole, S.ts(as_of)).cast("timestamp_ntz"))


def fn_message_format(df: DataFrame, fmt: str, cols: Sequence[str], out: str = "message") -> DataFrame:
    return df.withColumn(out, F.format_string(fmt, *[F.col(c) for c in cols]))


def fn_localised_date(df: DataFrame, col: str, out: str = "long_date") -> DataFrame:
    """Long date text with English day and month names."""
    return df.withColumn(out, F.date_format(F.col(col), "EEEE, d. MMMM yyyy"))


def fn_version_compare(df: DataFrame, a: str, b: str, out: str = "at_least") -> DataFrame:
    """True when dotted version a >= b, compared number by number."""
    return df.withColumn(out, S.version_array(a) >= S.version_array(b))


def fn_null_handling(df: DataFrame, cols: Sequence[str], out: str = "first_known") -> DataFrame:
    """First column that is neither NULL nor empty."""
    return df.withColumn(out, F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cols]))


def fn_xml_extract(df: DataFrame, col: str, xpath: str, out: str = "extracted") -> DataFrame:
    return df.withColumn(out, F.xpath_string(F.col(col), F.lit(xpath)))


def fn_xml_build(df: DataFrame, cols: Sequence[str], out: str = "extended_info") -> DataFrame:
    """Structured detail text; JSON takes the place of XML."""
    return df.withColumn(out, F.to_json(F.struct(*cols)))


def fn_drive_letter(df: DataFrame, col: str, out: str = "drive") -> DataFrame:
    return df.withColumn(out, S.drive_letter(col))
