"""Rankings, running totals and previous-row lookups that never put a whole group in one task.

A window over ``server_id`` (or over nothing) sends all rows of its largest
group to one task.  These helpers sort by range partitions instead, so a server
holding a third of all rows is spread like any other range of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from fleetwatch.session import settled, work_path

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _sort_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc() if isinstance(o, str) else o for o in order]


def ranges(df: DataFrame, keys: Sequence[Column], name: str = "ranged") -> DataFrame:
    """The rows in sorted ranges, written once: ``_part`` is a row's range and ``_pos`` its place in it.

    Range borders come from a sample of the keys, so a group of any size is spread over as many ranges as its share of
    the rows.  Rows that agree in all keys stay together: ``keys`` should end in a unique one.  What is read later sees
    the same ranges even when executors are lost, and reads only the columns it needs.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    ranged.write.parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    place = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return stored.withColumns({"_part": F.shiftright("_mid", _LOCAL_BITS), "_pos": place}).drop("_mid")


def _with_carry(
    stored: DataFrame, rows: DataFrame, groups: Sequence[str], total: Column, carry: Callable[[WindowSpec], Column]
) -> DataFrame:
    """Adds to ``rows`` the first place ``_first`` of the row's group in its range, and ``_carry`` from the ranges before.

    One row per (range, group) is all that crosses range borders: at most one per range plus one per group.
    """
    pieces = stored.groupBy("_part", *groups).agg(F.min("_pos").alias("_first"), total.alias("_total"))
    along = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_part")
    side = settled(
        pieces.select(
            F.col("_part").alias("_op"), *[F.col(g).alias(f"_o_{g}") for g in groups], "_first", carry(along).alias("_carry")
        ),
        "carried",
    )
    cond = F.col("_part") == F.col("_op")
    for g in groups:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    return rows.join(side, cond)


def _earlier(along: WindowSpec) -> WindowSpec:
    return along.rowsBetween(Window.unboundedPreceding, -1)


def rank_in_group(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], out: str) -> DataFrame:
    """``row_number() over (partition by groups order by order)`` without a huge task, by one plan at every size.

    Rows are numbered inside sorted ranges; the counts of the ranges before are added.  ``order`` must end in a unique
    key to make the numbering stable and to let the ranges split ties.
    """
    stored = ranges(df, [F.col(g).asc() for g in groups] + _sort_columns(order))
    met = _with_carry(stored, stored, groups, F.count(F.lit(1)), lambda w: F.sum("_total").over(_earlier(w)))
    rank = F.coalesce("_carry", F.lit(0)) + F.col("_pos") - F.col("_first") + 1
    return met.withColumn(out, rank.cast("bigint")).select(*df.columns, out)


def running_sum(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], value: str, out: str) -> DataFrame:
    """``sum(value) over (partition by groups order by order rows up to the current)`` in two levels.

    Sums run inside (range, group); only one total of each crosses range borders.
    """
    stored = ranges(df, [F.col(g).asc() for g in groups] + _sort_columns(order))
    inside = Window.partitionBy("_part", *groups).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = stored.withColumn("_inner", F.sum(value).over(inside))
    met = _with_carry(stored, rows, groups, F.sum(value), lambda w: F.sum("_total").over(_earlier(w)))
    return met.withColumn(out, F.col("_inner") + F.coalesce("_carry", F.lit(0))).select(*df.columns, out)


def previous_value(df: DataFrame, keys: Sequence[str], time: str, tie: str, value: str, out: str) -> DataFrame:
    """``lag(value) over (partition by keys order by time, tie)`` by ranges.

    The first row of a key in a range takes the last value of the key in the ranges before, found among one row per
    (range, key).
    """
    stored = ranges(df, [F.col(k).asc() for k in keys] + _sort_columns([time, tie]))
    rows = stored.withColumn("_before", F.lag(value).over(Window.partitionBy("_part", *keys).orderBy("_pos")))
    met = _with_carry(stored, rows, keys, F.max_by(F.col(value), "_pos"), lambda w: F.lag("_total").over(w))
    first = F.col("_pos") == F.col("_first")
    return met.withColumn(out, F.when(first, F.col("_carry")).otherwise(F.col("_before"))).select(*df.columns, out)


def running_max(df: DataFrame, keys: Sequence[str], position: str, tie: str, value: str, out: str) -> DataFrame:
    """``max(value) over (partition by keys order by position, tie)`` by ranges of rows.

    The ranges hold like numbers of rows however the positions cluster; only their maxima cross range borders.
    """
    stored = ranges(df, [F.col(k).asc() for k in keys] + _sort_columns([position, tie]))
    inside = Window.partitionBy("_part", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = stored.withColumn("_inner", F.max(value).over(inside))
    met = _with_carry(stored, rows, keys, F.max(value), lambda w: F.max("_total").over(_earlier(w)))
    return met.withColumn(out, F.greatest("_inner", "_carry")).select(*df.columns, out)


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, out: str = "rn") -> DataFrame:
    """First k rows per group.  Spark limits each partition to k rows per group before the shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key as a partial aggregate, so hot keys combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def with_group_total(df: DataFrame, groups: Sequence[str], total: Column, out: str, once: bool = False) -> DataFrame:
    """Attach an aggregate of the row's group.

    The totals (one row per group) are settled first, so the join knows their
    size: small totals are broadcast and the rows never shuffle.  ``once`` is for rows that are an
    aggregate themselves: they are settled too, so that what is behind them is read and computed once.
    """
    if once:
        df = settled(df, "groups")
    totals = settled(
        df.groupBy(*[F.col(g).alias(f"_g_{g}") for g in groups]).agg(total.alias(out)), "totals"
    )
    cond = F.col(groups[0]).eqNullSafe(F.col(f"_g_{groups[0]}"))
    for g in groups[1:]:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return df.join(totals, cond).select(*df.columns, out)


def string_list(
    df: DataFrame, groups: Sequence[str], item: str, out: str, sep: str = ", ", max_items: int = 1000
) -> DataFrame:
    """Distinct sorted names per group as delimited text, ``max_items`` names per row.

    ``chunk_no`` numbers the rows of a group, so a huge group becomes many
    bounded rows and no name is lost.
    """
    names = df.select(*groups, item).filter(F.col(item).isNotNull()).distinct()
    numbered = rank_in_group(names, groups, [item], "_rn")
    chunked = numbered.withColumn("chunk_no", F.floor((F.col("_rn") - 1) / max_items))
    return chunked.groupBy(*groups, "chunk_no").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("_rn", item))), lambda x: x[item]), sep
        ).alias(out),
        F.count(F.lit(1)).alias("n"),
    )
