"""Range-partitioned rankings and running values against plain windows, with one hot group."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetwatch.operators.joins import join_asof_state
from fleetwatch.plans import ordering as O
from fleetwatch.streaming.streams import counter_delta


def skewed(spark, n=3000):
    """Half of the rows on one server, many ties in the value."""
    return spark.range(n).select(
        F.when(F.col("id") < n / 2, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") / 100).cast("int").cast("string"))).alias("server_id"),
        F.col("id").alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(7)).alias("value"),
    )


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture
def narrow(spark):
    """Ranges stay as many as on a cluster."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_rank_in_group_equals_window(narrow):
    spark = narrow
    df = skewed(spark)
    got = O.rank_in_group(df, ["server_id"], [F.col("value").desc(), F.col("key").asc()], "rn")
    w = Window.partitionBy("server_id").orderBy(F.desc("value"), "key")
    assert pairs(got, "key", "rn") == pairs(df.withColumn("rn", F.row_number().over(w)), "key", "rn")


def test_global_rank_is_a_permutation(spark):
    df = skewed(spark)
    got = O.rank_in_group(df, [], [F.col("value").desc(), F.col("key").asc()], "rn")
    assert [r.rn for r in got.orderBy("rn").collect()] == list(range(1, 3001))
    ordered = [(-r.value, r.key) for r in got.orderBy("rn").collect()]
    assert ordered == sorted(ordered)


def test_rank_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, key int")
    assert pairs(O.rank_in_group(df, ["g"], ["key"], "rn"), "key", "rn") == [(1, 1), (2, 2), (3, 1)]


def test_running_sum_in_two_levels(narrow):
    df = skewed(narrow)
    got = O.running_sum(df, ["server_id"], ["key"], "value", "total")
    w = Window.partitionBy("server_id").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    assert pairs(got, "key", "total") == pairs(df.withColumn("total", F.sum("value").over(w)), "key", "total")


def test_running_max_of_clustered_positions(narrow):
    """99 % of the positions lie in 1 % of their range: no range of rows holds more than its share."""
    df = narrow.range(20_000).select(
        F.lit("s").alias("k"), F.when(F.col("id") % 100 == 0, F.col("id") * 1_000).otherwise(F.col("id")).alias("p"),
        F.col("id").alias("t"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("v"),
    )
    got = O.running_max(df, ["k"], "p", "t", "v", "m")
    w = Window.partitionBy("k").orderBy("p", "t").rowsBetween(Window.unboundedPreceding, 0)
    assert pairs(got, "t", "m") == pairs(df.withColumn("m", F.max("v").over(w)), "t", "m")
    sizes = [r["count"] for r in O.ranges(df, [F.col("k"), F.col("p"), F.col("t")]).groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_one_plan_at_every_size(spark):
    """Ten and ten thousand rows are ranked by the same operators."""
    import re

    def shape(n):
        plan = O.rank_in_group(skewed(spark, n), ["server_id"], ["key"], "rn")._jdf.queryExecution().optimizedPlan().toString()
        return re.findall(r"^\W*([A-Z]\w+)", plan, re.M)

    assert shape(10) == shape(10_000)


def counters(spark):
    return spark.range(400).select(
        F.lit("srv").alias("server_id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("key"),
        F.col("id").alias("reading_id"),
        F.timestamp_add("MINUTE", (F.col("id") * 7).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).cast("timestamp_ntz").alias("reading_time"),
        F.pmod(F.col("id") * 31, F.lit(97)).alias("counter_value"),
    )


def test_previous_value_equals_lag(narrow):
    df = counters(narrow)
    got = O.previous_value(df, ["server_id", "key"], "reading_time", "reading_id", "counter_value", "prev")
    w = Window.partitionBy("server_id", "key").orderBy("reading_time", "reading_id")
    want = df.withColumn("prev", F.lag("counter_value").over(w))
    key = lambda d: sorted((r.reading_id, -1 if r.prev is None else r.prev) for r in d.collect())
    assert key(got) == key(want)


def test_counter_reset_counts_from_zero(spark):
    rows = [("s", "k", i, f"2024-01-01 0{i}:00:00", v) for i, v in enumerate([5, 9, 2, 4])]
    df = spark.createDataFrame(rows, "server_id string, key string, reading_id int, reading_time string, counter_value int")
    df = df.withColumn("reading_time", F.col("reading_time").cast("timestamp_ntz"))
    got = {r.reading_id: r.delta for r in counter_delta(df).collect()}
    assert got == {0: None, 1: 4, 2: 2, 3: 2}


def test_asof_state_uses_strictly_earlier_log_ends(spark):
    logs = spark.createDataFrame([("d", 10), ("d", 20), ("e", 5)], "database_name string, base_lsn bigint")
    base = spark.createDataFrame(
        [("d", "L", "2024-01-01", 10, False), ("d", "L", "2024-01-02", 15, False), ("d", "L", "2024-01-09", 16, True), ("d", "D", "2023-12-31", 99, False)],
        "database_name string, type string, backup_start_date string, last_lsn bigint, is_damaged boolean",
    ).withColumn("backup_start_date", F.col("backup_start_date").cast("timestamp_ntz"))
    got = {(r.database_name, r.base_lsn): str(r.latest_safe) for r in join_asof_state(logs.withColumn("server_id", F.lit("s1")), base.withColumn("server_id", F.lit("s1"))).collect()}
    assert got == {("d", 10): "2023-12-31 00:00:00", ("d", 20): "2024-01-02 00:00:00", ("e", 5): "None"}


def test_string_list_keeps_every_name(spark):
    df = spark.range(25).select(F.lit("g").alias("g"), F.format_string("n%02d", F.col("id")).alias("name"))
    rows = O.string_list(df.union(df), ["g"], "name", "names", ",", max_items=10).orderBy("chunk_no").collect()
    assert [r.n for r in rows] == [10, 10, 5]
    assert ",".join(r.names for r in rows).split(",") == [f"n{i:02d}" for i in range(25)]


def test_share_sums_to_hundred(spark):
    from fleetwatch.operators.windows import win_share_of_total

    df = skewed(spark).withColumn("value", F.col("value") + 1)
    sums = win_share_of_total(df, "value").groupBy("server_id").agg(F.round(F.sum("pct"), 6).alias("s")).collect()
    assert {r.s for r in sums} == {100.0}
