"""Readers, sinks, exports and streams on small files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fleetwatch.operators import export as X
from fleetwatch.plans.maintenance import run_commands
from fleetwatch.sources import readers as RD
from fleetwatch.sources import sinks as SK
from fleetwatch.sources.roles import ROLES, conform
from fleetwatch.streaming import streams as ST


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_error_log_lines(spark):
    got = RD.parse_error_log(lines(spark, ["2024-01-31 10:00:00.12 spid7s      Starting up", "   continued"])).collect()
    assert got[0] == (datetime(2024, 1, 31, 10, 0, 0, 120000), "spid7s", "Starting up")
    assert got[1] == (None, None, "   continued")


def test_hotfix_dates_as_text_and_ticks(spark):
    ticks = format((int(datetime(2024, 1, 31).timestamp()) + RD.TICKS_TO_EPOCH) * 10_000_000, "x")
    rows = [
        "http://kb  HOST  Security Update  KB1  NT AUTHORITY\\SYSTEM  1/9/2024",
        f"http://kb  HOST  Update  KB2  me  {ticks}",
        "",
    ]
    got = [(r.description, r.hotfix_id, r.installed_on) for r in RD.parse_hotfixes(lines(spark, rows)).collect()]
    assert got == [("Security-Update", "KB1", datetime(2024, 1, 9)), ("Update", "KB2", datetime(2024, 1, 31))]


def test_web_log_skips_comments(spark, tmp_path):
    (tmp_path / "u.log").write_text(
        "#Software: x\n#Fields: date time\n2024-01-31 10:00:00 1.1.1.1 GET / 2.2.2.2 agent - 200 0\n"
    )
    row = RD.src_access_log(spark, str(tmp_path)).collect()
    assert len(row) == 1 and row[0].sc_status == 200 and row[0].referer is None


def test_conform_adds_missing_and_drops_extra(spark):
    df = conform(spark.createDataFrame([(1, "x")], "ID int, other string"), ROLES["error_log"])
    assert df.columns == ROLES["error_log"].names and df.first().id == 1 and df.first().text is None


def test_archive_append_is_idempotent_with_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (1, None), (2, "b")], "k int, t string")
    for _ in range(2):
        SK.sink_archive_append(df, str(tmp_path / "a"), ["k", "t"])
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2


def test_failed_commands_are_logged(spark):
    def boom():
        raise RuntimeError("no")

    log = run_commands(spark, [("OK x", lambda: None), ("BAD y", boom)])
    assert [(r["command_type"], r["error_number"]) for r in log] == [("OK", 0), ("BAD", 1)]


def test_compact_keeps_rows_and_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2000).withColumn("p", (F.col("id") % 3).cast("int")).repartition(20).write.partitionBy("p").parquet(path)
    files = X.list_files(spark, path, "t", "p")
    inv = files.groupBy("partition_id").agg(F.sum("file_rows").alias("bytes")).filter("partition_id < 2")
    X.mnt_compact(spark, path, "p", inv, target_bytes=400)
    after = {r.partition_id: r.n for r in X.list_files(spark, path, "t", "p").groupBy("partition_id").agg(F.count("*").alias("n")).collect()}
    assert spark.read.parquet(path).count() == 2000 and spark.read.parquet(path).select("id").distinct().count() == 2000
    assert after[2] == 20 and after[0] < 20 and after[0] > 1


def test_export_round_trip_and_diff(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    path = X.export_full(base, str(tmp_path / "full"))
    assert X.export_verify(base, path).first().ok
    assert not X.export_verify(base.limit(2), path).first().ok
    now = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "k int, v string")
    X.export_diff(now, path, ["k"], str(tmp_path / "diff"))
    got = {r.k: r.change for r in spark.read.parquet(str(tmp_path / "diff")).collect()}
    assert got == {2: "U", 3: "D", 4: "I"}


SAMPLES = "server_id string, event_time timestamp_ntz, sql_cpu int"


def test_stream_over_four_files_drops_only_the_late_row(spark, tmp_path):
    source = str(tmp_path / "in")
    batches = [
        [("s", datetime(2024, 1, 1, 0, 5), 80), ("s", datetime(2024, 1, 1, 0, 15), 60)],
        [("s", datetime(2024, 1, 1, 1, 5), 90)],
        [("s", datetime(2024, 1, 1, 2, 0), 10)],
        [("s", datetime(2024, 1, 1, 0, 6), 99), ("s", datetime(2024, 1, 1, 3, 0), 75)],  # 99 comes too late
    ]
    for rows in batches:
        spark.createDataFrame(rows, SAMPLES).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(source)
    ST.run_to_table(ST.str_cpu_alert(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {(str(r.window_start), r.max_cpu) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("2024-01-01 00:00:00", 80), ("2024-01-01 01:00:00", 90)}


def test_counter_stream_equals_batch(spark, tmp_path):
    schema = "server_id string, key string, reading_id bigint, reading_time timestamp_ntz, counter_value bigint"
    rows = [("s", "ab"[i % 2], i, datetime(2024, 1, 1, i // 4, i % 4), (i * 37) % 50) for i in range(40)]
    source = str(tmp_path / "in")
    for part in (rows[:13], rows[13:25], rows[25:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    ST.str_counter_delta(stream, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    key = lambda df: sorted((r.reading_id, str(r.delta)) for r in df.collect())
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(ST.counter_delta(spark.createDataFrame(rows, schema)))


def test_compaction_is_exact_and_survives_a_stop_between_staging_and_swap(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(i, None if i % 10 == 9 else "a b" if i % 3 else "c%d") for i in range(1200)]
    df = spark.createDataFrame(rows, "v bigint, p string")
    df.repartition(7).write.partitionBy("p").parquet(path)
    read = lambda: sorted((r.v, r.p) for r in spark.read.parquet(path).collect())
    want = read()
    inventory = spark.createDataFrame([("a b", 1000), (None, 10), ("absent", 500)], "partition_id string, bytes bigint")
    staging = X.stage_compact(spark, path, "p", inventory, target_bytes=300)
    assert read() == want  # the staged files are not part of the table
    moves = spark.read.parquet(f"{staging}/manifest").filter("action = 'add' AND partition_id = 'a b'").limit(1)
    list(X._move([moves.toPandas()]))  # an interrupted swap: one new file is in, no old one is out
    assert len(read()) > len(want)
    spark.catalog.refreshByPath(path)
    written = {r.partition_id: r.rows_written for r in X.finish_compact(spark, path, staging).collect()}
    assert read() == want and written == {"a b": sum(r[1] == "a b" for r in rows), None: 120}
    X.finish_compact(spark, path, staging)
    files = X.list_files(spark, path, "t", "p").groupBy("partition_id").agg(F.sort_array(F.collect_list("file_rows")).alias("n"))
    sizes = {r.partition_id: r.n for r in files.collect()}
    assert sizes["a b"] == [180, 180, 180, 180] and sizes[None] == [120] and len(sizes["c%d"]) == 7
    assert read() == want
    nothing = X.mnt_compact(spark, path, "p", inventory.filter("partition_id = 'absent'"))
    assert nothing.count() == 0 and nothing.columns == ["partition_id", "rows_written"]


COUNTERS = "server_id string, key string, reading_id bigint, reading_time timestamp_ntz, counter_value bigint"


def _counter_stream(spark, tmp_path, parts, **options):
    for part in parts:
        spark.createDataFrame(part, COUNTERS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(COUNTERS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    places = [str(tmp_path / p) for p in ("out", "state", "cp")]
    ST.str_counter_delta(stream, *places, **options).awaitTermination()
    return spark.read.parquet(places[0])


def test_late_and_untimed_readings_are_corrected(spark, tmp_path):
    rows = [("s", "abc"[i % 3], i, datetime(2024, 1, 1 + i // 12, i % 12), (i * 37) % 50) for i in range(72)]
    rows += [("s", "a", 100, None, 7), ("s", "a", 101, None, 9), (None, "b", 102, datetime(2024, 1, 3), 1), (None, "b", 103, datetime(2024, 1, 9), 5)]
    order = sorted(range(len(rows)), key=lambda i: (i * 31) % 77)
    shuffled = [rows[i] for i in order]
    written = _counter_stream(spark, tmp_path, [shuffled[:30], shuffled[30:50], shuffled[50:]])
    key = lambda df: sorted((r.reading_id, str(r.delta)) for r in df.collect())
    assert written.count() > len(rows)  # corrected successors come again
    assert key(ST.current_deltas(written)) == key(ST.counter_delta(spark.createDataFrame(rows, COUNTERS)))


def test_readings_beyond_the_lateness_correct_nothing(spark, tmp_path):
    day = lambda d: datetime(2024, 1, d)
    parts = [
        [("s", "a", 1, day(1), 10), ("s", "a", 2, day(2), 20), ("s", "b", 3, day(1), 1)],
        [("s", "a", 4, day(20), 50)],
        [("s", "a", 5, day(3), 30), ("s", "a", 6, day(18), 45), ("s", "b", 7, day(19), 4)],
    ]
    written = _counter_stream(spark, tmp_path, parts, lateness="5 days")
    got = {r.reading_id: r.delta for r in ST.current_deltas(written).collect()}
    assert got == {1: None, 2: 10, 3: None, 4: 5, 5: None, 6: 25, 7: 3}
    ends = spark.read.parquet(str(tmp_path / "state" / "ends" / "batch=2")).collect()
    assert sorted((r.key, r.slice) for r in ends) == [
        ("a", "0 expired"), ("a", "2024-01-18"), ("a", "2024-01-20"), ("b", "0 expired"), ("b", "2024-01-19"),
    ]


def test_delete_files_needs_apply(spark, tmp_path):
    from fleetwatch.operators.retention import delete_files

    old = tmp_path / "a_b_c.txt"
    old.write_text("x")
    rows = spark.createDataFrame([(f"file:{old}", 40)], "path string, age_days bigint")
    assert [r.deleted for r in delete_files(rows).collect()] == [False] and old.exists()
    assert [r.deleted for r in delete_files(rows, apply=True).collect()] == [True] and not old.exists()
    assert [r.outcome for r in delete_files(rows, apply=True).collect()] == ["not found"]


def test_delete_files_tells_what_became_of_each_path(spark, tmp_path):
    from fleetwatch.operators.retention import delete_files

    plain, uri, folder = tmp_path / "plain.txt", tmp_path / "uri.txt", tmp_path / "folder"
    plain.write_text("x")
    uri.write_text("x")
    folder.mkdir()
    paths = [str(plain), uri.as_uri(), str(folder), str(tmp_path / "missing"), "nosuch://host/path"]
    rows = spark.createDataFrame([(p, 40) for p in paths], "path string, age_days bigint")
    got = {r.path: (r.deleted, r.outcome) for r in delete_files(rows, apply=True).collect()}
    assert [got[p] for p in paths[:4]] == [(True, "deleted"), (True, "deleted"), (False, "not a file"), (False, "not found")]
    assert not got[paths[4]][0] and "nosuch" in got[paths[4]][1]
    assert not plain.exists() and not uri.exists() and folder.exists()


def test_login_sessions_merge_before_the_shuffle(spark, tmp_path):
    """One user holds half of the rows: what leaves a task are sessions."""
    rows = [("busy" if i % 2 else f"u{i % 40}", f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00") for i in range(600)]
    df = spark.createDataFrame(rows, "user string, event_time string").withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = ST.str_login_sessions(stream, "30 minutes", "1 minute").writeStream.format("memory").queryName("sessions")
    query = query.outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(user")
    assert "MergingSessions" in plan[:shuffle] and "MergingSessions" in plan[shuffle:]  # the plan's end runs first
    assert spark.table("sessions").where("user = 'busy'").count() <= 1
