"""Structured Streaming twins of periodic reports (keys str_*).

Late rows beyond the watermark are dropped; the query progress counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetwatch.functions import semantics as S
from fleetwatch.operators.logs import FAILURE_PATTERNS
from fleetwatch.operators.windows import win_share_of_total
from fleetwatch.plans.ordering import latest_row, previous_value

WATERMARK = "10 minutes"


def _event_time(df: DataFrame, c: str) -> DataFrame:
    """Watermarks and windows run on zoned timestamps."""
    return df.withColumn(c, F.col(c).cast("timestamp"))


def str_log_classify(
    log: DataFrame, patterns: Sequence[str] = FAILURE_PATTERNS, watermark: str = WATERMARK
) -> DataFrame:
    """Failure rows of a log stream, each once."""
    return (
        _event_time(log, "log_date")
        .filter(S.any_ilike("text", patterns))
        .select("server_id", "log_date", "process_info", "text")
        .withWatermark("log_date", watermark)
        .dropDuplicatesWithinWatermark(["server_id", "log_date", "process_info", "text"])
    )


def str_cpu_alert(
    samples: DataFrame, threshold: int = 70, window: str = "10 minutes", watermark: str = WATERMARK
) -> DataFrame:
    """Highest CPU per server and tumbling window, when above the threshold."""
    return (
        _event_time(samples, "event_time")
        .withWatermark("event_time", watermark)
        .groupBy("server_id", F.window("event_time", window).alias("w"))
        .agg(F.max("sql_cpu").alias("max_cpu"))
        .filter(F.col("max_cpu") > threshold)
        .select(
            "server_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "max_cpu",
        )
    )


def str_ip_threat(
    access: DataFrame, n: int = 10, window: str = "1 hour", slide: str | None = None, watermark: str = WATERMARK
) -> DataFrame:
    """Clients with more than ``n`` unauthorised requests per tumbling or sliding window."""
    span = F.window("log_time", window, slide) if slide else F.window("log_time", window)
    return (
        _event_time(access, "log_time")
        .filter(F.col("sc_status") == 401)
        .withWatermark("log_time", watermark)
        .groupBy("c_ip", span.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > n)
        .select("c_ip", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    )


def str_login_sessions(
    events: DataFrame, gap: str = "30 minutes", watermark: str = WATERMARK
) -> DataFrame:
    """Sessions per user, closed by inactivity.

    Sessions are merged inside each task before the shuffle, so that a busy account sends sessions, not its rows, to one task.
    """
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return (
        _event_time(events, "event_time")
        .withWatermark("event_time", watermark)
        .groupBy("user", F.session_window("event_time", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("user", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    )


def str_memory_trigger(samples: DataFrame, pressure: DataFrame, as_of) -> DataFrame:
    """Samples of servers that had memory pressure in the month before ``as_of``."""
    low = pressure.filter(
        (F.col("physical_low") | F.col("virtual_low"))
        & (F.col("event_time") > F.timestamp_add("MONTH", F.lit(-1), S.ts(as_of)).cast("timestamp_ntz"))
    )
    return samples.join(low.select("server_id").distinct(), "server_id", "left_semi")


def _growth(value: Column, before: Column) -> Column:
    return F.when(value < before, value).otherwise(value - before)


def counter_delta(counters: DataFrame) -> DataFrame:
    """Difference to the previous reading per server and key; a lower value means a restart.

    The first reading of a key has no difference.
    """
    prev = previous_value(counters, ["server_id", "key"], "reading_time", "reading_id", "counter_value", "_prev")
    return prev.withColumn("delta", _growth(F.col("counter_value"), F.col("_prev"))).drop("_prev")


def counter_share(counters: DataFrame) -> DataFrame:
    """Growth per server and key over all readings, and its share of the server's growth."""
    grown = (
        counter_delta(counters)
        .groupBy("server_id", "key")
        .agg(F.coalesce(F.sum("delta"), F.lit(0)).alias("delta"))
    )
    return win_share_of_total(grown, "delta", once=True)


READING = ("reading_time", "reading_id", "counter_value")
KEY = ("server_id", "key")
EXPIRED, UNTIMED = "0 expired", "0 untimed"  # slices that sort before all times


def _slice_ends(readings: DataFrame) -> DataFrame:
    """First and last reading of every key and slice."""
    reading = F.struct(*READING)
    return readings.groupBy(*KEY, "slice").agg(F.min(reading).alias("head"), F.max(reading).alias("tail"))


def _known_ends(ends: DataFrame, expired: str | None) -> DataFrame:
    """Ends of all batches so far; of slices before ``expired`` only each key's last reading stays."""
    old = F.coalesce(F.col("slice") < F.lit(expired), F.lit(False))
    one = F.when(old, F.lit(EXPIRED)).otherwise(F.col("slice")).alias("slice")
    merged = ends.groupBy(*KEY, one).agg(F.min("head").alias("head"), F.max("tail").alias("tail"))
    head = F.when(F.col("slice") == EXPIRED, F.col("tail")).otherwise(F.col("head"))
    return merged.withColumn("head", head)


def str_counter_delta(
    counters: DataFrame,
    out_path: str,
    state_path: str,
    checkpoint: str,
    slice_format: str = "yyyy-MM-dd",
    lateness: str | None = None,
) -> StreamingQuery:
    """Stream of counter readings to rows with ``delta``, written per batch below ``out_path``; ``current_deltas`` reads them.

    Readings may arrive in any order: a late one is compared with the reading before it in time, and the reading after
    it is written again with its corrected ``delta``.  A batch reads the readings of the time slices (``slice_format``)
    that it has rows in, and of all other slices only the first and last reading of each key, so its cost follows its own
    rows and no key has to fit into a task.

    With ``lateness`` (such as ``'7 days'``), readings older than that before the newest reading of earlier batches come
    out with a NULL ``delta`` and correct nothing; slices before are no longer read, and of them only the last reading
    per key is kept among the ends.  Readings without a time come before all others and are never late.  Slices must
    sort by name in time order.  Batches and states are written under their batch id, so a replayed batch replaces its own
    rows.  Columns other than key, reading and value are not carried.
    """
    columns = [*KEY, *READING]
    types = {c: counters.schema[c].dataType.simpleString() for c in columns}
    keyed = "".join(f"{c} {types[c]}, " for c in KEY)
    end = "struct<" + ", ".join(f"{c}: {types[c]}" for c in READING) + ">"
    stored_schema = ", ".join(f"{c} {kind}" for c, kind in types.items()) + ", batch bigint, slice string"
    ends_schema = f"{keyed}slice string, head {end}, tail {end}"
    slice_of = F.coalesce(F.date_format("reading_time", slice_format), F.lit(UNTIMED)).alias("slice")

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ends_at = lambda number: f"{state_path}/ends/batch={number}"
        batch = batch.select(*columns)
        late, expired = F.lit(False), None
        before = spark.read.schema(ends_schema).parquet(ends_at(batch_id - 1)) if batch_id > 0 else None
        if lateness and before is not None:
            newest = before.agg(F.max("tail.reading_time").alias("t")).select(F.expr(f"t - INTERVAL {lateness}").alias("t"))
            cut, expired = newest.select("t", F.date_format("t", slice_format)).first()
            if cut is not None:
                late = F.coalesce(F.col("reading_time") < S.ts(cut), F.lit(False))
        here = f"{state_path}/readings/batch={batch_id}"
        batch.filter(~late).select("*", slice_of).write.mode("overwrite").partitionBy("slice").parquet(here)

        stored = spark.read.schema(stored_schema).parquet(f"{state_path}/readings").filter(F.col("batch") <= batch_id)
        fresh = F.col("batch") == batch_id
        ends = _slice_ends(stored.filter(fresh))
        _known_ends(ends if before is None else ends.unionByName(before), expired).write.mode("overwrite").parquet(ends_at(batch_id))

        touched = [r.slice for r in stored.filter(fresh).select("slice").distinct().collect()]
        inside = stored.filter(F.col("slice").isin(touched)).select(*columns, fresh.alias("_new"))
        outside = spark.read.schema(ends_schema).parquet(ends_at(batch_id)).filter(~F.col("slice").isin(touched))
        outside = outside.select(*KEY, F.explode(F.array_distinct(F.array("head", "tail"))).alias("r"))
        rows = inside.unionByName(outside.select(*KEY, "r.*", F.lit(False).alias("_new")))
        rows = rows.withColumn("_reading", F.struct("counter_value", "_new"))
        rows = previous_value(rows, KEY, "reading_time", "reading_id", "_reading", "_before")
        told = rows.filter(F.col("_new") | F.coalesce("_before._new", F.lit(False)))
        told = told.select(*columns, _growth(F.col("counter_value"), F.col("_before.counter_value")).alias("delta"))
        too_late = batch.filter(late).withColumn("delta", F.lit(None).cast(told.schema["delta"].dataType))
        told.unionByName(too_late).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return (
        counters.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_deltas(written: DataFrame) -> DataFrame:
    """The newest ``delta`` of every reading, from all that ``str_counter_delta`` wrote; readings are known by server, key and id."""
    key = [*KEY, "reading_id"]
    return latest_row(written.select(*key, "delta", "batch"), key, ["batch"]).drop("batch")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over everything available and append its rows to a Parquet table."""
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
