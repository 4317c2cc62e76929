"""Queries of readers, sinks and streams.

Each one lets Spark write the role's rows to the shared folder in the format
under test, then reads them back through the reader.
"""

# ruff: noqa: E501
from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.operators import health as H
from fleetwatch.operators import logs as L
from fleetwatch.plans import maintenance as PM
from fleetwatch.queries.core import E
from fleetwatch.queries.health_q import log_rows_sql, log_summary_sql
from fleetwatch.queries.registry import query
from fleetwatch.queries.roles_sql import AS_OF_EVENTS
from fleetwatch.sources import readers as RD
from fleetwatch.sources import roles as RO
from fleetwatch.sources import sinks as SK
from fleetwatch.streaming import streams as ST
from fleetwatch.session import work_path


def _landed(t, role, name):
    """Role rows as Parquet files in the shared folder."""
    path = work_path(t.spark, name)
    t(role).write.parquet(path)
    return path


# ---- readers ---------------------------------------------------------------
@query("src_snapshot", "SELECT server_id, wait_type, wait_time_ms FROM v_wait_stats WHERE wait_time_ms > 1000")
def _(t):
    return RO.src_snapshot(t.spark, _landed(t, "wait_stats", "snapshot"), "wait_stats").filter("wait_time_ms > 1000").select("server_id", "wait_type", "wait_time_ms")


@query("src_text_log", "SELECT log_date, process_info, text FROM v_error_log")
def _(t):
    path = work_path(t.spark, "errorlog")
    line = F.concat_ws(" ", F.date_format("log_date", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "process_info", F.concat(F.lit("     "), F.col("text")))
    t("error_log").select(line.alias("value")).write.text(path)
    return RD.src_text_log(t.spark, path)


@query("src_access_log", """
SELECT strftime(log_time, '%Y-%m-%d') AS date, strftime(log_time, '%H:%M:%S') AS time, c_ip, cs_method, sc_status, sc_win32_status, CASE WHEN cs_method = 'GET' THEN 'agent/1' END AS user_agent FROM v_access_log""")
def _(t):
    path = work_path(t.spark, "weblog")
    none = F.lit("-")
    line = F.concat_ws(
        " ", F.date_format("log_time", "yyyy-MM-dd"), F.date_format("log_time", "HH:mm:ss"), F.lit("10.1.1.1"), "cs_method", F.lit("/index.html"), "c_ip",
        F.when(F.col("cs_method") == "GET", "agent/1").otherwise(none), none, F.col("sc_status").cast("string"), F.col("sc_win32_status").cast("string"),
    )
    header = F.array(F.lit("#Software: web server"), F.lit("#Fields: date time s-ip cs-method cs-uri-stem c-ip cs(User-Agent) cs(Referer) sc-status sc-win32-status"), line)
    t("access_log").select(F.explode(header).alias("value")).write.text(path)
    return RD.src_access_log(t.spark, path).select("date", "time", "c_ip", "cs_method", "sc_status", "sc_win32_status", "user_agent")


def _xml_lines(t):
    path = work_path(t.spark, "events-xml")
    name = F.when(F.col("event_type") == "error", "xml_deadlock_report").otherwise(F.col("event_type"))
    xml = F.concat(
        F.lit('<event name="'), name, F.lit('" timestamp="'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"><data name="xml_report"><value><deadlock><victim id="'),
        F.col("user_id").cast("string"), F.lit('"/></deadlock></value></data></event>'),
    )
    t.table("events").select(xml.alias("value")).write.text(path)
    return RD.src_event_xml(t.spark, path)


@query("src_event_xml", "SELECT ts AS event_time, user_id AS victim FROM events WHERE event_type = 'error'")
def _(t):
    return _xml_lines(t).select("event_time", F.xpath_long("payload", F.lit("//victim/@id")).alias("victim"))


@query("log_deadlocks", """SELECT ts AS event_time, concat('<deadlock><victim id="', user_id, '"/></deadlock>') AS graph FROM events WHERE event_type = 'error'""")
def _(t):
    return L.log_deadlocks(_xml_lines(t))


@query("src_trace", """
SELECT * FROM v_trace WHERE (event_class = 22 AND severity >= 17) OR (event_class IN (92, 93) AND duration > 15000000) OR event_class IN (94, 95, 116)""")
def _(t):
    return RD.src_trace(t.spark, _landed(t, "trace", "trace"))


@query("src_hotfix_lines", "SELECT concat('http://kb/', event_id) AS kb, 'Security-Update' AS description, hotfix_id, CAST(CAST(installed_on AS DATE) AS TIMESTAMP) AS installed_on FROM (SELECT event_id, concat('KB', event_id) AS hotfix_id, ts AS installed_on FROM events)")
def _(t):
    """Half of the dates as M/d/yyyy, half as hexadecimal ticks."""
    path = work_path(t.spark, "hotfixes")
    ticks = (F.unix_seconds(F.date_trunc("DAY", "ts").cast("timestamp")) + RD.TICKS_TO_EPOCH) * 10_000_000
    day = F.when(F.col("event_type") == "click", F.lower(F.hex(ticks))).otherwise(F.date_format("ts", "M/d/yyyy"))
    e = F.col("event_id").cast("string")
    line = F.concat(F.lit("http://kb/"), e, F.lit("  HOST1   Security Update   KB"), e, F.lit("   NT AUTHORITY\\SYSTEM  "), day)
    t.table("events").select(line.alias("value")).write.text(path)
    return RD.src_hotfix_lines(t.spark, path)


@query("src_event_export", "SELECT record_id, time, log_name, entry_type, event_id, replacement_strings[6] AS user_part, len(replacement_strings) AS parts FROM v_os_events")
def _(t):
    path = work_path(t.spark, "os-events")
    t("os_events").write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return RD.src_event_export(t.spark, path).select(
        "record_id", "time", "log_name", "entry_type", "event_id", F.element_at("replacement_strings", 6).alias("user_part"), F.size("replacement_strings").cast("bigint").alias("parts")
    )


@query("src_union_databases", """
SELECT 'sales' AS database_name, o_orderkey AS id, o_orderstatus AS state, NULL AS note FROM orders UNION ALL SELECT 'web', event_id, NULL, event_type FROM events""")
def _(t):
    sales = t.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"))
    web = t.table("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("note"))
    return RO.src_union_databases({"sales": sales, "web": web})


@query("src_optional_columns", "SELECT id, log_date, process_info, text, CAST(NULL AS VARCHAR) AS server_id FROM v_error_log")
def _(t):
    return RO.src_optional_columns(t("error_log").drop("server_id"), RO.ROLES["error_log"])


# ---- sinks -----------------------------------------------------------------
@query("sink_findings", "SELECT *, DATE '2024-01-31' AS run_date FROM (" + log_rows_sql("4.1", "Login failed", "%login failed%") + ") UNION ALL SELECT *, DATE '2024-01-31' FROM ("
       + log_summary_sql("4.3", "Unable to run a system task", "%SQL Server was unable%") + ")")
def _(t):
    path = work_path(t.spark, "findings")
    SK.sink_findings(H.hc_login_failed(t("error_log"), AS_OF_EVENTS), path, AS_OF_EVENTS)
    SK.sink_findings(H.hc_system_task(t("error_log"), AS_OF_EVENTS), path, AS_OF_EVENTS)
    schema = RO.ROLES["findings"].simpleString()[len("struct<"):-1]
    return t.spark.read.schema(", ".join(f.replace(":", " ", 1) for f in schema.split(",")) + ", run_date date").parquet(path)


ANY_SQL = " OR ".join(f"text ILIKE '{p}'" for p in L.FAILURE_PATTERNS)


@query("sink_archive_append", f"SELECT DISTINCT server_id, log_date, process_info, text FROM v_error_log WHERE {ANY_SQL}")
def _(t):
    """The second run appends nothing."""
    path = work_path(t.spark, "archive")
    rows = L.log_archive_failures(t("error_log"))
    for _run in range(2):
        SK.sink_archive_append(rows, path, ["server_id", "log_date", "process_info", "text"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query("sink_command_log", "SELECT 'COUNT orders' AS command, 'COUNT' AS command_type, 0 AS error_number UNION ALL SELECT 'COUNT events', 'COUNT', 0 UNION ALL SELECT 'FAIL missing', 'FAIL', 1")
def _(t):
    """Audit rows of two jobs over whole tables and one that fails."""
    path = work_path(t.spark, "command-log")
    commands = [
        ("COUNT orders", lambda: t.table("orders").count()),
        ("COUNT events", lambda: t.table("events").count()),
        ("FAIL missing", lambda: t.table("no_such_table").count()),
    ]
    SK.sink_command_log(t.spark, PM.run_commands(t.spark, commands), path)
    return t.spark.read.schema(RO.ROLES["command_log"]).parquet(path).select("command", "command_type", "error_number")


# ---- streams ---------------------------------------------------------------
def _stream(t, role, name):
    path = _landed(t, role, name)
    return t.spark.readStream.schema(t(role).schema).parquet(path)


def _run(t, stream, name):
    out = work_path(t.spark, f"{name}-out")
    ST.run_to_table(stream, out, work_path(t.spark, f"{name}-checkpoint"))
    return t.spark.read.schema(stream.schema).parquet(out)


@query("str_log_classify", f"SELECT DISTINCT server_id, log_date, process_info, text FROM v_error_log WHERE {ANY_SQL}")
def _(t):
    return _run(t, ST.str_log_classify(_stream(t, "error_log", "str-log")), "str-log")


CLOSED = "(SELECT MAX({c}) - INTERVAL 10 MINUTE FROM v_{v})"


@query("str_cpu_alert", f"""
SELECT server_id, time_bucket(INTERVAL 10 MINUTE, event_time) AS window_start, time_bucket(INTERVAL 10 MINUTE, event_time) + INTERVAL 10 MINUTE AS window_end, MAX(sql_cpu) AS max_cpu FROM v_cpu_samples
GROUP BY 1, 2, 3 HAVING MAX(sql_cpu) > 70 AND time_bucket(INTERVAL 10 MINUTE, event_time) + INTERVAL 10 MINUTE <= {CLOSED.format(c='event_time', v='cpu_samples')}""")
def _(t):
    """Append mode: windows the watermark has passed."""
    return _run(t, ST.str_cpu_alert(_stream(t, "cpu_samples", "str-cpu")), "str-cpu")


@query("str_ip_threat", """
WITH u AS (SELECT * FROM v_access_log WHERE sc_status = 401),
w AS (SELECT c_ip, time_bucket(INTERVAL 12 HOUR, log_time) - to_hours(12 * g) AS window_start, COUNT(*) AS n FROM u, generate_series(0, 1) AS s(g) GROUP BY 1, 2)
SELECT c_ip, window_start, window_start + INTERVAL 24 HOUR AS window_end, n FROM w WHERE n > 1 AND window_start + INTERVAL 24 HOUR <= (SELECT MAX(log_time) - INTERVAL 10 MINUTE FROM u)""")
def _(t):
    """Sliding day windows every twelve hours."""
    return _run(t, ST.str_ip_threat(_stream(t, "access_log", "str-ip"), 1, "24 hours", "12 hours"), "str-ip")


@query("str_login_sessions", """
WITH e AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY "user" ORDER BY event_time) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM v_logins),
g AS (SELECT *, SUM(fresh) OVER (PARTITION BY "user" ORDER BY event_time) AS no FROM e)
SELECT "user", MIN(event_time) AS session_start, MAX(event_time) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS n FROM g GROUP BY "user", no HAVING MAX(event_time) + INTERVAL 6 HOUR <= (SELECT MAX(event_time) - INTERVAL 10 MINUTE FROM v_logins)""")
def _(t):
    return _run(t, ST.str_login_sessions(_stream(t, "logins", "str-login"), "6 hours"), "str-login")


DELTA_SQL = """
WITH p AS (SELECT *, lag(counter_value) OVER (PARTITION BY server_id, key ORDER BY reading_time, reading_id) AS pv FROM v_counters),
d AS (SELECT *, CASE WHEN counter_value < pv THEN counter_value ELSE counter_value - pv END AS delta FROM p)
"""


@query("str_counter_delta", DELTA_SQL + "SELECT server_id, key, reading_id, delta FROM d")
def _(t):
    """Readings land shuffled, so that about half of them come after later ones; three batches read them."""
    spark = t.spark
    land, out = work_path(spark, "counters"), work_path(spark, "counters-out")
    rows = t("counters")
    files = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.repartition(files, "reading_id").write.parquet(land)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-files // 3)).parquet(land)
    ST.str_counter_delta(stream, out, work_path(spark, "counters-state"), work_path(spark, "counters-cp")).awaitTermination()
    return ST.current_deltas(spark.read.parquet(out)).select("server_id", "key", "reading_id", "delta")


@query("counter_share", DELTA_SQL + """, g AS (SELECT server_id, key, CAST(COALESCE(SUM(delta), 0) AS BIGINT) AS delta FROM d GROUP BY 1, 2)
SELECT *, CAST(delta AS DOUBLE) * 100 / SUM(delta) OVER (PARTITION BY server_id) AS pct FROM g""")
def _(t):
    return ST.counter_share(t("counters"))


@query("str_memory_trigger", f"""
SELECT server_id, sample_id, physical_used FROM v_memory_samples WHERE server_id IN (SELECT server_id FROM v_memory_samples WHERE (physical_low OR virtual_low) AND event_time > {E} - INTERVAL 1 MONTH)""")
def _(t):
    stream = ST.str_memory_trigger(_stream(t, "memory_samples", "str-memory"), t("memory_samples"), AS_OF_EVENTS)
    return _run(t, stream.select("server_id", "sample_id", "physical_used"), "str-memory")


