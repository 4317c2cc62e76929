"""The common output of checks and rules, its rollups and its order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.functions import semantics as S
from fleetwatch.plans.ordering import rank_in_group
from fleetwatch.session import settled

FINDING_COLUMNS = (
    "server_id",
    "check_id",
    "scope",
    "severity",
    "name",
    "current_value",
    "target_value",
    "achieved",
    "details",
    "observed_at",
)

OK, WARN, CRITICAL = 0, 1, 2


def _string(v) -> Column:
    if v is None:
        return F.lit(None).cast("string")
    return v.cast("string") if isinstance(v, Column) else F.lit(str(v))


def findings(
    df: DataFrame,
    check_id: str | Column,
    name: str | Column,
    *,
    severity: int | Column = WARN,
    scope=None,
    current=None,
    target=None,
    achieved: bool | Column = False,
    details=None,
    observed_at=None,
) -> DataFrame:
    """Project rows to the findings schema."""
    at = F.lit(None) if observed_at is None else S.col(observed_at)
    return df.select(
        F.col("server_id").cast("string").alias("server_id"),
        _string(check_id).alias("check_id"),
        _string(scope).alias("scope"),
        (severity if isinstance(severity, Column) else F.lit(severity)).cast("int").alias("severity"),
        _string(name).alias("name"),
        _string(current).alias("current_value"),
        _string(target).alias("target_value"),
        (achieved if isinstance(achieved, Column) else F.lit(achieved)).alias("achieved"),
        _string(details).alias("details"),
        at.cast("timestamp_ntz").alias("observed_at"),
    )


def union_findings(*parts: DataFrame) -> DataFrame:
    """All parts, joined in pairs of halves: every part is analysed as often as the tree is deep, not once per part behind it."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return union_findings(*parts[:half]).unionByName(union_findings(*parts[half:]))


def hc_traffic_light(all_findings: DataFrame, servers: DataFrame | None = None) -> DataFrame:
    """GREEN / YELLOW / RED per server from its highest severity; servers without findings are green."""
    worst = all_findings.groupBy("server_id").agg(F.max("severity").alias("severity"))
    if servers is not None:
        worst = (
            servers.select(F.col("server_id").cast("string").alias("server_id"))
            .distinct()
            .join(worst, "server_id", "left")
            .withColumn("severity", F.coalesce("severity", F.lit(OK)))
        )
    status = F.when(F.col("severity") >= CRITICAL, "RED").when(F.col("severity") == WARN, "YELLOW")
    return worst.select("server_id", status.otherwise("GREEN").alias("status"))


def cmp_report(*parts: DataFrame) -> DataFrame:
    """All rules, not achieved first, then by name.

    The findings are written first: a sort reads its input once for the borders of its ranges and once to deal the rows.
    """
    return settled(union_findings(*parts), "findings").orderBy("achieved", "name", "server_id", "scope", "details")


def cmp_score(all_findings: DataFrame) -> DataFrame:
    """Achieved share per server and section (the check id up to its first dot)."""
    section = F.split_part(F.col("check_id"), F.lit("."), F.lit(1)).alias("section")
    return all_findings.groupBy("server_id", section).agg(
        F.count_if("achieved").alias("achieved_rules"),
        F.count(F.lit(1)).alias("rules"),
        (F.count_if("achieved").cast("double") * 100 / F.count(F.lit(1))).alias("pct"),
    )


def sink_report_rows(all_findings: DataFrame, lines_per_row: int = 1000) -> DataFrame:
    """Status and report text per server, ``lines_per_row`` findings per text.

    ``part_no`` numbers the texts of a server, so a noisy server becomes several
    bounded rows instead of one unbounded string.
    """
    order = [F.col("severity").desc(), F.col("name"), F.col("scope"), F.col("details"), F.col("observed_at")]
    numbered = rank_in_group(all_findings, ["server_id"], order, "_rn")
    parts = (
        numbered.withColumn("part_no", F.floor((F.col("_rn") - 1) / lines_per_row))
        .withColumn("_line", S.text(F.col("name"), ": ", F.coalesce("details", F.lit(""))))
        .groupBy("server_id", "part_no")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_line"))), lambda x: x["_line"]),
                "\n",
            ).alias("report_text")
        )
    )
    return parts.join(hc_traffic_light(numbered), "server_id").select(
        "server_id", "status", "part_no", "report_text"
    )
