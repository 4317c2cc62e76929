"""Plan and run of a maintenance window."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from fleetwatch.operators.maintenance import mnt_plan_order, mnt_time_budget
from fleetwatch.operators.selectors import sel_name_list


def mnt_plan(databases: DataFrame, spec: str, mode: str = "LIST", seconds: float = 7200) -> DataFrame:
    """Selected databases in work order, with the flag of what fits the time limit.

    Databases need: database_name, database_type and est_seconds, plus the
    column the order mode reads.
    """
    named = databases.withColumnRenamed("database_name", "name").drop("start_position")
    chosen = sel_name_list(named, spec).filter("selected").withColumnRenamed("name", "database_name")
    return mnt_time_budget(mnt_plan_order(chosen, mode), seconds)


def run_commands(
    spark: SparkSession, commands: list[tuple[str, Callable[[], None]]], parallel: int = 4
) -> list[dict]:
    """Submit Spark jobs side by side and return one command-log row each.

    Each command is a named function that runs its own Spark job; a failure is
    logged and does not stop the others.
    """

    def run(item: tuple[str, Callable[[], None]]) -> dict:
        name, action = item
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", "maintenance")
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        number, message = 0, None
        try:
            action()
        except Exception as error:  # one failed command becomes one log row
            number, message = 1, str(error)
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        return {
            "command": name,
            "command_type": name.split(" ", 1)[0],
            "start_time": started,
            "end_time": ended,
            "error_number": number,
            "error_message": message,
        }

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(run, commands))
