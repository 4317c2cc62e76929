"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "fleetwatch", cpus: int | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if cpus is not None:
        builder = (
            builder.master(f"local[{cpus}]")
            .config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        )
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only an unset value (a bare local session) gets a temporary folder, which the
    session's checkpoint directory then names.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="fleetwatch-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written intermediate table."""
    return f"{shared_dir(spark).rstrip('/')}/fleetwatch/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """A small aggregate written to the shared folder and read back.

    The written size is exact, so Spark itself decides whether the table may be
    broadcast, and a lost executor never repeats the scan behind it.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Constant rows as a local relation, whose known size makes it a broadcast side."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"_{i}" for i in range(len(fields)))
    casts = ", ".join(f"CAST(_{i} AS {kind}) AS {name}" for i, (name, kind) in enumerate(fields))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
