"""Registered queries: an operator bound to role views, with its oracle."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fleetwatch.queries.roles_sql import duckdb_sql, spark_sql


class Tables:
    """Role views and driver tables of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._views: dict[str, str] = {}

    def __call__(self, role: str) -> DataFrame:
        return self.spark.sql(spark_sql(f"SELECT * FROM v_{role}", self.view))

    def view(self, name: str) -> str:
        """Temporary view of a driver table, whose files are listed and schema is read once for all roles."""
        if name not in self._views:
            self._views[name] = f"fleetwatch_{name}_{zlib.crc32(self.sf_dir.encode()):08x}"
            self.table(name).createOrReplaceTempView(self._views[name])
        return self._views[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(key: str, oracle: str | None = None):
    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = Query(key, fn, duckdb_sql(oracle) if oracle else None)
        return fn

    return add
