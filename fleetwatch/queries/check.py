"""Compare registered queries with their oracles: ``python -m fleetwatch.queries.check [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime

import pandas as pd

from fleetwatch.queries import load
from fleetwatch.queries.roles_sql import TABLES
from fleetwatch.session import get_session


def _plain(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return round(f, 6) if abs(f) < 1e9 else float(f"{f:.12g}")
    if isinstance(v, (pd.Timestamp, datetime)):
        return pd.Timestamp(v).tz_localize(None).isoformat()
    if isinstance(v, date):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(_plain(x) for x in v)
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    return sorted((tuple(_plain(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, query, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    got = query(spark, sf_dir).toPandas()
    if query.oracle is None:
        return None if len(got) else "no oracle, 0 rows"
    want = con.execute(query.oracle).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    a, b = rows_of(got), rows_of(want)
    if len(a) != len(b):
        extra = [r for r in a if r not in set(b)][:2] if len(a) < 100000 else []
        lack = [r for r in b if r not in set(a)][:2] if len(b) < 100000 else []
        return f"{len(a)} rows vs {len(b)}; extra {extra}; lacking {lack}"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ: {bad[0]}"
    return None if len(a) else "EMPTY"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session("check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for key, q in load().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, q, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        took = time.time() - start
        if problem or took > 8:
            print(f"\n## {key} {took:.1f}s {problem or 'ok'}", flush=True)
        failed += bool(problem)
    print("\n## failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
