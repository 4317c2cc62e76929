"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_ALL=1 for every registered query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from fleetwatch.queries import load
from fleetwatch.session import get_session

HEADLINE = (
    "wait_stats wait_top_cause backup_size_pivot backup_speed integrity_check_speed index_maintenance_cost "
    "cache_free_space log_write_share stale_stats_tables top_page_lock_waits top_page_splits memory_tree "
    "hc_backup_user hc_jobs_failed hc_trace_errors hc_cpu_pressure hc_traffic_light run_health "
    "log_archive_failures log_pattern_counts web_status_rows evt_system_errors cmp_settings cmp_presence cmp_report "
    "cmp_password_expiration cmp_flags_advice purge_cascade retention_cutoff mnt_inventory mnt_action_decision "
    "mnt_plan export_diff chk_integrity win_rank_desc win_share_of_total counter_share str_ip_threat"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session("bench", int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    registered = load()
    keys = list(registered) if os.environ.get("BENCH_ALL") else HEADLINE
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for key in keys:
        start = time.perf_counter()
        try:
            registered[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - start, 3)
        except Exception as error:  # keep timing the others
            print(f"{key}: {str(error)[:300]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
