"""Time the headline queries; prints one JSON line.

Every query runs to completion into a sink that discards rows, so the whole
result is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from plantlens.session import build_session
from plantlens.workbook.catalog import all_queries

HEADLINE = (
    "c01_work_order", "c02_production_run", "c03_quality_inspection", "c04_sensor_reading",
    "q11_issue_log", "q14_issue_summary", "q21_referential_audit",
    "m01_oee_daily_line", "m02_quality_daily", "m03_sensor_hourly", "m04_delivery_order",
    "m05_quality_features", "m06_dashboard_kpis", "m08_oee_daily_listing",
    "a07_defect_pareto", "a08_line_performance", "l02_metrics_by_plant", "j06_access_membership",
    "b06_machine_failure_features", "b07_quality_risk", "b09_daily_demand", "b10_drift_report",
    "b13_supplier_machines", "b14_broken_chain_links", "b16_alarm_watchlist",
    "l07_access_policy", "b12_plant_clients", "b15_stream_sensor_hourly", "e01_full_refresh",
)


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    only = tuple(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    timings, first = {}, {}
    for name in only or HEADLINE:
        runs = [timed(lambda: queries[name](spark, sf_dir)) for _ in range(repeats)]
        timings[name], first[name] = round(min(runs), 3), round(runs[0], 3)
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "first_runs": first, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
