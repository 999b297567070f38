"""Full refresh: raw exports to clean tables, audit log, marts and views.

Each layer is written once and read back, because clean tables feed several
marts; everything between two writes is one lazy plan.  Re-running replaces
every table.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import DEFAULT, Contract
from ..operators import quality_rules
from ..operators.access import user_plant_map
from ..session import configure, size_shuffles
from ..sources.csv_source import RAW_FILES, first_rows, read_csv
from ..sources.lake import Lake, row_counts
from . import clean, dashboard, marts, semantic

# Marts are read by time range, and a day holds few rows: sorted files, no
# folder per day.
TIME_COLUMNS = {
    "fact_oee_daily_line": "production_date",
    "fact_quality_daily": "inspection_date",
    "fact_sensor_hourly": "sensor_hour",
    "fact_delivery_order": "order_date",
}

def ingest(
    spark: SparkSession, source: str, lake: Lake, files: Mapping[str, str] = RAW_FILES,
    *, sensor_rows: int | None = None, line_breaks: bool = False,
) -> DataFrame:
    """Copy every export into the raw layer and report the row counts."""
    frames = {}
    for table, relative in files.items():
        frame = read_csv(spark, f"{source.rstrip('/')}/{relative}", line_breaks=line_breaks)
        if table == "sensor_reading" and sensor_rows is not None:
            frame = first_rows(frame, sensor_rows)
        frames[table] = frame
    return row_counts(lake.write_all("raw", frames))


def build_clean(
    lake: Lake, *, parity: bool = False, issue_cap: int | None = None, contracts: Mapping[str, Contract] | None = None,
) -> DataFrame:
    """Clean tables, the issue log and the values that the sources' contracts could not read."""
    raw = lambda t: lake.read("raw", t)
    of = lambda t: (contracts or {}).get(t, DEFAULT)
    frames = {
        "work_order": clean.work_orders(raw("work_order"), parity=parity, contract=of("work_order")),
        "production_run": clean.production_runs(raw("production_run"), parity=parity, contract=of("production_run")),
        "quality_inspection": clean.quality_inspections(
            raw("quality_inspection"), parity=parity, contract=of("quality_inspection")),
        "sensor_reading": clean.sensor_readings(raw("sensor_reading"), parity=parity, contract=of("sensor_reading")),
        "machine_state_event": clean.machine_state_events(
            raw("machine_state_event"), parity=parity, contract=of("machine_state_event")),
        "shipment": clean.shipments(raw("shipment"), contract=of("shipment")),
        "sales_order": clean.sales_orders(raw("sales_order"), contract=of("sales_order")),
        **{m: clean.master(m, raw(m), contract=of(m)) for m in clean.MASTERS},
        "rejected_value": reduce(DataFrame.unionByName, [
            clean.rejected_values(t, raw(t), of(t)) for t in (*clean.TIMES, *clean.MASTERS)]),
        "dq_issue_log": quality_rules.issue_log(
            {t: raw(t) for t in ("work_order", "production_run", "quality_inspection", "sensor_reading")},
            cap=issue_cap, pass_row=False, contracts=contracts,
        ),
    }
    written = lake.write_all("clean", frames)
    if written["dq_issue_log"].isEmpty():
        passed = quality_rules.pass_rows(lake.spark).withColumn("created_at", F.current_timestamp())
        written["dq_issue_log"] = lake.append("clean", "dq_issue_log", passed)
    return row_counts(written)


def build_marts(lake: Lake) -> DataFrame:
    c = lambda t: lake.read("clean", t)
    order = {t: [time] for t, time in TIME_COLUMNS.items()}
    facts = lake.write_all("mart", {
        "fact_oee_daily_line": marts.oee_daily_line(c("production_run"), c("work_order")),
        "fact_quality_daily": marts.quality_daily(
            c("quality_inspection"), c("work_order"), c("product_master")),
        "fact_sensor_hourly": marts.sensor_hourly(c("sensor_reading")),
        "fact_delivery_order": marts.delivery_order(c("sales_order"), c("shipment")),
        **{name: semantic.registry(lake.spark, name) for name in semantic.REGISTRIES},
        "superset_rls_user_plant": user_plant_map(c("plant_master")),
    }, sort_by=order)
    # Reads the hourly mart from its files instead of aggregating the sensors again; machine-days are few and written.
    step = lambda df, label: lake.write("lab", label, df) if label == "machine_day" else df
    features = lake.write("mart", "feature_quality_model", marts.quality_features(
        c("production_run"), c("work_order"), c("product_master"), c("machine_master"),
        c("quality_inspection"), facts["fact_sensor_hourly"], step=step))
    return row_counts({**facts, "feature_quality_model": features})


def datasets(lake: Lake) -> dict[str, DataFrame]:
    """The published datasets over the written marts."""
    mart = lambda t: lake.read("mart", t)
    issues = lake.read("clean", "dq_issue_log")
    oee, quality = mart("fact_oee_daily_line"), mart("fact_quality_daily")
    return {
        semantic.OEE: dashboard.dataset_view("v_dataset_oee_operational", oee),
        semantic.QUALITY: dashboard.dataset_view("v_dataset_quality_decision", quality),
        semantic.SENSOR: dashboard.dataset_view("v_dataset_sensor_hourly", mart("fact_sensor_hourly")),
        semantic.GOVERNANCE: dashboard.dataset_view(
            "v_dataset_dq_governance", quality_rules.summarize(issues)),
        semantic.EXECUTIVE: dashboard.kpi_row(
            lake.read("clean", "work_order"), lake.read("clean", "production_run"),
            oee, issues, quality, mart("fact_delivery_order")),
    }


def create_views(lake: Lake) -> list[str]:
    """Register the datasets and the audit summary as temporary views."""
    views = {
        d.physical_object.split(".")[1]: df
        for d in semantic.DATASETS for name, df in datasets(lake).items() if name == d.dataset_name
    }
    views["v_data_quality_summary"] = quality_rules.summarize(lake.read("clean", "dq_issue_log"))
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


# Lasting views of the mart layer: the table they read and what they show of it.
LASTING_VIEWS = {
    "v_dataset_oee_operational": ("mart", "fact_oee_daily_line"),
    "v_dataset_quality_decision": ("mart", "fact_quality_daily"),
    "v_dataset_sensor_hourly": ("mart", "fact_sensor_hourly"),
    "v_dataset_dq_governance": ("clean", "dq_issue_log"),
}


def register_all(lake: Lake, audits: Mapping[str, Mapping[str, int]]) -> None:
    """Catalog entries of all written tables, and views that outlive the session."""
    layers = {"ingest_raw_data": "raw", "clean_and_validate": "clean", "build_feature_marts": "mart"}
    lake.register_all([(layer, table) for step, layer in layers.items() for table in audits.get(step, ())])
    for view, (layer, table) in LASTING_VIEWS.items():
        columns = dashboard.DATASET_COLUMNS[view]
        grouped = "issue_count" in columns
        shown = ", ".join("count(*) as issue_count" if c == "issue_count" else c for c in columns)
        by = f" group by {', '.join(c for c in columns if c != 'issue_count')}" if grouped else ""
        lake.spark.sql(
            f"CREATE OR REPLACE VIEW `{lake.database('mart')}`.`{view}` AS "
            f"SELECT {shown} FROM `{lake.database(layer)}`.`{table}`{by}")


def run_all(
    spark: SparkSession, source: str, lake: Lake, files: Mapping[str, str] = RAW_FILES, *,
    parity: bool = False, sensor_rows: int | None = None, issue_cap: int | None = None, register: bool = True,
    contracts: Mapping[str, Contract] | None = None, line_breaks: bool = False,
) -> dict[str, DataFrame]:
    """Ingest, clean, build marts, create views; returns the row-count audits.

    ``sensor_rows`` caps the rows taken of the sensor export and ``issue_cap``
    the issues logged per rule; both are off by default.  ``contracts`` says, by
    raw table, how a source writes times and units; what they can't read is
    listed in ``clean.rejected_value``.  ``line_breaks`` takes quoted line breaks
    in exports as part of their fields.  Tables and views are entered in the
    catalog, where ``lake.tables()`` lists them, unless ``register`` is off.
    """
    configure(spark)
    size_shuffles(spark, source)
    steps = {
        "ingest_raw_data": lambda: ingest(spark, source, lake, files, sensor_rows=sensor_rows, line_breaks=line_breaks),
        "clean_and_validate": lambda: build_clean(lake, parity=parity, issue_cap=issue_cap, contracts=contracts),
        "build_feature_marts": lambda: build_marts(lake),
    }
    audits, counted = {}, {}
    for step, run in steps.items():
        began = time.monotonic()
        audits[step] = run()
        # The audit is one row per table, so its size does not grow with the data.
        counts = {r["table_name"]: r["row_count"] for r in audits[step].collect()}
        lake.log(step, "ok", {"status": "ok", "tables": counts, "seconds": round(time.monotonic() - began, 1)})
        counted[step] = counts
    create_views(lake)
    if register:
        register_all(lake, counted)
    return audits
