"""Dashboard reads: KPI row, listings, Pareto, line comparison, dataset views."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import RATE, exact_avg, exact_sum, ratio, round_half_up
from ..operators.quality_rules import first
from ..operators.running import running_total


def top(df: DataFrame, order: Sequence, limit: int | None = None) -> DataFrame:
    """Ordered listing: whole, or the first ``limit`` rows."""
    return first(df.orderBy(*order), limit)


def page(df: DataFrame, order: Sequence, limit: int = 200) -> DataFrame:
    """Ordered listing as the read API pages it: 1 to 2000 rows, others clamped."""
    return top(df, order, max(1, min(limit, 2000)))


def single_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Merge one-row aggregates with different columns into one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def kpi_row(
    work_orders: DataFrame, runs: DataFrame, oee: DataFrame, issues: DataFrame,
    quality: DataFrame, delivery: DataFrame, *, stamp: bool = True,
    step: Callable[[DataFrame], DataFrame] = lambda part: part,
) -> DataFrame:
    """Executive KPIs: one aggregate pass per table, merged into one row.

    ``issues`` is the issue log or its summary; a summary is added up.  ``step``
    may write the row of each pass, so that shuffle files of one pass only
    stand at a time.
    """
    serious = F.col("severity").isin("high", "medium")
    if "issue_count" in issues.columns:
        counted = F.coalesce(F.sum(F.when(serious, F.col("issue_count"))), F.lit(0).cast("bigint"))
    else:
        counted = F.count_if(serious)
    row = single_row([step(part) for part in (
        work_orders.agg(F.count(F.lit(1)).alias("work_orders")),
        runs.agg(F.count(F.lit(1)).alias("production_runs")),
        oee.agg(
            round_half_up(exact_avg("oee", RATE)).alias("avg_oee"),
            round_half_up(exact_avg("scrap_rate", RATE)).alias("avg_scrap_rate"),
        ),
        issues.agg(counted.alias("dq_issues_high_medium")),
        quality.agg(round_half_up(exact_avg("defect_rate", RATE)).alias("avg_defect_rate")),
        delivery.agg(round_half_up(exact_avg("late_delivery_flag")).alias("late_delivery_rate")),
    )])
    return row.withColumn("refreshed_at", F.current_timestamp()) if stamp else row


def oee_listing(oee: DataFrame) -> DataFrame:
    """Daily OEE with ratios to four places, unordered and whole."""
    rounded = [round_half_up(c).alias(c) for c in
               ("oee", "availability", "performance", "quality", "scrap_rate")]
    return oee.select("production_date", "plant_id", "line_id", *rounded,
                      "run_count", "output_quantity", "good_quantity")


def oee_daily(oee: DataFrame, limit: int | None = None) -> DataFrame:
    """Newest day first, then plant and line."""
    order = [F.desc_nulls_first("production_date"), F.asc_nulls_last("plant_id"),
             F.asc_nulls_last("line_id")]
    return top(oee_listing(oee), order, limit)


def defect_totals(quality: DataFrame) -> DataFrame:
    return quality.groupBy("defect_code").agg(
        exact_sum("defect_count").alias("defect_count"),
        exact_sum("sample_size").alias("sample_size"),
    )


def defect_pareto(quality: DataFrame, limit: int | None = None) -> DataFrame:
    rated = defect_totals(quality).withColumn(
        "defect_rate", round_half_up(ratio("defect_count", "sample_size")))
    return top(rated, [F.desc_nulls_first("defect_count"), F.asc_nulls_last("defect_code")], limit)


def line_performance(oee: DataFrame, limit: int | None = None) -> DataFrame:
    lines = oee.groupBy("plant_id", "line_id").agg(
        round_half_up(exact_avg("oee", RATE)).alias("avg_oee"),
        round_half_up(exact_avg("scrap_rate", RATE)).alias("avg_scrap_rate"),
        exact_sum("output_quantity").alias("output_quantity"),
        exact_sum("good_quantity").alias("good_quantity"),
        F.count(F.lit(1)).alias("production_days"),
    )
    order = [F.desc_nulls_first("avg_oee"), F.asc_nulls_last("plant_id"), F.asc_nulls_last("line_id")]
    return top(lines, order, limit)


def pareto_shares(totals: DataFrame, category: str, value: str) -> DataFrame:
    """Share and cumulative share per category, largest first.

    The running sum adds unrounded shares and rounds last.
    """
    order = [F.desc(value), F.asc_nulls_last(category)]
    running = running_total(totals.select(category, value), value, order, "_running")
    total = running.agg(exact_sum(value)).scalar()
    return running.select(
        category, value,
        round_half_up(ratio(value, total)).alias("defect_pct"),
        round_half_up(ratio("_running", total)).alias("cum_pct"),
    )


# Columns of the dataset views.
DATASET_COLUMNS: Mapping[str, tuple[str, ...]] = {
    "v_dataset_oee_operational": (
        "production_date", "plant_id", "line_id", "run_count", "active_machine_count",
        "runtime_minutes", "idle_minutes", "setup_minutes", "output_quantity", "good_quantity",
        "scrap_quantity", "planned_production_minutes", "availability", "performance", "quality",
        "oee", "scrap_rate"),
    "v_dataset_quality_decision": (
        "inspection_date", "plant_id", "line_id", "product_id", "product_family", "defect_code",
        "inspection_count", "sample_size", "defect_count", "defect_rate", "high_defect_risk_rate"),
    "v_dataset_sensor_hourly": (
        "sensor_hour", "plant_id", "line_id", "machine_id", "reading_count", "avg_temperature_c",
        "max_temperature_c", "avg_vibration_mm_s", "max_vibration_mm_s", "avg_pressure_bar",
        "avg_current_amp", "avg_speed_rpm", "sensor_valid_rate"),
    "v_dataset_dq_governance": ("severity", "rule_id", "table_name", "issue_count"),
}


def dataset_view(view: str, mart: DataFrame) -> DataFrame:
    return mart.select(*DATASET_COLUMNS[view])
