"""Marts over clean tables.

Only left equi joins: unmatched facts stay, with missing dimensions, and form
groups of their own.  No join is forced to broadcast; Catalyst and AQE choose
it from estimated and measured sizes and fall back to a shuffle join that AQE
splits where a key is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import date_of
from ..functions.numeric import RATE, exact_avg, exact_sum, ratio
from ..operators.joins import left_join_many


# Columns of the clean runs and inspections that the feature table reads.
FEATURE_RUNS = (
    "run_id", "work_order_id", "machine_id", "run_start_datetime",
    "setup_minutes", "runtime_minutes", "idle_minutes", "speed_ratio", "scrap_rate",
)
FEATURE_INSPECTIONS = ("run_id", "defect_rate", "high_defect_risk")

# Columns of the clean tables that the daily marts read.
OEE_RUNS = (
    "run_id", "work_order_id", "machine_id", "run_start_datetime", "runtime_minutes", "idle_minutes", "setup_minutes",
    "output_quantity", "scrap_quantity", "good_quantity", "speed_standard_ppm",
)
QUALITY_INSPECTIONS = (
    "work_order_id", "product_id", "inspection_datetime", "defect_code", "sample_size", "defect_count", "high_defect_risk",
)


def runs_with_orders(runs: DataFrame, work_orders: DataFrame) -> DataFrame:
    """Runs with the plant and line of their work order."""
    place = work_orders.select("work_order_id", "plant_id", "line_id")
    return runs.drop("plant_id", "line_id").join(place, "work_order_id", "left")


def oee_daily_line(runs: DataFrame, work_orders: DataFrame, *, runs_unique: bool = True) -> DataFrame:
    """Daily OEE per plant and line.

    Clean runs are unique by ``run_id`` and a work order matches at most once,
    so a plain count equals the distinct count and saves the row expansion that
    two distinct aggregates need; ``runs_unique=False`` counts distinct runs.
    """
    base = (
        runs_with_orders(runs, work_orders)
        .filter(F.col("run_start_datetime").isNotNull())
        .withColumn("production_date", date_of("run_start_datetime"))
    )
    runs_counted = F.count("run_id") if runs_unique else F.count_distinct("run_id")
    daily = base.groupBy("production_date", "plant_id", "line_id").agg(
        runs_counted.alias("run_count"),
        F.count_distinct("machine_id").alias("active_machine_count"),
        exact_sum("runtime_minutes").alias("runtime_minutes"),
        exact_sum("idle_minutes").alias("idle_minutes"),
        exact_sum("setup_minutes").alias("setup_minutes"),
        exact_sum("output_quantity").alias("output_quantity"),
        exact_sum("scrap_quantity").alias("scrap_quantity"),
        exact_sum("good_quantity").alias("good_quantity"),
        exact_sum(F.col("runtime_minutes") * F.col("speed_standard_ppm")).alias("theoretical_output"),
    )
    return daily.withColumn(
        "planned_production_minutes",
        F.col("runtime_minutes") + F.col("idle_minutes") + F.col("setup_minutes"),
    ).withColumns({
        "availability": ratio("runtime_minutes", "planned_production_minutes"),
        "performance": ratio("output_quantity", "theoretical_output"),
        "quality": ratio("good_quantity", "output_quantity"),
    }).withColumns({
        "oee": F.col("availability") * F.col("performance") * F.col("quality"),
        "scrap_rate": ratio("scrap_quantity", "output_quantity"),
    }).drop("theoretical_output")


def inspections_with_context(
    inspections: DataFrame, work_orders: DataFrame, products: DataFrame
) -> DataFrame:
    place = work_orders.select("work_order_id", "plant_id", "line_id")
    family = products.select("product_id", "product_family")
    return (
        inspections.drop("plant_id", "line_id")
        .join(place, "work_order_id", "left")
        .join(family, "product_id", "left")
    )


def quality_daily(inspections: DataFrame, work_orders: DataFrame, products: DataFrame) -> DataFrame:
    facts = inspections_with_context(inspections, work_orders, products)
    grouped = facts.groupBy(
        date_of("inspection_datetime").alias("inspection_date"),
        "plant_id", "line_id", "product_id", "product_family", "defect_code",
    )
    return grouped.agg(
        F.count(F.lit(1)).alias("inspection_count"),
        exact_sum("sample_size").alias("sample_size"),
        exact_sum("defect_count").alias("defect_count"),
        F.avg("high_defect_risk").alias("high_defect_risk_rate"),
    ).withColumn("defect_rate", ratio("defect_count", "sample_size"))


def sensor_hourly(readings: DataFrame) -> DataFrame:
    return readings.groupBy("sensor_hour", "plant_id", "line_id", "machine_id").agg(
        *sensor_measures()
    )


def sensor_measures():
    """Aggregates of the hourly sensor mart, shared with the streaming plan."""
    return [
        F.count(F.lit(1)).alias("reading_count"),
        exact_avg("temperature_c").alias("avg_temperature_c"),
        F.max("temperature_c").alias("max_temperature_c"),
        exact_avg("vibration_mm_s").alias("avg_vibration_mm_s"),
        F.max("vibration_mm_s").alias("max_vibration_mm_s"),
        exact_avg("pressure_bar").alias("avg_pressure_bar"),
        exact_avg("current_amp").alias("avg_current_amp"),
        exact_avg("speed_rpm").alias("avg_speed_rpm"),
        F.avg("sensor_valid_flag").alias("sensor_valid_rate"),
    ]


def machine_day(hourly: DataFrame) -> DataFrame:
    """Machine-day rollup of the hourly mart: unweighted average of averages.

    Grouped by ``spread`` next to the keys, so a join on the keys shuffles this
    small side again and AQE can split a hot machine-day of the other.
    """
    day = date_of("sensor_hour").alias("sensor_date")
    spread_ = F.xxhash64(date_of("sensor_hour"), F.col("machine_id")).alias("_spread")
    return hourly.groupBy(spread_, day, "machine_id").agg(
        exact_avg("avg_temperature_c", RATE).alias("avg_temperature_c"),
        F.max("max_vibration_mm_s").alias("max_vibration_mm_s"),
        exact_avg("sensor_valid_rate", RATE).alias("sensor_valid_rate"),
    ).drop("_spread")


def delivery_order(sales_orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Order lines with their shipments; an unshipped line counts as on time."""
    keys = ["sales_order_id", "order_line_id"]
    if "delay_days" not in shipments.columns:
        raise ValueError("shipments have no delay_days")
    shipped = shipments.select(
        *keys, "ship_date", "shipped_quantity", "late_delivery_flag", "root_cause", "delay_days"
    )
    net = (
        F.col("ordered_quantity") * F.col("unit_price")
        * (F.lit(1.0) - F.coalesce(F.col("discount_pct"), F.lit(0.0)) / F.lit(100.0))
    )
    return left_join_many(sales_orders, shipped, keys).select(
        *keys, "customer_id", "product_id", "order_date", "promised_delivery_date",
        "ordered_quantity", "unit_price", "discount_pct", "customer_priority",
        "ship_date", "shipped_quantity",
        F.coalesce(F.col("late_delivery_flag"), F.lit(0)).alias("late_delivery_flag"),
        F.coalesce("delay_days", F.lit(0.0)).alias("delay_days"),
        "root_cause",
        net.alias("net_order_value"),
    )


def quality_features(
    runs: DataFrame,
    work_orders: DataFrame,
    products: DataFrame,
    machines: DataFrame,
    inspections: DataFrame,
    hourly: DataFrame,
    carry: Sequence[str] = (),
    *,
    step: Callable[[DataFrame, str], DataFrame] = lambda df, label: df,
) -> DataFrame:
    """Run-level feature table; a run with several inspections gives several rows.

    ``carry`` names further columns of the runs to keep, so that nothing has to
    join the runs once more.  ``step`` may write what a step hands on and read it
    back: its shuffle files can go then, and the next join knows its size, so
    that machine-days, whose estimate is that of all readings, are broadcast
    instead of shuffling the runs once more.
    """
    facts = runs.select(*FEATURE_RUNS, *carry)
    risk = inspections.select(*FEATURE_INSPECTIONS)
    place = work_orders.select("work_order_id", "plant_id", "line_id", "product_id")
    kind = products.select("product_id", "product_family", "complexity_score")
    build = machines.select("machine_id", "machine_age_years", "criticality")
    daily = step(machine_day(hourly), "machine_day")
    context = step(place.join(kind, "product_id", "left"), "order_context")
    return (
        step(left_join_many(facts, risk, ["run_id"]), "inspected_runs")
        .join(context, "work_order_id", "left")
        .join(build, "machine_id", "left")
        .withColumn("sensor_date", date_of("run_start_datetime"))
        .join(daily, ["sensor_date", "machine_id"], "left")
        .select(
            "run_id", "work_order_id", "plant_id", "line_id", "machine_id", "product_id",
            "product_family", "complexity_score", "machine_age_years", "criticality",
            "setup_minutes", "runtime_minutes", "idle_minutes", "speed_ratio", "scrap_rate",
            F.coalesce("defect_rate", F.lit(0.0)).alias("defect_rate"),
            F.coalesce("high_defect_risk", F.lit(0)).alias("high_defect_risk"),
            F.coalesce("avg_temperature_c", F.lit(0.0)).alias("avg_temperature_c"),
            F.coalesce("max_vibration_mm_s", F.lit(0.0)).alias("max_vibration_mm_s"),
            F.coalesce("sensor_valid_rate", F.lit(1.0)).alias("sensor_valid_rate"),
            *carry,
        )
    )
