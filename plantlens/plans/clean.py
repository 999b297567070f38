"""Raw to clean: coercion, deduplication, derived columns and flags.

Every function takes a raw frame (all text from CSV, or already typed) and
returns a lazy clean frame.  ``contract`` says how the source writes times and
units; what it can't read becomes null and is listed by ``rejected_values``.
``order`` is the arrival position that decides
which duplicate is the last one; ``parity`` reproduces the literal text a
missing status or code turns into in the pandas pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerce as fx
from ..functions.coerce import DEFAULT, Contract, date_of, flag, hour_of, lower_text, minutes_between, upper_text
from ..functions.numeric import clamp_zero, ratio
from ..operators.dedup import INGEST_ORDER, keep_last

MASTERS = ("plant_master", "line_master", "machine_master", "product_master",
           "customer_master", "operator_master")


# Columns of the raw tables that hold times and numbers.
TIMES = {
    "work_order": ("planned_start_datetime", "planned_end_datetime", "actual_start_datetime",
                   "actual_end_datetime", "load_timestamp"),
    "production_run": ("run_start_datetime", "run_end_datetime"),
    "quality_inspection": ("inspection_datetime",),
    "sensor_reading": ("timestamp",),
    "machine_state_event": ("event_start", "event_end"),
    "shipment": ("ship_date", "promised_delivery_date"),
    "sales_order": ("order_date", "requested_delivery_date", "promised_delivery_date", "load_timestamp"),
}
NUMBERS = {
    "work_order": ("planned_quantity", "actual_quantity", "rejected_quantity", "rework_quantity"),
    "production_run": ("input_quantity", "output_quantity", "scrap_quantity", "rework_quantity",
                       "setup_minutes", "runtime_minutes", "idle_minutes", "speed_actual_ppm", "speed_standard_ppm"),
    "quality_inspection": ("sample_size", "defect_count", "measurement_1", "measurement_2",
                           "lower_spec_limit", "upper_spec_limit"),
    "sensor_reading": ("temperature_c", "vibration_mm_s", "pressure_bar", "current_amp", "speed_rpm", "humidity_pct"),
    "shipment": ("shipped_quantity", "distance_km", "late_delivery_flag", "delay_days"),
    "sales_order": ("ordered_quantity", "unit_price", "discount_pct"),
    "plant_master": ("latitude", "longitude", "capacity_units_per_day"),
    "line_master": ("design_rate_units_per_hour", "active_flag"),
    "machine_master": ("machine_age_years", "nominal_speed_rpm", "sensor_enabled",
                       "maintenance_interval_days"),
    "product_master": ("complexity_score", "standard_cycle_seconds", "standard_scrap_rate",
                       "standard_energy_kwh_per_unit", "standard_unit_cost", "list_price", "active_flag"),
    "customer_master": ("credit_risk_score",),
    "operator_master": ("experience_years", "active_flag"),
}


def typed(table: str, raw: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """The table's times and numbers, read as its source's contract says."""
    return fx.coerce(raw, timestamps=TIMES.get(table, ()), numbers=NUMBERS.get(table, ()), contract=contract)


def rejected_values(table: str, raw: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """(table_name, column_name, value, position) of each text that the contract can't read."""
    keep = [c for c in INGEST_ORDER if c in raw.columns]
    found = fx.rejected_values(
        raw, timestamps=TIMES.get(table, ()), numbers=NUMBERS.get(table, ()), contract=contract, keep=keep)
    return found.select(F.lit(table).alias("table_name"), "column_name", "value", *keep)


def _arrival(df: DataFrame, order: Sequence[str] | None) -> list[str]:
    wanted = INGEST_ORDER if order is None else order
    return [c for c in wanted if c in df.columns]


def _text(df: DataFrame, names: Sequence[str], how, parity: bool) -> dict:
    return {c: how(c, parity=parity) for c in names if c in df.columns}


def _without_arrival(df: DataFrame) -> DataFrame:
    return df.drop(*INGEST_ORDER)


def work_orders(
    raw: DataFrame, *, order: Sequence[str] | None = None, parity: bool = False, contract: Contract = DEFAULT,
) -> DataFrame:
    rows = typed("work_order", raw, contract)
    latest = keep_last(rows, ["work_order_id"], ["load_timestamp", *_arrival(raw, order)])
    good = clamp_zero(F.col("actual_quantity") - F.col("rejected_quantity"))
    started, ended = F.col("actual_start_datetime"), F.col("actual_end_datetime")
    return _without_arrival(latest.withColumns({
        **_text(latest, ("work_order_status", "priority_level"), lower_text, parity),
        "good_quantity": good,
        "yield_rate": ratio(good, "actual_quantity"),
        "schedule_delay_minutes": minutes_between("planned_end_datetime", "actual_end_datetime"),
        "production_attainment": ratio("actual_quantity", "planned_quantity"),
        "invalid_record_flag": flag(
            F.col("actual_quantity") < 0, F.col("planned_quantity") < 0, ended <= started, any_of=True
        ),
    }))


def production_runs(
    raw: DataFrame, *, order: Sequence[str] | None = None, parity: bool = False, contract: Contract = DEFAULT,
) -> DataFrame:
    rows = typed("production_run", raw, contract)
    last = keep_last(rows, ["run_id"], _arrival(raw, order))
    return _without_arrival(last.withColumns({
        **_text(last, ("run_status",), lower_text, parity),
        "good_quantity": clamp_zero(F.col("output_quantity") - F.col("scrap_quantity")),
        "scrap_rate": ratio("scrap_quantity", "output_quantity"),
        "speed_ratio": ratio("speed_actual_ppm", "speed_standard_ppm"),
        "run_date": date_of("run_start_datetime"),
    }))


def quality_inspections(
    raw: DataFrame, *, order: Sequence[str] | None = None, parity: bool = False, contract: Contract = DEFAULT,
) -> DataFrame:
    rows = typed("quality_inspection", raw, contract)
    last = keep_last(rows, ["inspection_id"], _arrival(raw, order))
    within = flag(F.col("measurement_1").between(F.col("lower_spec_limit"), F.col("upper_spec_limit")))
    rate = ratio("defect_count", "sample_size")
    return _without_arrival(last.withColumns({
        **_text(last, ("pass_fail",), lower_text, parity),
        **_text(last, ("defect_code",), upper_text, parity),
        "defect_rate": rate,
        "within_spec_flag": within,
        # An unmeasured part is not within limits, hence at risk.
        "high_defect_risk": flag(
            rate >= 0.05, lower_text("pass_fail") == "fail", within == 0, any_of=True
        ),
    }))


def sensor_readings(
    raw: DataFrame, *, order: Sequence[str] | None = None, parity: bool = False, contract: Contract = DEFAULT,
) -> DataFrame:
    rows = typed("sensor_reading", raw, contract)
    # After coercion: readings without a usable time collapse per machine and sensor.
    last = keep_last(rows, ["timestamp", "machine_id", "sensor_id"], _arrival(raw, order))
    return _without_arrival(derive_sensor_columns(last, parity=parity))


def derive_sensor_columns(typed: DataFrame, *, parity: bool = False) -> DataFrame:
    """Row-wise part of the sensor cleaning, shared with the streaming plan."""
    return typed.withColumns({
        **_text(typed, ("operating_state",), upper_text, parity),
        "sensor_hour": hour_of("timestamp"),
        "sensor_valid_flag": flag(
            F.col("temperature_c").between(0, 150),
            F.col("vibration_mm_s") >= 0,
            F.col("pressure_bar") >= 0,
            F.col("current_amp") >= 0,
        ),
    })


def machine_state_events(raw: DataFrame, *, parity: bool = False, contract: Contract = DEFAULT) -> DataFrame:
    rows = typed("machine_state_event", raw, contract)
    return _without_arrival(rows.withColumns({
        **_text(rows, ("state_code",), upper_text, parity),
        "event_duration_minutes": minutes_between("event_start", "event_end"),
    }))


def shipments(raw: DataFrame, *, contract: Contract = DEFAULT) -> DataFrame:
    return _without_arrival(typed("shipment", raw, contract))


def sales_orders(
    raw: DataFrame, *, dedupe: bool = False, order: Sequence[str] | None = None, contract: Contract = DEFAULT,
) -> DataFrame:
    """Dates parsed; repeated order lines stay unless ``dedupe`` is asked for.

    Quantities arrive as numbers in the source; text input is coerced so that
    the order value can be computed.
    """
    rows = typed("sales_order", raw, contract)
    if dedupe:
        by = [c for c in ("load_timestamp", *_arrival(raw, order)) if c in rows.columns]
        rows = keep_last(rows, ["sales_order_id", "order_line_id"], by)
    return _without_arrival(rows)


def master(table: str, raw: DataFrame, *, contract: Contract = DEFAULT) -> DataFrame:
    """Masters are copied; only their numeric columns get a type."""
    return _without_arrival(typed(table, raw, contract))
