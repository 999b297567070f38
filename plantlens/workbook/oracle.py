"""Reference SQL (DuckDB dialect) for the registered queries.

``CTES`` holds the shared clean tables and marts in SQL; ``with_ctes`` puts the
ones a statement mentions, and what they need, in front of it.
"""

from __future__ import annotations

import re

from .fixtures import ENTITIES, duckdb_text


def xsum(c: str, scale: int = 6) -> str:
    return f"cast(sum(cast({c} as decimal(28,{scale}))) as double)"


def xavg(c: str, scale: int = 6) -> str:
    return f"({xsum(c, scale)} / nullif(count({c}),0))"


def r4(c: str, places: int = 4) -> str:
    return f"cast(round(cast({c} as decimal(38,10)),{places}) as double)"


_RUN_ORDER = ("run_start_datetime desc, machine_id desc, product_id desc, input_quantity desc, "
              "seq_a desc, seq_b desc, seq_c desc, seq_d desc, seq_e desc")
_QMS_ORDER = ("inspection_datetime desc, product_id desc, sample_size desc, defect_count desc, "
              "seq_a desc, seq_b desc, seq_c desc, seq_d desc, seq_e desc")

CTES: dict[str, str] = {
    "c_work_order": """
select work_order_id, sales_order_id, plant_id, line_id, product_id,
 lower(trim(work_order_status)) as work_order_status, lower(trim(priority_level)) as priority_level,
 planned_quantity, actual_quantity, rejected_quantity,
 planned_start_datetime, planned_end_datetime, actual_start_datetime, actual_end_datetime, load_timestamp,
 case when actual_quantity-rejected_quantity<0 then 0 else actual_quantity-rejected_quantity end as good_quantity,
 (case when actual_quantity-rejected_quantity<0 then 0 else actual_quantity-rejected_quantity end)/nullif(actual_quantity,0) as yield_rate,
 (epoch_us(actual_end_datetime)-epoch_us(planned_end_datetime))/60000000.0::double as schedule_delay_minutes,
 actual_quantity/nullif(planned_quantity,0) as production_attainment,
 case when actual_quantity<0 or planned_quantity<0 or actual_end_datetime<=actual_start_datetime then 1 else 0 end as invalid_record_flag
from (select *, row_number() over (partition by work_order_id order by load_timestamp desc nulls first) as rn from work_order)
where rn=1""",
    "c_production_run": f"""
select run_id, work_order_id, machine_id, product_id, operator_id, lower(trim(run_status)) as run_status,
 run_start_datetime, run_end_datetime,
 input_quantity, output_quantity, scrap_quantity, runtime_minutes, idle_minutes, setup_minutes, speed_actual_ppm, speed_standard_ppm,
 case when output_quantity-scrap_quantity<0 then 0 else output_quantity-scrap_quantity end as good_quantity,
 scrap_quantity/nullif(output_quantity,0) as scrap_rate, speed_actual_ppm/nullif(speed_standard_ppm,0) as speed_ratio,
 cast(run_start_datetime as date) as run_date
from (select *, row_number() over (partition by run_id order by {_RUN_ORDER}) as rn from production_run) where rn=1""",
    "c_quality_inspection": f"""
select inspection_id, run_id, work_order_id, product_id, inspection_datetime, upper(trim(defect_code)) as defect_code,
 lower(trim(pass_fail)) as pass_fail, sample_size, defect_count, measurement_1, lower_spec_limit, upper_spec_limit,
 defect_count/nullif(sample_size,0) as defect_rate,
 case when measurement_1 between lower_spec_limit and upper_spec_limit then 1 else 0 end as within_spec_flag,
 case when defect_count/nullif(sample_size,0)>=0.05::double or lower(trim(pass_fail))='fail'
   or not coalesce(measurement_1 between lower_spec_limit and upper_spec_limit,false) then 1 else 0 end as high_defect_risk
from (select *, row_number() over (partition by inspection_id order by {_QMS_ORDER}) as rn from quality_inspection) where rn=1""",
    "c_sensor_reading": """
select "timestamp", plant_id, line_id, machine_id, sensor_id, upper(trim(operating_state)) as operating_state,
 temperature_c, vibration_mm_s, pressure_bar, current_amp, speed_rpm,
 date_trunc('hour',"timestamp") as sensor_hour,
 case when temperature_c between 0 and 150 and vibration_mm_s>=0 and pressure_bar>=0 and current_amp>=0 then 1 else 0 end as sensor_valid_flag
from (select *, row_number() over (partition by "timestamp",machine_id,sensor_id order by seq desc) as rn from sensor_reading) where rn=1""",
    "c_machine_state_event": """
select machine_id, upper(trim(state_code)) as state_code, event_start, event_end, reason_code,
 (epoch_us(event_end)-epoch_us(event_start))/60000000.0::double as event_duration_minutes from machine_state_event""",
    "m_oee": f"""
select production_date, plant_id, line_id, run_count, active_machine_count, runtime_minutes, idle_minutes, setup_minutes,
 output_quantity, scrap_quantity, good_quantity, ppm as planned_production_minutes,
 runtime_minutes/nullif(ppm,0) as availability, output_quantity/nullif(theo,0) as performance,
 good_quantity/nullif(output_quantity,0) as quality,
 (runtime_minutes/nullif(ppm,0))*(output_quantity/nullif(theo,0))*(good_quantity/nullif(output_quantity,0)) as oee,
 scrap_quantity/nullif(output_quantity,0) as scrap_rate
from (select *, runtime_minutes+idle_minutes+setup_minutes as ppm from (
 select cast(r.run_start_datetime as date) as production_date, w.plant_id, w.line_id,
  count(distinct r.run_id) as run_count, count(distinct r.machine_id) as active_machine_count,
  {xsum('r.runtime_minutes')} as runtime_minutes, {xsum('r.idle_minutes')} as idle_minutes, {xsum('r.setup_minutes')} as setup_minutes,
  {xsum('r.output_quantity')} as output_quantity, {xsum('r.scrap_quantity')} as scrap_quantity, {xsum('r.good_quantity')} as good_quantity,
  {xsum('r.runtime_minutes*r.speed_standard_ppm')} as theo
 from c_production_run r left join c_work_order w on r.work_order_id=w.work_order_id
 where r.run_start_datetime is not null group by 1,2,3))""",
    "m_quality": f"""
select inspection_date, plant_id, line_id, product_id, product_family, defect_code, inspection_count, sample_size, defect_count,
 defect_count/nullif(sample_size,0) as defect_rate, high_defect_risk_rate
from (select cast(q.inspection_datetime as date) as inspection_date, w.plant_id, w.line_id, q.product_id, p.product_family, q.defect_code,
  count(*) as inspection_count, {xsum('q.sample_size')} as sample_size, {xsum('q.defect_count')} as defect_count,
  avg(q.high_defect_risk) as high_defect_risk_rate
 from c_quality_inspection q left join c_work_order w on q.work_order_id=w.work_order_id
 left join product_master p on q.product_id=p.product_id group by 1,2,3,4,5,6)""",
    "m_sensor": f"""
select sensor_hour, plant_id, line_id, machine_id, count(*) as reading_count,
 {xavg('temperature_c')} as avg_temperature_c, max(temperature_c) as max_temperature_c,
 {xavg('vibration_mm_s')} as avg_vibration_mm_s, max(vibration_mm_s) as max_vibration_mm_s,
 {xavg('pressure_bar')} as avg_pressure_bar, {xavg('current_amp')} as avg_current_amp, {xavg('speed_rpm')} as avg_speed_rpm,
 avg(sensor_valid_flag) as sensor_valid_rate
from c_sensor_reading group by 1,2,3,4""",
    "m_delivery": """
select so.sales_order_id, so.order_line_id, so.customer_id, so.product_id, so.order_date, so.promised_delivery_date,
 so.ordered_quantity, so.unit_price, so.discount_pct, so.customer_priority, sh.ship_date, sh.shipped_quantity,
 cast(coalesce(sh.late_delivery_flag,0) as double) as late_delivery_flag, cast(coalesce(sh.delay_days,0) as double) as delay_days, sh.root_cause,
 so.ordered_quantity*so.unit_price*(1::double-coalesce(so.discount_pct,0)/100::double) as net_order_value
from sales_order so left join shipment sh on so.sales_order_id=sh.sales_order_id and so.order_line_id=sh.order_line_id""",
    "m_machine_day": f"""
select cast(sensor_hour as date) as sensor_date, machine_id, {xavg('avg_temperature_c',10)} as avg_temperature_c,
 max(max_vibration_mm_s) as max_vibration_mm_s, {xavg('sensor_valid_rate',10)} as sensor_valid_rate
from m_sensor group by 1,2""",
    "m_features": """
select r.run_id, r.work_order_id, w.plant_id, w.line_id, r.machine_id, w.product_id, p.product_family, p.complexity_score,
 m.machine_age_years, m.criticality, r.setup_minutes, r.runtime_minutes, r.idle_minutes, r.speed_ratio, r.scrap_rate,
 coalesce(q.defect_rate,0) as defect_rate, coalesce(q.high_defect_risk,0) as high_defect_risk,
 coalesce(d.avg_temperature_c,0) as avg_temperature_c, coalesce(d.max_vibration_mm_s,0) as max_vibration_mm_s,
 coalesce(d.sensor_valid_rate,1) as sensor_valid_rate
from c_production_run r left join c_work_order w on r.work_order_id=w.work_order_id
 left join product_master p on w.product_id=p.product_id left join machine_master m on r.machine_id=m.machine_id
 left join c_quality_inspection q on r.run_id=q.run_id
 left join m_machine_day d on d.sensor_date=cast(r.run_start_datetime as date) and d.machine_id=r.machine_id""",
}

# (rule, severity, entity, key, predicate, message)
_RULES = [
    ("DQ-WO-TIME", "high", "work_order", "cast(work_order_id as varchar)",
     "actual_end_datetime<=actual_start_datetime", "Actual end is not after actual start."),
    ("DQ-WO-QTY", "high", "work_order", "cast(work_order_id as varchar)",
     "planned_quantity<0 or actual_quantity<0 or rejected_quantity<0", "Negative production quantity detected."),
    ("DQ-WO-MISSING-END", "medium", "work_order", "cast(work_order_id as varchar)",
     "lower(work_order_status)='completed' and actual_end_datetime is null",
     "Completed order has no actual end datetime."),
    ("DQ-RUN-TIME", "high", "production_run", "run_id",
     "run_end_datetime<=run_start_datetime", "Run end is not after run start."),
    ("DQ-RUN-QTY", "high", "production_run", "run_id",
     "output_quantity<0 or scrap_quantity<0 or output_quantity>input_quantity*1.2::double",
     "Invalid or implausible run quantity detected."),
    ("DQ-QMS-COUNT", "high", "quality_inspection", "inspection_id",
     "defect_count>sample_size", "Defect count exceeds sample size."),
    ("DQ-QMS-MEASURE", "medium", "quality_inspection", "inspection_id",
     "measurement_1<lower_spec_limit-5 or measurement_1>upper_spec_limit+5",
     "Measurement is far outside specification range."),
    ("DQ-SENSOR-RANGE", "medium", "sensor_reading", "concat(cast(machine_id as varchar),'@',cast(\"timestamp\" as varchar))",
     "temperature_c<0 or temperature_c>150 or vibration_mm_s<0 or pressure_bar<0",
     "Sensor reading violates domain range."),
    ("DQ-SENSOR-MISSING", "low", "sensor_reading", "concat(cast(machine_id as varchar),'@',cast(\"timestamp\" as varchar))",
     "temperature_c is null or vibration_mm_s is null or pressure_bar is null or current_amp is null",
     "One or more sensor values are missing."),
]


def rule_sql(rule_id: str) -> str:
    """Issue rows of one predicate rule."""
    rid, sev, table, key, pred, msg = next(r for r in _RULES if r[0] == rule_id)
    return (f"select 'raw.{table}' as table_name, {key} as business_key, '{rid}' as rule_id, "
            f"'{sev}' as severity, '{msg}' as issue_message from {table} where {pred}")


DUP_SQL = (
    "select 'raw.work_order' as table_name, cast(work_order_id as varchar) as business_key, 'DQ-WO-DUP' as rule_id, "
    "'high' as severity, 'Duplicate work_order_id found.' as issue_message from work_order "
    "where work_order_id in (select work_order_id from work_order group by 1 having count(*)>1)"
)
CTES["dq_issues"] = " union all ".join([DUP_SQL] + [rule_sql(r[0]) for r in _RULES])
CTES["dq_summary"] = (
    "select severity, rule_id, table_name, count(*) as issue_count from dq_issues group by 1,2,3"
)

_NAMES = {**{n: None for n in ENTITIES}, **{n: None for n in CTES}}


def _text(name: str) -> str:
    return CTES[name] if name in CTES else duckdb_text(name)


def _mentions(text: str) -> list[str]:
    return [n for n in _NAMES if re.search(rf"\b{n}\b", text)]


def with_ctes(statement: str) -> str:
    """The statement with the shared tables it mentions in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in _mentions(_text(name)):
            if dep != name:
                visit(dep)
        ordered.append(name)

    for name in _mentions(statement):
        visit(name)
    if not ordered:
        return statement
    head = ",\n".join(f"{n} as ({_text(n)})" for n in ordered)
    body = statement.strip()
    if body.lower().startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"
