"""Test tables read as factory entities.

One SQL text per entity, valid in Spark and in DuckDB (``{S}`` is the string
type, ``{orders}`` a base table).  Every entity covers the whole base table;
modulo terms only inject duplicates, missing values and rule violations next to
the regular rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_ORDER_COLUMNS = """
 o_orderkey as work_order_id, o_orderkey as sales_order_id,
 concat('P0',cast(n_regionkey as {S})) as plant_id, concat('L',cast(n_nationkey as {S})) as line_id,
 o_orderkey % 200 as product_id,
 case o_orderstatus when 'F' then 'Completed' when 'O' then ' In_Progress ' else 'PLANNED' end as work_order_status,
 case when o_custkey % 31 = 0 then null when o_custkey % 7 = 0 then 'Urgent ' else concat(' ',o_orderpriority) end as priority_level,
 o_totalprice/1000 as planned_quantity, o_totalprice*(80+o_orderkey % 40)/100000 as actual_quantity,
 c_acctbal/1000 as rejected_quantity,
 o_orderdate as planned_start_datetime, o_orderdate + interval '30' day as planned_end_datetime,
 o_orderdate as actual_start_datetime,
 case when o_orderkey % 17 = 0 then null when o_orderkey % 13 = 0 then o_orderdate - interval '1' day
      else o_orderdate + interval '33' day end as actual_end_datetime"""
_ORDER_SOURCE = (
    "from {orders} join {customer} on o_custkey=c_custkey join {nation} on c_nationkey=n_nationkey"
)
_SENSOR_COLUMNS = """
 ts - interval '25' year as timestamp, concat('P0',cast(user_id % 5 as {S})) as plant_id,
 concat('L',cast(user_id % 25 as {S})) as line_id, user_id % 10 as machine_id, event_id as sensor_id,
 event_type as operating_state"""
_SENSOR_VALUES = """
 case when event_type='error' then -value/10 else value/10 end as vibration_mm_s,
 case when event_id % 40 = 0 then null else value/50 end as pressure_bar,
 value/5 as current_amp, value*10 as speed_rpm"""

ENTITIES: dict[str, str] = {
    "plant_master": "select concat('P0',cast(r_regionkey as {S})) as plant_id, r_name as plant_name from {region}",
    "line_master": (
        "select concat('L',cast(n_nationkey as {S})) as line_id, "
        "concat('P0',cast(n_regionkey as {S})) as plant_id, n_name as line_name from {nation}"
    ),
    "machine_master": """
select s_suppkey as machine_id, concat('L',cast(s_nationkey as {S})) as line_id,
 concat('P0',cast(n_regionkey as {S})) as plant_id, s_acctbal/1000 as machine_age_years,
 case when s_acctbal<0 then 'critical' when s_acctbal<3000 then 'high' when s_acctbal<6000 then 'medium' else 'low' end as criticality
from {supplier} left join {nation} on s_nationkey=n_nationkey""",
    "product_master": """
select p_partkey as product_id, p_type as product_family, p_size as complexity_score, p_brand as supplier_group,
 concat('S',substr(p_brand,7)) as primary_supplier_id from {part}""",
    "customer_master": """
select c_custkey as customer_id, c_name as customer_name, c_mktsegment as customer_segment,
 c_nationkey as country, c_acctbal/100 as credit_risk_score from {customer}""",
    "supplier_master": """
select concat('S',cast(n_nationkey as {S})) as supplier_id, n_name as supplier_name,
 cast(60+n_nationkey as double) as quality_score from {nation}""",
    "operator_master": """
select concat('OP-',cast(s_suppkey as {S})) as operator_id, s_name as operator_hash,
 case when s_acctbal<2000 then 'G3_junior' when s_acctbal<6000 then 'G2_mid' else 'G1_senior' end as fairness_group,
 concat('P0',cast(s_nationkey % 5 as {S})) as plant_id,
 case when s_acctbal<2000 then 'junior' when s_acctbal<6000 then 'intermediate' else 'expert' end as certification_level
from {supplier}""",
    "work_order": f"""
select {_ORDER_COLUMNS}, o_orderdate as load_timestamp {_ORDER_SOURCE}
union all
select {_ORDER_COLUMNS}, o_orderdate + interval '1' day as load_timestamp {_ORDER_SOURCE} where o_orderkey % 25 = 0""",
    "production_run": """
select concat(cast(l_orderkey as {S}),'-',cast(l_linenumber as {S})) as run_id,
 case when l_linenumber=7 then null else l_orderkey end as work_order_id, l_suppkey as machine_id, l_partkey as product_id,
 case when l_quantity=13 then ' ' when l_quantity=29 then concat('X-',cast(l_suppkey as {S}))
      else concat('OP-',cast(l_suppkey as {S})) end as operator_id,
 case when l_linestatus='F' then ' Completed' else 'RUNNING ' end as run_status,
 l_shipdate as run_start_datetime,
 case when l_returnflag='R' and l_linenumber=1 then l_shipdate - interval '1' hour else l_shipdate + interval '8' hour end as run_end_datetime,
 l_quantity as input_quantity, l_quantity*(1+l_tax*4) as output_quantity, l_quantity*l_discount as scrap_quantity,
 l_quantity*10 as runtime_minutes, l_quantity*l_tax*10 as idle_minutes, cast(l_linenumber*5 as double) as setup_minutes,
 cast(l_linenumber as double) as speed_actual_ppm,
 case when l_partkey % 50 = 0 then cast(0 as double) else cast(1+l_partkey % 5 as double) end as speed_standard_ppm,
 l_extendedprice as seq_a, l_tax as seq_b, l_discount as seq_c, l_returnflag as seq_d, l_linestatus as seq_e
from {lineitem}""",
    "quality_inspection": """
select concat('I',cast(l_orderkey as {S}),'-',cast(l_linenumber as {S})) as inspection_id,
 concat(cast(l_orderkey as {S}),'-',cast(l_linenumber as {S})) as run_id, l_orderkey as work_order_id, l_partkey as product_id,
 l_shipdate as inspection_datetime, concat(' ',lower(l_returnflag),l_linestatus) as defect_code, l_quantity as sample_size,
 case when l_tax=0 then l_quantity+1 else l_quantity*l_discount end as defect_count,
 case when l_linenumber=6 then null else l_discount*100 end as measurement_1,
 cast(1 as double) as lower_spec_limit, cast(4 as double) as upper_spec_limit,
 case when l_tax>=0.07 then 'FAIL ' else 'Pass' end as pass_fail,
 l_suppkey as seq_a, l_extendedprice as seq_b, l_tax as seq_c, l_returnflag as seq_d, l_linestatus as seq_e
from {lineitem}""",
    "sensor_reading": f"""
select {_SENSOR_COLUMNS}, value as temperature_c, {_SENSOR_VALUES}, 0 as seq from {{events}}
union all
select {_SENSOR_COLUMNS}, value+1 as temperature_c, {_SENSOR_VALUES}, 1 as seq from {{events}} where event_id % 40 = 1""",
    "machine_state_event": """
select user_id % 10 as machine_id, case event_type when 'error' then ' down' else 'run ' end as state_code,
 ts as event_start,
 case when event_id % 50 = 0 then ts - interval '5' minute else ts + interval '90' minute end as event_end,
 case when event_type='error' and event_id % 3 = 0 then null else event_type end as reason_code
from {events}""",
    "downtime_event": """
select event_id as downtime_id, user_id % 10 as machine_id, ts as downtime_start, value as downtime_minutes
from {events} where event_type='error'""",
    "alarm_event": """
select event_id as alarm_id, user_id % 10 as machine_id, ts as alarm_time from {events} where event_type='error'""",
    "maintenance_log": """
select event_id as log_id, user_id % 12 as machine_id, ts - interval '25' year as failure_time
from {events} where event_type='error' and value>30""",
    "sales_order": """
select l_orderkey as sales_order_id, l_linenumber as order_line_id, o_custkey as customer_id, l_partkey as product_id,
 o_orderdate as order_date,
 case when l_linenumber=5 then o_orderdate - interval '2' day else o_orderdate + interval '30' day end as promised_delivery_date,
 l_quantity as ordered_quantity, l_extendedprice/l_quantity as unit_price,
 case when l_tax=0 then null else l_discount*100 end as discount_pct, o_orderpriority as customer_priority,
 o_orderdate as load_timestamp, l_extendedprice as seq_a, l_suppkey as seq_b, l_tax as seq_c, l_discount as seq_d
from {lineitem} join {orders} on l_orderkey=o_orderkey""",
    "shipment": """
select concat('S',cast(l_orderkey as {S}),'-',cast(l_linenumber as {S})) as shipment_id,
 l_orderkey as sales_order_id, l_linenumber as order_line_id, l_shipdate as ship_date,
 l_quantity+(case when l_tax=0.08 then 1 else 0 end) as shipped_quantity,
 case when l_shipdate>o_orderdate + interval '30' day then 1 else 0 end as late_delivery_flag, l_returnflag as root_cause,
 case when l_linenumber=4 then null else cast(l_linenumber*0.5 - 1 as double) end as delay_days
from {lineitem} join {orders} on l_orderkey=o_orderkey where l_linestatus='F'""",
    "customer_complaint": """
select o_orderkey as complaint_id, concat('S',cast(o_orderkey as {S}),'-1') as shipment_id
from {orders} where o_orderpriority='1-URGENT'""",
    "supply_chain_transaction": """
select md5(cast(o_orderkey as {S})) as transaction_hash,
 case when o_orderkey=0 then null when o_orderkey % 41 = 0 then md5(concat('x',cast(o_orderkey as {S})))
      else md5(cast(o_orderkey-1 as {S})) end as previous_hash,
 o_orderdate as transaction_time, o_custkey as batch_id from {orders}""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def entity(name: str, base_table: Callable[[str], DataFrame]) -> DataFrame:
    """The factory entity as a Spark frame over the base tables it needs."""
    text = ENTITIES[name].replace("{S}", "string")
    tables = {t: base_table(t) for t in sorted(set(_PLACEHOLDER.findall(text)))}
    return next(iter(tables.values())).sparkSession.sql(text, **tables)


def duckdb_text(name: str) -> str:
    return _PLACEHOLDER.sub(lambda m: "varchar" if m[1] == "S" else m[1], ENTITIES[name])
