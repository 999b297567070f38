"""Queries for the declared outputs and the streaming plans."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import date_of
from ..functions.numeric import exact_sum, round_half_up
from ..operators import integrity, sketches
from ..plans import dashboard, extended, star
from ..streaming import telemetry
from ..sources.lake import Lake
from .core import query
from .oracle import r4, xavg, xsum

_TOTALS = f"(select defect_code, {xsum('defect_count')} as defect_count from m_quality group by 1)"


@query("b01_pareto_shares", f"""
select defect_code, defect_count, {r4('defect_count/nullif(cast(sum(cast(defect_count as decimal(28,6))) over () as double),0)')} as defect_pct,
 {r4('cast(sum(cast(defect_count as decimal(28,6))) over (order by defect_count desc, defect_code rows unbounded preceding) as double)/nullif(cast(sum(cast(defect_count as decimal(28,6))) over () as double),0)')} as cum_pct
from {_TOTALS}""")
def b01(shop):
    return dashboard.pareto_shares(dashboard.defect_totals(shop.quality), "defect_code", "defect_count")


@query("b02_plant_performance", f"""
select p.plant_id, p.plant_name, o.avg_oee, o.total_good_quantity, o.total_scrap_quantity, d.total_downtime_minutes from plant_master p
left join (select plant_id, {xavg('oee', 10)} as avg_oee, {xsum('good_quantity')} as total_good_quantity,
 {xsum('scrap_quantity')} as total_scrap_quantity from m_oee group by 1) o on p.plant_id=o.plant_id
left join (select m.plant_id, {xsum('e.minutes')} as total_downtime_minutes from
 (select machine_id, {xsum('event_duration_minutes')} as minutes from c_machine_state_event where state_code='DOWN' group by 1) e
 join machine_master m on e.machine_id=m.machine_id group by 1) d on p.plant_id=d.plant_id""")
def b02(shop):
    return extended.plant_performance(shop.oee, shop.states, shop.raw("machine_master"), shop.raw("plant_master"))


@query("b03_root_cause_counts", "select root_cause, count(*) as shipment_count from shipment group by 1")
def b03(shop):
    return extended.root_cause_counts(shop.shipments)


# Surrogate key of a dimension row in SQL: 60 bits of the digest of the natural key; -1 is the unknown member.
def _key_sql(c: str) -> str:
    return f"cast(concat('0x',substr(md5(cast({c} as varchar)),1,15)) as bigint)"


_DIMS = {"customer": "customer_id", "product": "product_id", "machine": "machine_id", "plant": "plant_id"}


def _fact_key_sql(dim: str, column: str) -> str:
    return (f"case when {column} in (select {_DIMS[dim]} from {dim}_master) then {_key_sql(column)} else -1 end")


def _dimensions(shop, *names):
    return {n: star.dimension(shop.raw(f"{n}_master"), _DIMS[n], f"{n}_key") for n in names}


@query("b04_star_schema_facts", f"""
select {_fact_key_sql('customer', 'customer_id')} as customer_key, {_fact_key_sql('product', 'product_id')} as product_key,
 cast(order_date as date) as order_day, {xsum('net_order_value')} as net_order_value, count(*) as order_lines from m_delivery group by 1,2,3""")
def b04(shop):
    """Sales fact of the star schema: customer, product and day."""
    return star.sales_fact(shop.delivery, **_dimensions(shop, "customer", "product"))


@query("b04_production_fact", f"""
select {_fact_key_sql('plant', 'w.plant_id')} as plant_key, {_fact_key_sql('machine', 'r.machine_id')} as machine_key,
 {_fact_key_sql('product', 'w.product_id')} as product_key, r.run_date as production_day, count(*) as run_count,
 {xsum('r.output_quantity')} as output_quantity, {xsum('r.good_quantity')} as good_quantity,
 {xsum('r.scrap_quantity')} as scrap_quantity, {xsum('r.runtime_minutes')} as runtime_minutes, {xsum('r.idle_minutes')} as idle_minutes
from c_production_run r left join c_work_order w on r.work_order_id=w.work_order_id group by 1,2,3,4""")
def b04_production(shop):
    """Production fact: plant, machine, product and day; runs without a work order have unknown members."""
    return star.production_fact(shop.runs, shop.work_orders, **_dimensions(shop, "plant", "machine", "product"))


@query("b04_quality_fact", f"""
select {_fact_key_sql('plant', 'w.plant_id')} as plant_key, {_fact_key_sql('product', 'q.product_id')} as product_key,
 cast(q.inspection_datetime as date) as inspection_day, q.defect_code, count(*) as inspection_count,
 {xsum('q.sample_size')} as sample_size, {xsum('q.defect_count')} as defect_count, cast(sum(q.high_defect_risk) as bigint) as high_risk_count
from c_quality_inspection q left join c_work_order w on q.work_order_id=w.work_order_id group by 1,2,3,4""")
def b04_quality(shop):
    """Quality fact: plant, product, day and defect code."""
    return star.quality_fact(shop.inspections, shop.work_orders, **_dimensions(shop, "plant", "product"))


@query("b04_dimensions", " union all ".join(
    f"select '{d}' as dimension, {_key_sql(c)} as surrogate_key, cast({c} as varchar) as natural_key from {d}_master "
    f"union all select '{d}', -1, null" for d, c in _DIMS.items()))
def b04_dimensions(shop):
    """Keys of all dimensions, the unknown members among them."""
    parts = [d.select(F.lit(n).alias("dimension"), F.col(f"{n}_key").alias("surrogate_key"),
                      F.col(_DIMS[n]).cast("string").alias("natural_key")) for n, d in _dimensions(shop, *_DIMS).items()]
    return reduce(DataFrame.unionByName, parts)


@query("b05_calendar", """
select cast(d as date) as "date", year(d) as "year", month(d) as "month", strftime(d,'%b') as month_name,
 cast(strftime(d,'%U') as integer) as week_of_year, dayname(d) as day_of_week,
 case when dayofweek(d) in (0,6) then 1 else 0 end as is_weekend, 0 as is_holiday,
 year(d) + case when month(d)>=10 then 1 else 0 end as fiscal_year
from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval '1' day)) as d from orders)""")
def b05(shop):
    """Calendar over the order dates; none of the fixed holidays falls into them."""
    return extended.calendar(shop.base("orders"), "o_orderdate")


@query("b05_calendar_holidays", """
select cast(d as date) as "date", case when dayofweek(d) in (0,6) then 1 else 0 end as is_weekend,
 case when cast(d as date) in (date '1996-12-25', date '1997-01-01') then 1 else 0 end as is_holiday
from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval '1' day)) as d from orders)""")
def b05_holidays(shop):
    """The same with holidays that fall into the order dates."""
    days = extended.calendar(shop.base("orders"), "o_orderdate", ("1996-12-25", "1997-01-01"))
    return days.select("date", "is_weekend", "is_holiday")


_MACHINE_HOURS = """(select machine_id, sensor_hour, max(max_vibration_mm_s) as v, max(max_temperature_c) as t, sum(reading_count) as n from m_sensor group by 1,2)"""


@query("b06_machine_failure_features", f"""
select s.machine_id, s.feature_date, s.max_vibration_24h, s.max_temperature_c, s.reading_count,
 case when exists (select 1 from maintenance_log f where f.machine_id=s.machine_id
   and cast(f.failure_time as date)>s.feature_date and cast(f.failure_time as date)<=s.feature_date + 7) then 1 else 0 end as failure_within_7d
from (select machine_id, cast(sensor_hour as date) as feature_date, arg_max(v24, sensor_hour) as max_vibration_24h, max(t) as max_temperature_c,
  cast(sum(n) as bigint) as reading_count
 from (select *, max(v) over (partition by machine_id order by sensor_hour range between interval '23' hour preceding and current row) as v24
  from {_MACHINE_HOURS}) group by 1,2) s""")
def b06(shop):
    return extended.machine_failure_features(shop.hourly, shop.raw("maintenance_log"))


@query("b07_quality_risk", """
select f.*, p.primary_supplier_id as supplier_id,
 s.quality_score as supplier_quality_score, r.operator_id, o.fairness_group as operator_fairness_group
from m_features f left join c_production_run r on f.run_id=r.run_id left join product_master p on f.product_id=p.product_id
left join supplier_master s on p.primary_supplier_id=s.supplier_id left join operator_master o on r.operator_id=o.operator_id""")
def b07(shop):
    return extended.quality_risk(
        shop.features_with("operator_id"), shop.raw("product_master"), shop.raw("supplier_master"), shop.raw("operator_master"))


@query("b08_delivery_risk", """
select d.sales_order_id, d.order_line_id, d.product_id, d.net_order_value, d.late_delivery_flag, c.customer_segment, c.credit_risk_score,
 p.product_family, p.complexity_score, date_diff('day', cast(d.order_date as date), cast(d.promised_delivery_date as date)) as promised_lead_days
from m_delivery d left join customer_master c on d.customer_id=c.customer_id left join product_master p on d.product_id=p.product_id""")
def b08(shop):
    return extended.delivery_risk(shop.delivery, shop.raw("customer_master"), shop.raw("product_master")).select(
        "sales_order_id", "order_line_id", "product_id", "net_order_value", "late_delivery_flag",
        "customer_segment", "credit_risk_score", "product_family", "complexity_score", "promised_lead_days")


@query("b09_daily_demand", """
select k.product_id, k.demand_date, coalesce(q.q,0) as demand_quantity, coalesce(q.n,0) as order_lines,
 lag(coalesce(q.q,0),1) over w as lag_1, lag(coalesce(q.q,0),7) over w as lag_7,
 cast(sum(cast(coalesce(q.q,0) as decimal(28,6))) over (partition by k.product_id order by k.demand_date rows between 7 preceding and 1 preceding) as double)
  /nullif(count(*) over (partition by k.product_id order by k.demand_date rows between 7 preceding and 1 preceding),0) as mean_prior_7d
from (select product_id, cast(d as date) as demand_date from (select distinct product_family as product_id from product_master p
   where product_id in (select product_id from sales_order)),
  (select unnest(generate_series(min(order_date), max(order_date), interval '1' day)) as d from sales_order)) k
left join (select p.product_family as product_id, cast(order_date as date) as demand_date,
  cast(sum(cast(ordered_quantity as decimal(28,6))) as double) as q, count(*) as n
 from sales_order s join product_master p on s.product_id=p.product_id group by 1,2) q
 on k.product_id=q.product_id and k.demand_date=q.demand_date
window w as (partition by k.product_id order by k.demand_date)""")
def b09(shop):
    """Daily demand, dense, with the product family as the product key."""
    family = shop.raw("product_master").select("product_id", "product_family")
    orders = shop.sales_orders.join(family, "product_id", "inner").withColumn(
        "product_id", F.col("product_family")).drop("product_family")
    return extended.daily_demand(orders)


@query("b09_product_demand", """
with bounds as (select min(cast(order_date as date)) as lo, max(cast(order_date as date)) as hi from sales_order),
days as (select k.product_id, k.day, coalesce(q.q,0) as q, coalesce(q.n,0) as n from
 (select product_id, cast(d as date) as day from (select distinct product_id from sales_order),
  (select unnest(generate_series(lo, hi, interval '1' day)) as d from bounds)) k
 left join (select product_id, cast(order_date as date) as day, cast(sum(cast(ordered_quantity as decimal(28,6))) as double) as q, count(*) as n
  from sales_order group by 1,2) q on k.product_id=q.product_id and k.day=q.day),
filled as (select *, lag(q,1) over w as lag_1, lag(q,7) over w as lag_7, sum(n) over (w rows between 7 preceding and current row) as near,
  cast(sum(cast(q as decimal(28,6))) over (w rows between 7 preceding and 1 preceding) as double)
   /nullif(count(*) over (w rows between 7 preceding and 1 preceding),0) as mean_prior_7d
 from days window w as (partition by product_id order by day)),
marked as (select *, near=0 and day>=lo+7 as idle from filled, bounds),
runs as (select *, day - cast(row_number() over (partition by product_id, idle order by day) as integer) as run from marked)
select product_id, min(day) as from_date, max(day) as to_date, max(q) as demand_quantity, cast(max(n) as bigint) as order_lines,
 max(lag_1) as lag_1, max(lag_7) as lag_7, max(mean_prior_7d) as mean_prior_7d
from runs group by product_id, idle, case when idle then run else day end""")
def b09_products(shop):
    """Daily demand at product grain; days without demand in reach are one row a run."""
    return extended.demand_runs(shop.sales_orders)


_DRIFT = "(select *, run_start_datetime<timestamp '1999-01-01 00:00:00' as is_ref from c_production_run)"


def _drift_sql(feature: str) -> str:
    return f"""
select '{feature}' as feature, cast(sum(ref_n) as bigint) as ref_rows, cast(sum(cur_n) as bigint) as cur_rows,
 {r4(xsum('ref_sum') + '/nullif(sum(ref_n),0)')} as ref_mean, {r4(xsum('cur_sum') + '/nullif(sum(cur_n),0)')} as cur_mean,
 {r4('sum((q-p)*ln(q/p))')} as psi,
 {r4(xsum('cur_sum') + '/nullif(sum(cur_n),0) - ' + xsum('ref_sum') + '/nullif(sum(ref_n),0)')} as mean_shift
from (select *, greatest(ref_n/sum(ref_n) over (), 0.0001::double) as p, greatest(cur_n/sum(cur_n) over (), 0.0001::double) as q from (
 select greatest(0, least(9, coalesce(floor((x-lo)*10/nullif(hi-lo,0)),0))) as bin, count(*) filter (where is_ref) as ref_n,
  count(*) filter (where not is_ref) as cur_n, cast(sum(cast(case when is_ref then x end as decimal(28,6))) as double) as ref_sum,
  cast(sum(cast(case when not is_ref then x end as decimal(28,6))) as double) as cur_sum
 from (select is_ref, {feature} as x from {_DRIFT} where {feature} is not null),
  (select min({feature}) as lo, max({feature}) as hi from {_DRIFT} where is_ref) group by 1))"""


@query("b10_drift_report", " union all ".join(_drift_sql(f) for f in ("speed_ratio", "scrap_rate", "output_quantity")))
def b10(shop):
    """Runs before 1999 against the later ones."""
    early = F.col("run_start_datetime") < F.lit("1999-01-01").cast("timestamp")
    report = extended.drift_report(
        shop.runs.filter(early), shop.runs.filter(~early), ["speed_ratio", "scrap_rate", "output_quantity"])
    return report.withColumns({c: round_half_up(c) for c in ("ref_mean", "cur_mean", "psi", "mean_shift")})


def _bucket_sql(x: str) -> str:
    """Bucket of a column by the definition of the sketches, in SQL."""
    guess = f"floor(log2(abs({x})))"
    exponent = f"({guess} + case when pow(2,{guess})>abs({x}) then -1 when pow(2,{guess})*2<=abs({x}) then 1 else 0 end)"
    code = f"(({exponent}+1100)*128 + floor((abs({x})/pow(2,{exponent})-1)*128) + 1)"
    return f"cast(case when {x}=0 then 0 when {x}<0 then -{code} else {code} end as bigint)"


def _quantile_drift_sql(feature: str) -> str:
    middle = lambda b: (f"case when {b}=0 then 0.0::double else sign({b})*pow(2,((abs({b})-1)//128)-1100)"
                        f"*(1+(((abs({b})-1)%128)+0.5::double)/128) end")
    side = lambda ref: (
        f"(select {middle('bucket')} from (select bucket, sum(n) over (order by bucket) as upto, sum(n) over () as total "
        f"from (select {_bucket_sql(feature)} as bucket, count(*) as n from {_DRIFT} where {feature} is not null and {ref} group by 1)) "
        "where upto>=ceil(0.5::double*total) order by bucket limit 1)")
    return f"""
select '{feature}' as feature, cast(sum(ref_n) as bigint) as ref_rows, cast(sum(cur_n) as bigint) as cur_rows,
 {r4('sum((q-p)*ln(q/p))')} as psi, {r4(side('is_ref'))} as ref_median, {r4(side('not is_ref'))} as cur_median,
 {r4(side('not is_ref') + '-' + side('is_ref'))} as median_shift
from (select *, greatest(ref_n/sum(ref_n) over (), 0.0001::double) as p, greatest(cur_n/sum(cur_n) over (), 0.0001::double) as q from (
 select least(9, coalesce(before,0)*10//total) as bin, sum(ref_n) as ref_n, sum(cur_n) as cur_n from (
  select *, sum(ref_n) over (order by bucket rows between unbounded preceding and 1 preceding) as before, sum(ref_n) over () as total from (
   select {_bucket_sql(feature)} as bucket, count(*) filter (where is_ref) as ref_n, count(*) filter (where not is_ref) as cur_n
   from {_DRIFT} where {feature} is not null group by 1)) group by 1))"""


@query("b10_drift_quantiles", " union all ".join(
    _quantile_drift_sql(f) for f in ("speed_ratio", "scrap_rate", "output_quantity")))
def b10_quantiles(shop):
    """Runs before 1999 against the later ones, from sketches kept by month."""
    features = ["speed_ratio", "scrap_rate", "output_quantity"]
    monthly = sketches.sketch(
        shop.runs.withColumn("month", F.trunc("run_date", "month")), features, by=["month"])
    early = F.col("month") < F.lit("1999-01-01").cast("date")
    report = extended.quantile_drift(
        sketches.merged(monthly.filter(early)), sketches.merged(monthly.filter(~early)))
    return report.withColumns({c: round_half_up(c) for c in ("psi", "ref_median", "cur_median", "median_shift")})


@query("b11_fairness_audit", """
select fairness_group, count(*) as rows, count(*) filter (where p=1) as selected, count(*) filter (where a=1) as positives,
 count(*) filter (where p=1 and a<>1) as false_positives, count(*) filter (where p<>1 and a=1) as false_negatives,
 count(*) filter (where p=1)/count(*) as selection_rate,
 count(*) filter (where p=1 and a<>1)/nullif(count(*)-count(*) filter (where a=1),0) as false_positive_rate,
 count(*) filter (where p<>1 and a=1)/nullif(count(*) filter (where a=1),0) as false_negative_rate
from (select o.fairness_group, case when r.scrap_rate>0.04::double then 1 else 0 end as p, q.high_defect_risk as a
 from c_quality_inspection q join c_production_run r on q.run_id=r.run_id left join operator_master o on r.operator_id=o.operator_id)
group by 1""")
def b11(shop):
    """A scrap-rate score as decision, the inspection risk as outcome, per operator group."""
    runs = shop.runs.select("run_id", "operator_id",
                            F.when(F.col("scrap_rate") > 0.04, 1).otherwise(0).alias("predicted"))
    groups = shop.raw("operator_master").select("operator_id", "fairness_group")
    scored = (shop.inspections.select("run_id", F.col("high_defect_risk").alias("actual"))
              .join(runs, "run_id", "inner").join(groups, "operator_id", "left"))
    return extended.fairness_audit(scored, "fairness_group", "predicted", "actual")


@query("b12_plant_clients", """
select concat('client_',plant_id) as client_id, plant_id, count(*) as sample_count from m_features where plant_id is not null group by 1,2""")
def b12(shop):
    """Feature rows written per plant client and counted from the files."""
    lake = Lake(shop.spark, shop.scratch("lake"))
    rows = shop.features.filter(F.col("plant_id").isNotNull())
    return extended.client_counts(lake.write("mart", "plant_clients", rows, partition_by=["plant_id"]))


@query("b13_graph_nodes", """
select cast(machine_id as varchar) as node_id, 'machine' as node_type, plant_id, line_id, machine_age_years as feature_value from machine_master
union all select cast(product_id as varchar), 'product', null, null, cast(complexity_score as double) from product_master
union all select supplier_id, 'supplier', null, null, quality_score from supplier_master""")
def b13_nodes(shop):
    return extended.graph_nodes(shop.raw("machine_master"), shop.raw("product_master"), shop.raw("supplier_master"))


_EDGES = """(select p.primary_supplier_id as source_id, cast(p.product_id as varchar) as target_id, 'supplies' as edge_type, s.quality_score/100::double as weight
 from product_master p join supplier_master s on p.primary_supplier_id=s.supplier_id
 union all select cast(product_id as varchar), cast(machine_id as varchar), 'processed_by', n/sum(n) over (partition by product_id)
 from (select product_id, machine_id, count(*) as n from c_production_run where product_id is not null and machine_id is not null group by 1,2))"""


@query("b13_graph_edges", f"select * from {_EDGES}")
def b13_edges(shop):
    return extended.supply_edges(shop.raw("product_master"), shop.raw("supplier_master")).unionByName(
        extended.process_edges(shop.runs))


@query("b13_graph_degrees", f"""
select edge_type, node_id, cast(sum(o) as bigint) as out_degree, cast(sum(i) as bigint) as in_degree from (
 select edge_type, source_id as node_id, 1 as o, 0 as i from {_EDGES} union all select edge_type, target_id, 0, 1 from {_EDGES}) group by 1,2""")
def b13_degrees(shop):
    return extended.node_degrees(b13_edges(shop))


@query("b13_supplier_machines", f"""
select a.source_id as supplier_id, b.target_id as machine_id, count(*) as shared_products from {_EDGES} a join {_EDGES} b
on a.target_id=b.source_id and a.edge_type='supplies' and b.edge_type='processed_by' group by 1,2""")
def b13_hops(shop):
    return extended.supplier_machines(
        extended.supply_edges(shop.raw("product_master"), shop.raw("supplier_master")),
        extended.process_edges(shop.runs))


@query("b14_broken_chain_links", """
select transaction_hash, previous_hash, transaction_time, batch_id from supply_chain_transaction where previous_hash is not null
and previous_hash not in (select transaction_hash from supply_chain_transaction)""")
def b14(shop):
    return integrity.broken_links(shop.raw("supply_chain_transaction"))


@query("b14_chain_sequence", """
select c.transaction_hash, c.previous_hash, c.transaction_time, p.transaction_time as previous_time from supply_chain_transaction c
join supply_chain_transaction p on c.previous_hash=p.transaction_hash where c.transaction_time<p.transaction_time""")
def b14_sequence(shop):
    return integrity.out_of_sequence(shop.raw("supply_chain_transaction"), "transaction_time").drop("batch_id")


# Links that skip a transaction make forks, links to a later one make cycles.
_TANGLED = """(select transaction_hash, case when k % 97 = 3 then md5(cast(k-2 as {S})) when k % 501 = 5 then md5(cast(k+3 as {S}))
 else previous_hash end as previous_hash from (select o_orderkey as k, md5(cast(o_orderkey as {S})) as transaction_hash,
 case when o_orderkey=0 then null when o_orderkey % 41 = 0 then md5(concat('x',cast(o_orderkey as {S})))
  else md5(cast(o_orderkey-1 as {S})) end as previous_hash from {orders}))"""


@query("b14_chain_order", f"""
with recursive chain as materialized {_TANGLED.replace('{S}', 'varchar').replace('{orders}', 'orders')},
walk as (
 select transaction_hash, transaction_hash as origin_hash, cast(0 as bigint) as position, previous_hash is not null as broken from chain
 where previous_hash is null or previous_hash not in (select transaction_hash from chain)
 union all select c.transaction_hash, w.origin_hash, w.position+1, false from chain c join walk w on c.previous_hash=w.transaction_hash)
select c.transaction_hash, w.origin_hash, w.position, coalesce(n.children, 0) as children,
 case when w.transaction_hash is null then 'unrooted' when w.broken then 'broken' else 'linked' end as state
from chain c left join walk w on c.transaction_hash=w.transaction_hash
left join (select previous_hash, count(*) as children from chain group by 1) n on c.transaction_hash=n.previous_hash""")
def b14_order(shop):
    """Origin and position of every transaction, over links with forks and cycles."""
    text = _TANGLED.replace("{S}", "string")
    tangled = shop.spark.sql(f"select * from {text}", orders=shop.base("orders"))
    ordered = integrity.chain_order(tangled)
    return ordered.withColumn("state", F.when(F.col("origin_hash").isNull(), "unrooted").otherwise(F.col("state")))


@query("b16_alarm_watchlist", """
select machine_id, alarm_date, alarms_on_day, cast(alarms_7d as bigint) as alarms_7d from (
 select *, sum(alarms_on_day) over (partition by machine_id order by alarm_date range between interval '6' day preceding and current row) as alarms_7d
 from (select machine_id, cast(alarm_time as date) as alarm_date, count(*) as alarms_on_day from alarm_event group by 1,2)) where alarms_7d>=2""")
def b16(shop):
    return extended.alarm_watchlist(shop.raw("alarm_event"))


_QI = "customer_segment, country"


@query("b17_anonymity_groups", f"""
select c.customer_id, c.customer_segment, c.country, g.k as k_anonymity_group_size from customer_master c
join (select {_QI}, count(*) as k from customer_master group by 1,2) g using ({_QI})""")
def b17(shop):
    """Group size over two quasi-identifiers, on every record."""
    records = shop.raw("customer_master").select("customer_id", "customer_segment", "country")
    return extended.with_group_size(records, ["customer_segment", "country"])


@query("b17_smallest_group", f"""
select min(k) as k, count(*) as groups from (select {_QI}, count(*) as k from customer_master group by 1,2)""")
def b17_k(shop):
    sizes = extended.anonymity_groups(shop.raw("customer_master"), ["customer_segment", "country"])
    return sizes.agg(F.min("k_anonymity_group_size").alias("k"), F.count(F.lit(1)).alias("groups"))


_IDENTIFIERS = ("customer_segment", "country", "credit_band", "name_end")
_PERSONS = ("(select customer_segment, country, cast(floor(credit_risk_score/20) as bigint) as credit_band, "
            "substr(customer_name, length(customer_name), 1) as name_end from customer_master)")


@query("b17_subset_anonymity", " union all ".join(
    f"select '{','.join(s)}' as identifiers, {len(s)} as size, min(n) as smallest_group "
    f"from (select {','.join(s)}, count(*) as n from {_PERSONS} group by all)"
    for k in range(1, 5) for s in combinations(_IDENTIFIERS, k)))
def b17_subsets(shop):
    """Smallest group of all 15 subsets of four quasi-identifiers."""
    persons = shop.raw("customer_master").select(
        "customer_segment", "country", F.floor(F.col("credit_risk_score") / 20).cast("bigint").alias("credit_band"),
        F.substring("customer_name", -1, 1).alias("name_end"))
    return extended.subset_anonymity(persons, _IDENTIFIERS).select("identifiers", "size", "smallest_group")


@query("b18_downtime_by_reason", f"""
select machine_id, state_code, reason_code, count(*) as event_count, {xsum('event_duration_minutes')} as total_minutes
from c_machine_state_event group by 1,2,3""")
def b18(shop):
    return extended.downtime_by_reason(shop.states)


@query("b18_downtime_events", f"""
select machine_id, cast(downtime_start as date) as day, {xsum('downtime_minutes')} as minutes, count(*) as events from downtime_event group by 1,2""")
def b18_events(shop):
    """Downtime log by machine and day."""
    return shop.raw("downtime_event").groupBy("machine_id", date_of("downtime_start").alias("day")).agg(
        exact_sum("downtime_minutes").alias("minutes"),
        F.count(F.lit(1)).alias("events"))


@query("b19_urgent_speed_cohort", f"""
select case when w.priority_level='urgent' and r.speed_ratio>1.05::double then 'cohort' else 'rest' end as cohort, count(*) as rows,
 {r4(xavg('r.scrap_rate', 10))} as avg_scrap_rate, {r4(xavg('r.speed_ratio', 10))} as avg_speed_ratio
from c_production_run r left join c_work_order w on r.work_order_id=w.work_order_id group by 1""")
def b19(shop):
    orders = shop.work_orders.select("work_order_id", "priority_level")
    joined = shop.runs.join(orders, "work_order_id", "left")
    compared = extended.cohort_compare(joined, extended.urgent_speed_cohort(), ["scrap_rate", "speed_ratio"])
    return compared.withColumns({c: round_half_up(c) for c in ("avg_scrap_rate", "avg_speed_ratio")})


@query("b19_supplier_window_cohort", f"""
select case when p.primary_supplier_id='S7' and r.run_date between date '1998-03-01' and date '1998-06-30' then 'cohort' else 'rest' end as cohort,
 count(*) as rows, {r4(xavg('q.defect_rate', 10))} as avg_defect_rate
from c_quality_inspection q join c_production_run r on q.run_id=r.run_id left join product_master p on r.product_id=p.product_id group by 1""")
def b19_supplier(shop):
    """Inspections of one supplier's products in a date window against the rest."""
    supplier = shop.raw("product_master").select("product_id", F.col("primary_supplier_id").alias("supplier_id"))
    runs = shop.runs.select("run_id", "run_date", "product_id").join(supplier, "product_id", "left").drop("product_id")
    joined = shop.inspections.join(runs, "run_id", "inner")
    cohort = extended.supplier_window_cohort("S7", "1998-03-01", "1998-06-30")
    return extended.cohort_compare(joined, cohort, ["defect_rate"]).withColumn(
        "avg_defect_rate", round_half_up("avg_defect_rate"))


# -- streams ------------------------------------------------------------------------------

TELEMETRY_RECORDS = 200_000  # of a file
_TEXT_MACHINE = "* replace (cast(machine_id as varchar) as machine_id)"


@query("b15_stream_sensor_hourly", f"""
select {_TEXT_MACHINE} from m_sensor where sensor_hour + interval '3' hour <= (select max("timestamp") from sensor_reading)""")
def b15(shop):
    """Telemetry documents with repeated and conflicting readings, streamed into closed hours."""
    readings = shop.raw("sensor_reading")
    path = shop.scratch("telemetry")
    _telemetry_files(readings.unionByName(readings.filter(F.col("sensor_id") % 40 == 1)), path)
    stream = telemetry.read_telemetry(shop.spark, path, extra="seq int")
    return telemetry.drain(telemetry.hourly_stream(stream, order=["seq"]), "sensor-hourly")


@query("b15_stream_revised_hours", f"select {_TEXT_MACHINE} from m_sensor")
def b15_revised(shop):
    """The same readings in three batches; corrections come both before and long after what they
    correct, and the mart equals the batch plan over all hours."""
    readings = shop.raw("sensor_reading")
    corrections, early = F.col("seq") == 1, F.col("sensor_id") % 80 == 1
    lake, path, checkpoint = Lake(shop.spark, shop.scratch("lake")), shop.scratch("telemetry"), shop.scratch("ckpt")
    for batch in (readings.filter(corrections & early), readings.filter(~corrections), readings.filter(corrections & ~early)):
        _telemetry_files(batch, path)
        stream = telemetry.read_telemetry(shop.spark, path, extra="seq int")
        telemetry.merge_hourly(stream, lake, ["seq"], checkpoint).awaitTermination()
    return lake.read("mart", "fact_sensor_hourly_live")


def _telemetry_files(batch, path):
    """Readings added to a folder of JSON lines, as many files as tasks write, none larger than a task should read."""
    text = batch.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    text.select(*[F.col(c).cast("string") for c in text.columns if c != "seq"], "seq").write.option(
        "maxRecordsPerFile", TELEMETRY_RECORDS).mode("append").json(path)


@query("b16_stream_alarm_windows", """
select machine_id, w as window_start, w + interval '7' day as window_end, count(*) as alarms_7d from (
 select machine_id, unnest(generate_series(date_trunc('day',alarm_time) - interval '6' day, date_trunc('day',alarm_time), interval '1' day)) as w
 from alarm_event where date_trunc('day',alarm_time) + interval '2' day <= (select max(alarm_time) from alarm_event))
where w + interval '8' day <= (select max(alarm_time) from alarm_event) group by 1,2 having count(*)>=2""")
def b16_stream(shop):
    """Alarm stream in seven-day windows that slide by a day."""
    path = shop.scratch("alarms")
    alarms = shop.raw("alarm_event").withColumn("alarm_time", F.col("alarm_time").cast("timestamp"))
    alarms.write.parquet(path)
    stream = shop.spark.readStream.schema(alarms.schema).parquet(path)
    return telemetry.drain(telemetry.alarm_stream(stream), "alarm-windows")
