"""Queries for joins, aggregates, marts, the metric layer, access and listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.coerce import date_of
from ..functions.numeric import RATE, exact_avg, exact_sum, round_half_up
from ..operators import access
from ..plans import dashboard, marts, semantic
from .core import query
from .oracle import r4, xavg, xsum

# -- joins ---------------------------------------------------------------------------


@query("j01_run_work_order", """
select r.run_id, r.work_order_id, w.plant_id, w.line_id, r.output_quantity
from c_production_run r left join c_work_order w on r.work_order_id=w.work_order_id""")
def j01(shop):
    return marts.runs_with_orders(shop.runs, shop.work_orders).select(
        "run_id", "work_order_id", "plant_id", "line_id", "output_quantity")


@query("j02_inspection_order_product", """
select q.inspection_id, q.work_order_id, q.product_id, w.plant_id, w.line_id, p.product_family
from c_quality_inspection q left join c_work_order w on q.work_order_id=w.work_order_id
left join product_master p on q.product_id=p.product_id""")
def j02(shop):
    return marts.inspections_with_context(
        shop.inspections, shop.work_orders, shop.raw("product_master")
    ).select("inspection_id", "work_order_id", "product_id", "plant_id", "line_id", "product_family")


@query("j03_order_shipment", """
select sales_order_id, order_line_id, product_id, ordered_quantity, ship_date, shipped_quantity from m_delivery""")
def j03(shop):
    return shop.delivery.select("sales_order_id", "order_line_id", "product_id", "ordered_quantity",
                                "ship_date", "shipped_quantity")


@query("j04_feature_star", "select * from m_features")
def j04(shop):
    """The whole star, sensors included; runs without a known product stay, as in any left join."""
    return shop.features


@query("j05_run_machine_day", """
select r.run_id, r.machine_id, d.avg_temperature_c, d.max_vibration_mm_s, d.sensor_valid_rate from c_production_run r
left join m_machine_day d on d.sensor_date=cast(r.run_start_datetime as date) and d.machine_id=r.machine_id""")
def j05(shop):
    runs = shop.runs.select("run_id", "machine_id", date_of("run_start_datetime").alias("sensor_date"))
    return runs.join(marts.machine_day(shop.hourly), ["sensor_date", "machine_id"], "left").select(
        "run_id", "machine_id", "avg_temperature_c", "max_vibration_mm_s", "sensor_valid_rate")


_USER_PLANTS = """(select 'admin' as username, plant_id from plant_master
 union all select 'plant_p01_user','P01' union all select 'plant_p02_user','P02' union all select 'plant_p03_user','P03')"""


@query("j06_access_membership", f"""
select production_date, plant_id, line_id, oee from m_oee where plant_id in
 (select plant_id from {_USER_PLANTS} where username='plant_p02_user')""")
def j06(shop):
    """Rows of one plant user."""
    return access.visible_to(shop.oee, shop.user_plants, "plant_p02_user").select(
        "production_date", "plant_id", "line_id", "oee")


# -- aggregates ----------------------------------------------------------------------

@query("a01_oee_daily_sums", f"""
select cast(r.run_start_datetime as date) as production_date, w.plant_id, w.line_id,
 count(distinct r.run_id) as run_count, count(distinct r.machine_id) as active_machine_count,
 {xsum('r.runtime_minutes')} as runtime_minutes, {xsum('r.idle_minutes')} as idle_minutes, {xsum('r.setup_minutes')} as setup_minutes,
 {xsum('r.output_quantity')} as output_quantity, {xsum('r.scrap_quantity')} as scrap_quantity, {xsum('r.good_quantity')} as good_quantity
from c_production_run r left join c_work_order w on r.work_order_id=w.work_order_id group by 1,2,3""")
def a01(shop):
    return shop.oee.select("production_date", "plant_id", "line_id", "run_count", "active_machine_count",
                           "runtime_minutes", "idle_minutes", "setup_minutes", "output_quantity",
                           "scrap_quantity", "good_quantity")


@query("a02_two_distinct_counts", """
select w.plant_id, count(distinct r.run_id) as run_count, count(distinct r.machine_id) as active_machine_count
from production_run r left join c_work_order w on r.work_order_id=w.work_order_id group by 1""")
def a02(shop):
    """Two exact distinct counts over runs that still hold duplicates."""
    runs = marts.runs_with_orders(shop.raw("production_run"), shop.work_orders)
    return runs.groupBy("plant_id").agg(F.count_distinct("run_id").alias("run_count"),
                                        F.count_distinct("machine_id").alias("active_machine_count"))


@query("a03_quality_daily", "select * from m_quality")
def a03(shop):
    return shop.quality


@query("a04_sensor_hourly", "select * from m_sensor")
def a04(shop):
    return shop.hourly


@query("a05_machine_day_rollup", "select * from m_machine_day")
def a05(shop):
    return marts.machine_day(shop.hourly)


_KPI = f"""select (select count(*) from c_work_order) as work_orders, (select count(*) from c_production_run) as production_runs,
 (select {r4(xavg('oee', 10))} from m_oee) as avg_oee, (select {r4(xavg('scrap_rate', 10))} from m_oee) as avg_scrap_rate,
 (select cast(sum(issue_count) as bigint) from dq_summary where severity in ('high','medium')) as dq_issues_high_medium,
 (select {r4(xavg('defect_rate', 10))} from m_quality) as avg_defect_rate,
 (select {r4(xavg('late_delivery_flag'))} from m_delivery) as late_delivery_rate"""


@query("a06_kpi_aggregates", _KPI)
def a06(shop):
    return shop.kpis(stamp=False)


@query("a07_defect_pareto", f"""
select defect_code, {xsum('defect_count')} as defect_count, {xsum('sample_size')} as sample_size,
 {r4(xsum('defect_count') + '/nullif(' + xsum('sample_size') + ',0)')} as defect_rate
from m_quality group by 1""")
def a07(shop):
    return dashboard.defect_pareto(shop.quality)


@query("a07_defect_pareto_top3", f"""
select defect_code, {xsum('defect_count')} as defect_count, {xsum('sample_size')} as sample_size,
 {r4(xsum('defect_count') + '/nullif(' + xsum('sample_size') + ',0)')} as defect_rate
from m_quality group by 1 order by 2 desc, 1 limit 3""")
def a07_top(shop):
    """The three most frequent defects."""
    return dashboard.defect_pareto(shop.quality, 3)


@query("a08_line_performance", f"""
select plant_id, line_id, {r4(xavg('oee', 10))} as avg_oee, {r4(xavg('scrap_rate', 10))} as avg_scrap_rate,
 {xsum('output_quantity')} as output_quantity, {xsum('good_quantity')} as good_quantity, count(*) as production_days
from m_oee group by 1,2""")
def a08(shop):
    return dashboard.line_performance(shop.oee)


@query("a09_filtered_count", """
select plant_id, count(*) as orders, count(*) filter (where actual_end_datetime is null) as open_orders,
 count(*) filter (where priority_level in ('urgent','1-urgent')) as urgent_orders from c_work_order group by 1""")
def a09(shop):
    return shop.work_orders.groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("actual_end_datetime").isNull()).alias("open_orders"),
        F.count_if(F.col("priority_level").isin("urgent", "1-urgent")).alias("urgent_orders"))


# -- marts ----------------------------------------------------------------------------

@query("m01_oee_daily_line", "select * from m_oee")
def m01(shop):
    """Daily OEE per plant and line."""
    return shop.oee


@query("m02_quality_daily", "select * from m_quality")
def m02(shop):
    return shop.quality


@query("m03_sensor_hourly", "select * from m_sensor")
def m03(shop):
    return shop.hourly


@query("m04_delivery_order", "select * from m_delivery")
def m04(shop):
    return shop.delivery


@query("m05_quality_features", "select * from m_features")
def m05(shop):
    return shop.features


@query("m05_feature_preview", "select * from m_features order by run_id limit 100")
def m05_preview(shop):
    return dashboard.top(shop.features, ["run_id"], 100)


@query("m06_dashboard_kpis", _KPI)
def m06(shop):
    """Executive row with its refresh stamp (left out of the comparison)."""
    return shop.kpis().drop("refreshed_at")


@query("m07_view_oee", """
select production_date, plant_id, line_id, run_count, active_machine_count, runtime_minutes, idle_minutes, setup_minutes,
 output_quantity, good_quantity, scrap_quantity, planned_production_minutes, availability, performance, quality, oee, scrap_rate from m_oee""")
def m07_oee(shop):
    return shop.dataset(semantic.OEE)


@query("m07_view_quality", """
select inspection_date, plant_id, line_id, product_id, product_family, defect_code, inspection_count, sample_size,
 defect_count, defect_rate, high_defect_risk_rate from m_quality""")
def m07_quality(shop):
    return shop.dataset(semantic.QUALITY)


@query("m07_view_sensor", "select * from m_sensor")
def m07_sensor(shop):
    return shop.dataset(semantic.SENSOR)


@query("m07_view_governance", "select severity, rule_id, table_name, issue_count from dq_summary")
def m07_governance(shop):
    return shop.dataset(semantic.GOVERNANCE)


@query("m08_oee_daily_listing", f"""
select production_date, plant_id, line_id, {r4('oee')} as oee, {r4('availability')} as availability,
 {r4('performance')} as performance, {r4('quality')} as quality, {r4('scrap_rate')} as scrap_rate,
 run_count, output_quantity, good_quantity from m_oee
""")
def m08(shop):
    return dashboard.oee_daily(shop.oee)


@query("m08_oee_newest", f"""
select production_date, plant_id, line_id, {r4('oee')} as oee, {r4('availability')} as availability,
 {r4('performance')} as performance, {r4('quality')} as quality, {r4('scrap_rate')} as scrap_rate,
 run_count, output_quantity, good_quantity from m_oee
order by production_date desc nulls first, plant_id nulls last, line_id nulls last limit 200""")
def m08_newest(shop):
    """The newest 200 lines."""
    return dashboard.oee_daily(shop.oee, 200)


@query("m08_oee_trend", "select production_date, plant_id, line_id, oee, availability, performance, quality, scrap_rate from m_oee")
def m08_trend(shop):
    """Whole trend, oldest first."""
    return shop.oee.select("production_date", "plant_id", "line_id", "oee", "availability", "performance",
                           "quality", "scrap_rate").orderBy("production_date", "plant_id", "line_id")


# -- metric layer ---------------------------------------------------------------------

def _rounded(df, *names):
    return df.withColumns({n: round_half_up(n) for n in names})


@query("l01_dataset_registry", """
select 'OEE operational dataset' as dataset_name, 'mart.v_dataset_oee_operational' as physical_object, 'production_date' as time_column,
  'plant_id, line_id' as recommended_dimensions, count(*) as row_count from m_oee
union all select 'Quality decision dataset', 'mart.v_dataset_quality_decision', 'inspection_date', 'plant_id, line_id, product_family, defect_code', count(*) from m_quality
union all select 'Sensor hourly dataset', 'mart.v_dataset_sensor_hourly', 'sensor_hour', 'plant_id, line_id, machine_id', count(*) from m_sensor
union all select 'Data quality governance dataset', 'mart.v_dataset_dq_governance', null, 'severity, rule_id, table_name', count(*) from dq_summary""")
def l01(shop):
    """Registered datasets with the rows behind them."""
    counts = semantic.readiness(shop.spark, shop.datasets).select("dataset_name", "row_count")
    listed = semantic.registry(shop.spark, "superset_dataset_registry").drop("business_description")
    return listed.join(counts, "dataset_name", "inner")


@query("l02_metrics_by_plant", f"""
select plant_id, {r4('avg(oee)')} as avg_oee, {r4('avg(availability)')} as avg_availability, {r4('avg(performance)')} as avg_performance,
 {r4('avg(quality)')} as avg_quality, {r4('sum(output_quantity)')} as total_output_quantity,
 {r4('sum(scrap_quantity)/nullif(sum(output_quantity),0)')} as scrap_rate from m_oee group by 1""")
def l02(shop):
    names = [m.metric_name for m in semantic.METRICS if m.dataset_name == semantic.OEE]
    chosen = [semantic.metric_named(n, semantic.OEE) for n in names]
    return _rounded(semantic.evaluate(shop.dataset(semantic.OEE), chosen, ["plant_id"]), *names)


@query("l02_quality_metrics", f"""
select product_family, {r4('sum(defect_count)/nullif(sum(sample_size),0)')} as defect_rate, {r4('sum(defect_count)')} as defect_count,
 {r4('avg(high_defect_risk_rate)')} as high_defect_risk_rate from m_quality group by 1""")
def l02_quality(shop):
    names = ["defect_rate", "defect_count", "high_defect_risk_rate"]
    chosen = [semantic.metric_named(n, semantic.QUALITY) for n in names]
    return _rounded(semantic.evaluate(shop.dataset(semantic.QUALITY), chosen, ["product_family"]), *names)


@query("l02_sensor_and_governance_metrics", f"""
select 'avg_temperature_c' as metric_name, {r4('avg(avg_temperature_c)')} as value from m_sensor
union all select 'max_vibration_mm_s', {r4('max(max_vibration_mm_s)')} from m_sensor
union all select 'dq_issue_count', cast(sum(issue_count) as double) from dq_summary""")
def l02_rest(shop):
    parts = None
    for name, dataset in (("avg_temperature_c", semantic.SENSOR), ("max_vibration_mm_s", semantic.SENSOR),
                          ("dq_issue_count", semantic.GOVERNANCE)):
        value = semantic.evaluate(shop.dataset(dataset), [name]).select(
            F.lit(name).alias("metric_name"), round_half_up(name).alias("value"))
        parts = value if parts is None else parts.unionByName(value)
    return parts


def _chart(name: str, chart: str, sql: str, metric: str):
    @query(name, sql)
    def run(shop):
        return _rounded(semantic.chart_query(chart, shop.chart_source(chart)), metric)

    run.__doc__ = chart


_chart("l03_big_number", "KPI - Average OEE", f"select {r4('avg(oee)')} as avg_oee from m_oee", "avg_oee")
_chart("l03_bar_plant_line", "Bar - OEE by plant and line",
       f"select plant_id, line_id, {r4('avg(oee)')} as avg_oee from m_oee group by 1,2", "avg_oee")
_chart("l03_pareto_defects", "Pareto - Defect count by defect code",
       f"select defect_code, {r4('sum(defect_count)')} as defect_count from m_quality group by 1", "defect_count")
_chart("l03_bar_severity", "Bar - Data quality issues by severity",
       "select severity, cast(sum(issue_count) as double) as dq_issue_count from dq_summary group by 1", "dq_issue_count")
_chart("l03_trend_vibration", "Trend - Sensor vibration by hour",
       f"select sensor_hour, {r4('max(max_vibration_mm_s)')} as max_vibration_mm_s from m_sensor group by 1",
       "max_vibration_mm_s")
_chart("l04_trend_daily_grain", "Trend - OEE by production date",
       f"select cast(production_date as timestamp) as production_date, {r4('avg(oee)')} as avg_oee from m_oee group by 1",
       "avg_oee")


@query("l04_monthly_grain", f"""
select cast(date_trunc('month',inspection_date) as timestamp) as inspection_date, {r4('sum(defect_count)')} as defect_count from m_quality group by 1""")
def l04_month(shop):
    """The same bucketing at another grain."""
    quality = shop.dataset(semantic.QUALITY)
    bucket = semantic.time_bucket(quality, semantic.QUALITY, "P1M")
    metric = semantic.metric_named("defect_count", semantic.QUALITY)
    return _rounded(semantic.evaluate(quality, [metric], [bucket]), "defect_count")


_CHART_DATASET = """(values ('KPI - Average OEE','OEE operational dataset'),('Trend - OEE by production date','OEE operational dataset'),
 ('Bar - OEE by plant and line','OEE operational dataset'),('Pareto - Defect count by defect code','Quality decision dataset'),
 ('Bar - Data quality issues by severity','Data quality governance dataset'),('Trend - Sensor vibration by hour','Sensor hourly dataset'))"""
_DATASET_ROWS = """(select 'OEE operational dataset' as dataset_name, count(*) as row_count from m_oee
 union all select 'Quality decision dataset', count(*) from m_quality union all select 'Sensor hourly dataset', count(*) from m_sensor
 union all select 'Data quality governance dataset', count(*) from dq_summary)"""


@query("l05_dashboard_charts", f"""
select d.dashboard_name, c.chart_name, c.dataset_name, r.row_count from
 (select 'Manufacturing Decision Dashboard' as dashboard_name, chart_name from {_CHART_DATASET} as t(chart_name,dataset_name)
  union all select 'Lecture 3 Data Quality Audit Board','Bar - Data quality issues by severity') d
 join {_CHART_DATASET} as c(chart_name,dataset_name) on d.chart_name=c.chart_name join {_DATASET_ROWS} r on c.dataset_name=r.dataset_name""")
def l05(shop):
    """Charts of every dashboard with the rows of their datasets."""
    charts = semantic.registry(shop.spark, "superset_chart_registry").select("chart_name", "dataset_name")
    counts = semantic.readiness(shop.spark, shop.datasets).select("dataset_name", "row_count")
    return (semantic.dashboard_charts(shop.spark).drop("position")
            .join(charts, "chart_name", "inner").join(counts, "dataset_name", "inner"))


@query("l06_user_plant_map", f"""
select u.username, u.plant_id, count(w.work_order_id) as work_orders from {_USER_PLANTS} u
left join c_work_order w on u.plant_id=w.plant_id group by 1,2""")
def l06(shop):
    """Who sees which plant, and how many work orders that is."""
    orders = shop.work_orders.groupBy("plant_id").agg(F.count(F.lit(1)).alias("work_orders"))
    return shop.user_plants.join(orders, "plant_id", "left").select(
        "username", "plant_id", F.coalesce("work_orders", F.lit(0).cast("bigint")).alias("work_orders"))


@query("l07_access_policy", " union all ".join(
    f"select '{ds}' as dataset_name, '{user}' as username, count(*) as visible_rows from {table} "
    f"where plant_id in (select plant_id from {_USER_PLANTS} where username='{user}')"
    for ds, table in (("OEE operational dataset", "m_oee"), ("Quality decision dataset", "m_quality"),
                      ("Sensor hourly dataset", "m_sensor"))
    for user in ("admin", "plant_p01_user", "stranger")))
def l07(shop):
    """Visible rows per policy dataset for an admin, a plant user, a stranger."""
    datasets = {name: shop.dataset(name) for name in (semantic.OEE, semantic.QUALITY, semantic.SENSOR)}
    return semantic.visible_rows(datasets, shop.user_plants, ["admin", "plant_p01_user", "stranger"])


@query("l07_secured_dataset", f"""
select * from m_quality where plant_id in (select plant_id from {_USER_PLANTS} where username='plant_p01_user')""")
def l07_secured(shop):
    """The quality dataset as a plant user sees it."""
    columns = shop.quality.columns
    return semantic.secured(semantic.QUALITY, shop.quality, shop.user_plants, "plant_p01_user").select(*columns)


@query("l08_metric_listing", f"""
select * from (values ('OEE operational dataset',6),('Quality decision dataset',3),('Sensor hourly dataset',2),('Data quality governance dataset',1)) as t(dataset_name,metrics)
join {_DATASET_ROWS} using (dataset_name)""")
def l08(shop):
    """Registered metrics per dataset, next to the dataset's rows."""
    listed = semantic.listing(shop.spark, "superset_metric_layer").groupBy("dataset_name").agg(
        F.count(F.lit(1)).cast("int").alias("metrics"))
    counts = semantic.readiness(shop.spark, shop.datasets).select("dataset_name", "row_count")
    return listed.join(counts, "dataset_name", "inner")


@query("l09_catalog_readiness", f"""
select dataset_name, row_count, metric_count, chart_count, policy_count, 0 as unresolved_metrics from
 (values ('OEE operational dataset',6,3,1),('Quality decision dataset',3,1,1),('Sensor hourly dataset',2,1,1),
  ('Data quality governance dataset',1,1,0)) as t(dataset_name,metric_count,chart_count,policy_count)
join {_DATASET_ROWS} using (dataset_name)""")
def l09(shop):
    return semantic.readiness(shop.spark, shop.datasets)


@query("l10_dashboard_filters", f"""
select defect_code, {r4('sum(defect_count)')} as defect_count from m_quality
where plant_id in ('P01','P02') and product_family in ('ECONOMY','SMALL') and inspection_date>=date '1997-01-01' and inspection_date<=date '1999-12-31'
group by 1""")
def l10(shop):
    """A chart under plant, family and date filters."""
    where = semantic.dashboard_filter(
        time_column="inspection_date", start=dt.date(1997, 1, 1), end=dt.date(1999, 12, 31),
        plants=["P01", "P02"], families=["ECONOMY", "SMALL"])
    chart = "Pareto - Defect count by defect code"
    pareto = semantic.chart_query(chart, shop.chart_source(chart), where)
    return _rounded(pareto, "defect_count")


@query("l11_defect_rate_by_family", f"select product_family, {r4(xavg('defect_rate', 10))} as avg_defect_rate from m_quality group by 1")
def l11_family(shop):
    return shop.quality.groupBy("product_family").agg(
        round_half_up(exact_avg("defect_rate", RATE)).alias("avg_defect_rate"))


@query("l11_valid_rate_by_machine", f"select machine_id, {r4(xavg('sensor_valid_rate', 10))} as avg_valid_rate from m_sensor group by 1")
def l11_valid(shop):
    return shop.hourly.groupBy("machine_id").agg(
        round_half_up(exact_avg("sensor_valid_rate", RATE)).alias("avg_valid_rate"))


@query("l11_late_by_root_cause", f"""
select root_cause, count(*) as order_lines, {xsum('late_delivery_flag')} as late_lines from m_delivery group by 1""")
def l11_late(shop):
    return shop.delivery.groupBy("root_cause").agg(
        F.count(F.lit(1)).alias("order_lines"), exact_sum("late_delivery_flag").alias("late_lines"))


@query("l11_components_by_line", f"""
select plant_id, line_id, {r4('avg(availability)')} as avg_availability, {r4('avg(performance)')} as avg_performance,
 {r4('avg(quality)')} as avg_quality from m_oee group by 1,2""")
def l11_components(shop):
    names = ["avg_availability", "avg_performance", "avg_quality"]
    chosen = [semantic.metric_named(n, semantic.OEE) for n in names]
    return _rounded(semantic.evaluate(shop.dataset(semantic.OEE), chosen, ["plant_id", "line_id"]), *names)


# -- sorts, limits, unions --------------------------------------------------------------

@query("t01_mixed_direction_sort", """
select production_date, plant_id, line_id, run_count from m_oee
order by production_date desc nulls first, plant_id nulls last, line_id nulls last limit 2000""")
def t01(shop):
    """Newest date first, then plant and line ascending, missing places last."""
    order = [F.desc_nulls_first("production_date"), F.asc_nulls_last("plant_id"), F.asc_nulls_last("line_id")]
    return dashboard.top(shop.oee.select("production_date", "plant_id", "line_id", "run_count"), order, 2000)


@query("t02_clamped_limit", """
select * from (select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 2000)
union all select * from (select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 1)""")
def t02(shop):
    """Asked for 9,999 and for 0 rows; the read API gives 2,000 and 1."""
    orders = shop.base("orders").select("o_orderkey", "o_totalprice")
    order = [F.desc_nulls_first("o_totalprice"), F.asc_nulls_last("o_orderkey")]
    return dashboard.page(orders, order, 9_999).unionByName(dashboard.page(orders, order, 0))


@query("t04_physical_head", """
select l_orderkey, l_linenumber, l_quantity from (select *, row_number() over () as rn from lineitem) where rn<=500""")
def t04(shop):
    """First 500 records as they stand in the file, by the row index of the scan."""
    rows = shop.base("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    return rows.orderBy("f", "r").limit(500).drop("f", "r")


@query("u01_union_all", """
select 'run' as source, machine_id, count(*) as rows from production_run group by 2
union all select 'state', machine_id, count(*) from machine_state_event group by 2""")
def u01(shop):
    count = F.count(F.lit(1)).alias("rows")
    runs = shop.raw("production_run").groupBy("machine_id").agg(count).withColumn("source", F.lit("run"))
    states = shop.raw("machine_state_event").groupBy("machine_id").agg(count).withColumn("source", F.lit("state"))
    return runs.unionByName(states)
