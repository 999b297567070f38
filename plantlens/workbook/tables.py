"""Queries for sources, sinks, projections, scalar functions, dedup, profiling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerce as fx
from ..functions.numeric import RATE, clamp_zero, exact_sum, ratio, round_half_up
from ..operators import dedup
from ..plans import clean, dashboard, marts, refresh
from ..session import discard
from ..sources import csv_source, lake as lk
from .core import QMS_ORDER, RUN_ORDER, query
from .oracle import r4, xsum

# -- sources and sinks ---------------------------------------------------------


@query("s01_csv_load", """
select run_id, cast(work_order_id as bigint) as work_order_id, operator_id, run_status, run_start_datetime,
 input_quantity, output_quantity, scrap_quantity from production_run""")
def s01(shop):
    """CSV export with untidy headers, loaded as text and then typed."""
    path = shop.scratch("csv")
    shop.export_csv("production_run", path, lambda c: c.replace("_", " ").title())
    raw = csv_source.read_csv(shop.spark, path, required=("run_id", "work_order_id"))
    typed = fx.coerce(raw, timestamps=("run_start_datetime",),
                      numbers=("input_quantity", "output_quantity", "scrap_quantity"))
    return typed.select("run_id", F.col("work_order_id").try_cast("bigint").alias("work_order_id"),
                        "operator_id", "run_status", "run_start_datetime",
                        "input_quantity", "output_quantity", "scrap_quantity")


@query("s01_quoted_line_breaks", r"""
select doc_id, length(text) as characters, md5(text) as text_md5, source,
 len(regexp_extract_all(text, '\n')) as line_breaks from documents""")
def s01_line_breaks(shop):
    """Whole texts, line breaks, quotes and commas included, exported as CSV and read back in splits."""
    path = shop.scratch("csv")
    shop.base("documents").select("doc_id", "text", "source").write.option("header", True).options(
        escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    raw = csv_source.read_csv(shop.spark, path, required=("doc_id", "text"), line_breaks=True)
    return raw.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.length("text").cast("bigint").alias("characters"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"), "source",
        F.regexp_count("text", F.lit("\n")).cast("bigint").alias("line_breaks"))


@query("s02_row_capped_load", "select event_id, event_type, value from events order by event_id limit 2000")
def s02(shop):
    """First 2,000 records of an export in file order."""
    path = shop.scratch("csv-ordered")
    shop.base("events").orderBy("event_id").write.option("header", True).csv(path)
    rows = csv_source.first_rows(csv_source.read_csv(shop.spark, path), 2000)
    return rows.select(F.col("event_id").try_cast("bigint").alias("event_id"), "event_type",
                       fx.to_number("value").alias("value"))


_COUNTED = ("plant_master", "line_master", "machine_master", "product_master", "customer_master",
            "operator_master", "sales_order", "work_order", "production_run", "machine_state_event",
            "downtime_event", "quality_inspection", "shipment", "sensor_reading")


@query("s03_batch_ingest", " union all ".join(
    f"select '{t}' as table_name, count(*) as row_count from {t}" for t in _COUNTED))
def s03(shop):
    """Every export copied into the raw layer, with row counts; an export goes once its rows are in their table."""
    source, lake = shop.scratch("exports"), lk.Lake(shop.spark, shop.scratch("lake"))

    def one(table, relative):
        shop.export_csv(table, f"{source}/{relative}")
        counts = refresh.ingest(shop.spark, source, lake, {table: relative})
        discard(shop.spark, f"{source}/{relative}")
        return counts

    return reduce(DataFrame.unionByName, shop.each_export(one, parallel=2))


@query("s04_header_normalization", """
select o_orderkey as order_key, o_orderstatus as order_status, o_totalprice as total_price from orders""")
def s04(shop):
    messy = shop.base("orders").select(
        F.col("o_orderkey").alias(" Order Key"), F.col("o_orderstatus").alias("Order-Status"),
        F.col("o_totalprice").alias("TOTAL/PRICE "))
    return fx.normalize_headers(messy)


@query("s05_table_scan", "select * from customer_master")
def s05(shop):
    lake = lk.Lake(shop.spark, shop.scratch("lake"))
    lake.write("raw", "customer_master", shop.raw("customer_master"))
    return lake.read("raw", "customer_master")


@query("s06_full_refresh_sink", "select customer_id, customer_segment from customer_master")
def s06(shop):
    """Two overwrites leave one copy."""
    lake = lk.Lake(shop.spark, shop.scratch("lake"))
    rows = shop.raw("customer_master").select("customer_id", "customer_segment")
    lake.write("raw", "customer_master", rows)
    return lake.write("raw", "customer_master", rows)


@query("s07_append_sink", """
select event_type, 2*count(*) as row_count from events group by 1""")
def s07(shop):
    """The same chunk appended twice."""
    lake = lk.Lake(shop.spark, shop.scratch("lake"))
    rows = shop.base("events").select("event_id", "event_type")
    lake.append("raw", "events", rows)
    lake.append("raw", "events", rows)
    return lake.read("raw", "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"))


@query("s08_create_mart_table", """
select *, cast(date_trunc('month',production_date) as date) as production_month from m_oee""")
def s08(shop):
    """Mart written partitioned by month and read back."""
    lake = lk.Lake(shop.spark, shop.scratch("lake"))
    mart = shop.oee.withColumn("production_month", F.trunc("production_date", "month"))
    return lake.write("mart", "fact_oee_daily_line", mart, partition_by=["production_month"])


@query("s09_views", """
select plant_id, count(*) as line_days, max(active_machine_count) as most_machines from m_oee group by 1""")
def s09(shop):
    """A dataset view queried in SQL."""
    dashboard.dataset_view("v_dataset_oee_operational", shop.oee).createOrReplaceTempView(
        "v_dataset_oee_operational")
    return shop.spark.sql(
        "select plant_id, count(*) as line_days, max(active_machine_count) as most_machines "
        "from v_dataset_oee_operational group by plant_id")


@query("s10_run_log", """
select 'clean_and_validate' as step_name, 'ok' as status,
 concat('{"status": "ok", "rows": ', cast((select count(*) from c_work_order) as varchar), '}') as detail""")
def s10(shop):
    lake = lk.Lake(shop.spark, shop.scratch("lake"))
    rows = shop.work_orders.count()
    lake.log("clean_and_validate", "ok", {"status": "ok", "rows": rows})
    return lake.read("lab", "run_log").select("step_name", "status", "detail")


@query("s11_keyed_upsert", """
select c_custkey, c_acctbal, c_mktsegment from customer where c_acctbal>=0
union all select c_custkey, 0.0::double, 'REVIEW' from customer where c_acctbal<0
union all select -1-c_custkey, c_acctbal, 'NEW' from customer where c_mktsegment='BUILDING'""")
def s11(shop):
    """Customers with a debt are replaced, new keys are added."""
    target = shop.base("customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    changed = target.filter("c_acctbal < 0").select(
        "c_custkey", F.lit(0.0).alias("c_acctbal"), F.lit("REVIEW").alias("c_mktsegment"))
    added = target.filter("c_mktsegment = 'BUILDING'").select(
        (-1 - F.col("c_custkey")).alias("c_custkey"), "c_acctbal", F.lit("NEW").alias("c_mktsegment"))
    lake = lk.Lake(shop.spark, shop.scratch("lake"))
    lake.write("lab", "customer", target)
    return lake.upsert("lab", "customer", changed.unionByName(added), ["c_custkey"])


@query("s12_catalog_listing", """
select 'mart' as layer, 'fact_sensor_hourly' as table_name, count(*) as row_count from m_sensor
union all select 'raw', 'customer_master', count(*) from customer_master""")
def s12(shop):
    """Registered tables by layer, with their row counts."""
    root = shop.scratch("lake")
    lake = lk.Lake(shop.spark, root, prefix=f"z{root[-32:]}_")
    lake.write("raw", "customer_master", shop.raw("customer_master"))
    lake.write("mart", "fact_sensor_hourly", shop.hourly)
    names = {t: lake.register(layer, t) for layer, t in
             (("raw", "customer_master"), ("mart", "fact_sensor_hourly"))}
    counts = lk.row_counts({t: shop.spark.table(n) for t, n in names.items()})
    return lake.tables().join(counts, "table_name", "inner")


@query("s13_row_count_audit", """
select 'work_order' as table_name, count(*) as row_count from c_work_order
union all select 'production_run', count(*) from c_production_run
union all select 'quality_inspection', count(*) from c_quality_inspection
union all select 'sensor_reading', count(*) from c_sensor_reading
union all select 'fact_oee_daily_line', count(*) from m_oee
union all select 'fact_quality_daily', count(*) from m_quality
union all select 'fact_sensor_hourly', count(*) from m_sensor
union all select 'fact_delivery_order', count(*) from m_delivery
union all select 'feature_quality_model', count(*) from m_features""")
def s13(shop):
    """Row counts of clean tables and marts; what several marts read is deduplicated and written once, as in the refresh."""
    oee_runs = ("output_quantity", "scrap_quantity", "good_quantity", "speed_standard_ppm")
    runs = shop.kept(shop.runs.select(*marts.FEATURE_RUNS, *oee_runs), "runs")
    orders = shop.kept(shop.work_orders.select("work_order_id", "plant_id", "line_id", "product_id"), "work-orders")
    inspections = shop.kept(shop.inspections.select(
        "inspection_id", "inspection_datetime", "work_order_id", "product_id", "defect_code", "sample_size", "defect_count",
        *marts.FEATURE_INSPECTIONS), "inspections")
    return lk.row_counts({
        "work_order": orders, "production_run": runs, "quality_inspection": inspections, "sensor_reading": shop.sensors,
        "fact_oee_daily_line": marts.oee_daily_line(runs, orders),
        "fact_quality_daily": marts.quality_daily(inspections, orders, shop.raw("product_master")),
        "fact_sensor_hourly": shop.hourly, "fact_delivery_order": shop.delivery,
        "feature_quality_model": shop.features_from(runs, inspections, orders),
    })


@query("s14_inline_relation", """
select t.label, count(*) as order_count from orders o
 join (values ('1-URGENT','urgent'),('2-HIGH','high'),('3-MEDIUM','medium')) as t(code,label) on o.o_orderpriority=t.code
group by 1""")
def s14(shop):
    """An inline code list joined with the orders."""
    codes = shop.spark.sql(
        "select * from values ('1-URGENT','urgent'),('2-HIGH','high'),('3-MEDIUM','medium') as t(code,label)")
    orders = shop.base("orders")
    return orders.join(codes, orders["o_orderpriority"] == codes["code"], "inner").groupBy("label").agg(
        F.count(F.lit(1)).alias("order_count"))


@query("s15_jsonl_documents", """
select cast(doc_id as varchar) as doc_id, concat(lang,'-',source) as title, length(text) as text_length, md5(text) as text_hash
from documents""")
def s15(shop):
    """Documents written as JSON lines and read with a fixed schema."""
    path = shop.scratch("jsonl")
    shop.base("documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat_ws("-", "lang", "source").alias("title"), "text").write.json(path)
    docs = csv_source.read_documents(shop.spark, path)
    return docs.select("doc_id", "title", F.char_length("text").cast("bigint").alias("text_length"),
                       F.md5("text").alias("text_hash"))


_REFRESH = [("raw", t, t) for t in _COUNTED] + [
    ("clean", "work_order", "c_work_order"),
    ("clean", "sales_order", "sales_order"), ("clean", "shipment", "shipment"),
    ("clean", "machine_state_event", "machine_state_event"),
    ("mart", "fact_delivery_order", "m_delivery"),
]


@query("e01_full_refresh", " union all ".join(
    f"select '{layer}' as layer, '{t}' as table_name, count(*) as row_count from {src}"
    for layer, t, src in _REFRESH))
def e01(shop):
    """Exports to marts in one call; row counts of the tables that do not depend
    on which duplicate arrived last."""
    source, files = shop.export_all()
    root = shop.scratch("lake")
    lake = lk.Lake(shop.spark, root, prefix=f"e{root[-32:]}_")
    audits = refresh.run_all(shop.spark, source, lake, files)
    layers = {"ingest_raw_data": "raw", "clean_and_validate": "clean", "build_feature_marts": "mart"}
    listed = None
    for step, counts in audits.items():
        wanted = [t for layer, t, _ in _REFRESH if layer == layers[step]]
        part = counts.filter(F.col("table_name").isin(wanted)).select(
            F.lit(layers[step]).alias("layer"), "table_name", "row_count")
        listed = part if listed is None else listed.unionByName(part)
    return listed


# (layer, table, reference table, measures)
_VALUES = (
    ("clean", "work_order", "c_work_order", ("good_quantity", "schedule_delay_minutes")),
    ("clean", "production_run", "c_production_run", ("good_quantity", "scrap_rate", "speed_ratio")),
    ("clean", "quality_inspection", "c_quality_inspection", ("defect_rate", "high_defect_risk")),
    ("clean", "sensor_reading", "c_sensor_reading", ("temperature_c", "sensor_valid_flag")),
    ("clean", "machine_state_event", "c_machine_state_event", ("event_duration_minutes",)),
    ("clean", "shipment", "shipment", ("shipped_quantity", "delay_days")),
    ("mart", "fact_oee_daily_line", "m_oee", ("oee", "output_quantity", "planned_production_minutes")),
    ("mart", "fact_quality_daily", "m_quality", ("defect_rate", "sample_size")),
    ("mart", "fact_sensor_hourly", "m_sensor", ("avg_temperature_c", "max_vibration_mm_s", "reading_count")),
    ("mart", "fact_delivery_order", "m_delivery", ("net_order_value", "delay_days")),
    ("mart", "feature_quality_model", "m_features", ("defect_rate", "avg_temperature_c", "scrap_rate")),
)


@query("e01_refresh_values", " union all ".join(
    f"select '{layer}' as layer, '{t}' as table_name, '{m}' as measure, count({m}) as rows, {r4(xsum(m, 10))} as total from {src}"
    for layer, t, src, measures in _VALUES for m in measures))
def e01_values(shop):
    """CSV exports to marts, compared by the sums of their measures; exports stand in arrival order."""
    source, files = shop.export_all(ordered=True)
    root = shop.scratch("lake")
    lake = lk.Lake(shop.spark, root, prefix=f"e{root[-32:]}_")
    refresh.run_all(shop.spark, source, lake, files)
    parts = []
    for layer, table, _, measures in _VALUES:
        sums = lake.read(layer, table).agg(F.array(*[F.struct(
            F.lit(m).alias("measure"), F.count(m).alias("rows"), round_half_up(exact_sum(m, RATE)).alias("total"))
            for m in measures]).alias("_sums"))
        parts.append(sums.select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.explode("_sums").alias("s")).select(
            "layer", "table_name", "s.*"))
    return reduce(DataFrame.unionByName, parts)


MONTH_FIRST = "MM/dd/yyyy HH:mm:ss.SSSSSS"
_SITE = {
    "machine_state_event": fx.Contract(formats=(MONTH_FIRST,), strict=True),
    "sensor_reading": fx.Contract(formats=(MONTH_FIRST,), strict=True, units={"temperature_c": (1 / 1.8, -32 / 1.8)}),
}


def _site_exports(shop) -> dict:
    """Raw frames of a site that writes months first and degrees Fahrenheit, with marks no contract reads."""
    root = shop.scratch("site")
    stamp = lambda c: F.date_format(c, MONTH_FIRST)
    states, sensors = shop.raw("machine_state_event"), shop.raw("sensor_reading")
    states.withColumns({
        "event_start": stamp("event_start"),
        "event_end": F.when(F.col("reason_code").isNull(), "open").otherwise(stamp("event_end")),
    }).write.option("header", True).csv(f"{root}/states", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    sensors.withColumns({
        "timestamp": stamp("timestamp"),
        "temperature_c": F.when(F.col("sensor_id") % 50 == 3, "broken").otherwise(
            (F.col("temperature_c") * 1.8 + 32).cast("string")),
    }).write.option("header", True).csv(f"{root}/sensors")
    read = lambda name: csv_source.read_csv(shop.spark, f"{root}/{name}")
    return {"machine_state_event": read("states"), "sensor_reading": read("sensors")}


@query("p01_contract_times", """
select cast(machine_id as varchar) as machine_id, state_code, event_start, case when reason_code is not null then event_end end as event_end,
 reason_code, case when reason_code is not null then event_duration_minutes end as event_duration_minutes from c_machine_state_event""")
def p01_times(shop):
    """Month-first exports through their contract into the clean state events."""
    table = "machine_state_event"
    return clean.machine_state_events(_site_exports(shop)[table], contract=_SITE[table])


@query("p01_contract_units", """
select "timestamp", cast(machine_id as varchar) as machine_id, cast(sensor_id as varchar) as sensor_id,
 case when sensor_id % 50 <> 3 then (temperature_c*1.8::double+32)*(1/1.8::double)+(-32/1.8::double) end as temperature_c, pressure_bar, sensor_hour
from c_sensor_reading""")
def p01_units(shop):
    """Fahrenheit readings through their contract into the clean sensor table, the last copy kept."""
    table = "sensor_reading"
    cleaned = clean.sensor_readings(_site_exports(shop)[table], order=("seq",), contract=_SITE[table])
    return cleaned.select("timestamp", "machine_id", "sensor_id", "temperature_c", "pressure_bar", "sensor_hour")


@query("p01_rejected_values", """
select 'machine_state_event' as table_name, 'event_end' as column_name, 'open' as value, count(*) as rows from machine_state_event
where reason_code is null
union all select 'sensor_reading', 'temperature_c', 'broken', count(*) from sensor_reading where sensor_id % 50 = 3""")
def p01_rejected(shop):
    """What the contracts could not read, by value."""
    parts = [clean.rejected_values(t, raw, _SITE[t]) for t, raw in _site_exports(shop).items()]
    return parts[0].unionByName(parts[1]).groupBy("table_name", "column_name", "value").agg(
        F.count(F.lit(1)).alias("rows"))


# -- projections and scalar functions -------------------------------------------

@query("p01_lenient_timestamp", """
select o_orderkey, case when o_orderkey % 4 = 3 then null else o_orderdate end as parsed,
 case when o_orderkey % 4 = 0 then o_orderdate end as parsed_strict from orders""")
def p01(shop):
    """Text in mixed formats, with junk; lenient and one-format parsing."""
    day = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 4
    text = (F.when(kind == 0, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
            .when(kind == 1, F.date_format(day, "dd/MM/yyyy HH:mm"))
            .when(kind == 2, F.date_format(day, "yyyy/MM/dd")).otherwise("n.a."))
    orders = shop.base("orders").select("o_orderkey", text.alias("text"))
    return orders.select("o_orderkey", fx.to_timestamp("text").alias("parsed"),
                         fx.to_timestamp("text", strict=True).alias("parsed_strict"))


@query("p02_lenient_number", """
select event_id, try_cast(case when event_id % 50 = 0 then 'ERR' when event_id % 50 = 1 then null
 else cast(value as varchar) end as double) as value from events""")
def p02(shop):
    text = (F.when(F.col("event_id") % 50 == 0, "ERR").when(F.col("event_id") % 50 == 1, F.lit(" NaN "))
            .otherwise(F.col("value").cast("string")))
    return shop.base("events").select("event_id", fx.to_number(text).alias("value"))


@query("p03_trim_lower", """
select work_order_id, load_timestamp, lower(trim(work_order_status)) as work_order_status,
 lower(trim(priority_level)) as priority_level, lower(trim(coalesce(priority_level,'None'))) as priority_parity from work_order""")
def p03(shop):
    return shop.raw("work_order").select(
        "work_order_id", "load_timestamp", fx.lower_text("work_order_status").alias("work_order_status"),
        fx.lower_text("priority_level").alias("priority_level"),
        fx.lower_text("priority_level", parity=True).alias("priority_parity"))


@query("p04_trim_upper", """
select inspection_id, upper(trim(defect_code)) as defect_code, count(*) as copies from quality_inspection group by 1,2""")
def p04(shop):
    codes = shop.raw("quality_inspection").select("inspection_id", fx.upper_text("defect_code").alias("defect_code"))
    return codes.groupBy("inspection_id", "defect_code").agg(F.count(F.lit(1)).alias("copies"))


@query("p05_clamp_zero", """
select work_order_id, load_timestamp, case when actual_quantity-rejected_quantity<0 then 0
 else actual_quantity-rejected_quantity end as good_quantity from work_order""")
def p05(shop):
    good = clamp_zero(F.col("actual_quantity") - F.col("rejected_quantity"))
    return shop.raw("work_order").select("work_order_id", "load_timestamp", good.alias("good_quantity"))


@query("p06_zero_safe_ratio", """
select machine_id, product_id, speed_actual_ppm/nullif(speed_standard_ppm,0) as speed_ratio, count(*) as rows
from production_run group by 1,2,3""")
def p06(shop):
    rated = shop.raw("production_run").select(
        "machine_id", "product_id", ratio("speed_actual_ppm", "speed_standard_ppm").alias("speed_ratio"))
    return rated.groupBy("machine_id", "product_id", "speed_ratio").agg(F.count(F.lit(1)).alias("rows"))


@query("p07_duration_minutes", """
select machine_id, event_start, state_code,
 (epoch_us(event_end)-epoch_us(event_start))/60000000.0::double as minutes from machine_state_event""")
def p07(shop):
    return shop.raw("machine_state_event").select(
        "machine_id", "event_start", "state_code",
        fx.minutes_between("event_start", "event_end").alias("minutes"))


@query("p08_date_of", "select event_id, cast(ts as date) as day from events")
def p08(shop):
    return shop.base("events").select("event_id", fx.date_of("ts").alias("day"))


@query("p09_floor_hour", "select event_id, date_trunc('hour',ts) as hour from events")
def p09(shop):
    return shop.base("events").select("event_id", fx.hour_of("ts").alias("hour"))


@query("p10_between", """
select inspection_id, seq_a, seq_b, seq_c, case when measurement_1 between lower_spec_limit and upper_spec_limit
 then 1 else 0 end as within_spec from quality_inspection""")
def p10(shop):
    inside = F.col("measurement_1").between(F.col("lower_spec_limit"), F.col("upper_spec_limit"))
    return shop.raw("quality_inspection").select(
        "inspection_id", "seq_a", "seq_b", "seq_c", fx.flag(inside).alias("within_spec"))


@query("p11_boolean_flag", """
select sensor_id, seq, case when temperature_c between 0 and 150 and vibration_mm_s>=0 and pressure_bar>=0
 and current_amp>=0 then 1 else 0 end as sensor_valid_flag from sensor_reading""")
def p11(shop):
    return clean.derive_sensor_columns(shop.raw("sensor_reading")).select(
        "sensor_id", "seq", "sensor_valid_flag")


@query("p12_default_for_null", """
select sales_order_id, order_line_id, coalesce(discount_pct,0) as discount_pct, count(*) as lines
from sales_order group by 1,2,3""")
def p12(shop):
    filled = shop.raw("sales_order").withColumn("discount_pct", F.coalesce("discount_pct", F.lit(0.0)))
    return filled.groupBy("sales_order_id", "order_line_id", "discount_pct").agg(
        F.count(F.lit(1)).alias("lines"))


@query("p13_net_value", """
select sales_order_id, order_line_id, seq_a, seq_b,
 ordered_quantity*unit_price*(1::double-coalesce(discount_pct,0)/100::double) as net_value from sales_order""")
def p13(shop):
    net = (F.col("ordered_quantity") * F.col("unit_price")
           * (F.lit(1.0) - F.coalesce("discount_pct", F.lit(0.0)) / 100.0))
    return shop.raw("sales_order").select("sales_order_id", "order_line_id", "seq_a", "seq_b",
                                          net.alias("net_value"))


@query("p14_round_half_up", """
select run_id, seq_a, seq_b, seq_c, machine_id,
 cast(round(cast(scrap_quantity/nullif(output_quantity,0) as decimal(38,10)),4) as double) as scrap_rate
from production_run""")
def p14(shop):
    return shop.raw("production_run").select(
        "run_id", "seq_a", "seq_b", "seq_c", "machine_id",
        round_half_up(ratio("scrap_quantity", "output_quantity")).alias("scrap_rate"))


@query("p15_severity_rank", """
select machine_id, criticality, case criticality when 'high' then 1 when 'medium' then 2 when 'low' then 3 else 4 end as severity_rank
from machine_master""")
def p15(shop):
    return shop.raw("machine_master").select(
        "machine_id", "criticality", fx.severity_rank("criticality").alias("severity_rank"))


@query("p16_composite_key", """
select sensor_id, seq, concat(cast(machine_id as varchar),'@',coalesce(cast(pressure_bar>1 as varchar),'None')) as business_key
from sensor_reading""")
def p16(shop):
    return shop.raw("sensor_reading").select(
        "sensor_id", "seq", fx.composite_key("machine_id", F.col("pressure_bar") > 1).alias("business_key"))


@query("p17_cast_in_predicate", """
select event_id, value from events where event_id % 50 <> 0 and value>20""")
def p17(shop):
    text = F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return shop.base("events").withColumn("t", text).filter(F.col("t").try_cast("double") > 20).select(
        "event_id", "value")


@query("p18_current_timestamp", "select count(*) as stamped_rows, 1 as distinct_stamps from orders")
def p18(shop):
    """One refresh stamp on every row (the stamp itself changes per run)."""
    stamped = shop.base("orders").withColumn("refreshed_at", F.current_timestamp())
    return stamped.agg(F.count("refreshed_at").alias("stamped_rows"),
                       F.count_distinct("refreshed_at").cast("int").alias("distinct_stamps"))


@query("p19_row_filter", """
select event_id, event_type, value from events where event_type in ('error','purchase') and value between 5 and 60""")
def p19(shop):
    return shop.base("events").filter(
        F.col("event_type").isin("error", "purchase") & F.col("value").between(5, 60)
    ).select("event_id", "event_type", "value")


@query("p20_column_subset", """
select sensor_hour, plant_id, line_id, machine_id, reading_count, avg_temperature_c, max_temperature_c,
 avg_vibration_mm_s, max_vibration_mm_s, avg_pressure_bar, avg_current_amp, avg_speed_rpm, sensor_valid_rate from m_sensor""")
def p20(shop):
    return dashboard.dataset_view("v_dataset_sensor_hourly", shop.hourly)


@query("p21_json_rows", """
select concat('{"o_orderkey":',cast(o_orderkey as varchar),',"o_totalprice":',
 case when o_orderstatus='P' then 'null' else cast(o_totalprice as varchar) end,
 ',"o_orderdate":"',strftime(o_orderdate,'%Y-%m-%dT%H:%M:%S'),'"}') as json from orders""")
def p21(shop):
    """Rows as JSON text; a NaN comes out as null."""
    price = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    rows = shop.base("orders").select(
        "o_orderkey", price.alias("o_totalprice"), F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    return fx.json_rows(rows)


# -- dedup and profiling ---------------------------------------------------------

@query("d01_latest_by_load_time", """
select work_order_id, load_timestamp, actual_quantity from c_work_order""")
def d01(shop):
    return dedup.keep_last(shop.raw("work_order"), ["work_order_id"], ["load_timestamp"]).select(
        "work_order_id", "load_timestamp", "actual_quantity")


@query("d02_keep_last_single_key", """
select run_id, machine_id, product_id, run_start_datetime, input_quantity, output_quantity from c_production_run""")
def d02(shop):
    return dedup.keep_last(shop.raw("production_run"), ["run_id"], RUN_ORDER).select(
        "run_id", "machine_id", "product_id", "run_start_datetime", "input_quantity", "output_quantity")


@query("d03_keep_last_composite_key", """
select "timestamp", machine_id, sensor_id, temperature_c from c_sensor_reading""")
def d03(shop):
    return dedup.keep_last(shop.raw("sensor_reading"), ["timestamp", "machine_id", "sensor_id"], ["seq"]).select(
        "timestamp", "machine_id", "sensor_id", "temperature_c")


@query("d04_flag_duplicate_members", """
select run_id, work_order_id, machine_id, seq_a,
 case when count(*) over (partition by work_order_id)>1 then 1 else 0 end as is_duplicate from production_run""")
def d04(shop):
    """Rows whose work order occurs more than once; missing keys form a group."""
    runs = shop.raw("production_run").select("run_id", "work_order_id", "machine_id", "seq_a")
    return dedup.flag_duplicates(runs, ["work_order_id"])


@query("d05_duplicate_key_profile", """
select work_order_id, count(*) as row_count from work_order group by 1 having count(*)>1""")
def d05(shop):
    return dedup.duplicate_keys(shop.raw("work_order"), ["work_order_id"])


_PROFILED = ("work_order_id", "plant_id", "priority_level", "actual_end_datetime", "actual_quantity")


@query("d06_missing_profile", " union all ".join(
    f"select '{c}' as column_name, count(*) as row_count, count(*) filter (where {c} is null) as missing_rows from work_order"
    for c in _PROFILED))
def d06(shop):
    return dedup.missing_profile(shop.raw("work_order").select(*_PROFILED))


@query("d07_invalid_intervals", """
select work_order_id, actual_start_datetime, actual_end_datetime from work_order where actual_end_datetime<actual_start_datetime""")
def d07(shop):
    return dedup.invalid_intervals(shop.raw("work_order"), "actual_start_datetime", "actual_end_datetime").select(
        "work_order_id", "actual_start_datetime", "actual_end_datetime")


@query("d08_out_of_range_listing", """
select sensor_id, seq, temperature_c, vibration_mm_s from sensor_reading
where temperature_c<0 or temperature_c>150 or vibration_mm_s<0 order by sensor_id, seq limit 50""")
def d08(shop):
    """First 50 readings outside the limits."""
    text = shop.raw("sensor_reading").withColumn("temperature_c", F.col("temperature_c").cast("string"))
    found = dedup.sensor_out_of_range(text).orderBy("sensor_id", "seq").limit(50)
    return found.select("sensor_id", "seq", F.col("temperature_c").try_cast("double").alias("temperature_c"),
                        "vibration_mm_s")


# -- clean tables ------------------------------------------------------------------

@query("c01_work_order", "select * from c_work_order")
def c01(shop):
    return shop.work_orders


@query("c02_production_run", "select * from c_production_run")
def c02(shop):
    return shop.runs.drop(*[c for c in RUN_ORDER if c.startswith("seq_")])


@query("c03_quality_inspection", "select * from c_quality_inspection")
def c03(shop):
    return shop.inspections.drop(*[c for c in QMS_ORDER if c.startswith("seq_")])


@query("c04_sensor_reading", "select * from c_sensor_reading")
def c04(shop):
    return shop.sensors.drop("seq")


@query("c05_machine_state_event", "select * from c_machine_state_event")
def c05(shop):
    return shop.states


@query("c06_shipment", """
select shipment_id, sales_order_id, order_line_id, ship_date, cast(shipped_quantity as double) as shipped_quantity,
 cast(late_delivery_flag as double) as late_delivery_flag, root_cause, cast(delay_days as double) as delay_days from shipment""")
def c06(shop):
    return shop.shipments


@query("c07_masters_and_orders", """
select 'sales_order' as table_name, count(*) as row_count, count(distinct product_id) as keys from sales_order
union all select 'plant_master', count(*), count(distinct plant_id) from plant_master
union all select 'line_master', count(*), count(distinct line_id) from line_master
union all select 'machine_master', count(*), count(distinct machine_id) from machine_master
union all select 'product_master', count(*), count(distinct product_id) from product_master
union all select 'customer_master', count(*), count(distinct customer_id) from customer_master
union all select 'operator_master', count(*), count(distinct operator_id) from operator_master""")
def c07(shop):
    """Masters and sales orders pass through whole."""
    keys = {"plant_master": "plant_id", "line_master": "line_id", "machine_master": "machine_id",
            "product_master": "product_id", "customer_master": "customer_id", "operator_master": "operator_id"}
    parts = shop.sales_orders.agg(F.lit("sales_order").alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                                  F.count_distinct("product_id").alias("keys"))
    for table, key in keys.items():
        parts = parts.unionByName(clean.master(table, shop.raw(table)).agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(key).alias("keys")))
    return parts


def _register_master(table: str) -> None:
    @query(f"c07_{table}", f"select * from {table}")
    def whole(shop):
        return clean.master(table, shop.raw(table))

    whole.__doc__ = f"Clean {table}, value by value."


for _table in clean.MASTERS:
    _register_master(_table)


@query("c07_sales_order", """
select sales_order_id, order_line_id, customer_id, product_id, order_date, promised_delivery_date,
 ordered_quantity, unit_price, discount_pct, customer_priority from sales_order""")
def c07_orders(shop):
    return shop.sales_orders.drop("load_timestamp", "seq_a", "seq_b", "seq_c", "seq_d")


@query("c07_sales_order_deduped", """
select sales_order_id, order_line_id, product_id, ordered_quantity, unit_price from (select *, row_number() over (
 partition by sales_order_id, order_line_id order by load_timestamp desc, seq_a desc, seq_b desc, seq_c desc, seq_d desc, product_id desc) as rn
from sales_order) where rn=1""")
def c07_deduped(shop):
    """Optional dedup of repeated order lines."""
    deduped = clean.sales_orders(shop.raw("sales_order"), dedupe=True,
                                 order=("seq_a", "seq_b", "seq_c", "seq_d", "product_id"))
    return deduped.select("sales_order_id", "order_line_id", "product_id", "ordered_quantity", "unit_price")
