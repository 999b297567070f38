"""Queries for the data-quality rules and the checks across tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import defects, integrity
from ..operators import quality_rules as qr
from .core import CORE_TABLES, ROW_ORDER, query
from .oracle import DUP_SQL, rule_sql

_NAMES = {
    "q01_work_order_duplicates": "DQ-WO-DUP", "q02_work_order_time": "DQ-WO-TIME",
    "q03_work_order_quantity": "DQ-WO-QTY", "q04_work_order_missing_end": "DQ-WO-MISSING-END",
    "q05_run_time": "DQ-RUN-TIME", "q06_run_quantity": "DQ-RUN-QTY",
    "q07_inspection_count": "DQ-QMS-COUNT", "q08_inspection_measure": "DQ-QMS-MEASURE",
    "q09_sensor_range": "DQ-SENSOR-RANGE", "q10_sensor_missing": "DQ-SENSOR-MISSING",
}


def _register_rule(name: str, rule_id: str) -> None:
    rule = next(r for r in qr.CORE_RULES if r.rule_id == rule_id)

    @query(name, DUP_SQL if rule.duplicate_of else rule_sql(rule_id))
    def issues(shop):
        return qr.issue_log({rule.table: shop.raw(rule.table)}, [rule], stamp=False)

    issues.__doc__ = rule.message


for _name, _rule in _NAMES.items():
    _register_rule(_name, _rule)


@query("q11_issue_log", "select *, 1 as stamped from dq_issues")
def q11(shop):
    """All issues of all rules, stamped with the time of the run."""
    return qr.issue_log(shop.core_raw).withColumn(
        "stamped", F.col("created_at").isNotNull().cast("int")).drop("created_at")


_FIRST = """
select table_name, business_key, rule_id, severity, issue_message from (select *, row_number() over (
 partition by rule_id order by sort_a, sort_b) as rn from (
 select *, 0 as sort_a, cast(business_key as bigint) as sort_b from dq_issues where table_name='raw.work_order'
 union all select *, 0, dense_rank() over (order by business_key) from dq_issues where table_name in ('raw.production_run','raw.quality_inspection')
 union all select *, cast(split_part(business_key,'@',1) as bigint), dense_rank() over (order by split_part(business_key,'@',2))
  from dq_issues where table_name='raw.sensor_reading')) where rn<=500"""


@query("q12_issue_log_capped", _FIRST)
def q12(shop):
    """At most 500 issues per rule, in row order."""
    return qr.issue_log(shop.core_raw, cap=500, order=ROW_ORDER, stamp=False)


@query("q13_pass_row", """
select 'all' as table_name, 'none' as business_key, 'DQ-PASS' as rule_id, 'info' as severity,
 'No critical issues detected in the loaded sample.' as issue_message
where not exists (select 1 from production_run where run_end_datetime>run_start_datetime
 and run_end_datetime<=run_start_datetime)""")
def q13(shop):
    """Runs with a proper interval break no interval rule, so only the pass row remains."""
    proper = shop.raw("production_run").filter("run_end_datetime > run_start_datetime")
    rules = [r for r in qr.CORE_RULES if r.rule_id == "DQ-RUN-TIME"]
    return qr.issue_log({"production_run": proper}, rules, stamp=False)


@query("q14_issue_summary", "select * from dq_summary")
def q14(shop):
    """Issue counts per rule without building the log."""
    return shop.issue_counts


@query("q14_issue_summary_from_log", "select * from dq_summary")
def q14_log(shop):
    return qr.summarize(qr.issue_log(shop.core_raw, stamp=False))


@query("q14_issue_summary_capped", """
select severity, rule_id, table_name, least(issue_count,500) as issue_count from dq_summary""")
def q14_capped(shop):
    return qr.issue_counts(shop.core_raw, cap=500)


@query("q15_ranked_summary", """
select severity, rule_id, table_name, issue_count from dq_summary
order by case severity when 'high' then 1 when 'medium' then 2 when 'low' then 3 else 4 end, issue_count desc""")
def q15(shop):
    return qr.ranked_summary(shop.issue_counts)


@query("q15_ranked_issues", """
select table_name, business_key, rule_id, severity, issue_message from dq_issues
order by case severity when 'high' then 1 when 'medium' then 2 when 'low' then 3 else 4 end,
 table_name, rule_id, business_key limit 100""")
def q15_issues(shop):
    """The hundred issues to look at first."""
    return qr.ranked_issues(qr.issue_log(shop.core_raw, stamp=False), 100)


@query("q15_every_issue", "select table_name, business_key, rule_id, severity, issue_message from dq_issues")
def q15_every(shop):
    """All issues, worst first."""
    return qr.ranked_issues(qr.issue_log(shop.core_raw, stamp=False))


def _declared(shop, rule_id: str):
    rule = next(r for r in qr.DECLARED_RULES if r.rule_id == rule_id)
    return qr.issue_log({rule.table: shop.raw(rule.table)}, [rule], stamp=False)


@query("q16_promised_before_ordered", """
select 'raw.sales_order' as table_name, concat(sales_order_id,'@',order_line_id) as business_key, 'DQ005' as rule_id,
 'medium' as severity, 'promised_delivery_date must be on or after order_date' as issue_message
from sales_order where promised_delivery_date<order_date""")
def q16(shop):
    return _declared(shop, "DQ005")


@query("q17_state_interval", """
select 'raw.machine_state_event' as table_name, concat(machine_id,'@',cast(event_start as varchar)) as business_key,
 'DQ006' as rule_id, 'high' as severity, 'event_end must be after event_start' as issue_message
from machine_state_event where event_end<=event_start""")
def q17(shop):
    return _declared(shop, "DQ006")


@query("q18_over_shipped_lines", """
select s.sales_order_id, s.order_line_id, s.shipped_quantity, o.ordered_quantity from
 (select sales_order_id, order_line_id, cast(sum(cast(shipped_quantity as decimal(28,6))) as double) as shipped_quantity from shipment group by 1,2) s
 join (select sales_order_id, order_line_id, max(ordered_quantity) as ordered_quantity from sales_order group by 1,2) o
 on s.sales_order_id=o.sales_order_id and s.order_line_id=o.order_line_id where s.shipped_quantity>o.ordered_quantity""")
def q18(shop):
    return integrity.over_shipped_lines(shop.sales_orders, shop.shipments)


@query("q19_unknown_operators", """
select coalesce(nullif(trim(operator_id),''),'UNKNOWN_OPERATOR') as operator_id, run_id, machine_id, seq_a
from production_run where coalesce(nullif(trim(operator_id),''),'UNKNOWN_OPERATOR') not in (select operator_id from operator_master)""")
def q19(shop):
    runs = shop.raw("production_run").select("operator_id", "run_id", "machine_id", "seq_a")
    return integrity.unknown_operators(runs, shop.raw("operator_master"))


@query("q20_down_without_reason", """
select 'raw.machine_state_event' as table_name, concat(machine_id,'@',cast(event_start as varchar)) as business_key,
 'DQ009' as rule_id, 'medium' as severity, 'DOWN events should have a downtime reason code' as issue_message
from machine_state_event where upper(trim(state_code))='DOWN' and (reason_code is null or trim(reason_code)='')""")
def q20(shop):
    return _declared(shop, "DQ009")


def _relation_sql(r: integrity.Relation) -> str:
    orphan = (f"{r.child_key} is not null and {r.child_key} not in "
              f"(select {r.parent_key} from {r.parent} where {r.parent_key} is not null)")
    return (f"select '{r.parent}' as from_table, '{r.child}' as to_table, '{r.child_key}' as to_key, "
            f"count(*) as child_rows, count(*) filter (where {r.child_key} is null) as missing_key_rows, "
            f"count(*) filter (where {orphan}) as orphan_rows, "
            f"count(distinct {r.child_key}) filter (where {orphan}) as orphan_keys from {r.child}")


@query("q21_referential_audit", " union all ".join(_relation_sql(r) for r in integrity.ENTITY_MAP))
def q21(shop):
    """Missing and orphaned keys of every declared relation."""
    names = {n for r in integrity.ENTITY_MAP for n in (r.parent, r.child)}
    return integrity.audit_relations({n: shop.raw(n) for n in names})


@query("q22_rule_evaluation", """
select rule_id, count(*) filter (where f=1 and t=1) as true_positive, count(*) filter (where f=1 and t=0) as false_positive,
 count(*) filter (where f=0 and t=1) as false_negative,
 count(*) filter (where f=1 and t=1)/nullif(count(*) filter (where f=1),0) as "precision",
 count(*) filter (where f=1 and t=1)/nullif(count(*) filter (where t=1),0) as recall
from (select rule_id, business_key, max(f) as f, max(t) as t from (
 select rule_id, business_key, 1 as f, 0 as t from dq_issues where table_name='raw.work_order'
 union all select 'DQ-WO-DUP', cast(o_orderkey as varchar), 0, 1 from orders where o_orderkey % 25 = 0
 union all select 'DQ-WO-TIME', cast(o_orderkey as varchar), 0, 1 from orders where o_orderkey % 13 = 0
 union all select 'DQ-WO-MISSING-END', cast(o_orderkey as varchar), 0, 1 from orders where o_orderkey % 17 = 0
 union all select 'DQ-WO-QTY', cast(o_orderkey as varchar), 0, 1 from orders join customer on o_custkey=c_custkey where c_acctbal<0
) group by 1,2) group by 1""")
def q22(shop):
    """Found work-order issues against the violations the test entity injects."""
    key = F.col("o_orderkey")
    truth = None
    for rule_id, step in (("DQ-WO-DUP", 25), ("DQ-WO-TIME", 13), ("DQ-WO-MISSING-END", 17)):
        injected = shop.base("orders").filter(key % step == 0).select(
            F.lit(rule_id).alias("rule_id"), key.cast("string").alias("business_key"))
        truth = injected if truth is None else truth.unionByName(injected)
    negative = shop.base("customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    truth = truth.unionByName(shop.base("orders").join(negative, "o_custkey", "left_semi").select(
        F.lit("DQ-WO-QTY").alias("rule_id"), key.cast("string").alias("business_key")))
    found = qr.issue_log({"work_order": shop.raw("work_order")}, stamp=False)
    return qr.evaluate_rules(found, truth, ["business_key"])


# Readings with copies of whole rows and with spikes, next to the conflicts and gaps that the entity has.
_SPOILED = """(select * replace (case when sensor_id % 333 = 5 then temperature_c + 10000 else temperature_c end as temperature_c) from (
 select * from sensor_reading union all select * from sensor_reading where sensor_id % 60 = 7 and seq=0))"""
_HOURS_SQL = f"""(select machine_id, h, level, 1.4826::double*median(abs(m-level)) over w as spread from (
 select *, median(m) over w as level from (select machine_id, date_trunc('hour',"timestamp") as h, median(temperature_c) as m from {_SPOILED} group by 1,2)
 window w as (partition by machine_id order by h range between interval '12' hour preceding and interval '12' hour following))
 window w as (partition by machine_id order by h range between interval '12' hour preceding and interval '12' hour following))"""


@query("q22_truth_kinds", f"""
select rule_id, count(*) filter (where f=1 and t=1) as true_positive, count(*) filter (where f=1 and t=0) as false_positive,
 count(*) filter (where f=0 and t=1) as false_negative,
 count(*) filter (where f=1 and t=1)/nullif(count(*) filter (where f=1),0) as "precision",
 count(*) filter (where f=1 and t=1)/nullif(count(*) filter (where t=1),0) as recall
from (select rule_id, sensor_id, max(f) as f, max(t) as t from (
 select 'exact_duplicate' as rule_id, sensor_id, 1 as f, 0 as t from (select *, count(*) as n from {_SPOILED} group by all) where n>1
 union all select 'duplicate_business_key', sensor_id, 1, 0 from (select distinct * from {_SPOILED}) group by "timestamp", machine_id, sensor_id having count(*)>1
 union all select 'missing', sensor_id, 1, 0 from {_SPOILED} where temperature_c is null or vibration_mm_s is null or pressure_bar is null or current_amp is null
 union all select 'spike', r.sensor_id, 1, 0 from {_SPOILED} r join {_HOURS_SQL} s on r.machine_id=s.machine_id and date_trunc('hour',r."timestamp")=s.h
  where s.spread>0 and abs(r.temperature_c-s.level) > 6.0::double*s.spread
 union all select 'exact_duplicate', event_id, 0, 1 from events where event_id % 60 = 7
 union all select 'duplicate_business_key', event_id, 0, 1 from events where event_id % 40 = 1
 union all select 'missing', event_id, 0, 1 from events where event_id % 40 = 0
 union all select 'spike', event_id, 0, 1 from events where event_id % 333 = 5
) group by 1,2) group by 1""")
def q22_kinds(shop):
    """Found defects of sensor readings against the injected ones, by kind of defect."""
    raw = shop.raw("sensor_reading")
    spoiled = raw.unionByName(raw.filter("sensor_id % 60 = 7 and seq = 0")).withColumn(
        "temperature_c", F.when(F.expr("sensor_id % 333 = 5"), F.col("temperature_c") + 10000).otherwise(F.col("temperature_c")))
    missing, = [r for r in qr.CORE_RULES if r.rule_id == "DQ-SENSOR-MISSING"]
    found = {
        "exact_duplicate": defects.exact_duplicates(spoiled),
        "duplicate_business_key": defects.conflicting_keys(spoiled, ["timestamp", "machine_id", "sensor_id"]),
        "missing": spoiled.filter(missing.predicate),
        "spike": defects.spikes(spoiled, "temperature_c"),
    }
    injected = {"exact_duplicate": (60, 7), "duplicate_business_key": (40, 1), "missing": (40, 0), "spike": (333, 5)}
    key = F.col("event_id")
    named = lambda kind, df, c: df.select(F.lit(kind).alias("rule_id"), F.col(c).alias("sensor_id"))
    truth = [named(k, shop.base("events").filter(key % step == rest), "event_id") for k, (step, rest) in injected.items()]
    return qr.evaluate_rules(
        reduce(DataFrame.unionByName, [named(k, df, "sensor_id") for k, df in found.items()]),
        reduce(DataFrame.unionByName, truth), ["sensor_id"])


@query("t03_first_issues_per_rule", """
select table_name, business_key, rule_id, severity, issue_message from (select *, row_number() over (partition by rule_id order by k, s) as rn from (
 select 'raw.machine_state_event' as table_name, concat(machine_id,'@',cast(event_start as varchar)) as business_key, 'DQ006' as rule_id,
  'high' as severity, 'event_end must be after event_start' as issue_message, machine_id as k, event_start as s
 from machine_state_event where event_end<=event_start
 union all select 'raw.machine_state_event', concat(machine_id,'@',cast(event_start as varchar)), 'DQ009', 'medium',
  'DOWN events should have a downtime reason code', machine_id, event_start
 from machine_state_event where upper(trim(state_code))='DOWN' and (reason_code is null or trim(reason_code)=''))) where rn<=500""")
def t03(shop):
    """Top rows per group: the first 500 state-event issues of each rule."""
    rules = [r for r in qr.DECLARED_RULES if r.table == "machine_state_event"]
    return qr.issue_log({"machine_state_event": shop.raw("machine_state_event")}, rules, cap=500,
                        order={"machine_state_event": ("machine_id", "event_start")}, stamp=False)


assert set(CORE_TABLES) == {r.table for r in qr.CORE_RULES}
