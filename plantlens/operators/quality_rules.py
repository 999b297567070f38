"""Data-quality rules: declarative predicates over raw tables, one scan each.

A rule is a SQL predicate on the raw frame after a local coercion (the rules
look at raw, not clean, rows).  All predicate rules of a table are evaluated in
one pass; the duplicate-key rule needs a count per key and is added to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.coerce import DEFAULT, Contract, coerce, composite_key, holds, severity_rank
from .dedup import INGEST_ORDER, duplicate_members, group_sizes


@dataclass(frozen=True)
class Rule:
    table: str
    rule_id: str
    severity: str
    message: str
    key: tuple[str, ...]
    predicate: str | None = None        # SQL over the coerced raw columns
    duplicate_of: tuple[str, ...] = ()  # or: every member of a repeated key


# Rule ids, severities, messages, limits.
CORE_RULES = (
    Rule("work_order", "DQ-WO-DUP", "high", "Duplicate work_order_id found.",
         ("work_order_id",), duplicate_of=("work_order_id",)),
    Rule("work_order", "DQ-WO-TIME", "high", "Actual end is not after actual start.",
         ("work_order_id",), "actual_end_datetime <= actual_start_datetime"),
    Rule("work_order", "DQ-WO-QTY", "high", "Negative production quantity detected.",
         ("work_order_id",),
         "planned_quantity < 0 or actual_quantity < 0 or rejected_quantity < 0"),
    Rule("work_order", "DQ-WO-MISSING-END", "medium", "Completed order has no actual end datetime.",
         ("work_order_id",),
         "lower(work_order_status) = 'completed' and actual_end_datetime is null"),
    Rule("production_run", "DQ-RUN-TIME", "high", "Run end is not after run start.",
         ("run_id",), "run_end_datetime <= run_start_datetime"),
    Rule("production_run", "DQ-RUN-QTY", "high", "Invalid or implausible run quantity detected.",
         ("run_id",),
         "output_quantity < 0 or scrap_quantity < 0 or output_quantity > input_quantity * 1.2D"),
    Rule("quality_inspection", "DQ-QMS-COUNT", "high", "Defect count exceeds sample size.",
         ("inspection_id",), "defect_count > sample_size"),
    Rule("quality_inspection", "DQ-QMS-MEASURE", "medium",
         "Measurement is far outside specification range.", ("inspection_id",),
         "measurement_1 < lower_spec_limit - 5 or measurement_1 > upper_spec_limit + 5"),
    Rule("sensor_reading", "DQ-SENSOR-RANGE", "medium", "Sensor reading violates domain range.",
         ("machine_id", "timestamp"),
         "temperature_c < 0 or temperature_c > 150 or vibration_mm_s < 0 or pressure_bar < 0"),
    Rule("sensor_reading", "DQ-SENSOR-MISSING", "low", "One or more sensor values are missing.",
         ("machine_id", "timestamp"),
         "temperature_c is null or vibration_mm_s is null or pressure_bar is null or current_amp is null"),
)

# Declared rules without published code; each predicate is our reading of the
# rule text.  The order-line and operator rules compare two tables and live in
# ``integrity``.
DECLARED_RULES = (
    Rule("sales_order", "DQ005", "medium",
         "promised_delivery_date must be on or after order_date",
         ("sales_order_id", "order_line_id"), "promised_delivery_date < order_date"),
    Rule("machine_state_event", "DQ006", "high", "event_end must be after event_start",
         ("machine_id", "event_start"), "event_end <= event_start"),
    Rule("machine_state_event", "DQ009", "medium",
         "DOWN events should have a downtime reason code", ("machine_id", "event_start"),
         "upper(trim(state_code)) = 'DOWN' and (reason_code is null or trim(reason_code) = '')"),
)

# Columns that the published rules read as times and numbers.
RAW_TIMES = {
    "work_order": ("planned_start_datetime", "planned_end_datetime",
                   "actual_start_datetime", "actual_end_datetime"),
    "production_run": ("run_start_datetime", "run_end_datetime"),
    "sales_order": ("order_date", "promised_delivery_date"),
    "machine_state_event": ("event_start", "event_end"),
}
RAW_NUMBERS = {
    "work_order": ("planned_quantity", "actual_quantity", "rejected_quantity", "rework_quantity"),
    "production_run": ("input_quantity", "output_quantity", "scrap_quantity",
                       "runtime_minutes", "idle_minutes", "setup_minutes"),
    "quality_inspection": ("sample_size", "defect_count", "measurement_1",
                           "lower_spec_limit", "upper_spec_limit"),
    "sensor_reading": ("temperature_c", "vibration_mm_s", "pressure_bar",
                       "current_amp", "speed_rpm", "humidity_pct"),
}

ISSUE_COLUMNS = ("table_name", "business_key", "rule_id", "severity", "issue_message")


def coerced(table: str, raw: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    return coerce(raw, timestamps=RAW_TIMES.get(table, ()), numbers=RAW_NUMBERS.get(table, ()), contract=contract)


def _key(rule: Rule) -> Column:
    if len(rule.key) == 1:
        return F.coalesce(F.col(rule.key[0]).cast("string"), F.lit("None"))
    return composite_key(*rule.key)


def _issue(rule: Rule) -> Column:
    return F.struct(
        F.lit(f"raw.{rule.table}").alias("table_name"),
        _key(rule).alias("business_key"),
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.message).alias("issue_message"),
    )


def _for_table(rules: Sequence[Rule], table: str) -> tuple[list[Rule], list[Rule]]:
    mine = [r for r in rules if r.table == table]
    return [r for r in mine if r.predicate], [r for r in mine if r.duplicate_of]


def table_issues(
    table: str, raw: DataFrame, rules: Sequence[Rule], order: Sequence[str] = (), contract: Contract = DEFAULT,
) -> DataFrame:
    """Issue rows of one table; ``order`` columns are carried for the cap."""
    predicates, duplicates = _for_table(rules, table)
    frame = coerced(table, raw, contract)
    carried = [F.col(c) for c in order]
    parts = []
    if predicates:
        broken = [holds(F.expr(r.predicate)) for r in predicates]
        hits = F.array_compact(F.array(*[F.when(b, _issue(r)) for b, r in zip(broken, predicates)]))
        rows = frame.filter(reduce(lambda a, b: a | b, broken))  # compiled; lists are made of these rows only
        parts.append(rows.select(*carried, F.explode(hits).alias("i")).select(*order, "i.*"))
    for rule in duplicates:
        members = duplicate_members(frame, rule.duplicate_of)
        parts.append(members.select(*carried, _issue(rule).alias("i")).select(*order, "i.*"))
    return reduce(DataFrame.unionByName, parts)


CAP_PARTS = 64  # parts of a rule's issues that are ranked on their own


def capped(issues: DataFrame, order: Sequence[str], cap: int) -> DataFrame:
    """First ``cap`` issues per rule in row order.

    Ranked within salted parts of a rule first, so at most ``CAP_PARTS * cap``
    rows of a rule meet for the final rank, whatever the cap and the count.
    """
    position = [F.col(c).asc_nulls_last() for c in order]

    def ranked(rows: DataFrame, *parts: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("rule_id", *parts).orderBy(*position))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= cap).drop("_rank")

    salted = issues.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(CAP_PARTS)))
    return ranked(ranked(salted, "_part")).drop("_part")


def issue_log(
    raw: Mapping[str, DataFrame],
    rules: Sequence[Rule] = CORE_RULES,
    *,
    cap: int | None = None,
    order: Mapping[str, Sequence[str]] | None = None,
    stamp: bool = True,
    pass_row: bool = True,
    contracts: Mapping[str, Contract] | None = None,
) -> DataFrame:
    """Issues of every table that has rules, with a pass row when there are none.

    ``cap=None`` logs every issue; ``cap=500`` is the row limit per rule of the
    teaching pipeline and then needs an ``order`` per table (the ingest position
    by default).  The lazy pass row probes the issues once more; a caller that
    writes the log can leave it out and add ``pass_rows`` to an empty table.
    """
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        if table not in raw:
            continue
        frame = raw[table]
        by = tuple((order or {}).get(table, [c for c in INGEST_ORDER if c in frame.columns]))
        contract = (contracts or {}).get(table, DEFAULT)
        if cap is None:
            part = table_issues(table, frame, rules, contract=contract)
        else:
            if not by:
                raise ValueError(f"a capped log of {table} needs an order")
            part = capped(table_issues(table, frame, rules, by, contract), by, cap)
        parts.append(part.select(*ISSUE_COLUMNS))
    issues = reduce(DataFrame.unionByName, parts)
    if pass_row:
        issues = with_pass_row(issues)
    return issues.withColumn("created_at", F.current_timestamp()) if stamp else issues


def pass_rows(spark: SparkSession) -> DataFrame:
    """The fixed row that stands for "nothing found"."""
    return spark.createDataFrame(
        [("all", "none", "DQ-PASS", "info", "No critical issues detected in the loaded sample.")],
        ", ".join(f"{c} string" for c in ISSUE_COLUMNS),
    )


def with_pass_row(issues: DataFrame) -> DataFrame:
    """Add the pass row if, and only if, the log is empty."""
    # Each task of the probe stops at its first issue.
    found = issues.select(F.lit(1).alias("_probe")).limit(1)
    passed = pass_rows(issues.sparkSession).withColumn("_probe", F.lit(1))
    return issues.unionByName(passed.join(found, "_probe", "left_anti").drop("_probe"))


def summarize(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity", "rule_id", "table_name").agg(
        F.count(F.lit(1)).alias("issue_count")
    )


def issue_counts(
    raw: Mapping[str, DataFrame],
    rules: Sequence[Rule] = CORE_RULES,
    *,
    cap: int | None = None,
    contracts: Mapping[str, Contract] | None = None,
) -> DataFrame:
    """The summary without building the log: conditional counts in one pass per table.

    Exchanges one row per task.  A rule sits on one table, so the capped count
    is the smaller of the count and the cap.
    """
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        if table not in raw:
            continue
        predicates, duplicates = _for_table(rules, table)
        frame = coerced(table, raw[table], (contracts or {}).get(table, DEFAULT))
        if predicates:
            counted = frame.agg(
                *[F.count_if(F.expr(r.predicate)).alias(r.rule_id) for r in predicates]
            )
            parts.append((counted.unpivot([], [F.col(f"`{r.rule_id}`") for r in predicates],
                                          "rule_id", "issue_count"), predicates))
        for rule in duplicates:
            members = (
                group_sizes(frame, rule.duplicate_of, "_n")
                .filter(F.col("_n") > 1)
                .agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("issue_count"))
            )
            parts.append((members.select(F.lit(rule.rule_id).alias("rule_id"), "issue_count"), [rule]))
    frames = []
    for part, owners in parts:
        severity, table_name = F.lit(None), F.lit(None)
        for r in owners:
            hit = F.col("rule_id") == r.rule_id
            severity = F.when(hit, r.severity).otherwise(severity)
            table_name = F.when(hit, f"raw.{r.table}").otherwise(table_name)
        count = F.col("issue_count") if cap is None else F.least("issue_count", F.lit(cap).cast("bigint"))
        frames.append(part.select(severity.alias("severity"), "rule_id",
                                  table_name.alias("table_name"), count.alias("issue_count")))
    return reduce(DataFrame.unionByName, frames).filter(F.col("issue_count") > 0)


def first(ordered: DataFrame, limit: int | None) -> DataFrame:
    """The whole listing, or as many rows as the caller asks for."""
    if limit is None:
        return ordered
    if limit < 1:
        raise ValueError(f"limit has to be at least 1, not {limit}")
    return ordered.limit(limit)


def ranked_summary(summary: DataFrame, limit: int | None = None) -> DataFrame:
    return first(summary.orderBy(severity_rank(), F.desc("issue_count"), "rule_id", "table_name"), limit)


def ranked_issues(issues: DataFrame, limit: int | None = None) -> DataFrame:
    """Issue listing, worst severity and newest first; keys break ties."""
    newest = [F.desc("created_at")] if "created_at" in issues.columns else []
    return first(issues.orderBy(severity_rank(), *newest, "table_name", "rule_id", "business_key"), limit)


def evaluate_rules(found: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Precision and recall per rule of found issues against known ones.

    Contract of ours: both sides hold (rule_id, *keys); repeated rows count once.
    """
    cols = ["rule_id", *keys]
    sides = (
        found.select(*cols, F.lit(1).alias("_f"), F.lit(0).alias("_t"))
        .unionByName(truth.select(*cols, F.lit(0).alias("_f"), F.lit(1).alias("_t")))
        .groupBy(*cols).agg(F.max("_f").alias("_f"), F.max("_t").alias("_t"))
    )
    scored = sides.groupBy("rule_id").agg(
        F.count_if((F.col("_f") == 1) & (F.col("_t") == 1)).alias("true_positive"),
        F.count_if((F.col("_f") == 1) & (F.col("_t") == 0)).alias("false_positive"),
        F.count_if((F.col("_f") == 0) & (F.col("_t") == 1)).alias("false_negative"),
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return scored.withColumns({
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
    })
