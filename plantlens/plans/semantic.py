"""Metric layer: datasets, metrics, charts, dashboards and access policies.

A metric is a SQL aggregate over the columns of a dataset; evaluating it is a
``groupBy`` with ``F.expr``, so Catalyst plans it like any other aggregate.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.access import visible_to
from ..operators.quality_rules import first

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Dataset:
    dataset_name: str
    physical_object: str
    business_description: str
    time_column: str | None
    recommended_dimensions: str | None


@dataclass(frozen=True)
class Metric:
    metric_name: str
    dataset_name: str
    sql_expression: str
    metric_description: str
    unit: str


@dataclass(frozen=True)
class Chart:
    chart_name: str
    viz_type: str
    dataset_name: str
    primary_metric: str
    decision_purpose: str
    group_by: tuple[str, ...] = ()
    time_grain: str | None = None


@dataclass(frozen=True)
class Dashboard:
    dashboard_name: str
    dashboard_purpose: str
    included_charts: str
    target_users: str


@dataclass(frozen=True)
class Policy:
    policy_name: str
    dataset_name: str
    sql_clause: str
    policy_description: str


OEE, QUALITY, SENSOR, GOVERNANCE, EXECUTIVE = (
    "OEE operational dataset", "Quality decision dataset", "Sensor hourly dataset",
    "Data quality governance dataset", "Executive KPI dataset",
)

# The registries.
DATASETS = (
    Dataset(OEE, "mart.v_dataset_oee_operational",
            "Line-date grain for OEE, availability, performance, quality, scrap, and output monitoring.",
            "production_date", "plant_id, line_id"),
    Dataset(QUALITY, "mart.v_dataset_quality_decision",
            "Daily quality inspection dataset for defect Pareto, defect-rate trend, and quality-risk discussion.",
            "inspection_date", "plant_id, line_id, product_family, defect_code"),
    Dataset(SENSOR, "mart.v_dataset_sensor_hourly",
            "Hourly IIoT sensor aggregation for visualization of operating behavior and anomaly signals.",
            "sensor_hour", "plant_id, line_id, machine_id"),
    Dataset(GOVERNANCE, "mart.v_dataset_dq_governance",
            "Audit-oriented summary of data quality rules, severity, and issue counts.",
            None, "severity, rule_id, table_name"),
    Dataset(EXECUTIVE, "mart.v_dashboard_kpis",
            "One-row KPI view for scorecards and dashboard heading indicators.",
            "refreshed_at", None),
)

METRICS = (
    Metric("avg_oee", OEE, "AVG(oee)", "Average overall equipment effectiveness.", "percent"),
    Metric("avg_availability", OEE, "AVG(availability)", "Average availability component of OEE.", "percent"),
    Metric("avg_performance", OEE, "AVG(performance)", "Average performance component of OEE.", "percent"),
    Metric("avg_quality", OEE, "AVG(quality)", "Average quality component of OEE.", "percent"),
    Metric("total_output_quantity", OEE, "SUM(output_quantity)", "Total production output quantity.", "units"),
    Metric("scrap_rate", OEE, "SUM(scrap_quantity) / NULLIF(SUM(output_quantity), 0)",
           "Scrap quantity divided by output quantity.", "percent"),
    Metric("defect_rate", QUALITY, "SUM(defect_count) / NULLIF(SUM(sample_size), 0)",
           "Overall defect rate from inspection samples.", "percent"),
    Metric("defect_count", QUALITY, "SUM(defect_count)", "Total number of detected defects.", "count"),
    Metric("high_defect_risk_rate", QUALITY, "AVG(high_defect_risk_rate)",
           "Average rate of high-defect-risk inspections.", "percent"),
    Metric("avg_temperature_c", SENSOR, "AVG(avg_temperature_c)", "Average operating temperature.", "celsius"),
    Metric("max_vibration_mm_s", SENSOR, "MAX(max_vibration_mm_s)",
           "Maximum vibration signal for anomaly monitoring.", "mm/s"),
    Metric("dq_issue_count", GOVERNANCE, "SUM(issue_count)", "Total number of logged data quality issues.", "count"),
)

CHARTS = (
    Chart("KPI - Average OEE", "big_number_total", OEE, "avg_oee",
          "Executive KPI card for OEE monitoring."),
    Chart("Trend - OEE by production date", "echarts_timeseries_line", OEE, "avg_oee",
          "Line chart for time-series OEE monitoring.", time_grain="P1D"),
    Chart("Bar - OEE by plant and line", "echarts_bar", OEE, "avg_oee",
          "Comparative bar chart for line performance.", ("plant_id", "line_id")),
    Chart("Pareto - Defect count by defect code", "echarts_bar", QUALITY, "defect_count",
          "Pareto-style defect prioritization chart.", ("defect_code",)),
    Chart("Bar - Data quality issues by severity", "echarts_bar", GOVERNANCE, "dq_issue_count",
          "Audit-style data quality severity chart.", ("severity",)),
    Chart("Trend - Sensor vibration by hour", "echarts_timeseries_line", SENSOR, "max_vibration_mm_s",
          "Hourly IIoT anomaly-monitoring trend chart.", time_grain="PT1H"),
)

DASHBOARDS = (
    Dashboard("Manufacturing Decision Dashboard",
              "OEE, quality, data quality, and sensor risk overview for Lecture 4.",
              "KPI - Average OEE; Trend - OEE by production date; Bar - OEE by plant and line; "
              "Pareto - Defect count by defect code; Bar - Data quality issues by severity; "
              "Trend - Sensor vibration by hour",
              "Production manager; quality analyst; data steward"),
    Dashboard("Lecture 3 Data Quality Audit Board",
              "Data profiling, cleaning issues, and validation evidence for Lecture 3 lab reporting.",
              "Bar - Data quality issues by severity",
              "Student team; instructor; data steward"),
)

_CLAUSE = ("plant_id IN (SELECT plant_id FROM mart.superset_rls_user_plant "
           "WHERE username = '{{ current_username() }}')")
POLICIES = (
    Policy("RLS - Plant scoped access", OEE, _CLAUSE,
           "Restricts OEE records to plants mapped to the current Superset username."),
    Policy("RLS - Plant scoped quality access", QUALITY, _CLAUSE,
           "Restricts quality records to plants mapped to the current Superset username."),
    Policy("RLS - Plant scoped sensor access", SENSOR, _CLAUSE,
           "Restricts sensor records to plants mapped to the current Superset username."),
)

# ISO 8601 grain to the unit ``date_trunc`` takes.
GRAINS = {"PT1H": "hour", "P1D": "day", "P1W": "week", "P1M": "month", "P1Y": "year"}

REGISTRIES = {
    "superset_dataset_registry": (DATASETS, ("dataset_name",)),
    "superset_metric_layer": (METRICS, ("dataset_name", "metric_name")),
    "superset_chart_registry": (CHARTS, ("chart_name",)),
    "superset_dashboard_registry": (DASHBOARDS, ("dashboard_name",)),
    "superset_rls_policy_registry": (POLICIES, ("policy_name",)),
}


def registry(spark: SparkSession, name: str) -> DataFrame:
    """One registry as a table with the published column names."""
    entries, _ = REGISTRIES[name]
    if name == "superset_chart_registry":
        rows = [(c.chart_name, c.viz_type, c.dataset_name, c.primary_metric, c.decision_purpose)
                for c in entries]
        names = ("chart_name", "superset_viz_type", "dataset_name", "primary_metric", "decision_purpose")
    else:
        names = tuple(entries[0].__dataclass_fields__)
        rows = [tuple(getattr(e, n) for n in names) for e in entries]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def listing(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """Registry listing in its published order."""
    return first(registry(spark, name).orderBy(*REGISTRIES[name][1]), limit)


def dashboard_charts(spark: SparkSession) -> DataFrame:
    """(dashboard, position, chart) rows from the delimited lists."""
    return registry(spark, "superset_dashboard_registry").select(
        "dashboard_name", F.posexplode(F.split("included_charts", r";\s*")).alias("position", "chart_name")
    )


def metric_named(name: str, dataset: str | None = None) -> Metric:
    found = [m for m in METRICS if m.metric_name == name and dataset in (None, m.dataset_name)]
    if len(found) != 1:
        raise KeyError(f"no single metric {name!r} in {dataset!r}")
    return found[0]


def dataset_named(name: str) -> Dataset:
    return next(d for d in DATASETS if d.dataset_name == name)


def evaluate(
    df: DataFrame, metrics: Sequence[Metric | str], dims: Sequence = (), where=None
) -> DataFrame:
    """Metrics of one dataset by dimensions; ``where`` filters rows first."""
    chosen = [metric_named(m) if isinstance(m, str) else m for m in metrics]
    source = df if where is None else df.filter(where)
    return source.groupBy(*dims).agg(*[F.expr(m.sql_expression).alias(m.metric_name) for m in chosen])


def time_bucket(df: DataFrame, dataset: str, grain: str):
    column = dataset_named(dataset).time_column
    return F.date_trunc(GRAINS[grain], F.col(column)).alias(column)


def chart_query(chart: Chart | str, datasets: Mapping[str, DataFrame], where=None) -> DataFrame:
    """Rows behind a chart: one number, a time series, or bars by descending value."""
    spec = next(c for c in CHARTS if c.chart_name == chart) if isinstance(chart, str) else chart
    source = datasets[spec.dataset_name]
    metric = metric_named(spec.primary_metric, spec.dataset_name)
    if spec.time_grain:
        bucket = time_bucket(source, spec.dataset_name, spec.time_grain)
        series = evaluate(source, [metric], [bucket, *spec.group_by], where)
        return series.orderBy(F.asc_nulls_last(dataset_named(spec.dataset_name).time_column),
                              *[F.asc_nulls_last(c) for c in spec.group_by])
    result = evaluate(source, [metric], spec.group_by, where)
    if not spec.group_by:
        return result
    return result.orderBy(F.desc_nulls_last(spec.primary_metric),
                          *[F.asc_nulls_last(c) for c in spec.group_by])


def secured(
    dataset: str, df: DataFrame, user_plants: DataFrame, username: str
) -> DataFrame:
    """Apply the access policy of a dataset; datasets without one are open."""
    if any(p.dataset_name == dataset for p in POLICIES):
        return visible_to(df, user_plants, username)
    return df


def visible_rows(
    datasets: Mapping[str, DataFrame], user_plants: DataFrame, users: Sequence[str],
) -> DataFrame:
    """Rows of each policy dataset that each user sees, from one pass over each dataset."""
    granted = user_plants.filter(F.col("username").isin(*users)).select("username", "plant_id").distinct()
    listed = user_plants.sparkSession.createDataFrame([(u,) for u in users], "username string")
    parts = []
    for name, df in datasets.items():
        by_plant = df.groupBy("plant_id").agg(F.count(F.lit(1)).alias("_n"))
        seen = by_plant.join(granted, "plant_id").groupBy("username").agg(F.sum("_n").alias("_n"))
        parts.append(listed.join(seen, "username", "left").select(
            F.lit(name).alias("dataset_name"), "username", F.coalesce("_n", F.lit(0).cast("bigint")).alias("visible_rows")))
    return reduce(DataFrame.unionByName, parts)


def dashboard_filter(
    *, time_column: str | None = None, start: date | None = None, end: date | None = None,
    plants: Sequence[str] = (), lines: Sequence[str] = (), families: Sequence[str] = (),
):
    """Dashboard filters as one predicate; both dates are inclusive."""
    terms = [F.col(c).isin(*values) for c, values in
             (("plant_id", plants), ("line_id", lines), ("product_family", families)) if values]
    if start is not None:
        terms.append(F.col(time_column) >= F.lit(start))
    if end is not None:
        terms.append(F.to_date(F.col(time_column)) <= F.lit(end))
    predicate = F.lit(True)
    for term in terms:
        predicate = predicate & term
    return predicate


def unresolved_metrics(datasets: Mapping[str, DataFrame]) -> list[str]:
    """Metrics whose expression does not analyse against its dataset."""
    broken = []
    for metric in METRICS:
        df = datasets.get(metric.dataset_name)
        try:
            if df is None:
                raise KeyError(metric.dataset_name)
            evaluate(df, [metric]).schema
        except Exception:
            logger.exception("metric %s does not resolve", metric.metric_name)
            broken.append(metric.metric_name)
    return broken


def readiness(spark: SparkSession, datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Per dataset: rows, registered metrics and charts, metrics that do not resolve."""
    broken = set(unresolved_metrics(datasets))
    parts = None
    for d in DATASETS:
        if d.dataset_name not in datasets:
            continue
        metrics = [m for m in METRICS if m.dataset_name == d.dataset_name]
        row = datasets[d.dataset_name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(d.dataset_name).alias("dataset_name"), "row_count",
            F.lit(len(metrics)).alias("metric_count"),
            F.lit(sum(c.dataset_name == d.dataset_name for c in CHARTS)).alias("chart_count"),
            F.lit(sum(p.dataset_name == d.dataset_name for p in POLICIES)).alias("policy_count"),
            F.lit(sum(m.metric_name in broken for m in metrics)).alias("unresolved_metrics"),
        )
        parts = row if parts is None else parts.unionByName(row)
    return parts
