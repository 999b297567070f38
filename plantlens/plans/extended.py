"""Declared outputs whose producing code is not published.

Each docstring states the definition we chose.  Where an output looks along
time per machine or product, rows are first aggregated to an hour or a day, so
the ordered group is bounded by the calendar and not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import date_of, flag
from ..functions.numeric import RATE, exact_avg, exact_sum, ratio
from ..operators import sketches
from ..operators.dedup import join_side, null_safe_on
from ..session import cut_lineage

# Holidays of the published calendar year.
HOLIDAYS = (
    "2025-08-18", "2025-08-25", "2025-12-27", "2026-01-26", "2026-02-23", "2026-03-29",
    "2026-04-27", "2026-05-08", "2026-05-18", "2026-05-23", "2026-07-21",
)


# -- plant, delivery, calendar ------------------------------------------------

def plant_performance(oee: DataFrame, state_events: DataFrame, machines: DataFrame, plants: DataFrame) -> DataFrame:
    """Plant summary: average line-day OEE, quantities, minutes of DOWN events.

    Downtime is the summed duration of DOWN events of the machines placed in
    the plant.  Energy intensity is left out: no table carries its source.
    """
    down = (
        state_events.filter(F.col("state_code") == "DOWN")
        .groupBy("machine_id").agg(exact_sum("event_duration_minutes").alias("_minutes"))
        .join(machines.select("machine_id", "plant_id"), "machine_id", "inner")
        .groupBy("plant_id").agg(exact_sum("_minutes").alias("total_downtime_minutes"))
    )
    output = oee.groupBy("plant_id").agg(
        exact_avg("oee", RATE).alias("avg_oee"),
        exact_sum("good_quantity").alias("total_good_quantity"),
        exact_sum("scrap_quantity").alias("total_scrap_quantity"),
    )
    return (
        plants.select("plant_id", "plant_name")
        .join(output, "plant_id", "left").join(down, "plant_id", "left")
    )


def root_cause_counts(shipments: DataFrame) -> DataFrame:
    """Shipments per root cause."""
    return shipments.groupBy("root_cause").agg(F.count(F.lit(1)).alias("shipment_count"))


def calendar_columns(day: str, holidays: Sequence[str] = HOLIDAYS) -> list[Column]:
    """Calendar attributes of a date column.

    Week of year counts from the first Sunday (days before it are week 0);
    the fiscal year starts in October.
    """
    d = F.col(day)
    holiday = d.isin(*[F.to_date(F.lit(h)) for h in holidays])
    return [
        d.alias("date"),
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int").alias("week_of_year"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).cast("int").alias("is_weekend"),
        flag(holiday).alias("is_holiday"),
        (F.year(d) + F.when(F.month(d) >= 10, 1).otherwise(0)).cast("bigint").alias("fiscal_year"),
    ]


def date_span(df: DataFrame, column: str, name: str = "date") -> DataFrame:
    """Every date from the first to the last one in ``column``."""
    bounds = df.agg(F.min(date_of(column)).alias("lo"), F.max(date_of(column)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias(name))


def calendar(df: DataFrame, column: str, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Calendar dimension over the dates a fact table spans."""
    return date_span(df, column, "_day").select(*calendar_columns("_day", holidays))


def daily_demand(sales_orders: DataFrame) -> DataFrame:
    """Daily demand per product, dense over all dates, with lags and a trailing mean.

    Days without orders have demand 0.  The dense frame comes from exploding
    the date range per product, so there is no join of products with dates;
    windows then run over one row per product and day.
    """
    bounds = sales_orders.agg(
        F.min(date_of("order_date")).alias("lo"), F.max(date_of("order_date")).alias("hi")
    )
    low, high = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    dense = sales_orders.select("product_id").distinct().select(
        "product_id", F.explode(F.sequence(low, high)).alias("demand_date")
    )
    demand = sales_orders.groupBy("product_id", date_of("order_date").alias("demand_date")).agg(
        exact_sum("ordered_quantity").alias("_quantity"), F.count(F.lit(1)).alias("_lines")
    )
    by_day = Window.partitionBy("product_id").orderBy("demand_date")
    week = by_day.rowsBetween(-7, -1)
    quantity = F.col("demand_quantity")
    return (
        dense.join(demand, ["product_id", "demand_date"], "left")
        .select(
            "product_id", "demand_date",
            F.coalesce("_quantity", F.lit(0.0)).alias("demand_quantity"),
            F.coalesce("_lines", F.lit(0).cast("bigint")).alias("order_lines"),
        )
        .withColumns({
            "lag_1": F.lag(quantity, 1).over(by_day),
            "lag_7": F.lag(quantity, 7).over(by_day),
            "mean_prior_7d": F.try_divide(
                exact_sum(quantity, over=week),
                F.count(quantity).over(week),
            ),
        })
    )


def demand_runs(sales_orders: DataFrame, back: int = 7) -> DataFrame:
    """``daily_demand`` with idle days written as runs: (product_id, from_date, to_date, ...).

    A day is idle when neither it nor the ``back`` days before it have an order
    and all of these days lie within the calendar; its demand, lags and mean
    are 0.  All other days are a run of one day.  Windows run over the order
    days of a product (at most one row a date of the calendar); each then gives
    the days up to the next one, so what moves is one row an order day, not one
    a product and date.  ``expand_runs`` gives the dense frame.
    """
    bounds = sales_orders.agg(F.min(date_of("order_date")).alias("lo"), F.max(date_of("order_date")).alias("hi"))
    low, high = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    lines = sales_orders.filter(F.col("order_date").isNotNull()).select(
        "product_id", date_of("order_date").alias("day"), "ordered_quantity", F.lit(1).cast("bigint").alias("lines"))
    # The first days have a short past, so they are never idle: every product states the first day.
    begun = sales_orders.select("product_id").distinct().select(
        "product_id", low.alias("day"), F.lit(None).cast("double").alias("ordered_quantity"), F.lit(0).cast("bigint").alias("lines"))
    stated = lines.unionByName(begun).groupBy("product_id", "day").agg(
        exact_sum("ordered_quantity").alias("quantity"), F.sum("lines").alias("lines"))
    by_day = Window.partitionBy("product_id").orderBy(F.unix_date("day"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    on = lambda k: F.max("quantity").over(by_day.rangeBetween(-k, -k))
    # A day k days on is preceded by the days up to this one alone, as it comes before the next stated day.
    past = lambda k: exact_sum("quantity", over=by_day.rangeBetween(k - back, 0 if k else -1))
    placed = stated.withColumns({
        "_following": F.coalesce(F.lead("day").over(by_day), F.date_add(high, 1)),
        "_before": on(1),
        **{f"_past{k}": past(k) for k in range(back + 1)},
        **{f"_back{k}": on(back - k) for k in range(back)},
    }).withColumn("_last", F.least(
        F.date_add("day", F.when(F.col("lines") > 0, back).otherwise(back - 1)), F.date_sub("_following", 1)))
    nothing, none = F.lit(0.0), F.lit(0).cast("bigint")

    def busy(k: int) -> Column:
        day = F.date_add("day", k)
        age = F.datediff(day, low)
        lag_1 = zero(F.col("_before")) if k == 0 else zero(F.col("quantity")) if k == 1 else nothing
        return F.struct(
            day.alias("from_date"), day.alias("to_date"),
            (nothing if k else zero(F.col("quantity"))).alias("demand_quantity"),
            (none if k else F.col("lines")).alias("order_lines"), F.when(age >= 1, lag_1).alias("lag_1"),
            F.when(age >= back, zero(F.col("quantity" if k == back else f"_back{k}"))).alias("lag_7"),
            F.try_divide(zero(F.col(f"_past{k}")), F.least(F.lit(back), age)).alias("mean_prior_7d"))

    idle = F.struct(
        F.date_add("_last", 1).alias("from_date"), F.date_sub("_following", 1).alias("to_date"),
        nothing.alias("demand_quantity"), none.alias("order_lines"), nothing.alias("lag_1"), nothing.alias("lag_7"),
        nothing.alias("mean_prior_7d"))
    runs = F.slice(F.array(*[busy(k) for k in range(back + 1)]), F.lit(1), F.datediff("_last", "day") + 1)
    left = F.filter(F.array(idle), lambda r: r["from_date"] <= r["to_date"])
    return placed.select("product_id", F.inline(F.concat(runs, left)))


def expand_runs(runs: DataFrame) -> DataFrame:
    """One row a product and date, as ``daily_demand`` returns them."""
    return runs.withColumn("demand_date", F.explode(F.sequence("from_date", "to_date"))).drop("from_date", "to_date")


# -- machine failure, alarms, downtime ---------------------------------------

def machine_failure_features(hourly: DataFrame, failures: DataFrame) -> DataFrame:
    """Machine-day features and the label "fails within the next seven days".

    ``max_vibration_24h`` is the highest vibration in the 24 hours that end with
    the last reported hour of the day; the label looks at days 1 to 7 after the
    day.  Both windows run over machine-hours and machine-days.
    """
    hours = hourly.groupBy("machine_id", "sensor_hour").agg(
        F.max("max_vibration_mm_s").alias("vibration"),
        F.max("max_temperature_c").alias("temperature"),
        F.sum("reading_count").alias("readings"),
    ).withColumn("_sec", F.unix_seconds(F.col("sensor_hour").cast("timestamp")))
    day_back = Window.partitionBy("machine_id").orderBy("_sec").rangeBetween(-23 * 3600, 0)
    rolled = hours.withColumn("_v24", F.max("vibration").over(day_back))
    days = rolled.groupBy("machine_id", date_of("sensor_hour").alias("feature_date")).agg(
        F.max_by("_v24", "_sec").alias("max_vibration_24h"),
        F.max("temperature").alias("max_temperature_c"),
        F.sum("readings").alias("reading_count"),
        F.lit(0).cast("bigint").alias("failures"),
        F.lit(1).alias("_observed"),
    )
    failed = failures.groupBy("machine_id", date_of("failure_time").alias("feature_date")).agg(
        F.lit(None).cast("double").alias("max_vibration_24h"),
        F.lit(None).cast("double").alias("max_temperature_c"),
        F.lit(0).cast("bigint").alias("reading_count"),
        F.count(F.lit(1)).alias("failures"),
        F.lit(0).alias("_observed"),
    )
    # One row per machine-day on each side: the union replaces a range join.
    ahead = Window.partitionBy("machine_id").orderBy("_day").rangeBetween(1, 7)
    both = days.unionByName(failed).withColumn("_day", F.unix_date("feature_date"))
    labelled = both.withColumn(
        "failure_within_7d", F.when(F.coalesce(F.sum("failures").over(ahead), F.lit(0)) > 0, 1).otherwise(0)
    )
    return labelled.filter(F.col("_observed") == 1).select(
        "machine_id", "feature_date", "max_vibration_24h", "max_temperature_c",
        "reading_count", "failure_within_7d",
    )


def alarm_watchlist(alarms: DataFrame, threshold: int = 2) -> DataFrame:
    """Machine-days whose alarms of the last seven days reach the threshold.

    Seven days are the day itself and the six before it, counted by date.
    """
    daily = alarms.groupBy("machine_id", date_of("alarm_time").alias("alarm_date")).agg(
        F.count(F.lit(1)).alias("alarms_on_day")
    )
    week = (
        Window.partitionBy("machine_id").orderBy(F.unix_date("alarm_date")).rangeBetween(-6, 0)
    )
    return daily.withColumn("alarms_7d", F.sum("alarms_on_day").over(week)).filter(
        F.col("alarms_7d") >= threshold
    )


def downtime_by_reason(state_events: DataFrame) -> DataFrame:
    """Events and minutes per machine, state and reason."""
    return state_events.groupBy("machine_id", "state_code", "reason_code").agg(
        F.count(F.lit(1)).alias("event_count"),
        exact_sum("event_duration_minutes").alias("total_minutes"),
    )


# -- risk tables --------------------------------------------------------------

def quality_risk(
    features: DataFrame, products: DataFrame, suppliers: DataFrame, operators: DataFrame
) -> DataFrame:
    """Quality features, made with ``carry=["operator_id"]``, with the supplier score of the
    product and the operator group."""
    source = products.select("product_id", F.col("primary_supplier_id").alias("supplier_id"))
    score = suppliers.select("supplier_id", F.col("quality_score").alias("supplier_quality_score"))
    group = operators.select("operator_id", F.col("fairness_group").alias("operator_fairness_group"))
    return (
        features.join(source, "product_id", "left")
        .join(score, "supplier_id", "left")
        .join(group, "operator_id", "left")
    )


def delivery_risk(delivery: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Delivery lines with customer segment, product family and promised lead time."""
    who = customers.select("customer_id", "customer_segment", "credit_risk_score")
    what = products.select("product_id", "product_family", "complexity_score")
    lead = F.datediff(date_of("promised_delivery_date"), date_of("order_date")).cast("bigint")
    return (
        delivery.join(who, "customer_id", "left").join(what, "product_id", "left")
        .withColumn("promised_lead_days", lead)
    )


# -- monitoring, fairness, privacy --------------------------------------------

def drift_report(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Mean shift and population stability index per feature.

    Bins are equal-width between the smallest and largest reference value;
    values outside fall into the edge bins, and an empty bin counts as 0.0001
    of its window.  Missing values are left out.
    """
    value = lambda c: F.col(c).cast("double")
    both = (
        reference.select(F.lit(1).alias("_ref"), *[value(c).alias(c) for c in features])
        .unionByName(current.select(F.lit(0).alias("_ref"), *[value(c).alias(c) for c in features]))
        .unpivot("_ref", list(features), "feature", "x")
        .filter(F.col("x").isNotNull())
    )
    limits = reference.agg(*[
        F.struct(F.min(value(c)).alias("lo"), F.max(value(c)).alias("hi")).alias(c) for c in features
    ])
    # One row with a range per feature, looked up as a scalar.
    ranges = limits.select(
        F.create_map(*[part for c in features for part in (F.lit(c), F.col(c))])
    ).scalar()
    of_feature = F.element_at(ranges, F.col("feature"))
    low, high = of_feature.getField("lo"), of_feature.getField("hi")
    slot = F.floor(F.try_divide((F.col("x") - low) * bins, high - low))
    binned = both.withColumn(
        "bin", F.coalesce(F.greatest(F.lit(0), F.least(F.lit(bins - 1), slot)), F.lit(0)).cast("int")
    )
    is_ref = F.col("_ref") == 1
    counts = binned.groupBy("feature", "bin").agg(
        F.count_if(is_ref).alias("ref_n"),
        F.count_if(~is_ref).alias("cur_n"),
        exact_sum(F.when(is_ref, F.col("x"))).alias("ref_sum"),
        exact_sum(F.when(~is_ref, F.col("x"))).alias("cur_sum"),
    )
    # At most ``bins`` rows per feature from here on.
    of = Window.partitionBy("feature")
    total = lambda c: F.sum(c).over(of)
    share = lambda c: F.greatest(F.try_divide(F.col(c), total(c)), F.lit(0.0001))
    parted = counts.withColumns({"p": share("ref_n"), "q": share("cur_n")})
    return parted.groupBy("feature").agg(
        F.sum("ref_n").alias("ref_rows"),
        F.sum("cur_n").alias("cur_rows"),
        F.try_divide(exact_sum("ref_sum"), F.sum("ref_n")).alias("ref_mean"),
        F.try_divide(exact_sum("cur_sum"), F.sum("cur_n")).alias("cur_mean"),
        F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi"),
    ).withColumn("mean_shift", F.col("cur_mean") - F.col("ref_mean"))


def _psi(counts: DataFrame) -> DataFrame:
    """Population stability index per feature from (feature, bin, ref_n, cur_n)."""
    of = Window.partitionBy("feature")
    share = lambda c: F.greatest(F.try_divide(F.col(c), F.sum(c).over(of)), F.lit(0.0001))
    parted = counts.withColumns({"p": share("ref_n"), "q": share("cur_n")})
    return parted.groupBy("feature").agg(
        F.sum("ref_n").alias("ref_rows"), F.sum("cur_n").alias("cur_rows"),
        F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi"))


def quantile_drift(reference: DataFrame, current: DataFrame, bins: int = 10) -> DataFrame:
    """Stability index over reference quantile bins, and both medians, from two sketches.

    The windows are sketches (``operators.sketches``), merged from whatever
    days or sites they cover, so no raw row is read again.  Shares are exact;
    bin edges and medians are within a bucket's width (2**-7 of the value) of
    the exact quantiles.  A bin empty in one window counts as 0.0001 of it.
    """
    median = lambda df, name: sketches.quantiles(df, [0.5]).select("feature", F.col("q_0").alias(name))
    return (
        _psi(sketches.quantile_bins(reference, current, bins))
        .join(median(reference, "ref_median"), "feature", "left")
        .join(median(current, "cur_median"), "feature", "left")
        .withColumn("median_shift", F.col("cur_median") - F.col("ref_median"))
    )


def fairness_audit(scored: DataFrame, group: str, predicted: str, actual: str) -> DataFrame:
    """Selection and error rates per group of a 0/1 decision against a 0/1 outcome."""
    p, a = F.col(predicted) == 1, F.col(actual) == 1
    counts = scored.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(p).alias("selected"),
        F.count_if(a).alias("positives"),
        F.count_if(p & ~a).alias("false_positives"),
        F.count_if(~p & a).alias("false_negatives"),
    )
    return counts.withColumns({
        "selection_rate": ratio("selected", "rows"),
        "false_positive_rate": F.try_divide(F.col("false_positives"), F.col("rows") - F.col("positives")),
        "false_negative_rate": ratio("false_negatives", "positives"),
    })


def anonymity_groups(records: DataFrame, quasi_identifiers: Sequence[str]) -> DataFrame:
    """Group size per combination of quasi-identifiers."""
    return records.groupBy(*quasi_identifiers).agg(F.count(F.lit(1)).alias("k_anonymity_group_size"))


def with_group_size(records: DataFrame, quasi_identifiers: Sequence[str]) -> DataFrame:
    """Every record with the size of its group.

    Sizes are counted map-side and joined back, so a group that holds a third
    of the records is never gathered; missing values match each other.
    """
    sizes = join_side(records, quasi_identifiers, "k_anonymity_group_size")
    return records.join(sizes, null_safe_on(records, sizes, quasi_identifiers), "left").drop(
        *[f"_{c}" for c in quasi_identifiers]
    )


MOST_IDENTIFIERS = 12  # subsets double with each one


def subset_anonymity(records: DataFrame, quasi_identifiers: Sequence[str]) -> DataFrame:
    """Smallest group of every non-empty subset of the quasi-identifiers.

    Returns (identifiers, size, smallest_group, groups, rows_alone, computed).
    Records are counted once by all identifiers; levels of the subset lattice
    are then grouping sets over these counts, one aggregation a level.  A record
    that is alone under a subset is alone under every larger one, so subsets
    above one with a smallest group of 1 are not computed: their smallest group
    is 1, the other counts are null.  Missing values match each other.
    """
    names = list(quasi_identifiers)
    if len(names) > MOST_IDENTIFIERS:
        raise ValueError(f"at most {MOST_IDENTIFIERS} quasi-identifiers, not {len(names)}")
    spark = records.sparkSession
    cells = cut_lineage(records.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")))
    alone: list[frozenset] = []
    rows = []
    for size in range(1, len(names) + 1):
        level = [frozenset(c) for c in combinations(names, size)]
        wanted = [s for s in level if not any(a <= s for a in alone)]
        found = {}
        if wanted:
            sets = [[F.col(n) for n in names if n in s] for s in wanted]
            sizes = cells.groupingSets(sets, *names).agg(F.sum("_n").alias("_n"), F.grouping_id().alias("_set"))
            found = {r["_set"]: r for r in sizes.groupBy("_set").agg(
                F.min("_n").alias("smallest"), F.count(F.lit(1)).alias("groups"),
                F.count_if(F.col("_n") == 1).alias("alone")).collect()}  # one row a subset
        for s in level:
            # The set's number has a bit for each column that is left out, the last column lowest.
            bits = sum(1 << (len(names) - 1 - i) for i, n in enumerate(names) if n not in s)
            r, label = found.get(bits), ",".join(n for n in names if n in s)
            if s in wanted:
                rows.append((label, size, *((r["smallest"], r["groups"], r["alone"]) if r else (None, 0, 0)), True))
                if r and r["smallest"] == 1:
                    alone.append(s)
            else:
                rows.append((label, size, 1, None, None, False))
    return spark.createDataFrame(
        rows, "identifiers string, size int, smallest_group long, groups long, rows_alone long, computed boolean")


# -- partitions, graph, cohorts -----------------------------------------------

def client_counts(features: DataFrame) -> DataFrame:
    """Rows per plant client; rows without a plant belong to no client."""
    return features.filter(F.col("plant_id").isNotNull()).groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("sample_count")
    ).select(F.concat(F.lit("client_"), F.col("plant_id")).alias("client_id"), "plant_id", "sample_count")


def graph_nodes(machines: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Machines (age), products (complexity) and suppliers (score) as nodes."""
    none = F.lit(None).cast("string")
    node = lambda df, key, kind, value, plant, line: df.select(
        F.col(key).cast("string").alias("node_id"), F.lit(kind).alias("node_type"),
        plant.alias("plant_id"), line.alias("line_id"),
        F.col(value).cast("double").alias("feature_value"),
    )
    return (
        node(machines, "machine_id", "machine", "machine_age_years", F.col("plant_id"), F.col("line_id"))
        .unionByName(node(products, "product_id", "product", "complexity_score", none, none))
        .unionByName(node(suppliers, "supplier_id", "supplier", "quality_score", none, none))
    )


def supply_edges(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Supplier to product, weighted with the supplier's score over 100."""
    score = suppliers.select(F.col("supplier_id").alias("primary_supplier_id"), "quality_score")
    return products.join(score, "primary_supplier_id", "inner").select(
        F.col("primary_supplier_id").cast("string").alias("source_id"),
        F.col("product_id").cast("string").alias("target_id"),
        F.lit("supplies").alias("edge_type"),
        (F.col("quality_score") / F.lit(100.0)).alias("weight"),
    )


def process_edges(runs: DataFrame) -> DataFrame:
    """Product to machine, weighted with the share of the product's runs.

    The published weights cannot be derived; the share is our choice.
    """
    pairs = runs.filter(F.col("product_id").isNotNull() & F.col("machine_id").isNotNull()).groupBy(
        "product_id", "machine_id"
    ).agg(F.count(F.lit(1)).alias("_n"))
    totals = pairs.groupBy(F.col("product_id").alias("_p")).agg(F.sum("_n").alias("_total"))
    return pairs.join(totals, pairs["product_id"] == totals["_p"], "inner").select(
        F.col("product_id").cast("string").alias("source_id"),
        F.col("machine_id").cast("string").alias("target_id"),
        F.lit("processed_by").alias("edge_type"),
        (F.col("_n") / F.col("_total")).alias("weight"),
    )


def node_degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree per node id and role."""
    outgoing = edges.select("edge_type", F.col("source_id").alias("node_id"),
                            F.lit(1).alias("o"), F.lit(0).alias("i"))
    incoming = edges.select("edge_type", F.col("target_id").alias("node_id"),
                            F.lit(0).alias("o"), F.lit(1).alias("i"))
    return outgoing.unionByName(incoming).groupBy("edge_type", "node_id").agg(
        F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree")
    )


def supplier_machines(supplies: DataFrame, processed: DataFrame) -> DataFrame:
    """Two hops: products that connect a supplier to a machine.

    A product has one primary supplier, so the join keeps the number of
    ``processed_by`` edges.
    """
    first = supplies.select(F.col("source_id").alias("supplier_id"), F.col("target_id").alias("product_id"))
    second = processed.select(F.col("source_id").alias("product_id"), F.col("target_id").alias("machine_id"))
    return second.join(first, "product_id", "inner").groupBy("supplier_id", "machine_id").agg(
        F.count(F.lit(1)).alias("shared_products")
    )


def cohort_compare(df: DataFrame, cohort: Column, measures: Sequence[str]) -> DataFrame:
    """Row count and measure averages of a scenario cohort against the rest."""
    return df.groupBy(F.when(cohort, F.lit("cohort")).otherwise(F.lit("rest")).alias("cohort")).agg(
        F.count(F.lit(1)).alias("rows"), *[exact_avg(m, RATE).alias(f"avg_{m}") for m in measures]
    )


def urgent_speed_cohort() -> Column:
    """Urgent work orders run faster than standard by more than five percent."""
    return (F.col("priority_level") == "urgent") & (F.col("speed_ratio") > 1.05)


def supplier_window_cohort(supplier: str, start: str, end: str, day: str = "run_date") -> Column:
    """Runs on products of one supplier between two dates, both inclusive."""
    return (F.col("supplier_id") == supplier) & F.col(day).between(
        F.to_date(F.lit(start)), F.to_date(F.lit(end))
    )
