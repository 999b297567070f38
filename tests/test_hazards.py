"""Missing-value, parsing and ordering behaviour on small hand-made frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plantlens.functions import coerce as fx
from plantlens.functions.numeric import clamp_zero, exact_avg, ratio, round_half_up
from plantlens.operators import access, dedup, quality_rules as qr
from plantlens.plans import clean, dashboard, marts, semantic


def column(df, name):
    return [r[name] for r in df.collect()]


def test_clamp_keeps_missing(spark):
    df = spark.createDataFrame([(-2.0,), (3.0,), (None,)], "x double")
    assert column(df.select(clamp_zero("x").alias("y")), "y") == [0.0, 3.0, None]


def test_flags_treat_missing_as_false(spark):
    df = spark.createDataFrame([(None, -1.0), (None, 1.0), (1.0, 1.0)], "a double, b double")
    got = df.select(fx.flag(F.col("a") < 0, F.col("b") < 0, any_of=True).alias("y"))
    assert column(got, "y") == [1, 0, 0]


def inspection(rows, **values):
    base = dict(inspection_id="I1", inspection_datetime="2026-01-02 03:04:05", sample_size="100",
                defect_count="1", measurement_1="2", lower_spec_limit="1", upper_spec_limit="4",
                pass_fail=" Pass ", defect_code=" scratch", _ingest_row="1")
    base.update(values)
    return rows(list(base), [tuple(base.values())])


def test_unmeasured_part_is_at_risk(rows):
    got = clean.quality_inspections(inspection(rows, measurement_1=None)).first()
    assert (got["within_spec_flag"], got["high_defect_risk"]) == (0, 1)
    got = clean.quality_inspections(inspection(rows)).first()
    assert (got["within_spec_flag"], got["high_defect_risk"]) == (1, 0)
    assert (got["pass_fail"], got["defect_code"]) == ("pass", "SCRATCH")


def test_risk_conditions(rows):
    risk = lambda **v: clean.quality_inspections(inspection(rows, **v)).first()["high_defect_risk"]
    assert risk(defect_count="5") == 1          # exactly five percent
    assert risk(pass_fail="FAIL ") == 1
    assert risk(measurement_1="4") == 0         # limits are inclusive
    assert risk(measurement_1="4.01") == 1
    assert risk(sample_size="0", defect_count="9") == 0  # no rate without a sample


def test_parity_text(rows):
    raw = inspection(rows, defect_code=None)
    assert clean.quality_inspections(raw).first()["defect_code"] is None
    assert clean.quality_inspections(raw, parity=True).first()["defect_code"] == "NONE"


def test_timestamp_formats(rows):
    texts = ["2026-01-02 03:04:05", "2026-01-02T03:04:05.25", "2026-01-02", "02/01/2026 03:04",
             "2026/01/02 03:04:05", "02-01-2026", "31/31/2026", "soon", None]
    df = rows(["t"], [(t,) for t in texts])
    got = column(df.select(fx.to_timestamp("t").cast("string").alias("p")), "p")
    assert got == ["2026-01-02 03:04:05", "2026-01-02 03:04:05.25", "2026-01-02 00:00:00",
                   "2026-01-02 03:04:00", "2026-01-02 03:04:05", "2026-01-02 00:00:00", None, None, None]
    strict = column(df.select(fx.to_timestamp("t", strict=True).cast("string").alias("p")), "p")
    assert strict[:3] == got[:3] and strict[3:] == [None] * 6


def test_numbers_from_text(rows):
    df = rows(["t"], [(t,) for t in ["1.5", " 2 ", "ERR", "NaN", "inf", "", None, "1e3"]])
    assert column(df.select(fx.to_number("t").alias("x")), "x") == [1.5, 2.0, None, None, None, None, None, 1000.0]


def test_null_tokens(rows):
    df = rows(["t"], [(t,) for t in ["NA", "null", "", "x", "None", "n/a", None, "nano"]])
    assert column(df.select(fx.tokens_to_null("t").alias("x")), "x") == [
        None, None, None, "x", None, None, None, "nano"]


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 8.0)], "a double, b double")
    assert column(df.select(ratio("a", "b").alias("r")), "r") == [None, None, 0.125]
    ties = spark.createDataFrame([(0.12345,), (-0.12345,), (0.00005,)], "a double")
    assert column(ties.select(round_half_up("a").alias("r")), "r") == [0.1235, -0.1235, 0.0001]


def test_latest_record_wins_and_missing_load_time_is_latest(rows):
    raw = rows(["work_order_id", "load_timestamp", "actual_quantity", "rejected_quantity", "planned_quantity",
                "actual_start_datetime", "actual_end_datetime", "planned_end_datetime", "work_order_status",
                "priority_level", "_ingest_row"], [
        ("W1", "2026-01-02", "10", "1", "10", None, None, None, " Done ", None, "1"),
        ("W1", "2026-01-01", "20", "1", "10", None, None, None, "Done", None, "2"),
        ("W2", "2026-01-02", "30", "40", "0", "2026-01-02", "2026-01-01", "2026-01-01 12:00", "x", "HIGH", "3"),
        ("W2", "not a date", "50", "60", "0", "2026-01-02", "2026-01-01", "2026-01-01 12:00", "x", "HIGH", "4"),
    ])
    got = {r["work_order_id"]: r for r in clean.work_orders(raw).collect()}
    assert got["W1"]["actual_quantity"] == 10.0 and got["W1"]["yield_rate"] == 0.9
    assert got["W1"]["work_order_status"] == "done" and got["W1"]["priority_level"] is None
    w2 = got["W2"]
    assert w2["actual_quantity"] == 50.0 and w2["good_quantity"] == 0.0
    assert w2["production_attainment"] is None and w2["invalid_record_flag"] == 1
    assert w2["schedule_delay_minutes"] == -720.0
    assert "_ingest_row" not in got["W1"].asDict()


def test_sensor_rows_without_time_collapse(rows):
    raw = rows(["timestamp", "machine_id", "sensor_id", "temperature_c", "vibration_mm_s", "pressure_bar",
                "current_amp", "speed_rpm", "operating_state", "_ingest_row"], [
        ("bad", "M1", "S1", "20", "1", "1", "1", "1", " run", "1"),
        ("worse", "M1", "S1", "30", "1", "1", "1", "1", "run", "2"),
        ("2026-01-01 10:59:59", "M1", "S1", "151", "1", "1", "1", "1", "run", "3"),
        ("2026-01-01 11:00:00", "M1", "S1", "150", "0", "0", None, "1", "run", "4"),
        ("2026-01-01 12:00:00", "M1", "S1", "0", "0", "0", "0", "1", "run", "5"),
    ])
    got = sorted(clean.sensor_readings(raw).collect(), key=lambda r: r["temperature_c"])
    assert [r["temperature_c"] for r in got] == [0.0, 30.0, 150.0, 151.0]
    assert [r["sensor_valid_flag"] for r in got] == [1, 1, 0, 0]
    assert got[3]["sensor_hour"] == dt.datetime(2026, 1, 1, 10) and got[0]["operating_state"] == "RUN"


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1), (None, 3)], "k int, o int")
    once = dedup.keep_last(df, ["k"], ["o"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(
        map(tuple, dedup.keep_last(once, ["k"], ["o"]).collect()), key=str) == [(1, 2), (None, 3)]


def test_every_duplicate_member_is_flagged(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert sorted((str(r["k"]), r["is_duplicate"]) for r in dedup.flag_duplicates(df, ["k"]).collect()) == [
        ("1", 1), ("1", 1), ("2", 0), ("None", 1), ("None", 1)]
    assert dedup.duplicate_members(df, ["k"]).count() == 4


def run_frame(rows, data):
    return rows(["run_id", "run_start_datetime", "run_end_datetime", "input_quantity", "output_quantity",
                 "scrap_quantity", "_ingest_row"], data)


def test_run_rules(rows):
    raw = run_frame(rows, [
        ("R1", "2026-01-02", "2026-01-02", "10", "12", "0", "1"),    # no duration; 1.2 times input is fine
        ("R2", "2026-01-01", "2026-01-02", "10", "12.1", "0", "2"),  # too much output
        ("R3", "2026-01-01", None, "10", None, "-1", "3"),           # negative scrap
        ("R4", "2026-01-01", "2026-01-02", None, "5", None, "4"),    # nothing to compare
    ])
    got = sorted((r["rule_id"], r["business_key"]) for r in qr.issue_log({"production_run": raw}, stamp=False).collect())
    assert got == [("DQ-RUN-QTY", "R2"), ("DQ-RUN-QTY", "R3"), ("DQ-RUN-TIME", "R1")]


def test_status_rule_does_not_trim(rows):
    columns = ["work_order_id", "work_order_status", "actual_start_datetime", "actual_end_datetime",
               "planned_quantity", "actual_quantity", "rejected_quantity"]
    raw = rows(columns, [("A", "COMPLETED", "2026-01-01", None, "1", "1", "0"),
                         ("B", " completed", "2026-01-01", None, "1", "1", "0"),
                         ("C", "completed", "2026-01-01", "2026-01-02", "1", "1", "-1")])
    got = sorted((r["rule_id"], r["business_key"]) for r in qr.issue_log({"work_order": raw}, stamp=False).collect())
    assert got == [("DQ-WO-MISSING-END", "A"), ("DQ-WO-QTY", "C")]
    # The flag of the clean table does not look at rejected quantities.
    cleaned = clean.work_orders(raw.withColumns({
        "load_timestamp": F.lit("2026-01-01"), "planned_end_datetime": F.lit(None).cast("string")}))
    assert {r["work_order_id"]: r["invalid_record_flag"] for r in cleaned.collect()} == {"A": 0, "B": 0, "C": 0}


def test_pass_row_cap_and_counts(rows):
    good = run_frame(rows, [("R1", "2026-01-01", "2026-01-02", "10", "10", "0", "1")])
    assert [r["rule_id"] for r in qr.issue_log({"production_run": good}).collect()] == ["DQ-PASS"]
    bad = run_frame(rows, [(f"R{i}", "2026-01-02", "2026-01-01", "1", "1", "0", f"{i:02d}") for i in range(7)])
    log = qr.issue_log({"production_run": bad}, cap=3, order={"production_run": ("_ingest_row",)}, stamp=False)
    assert sorted(column(log, "business_key")) == ["R0", "R1", "R2"]
    for cap, want in ((None, 7), (3, 3)):
        counts = qr.issue_counts({"production_run": bad}, cap=cap).collect()
        assert [(r["rule_id"], r["severity"], r["table_name"], r["issue_count"]) for r in counts] == [
            ("DQ-RUN-TIME", "high", "raw.production_run", want)]


def test_missing_place_forms_a_group(spark):
    runs = spark.createDataFrame(
        [("R1", None, "M1", "2026-01-01", 10.0), ("R2", "W9", "M1", "2026-01-01", 10.0), ("R3", "W1", "M1", None, 1.0)],
        "run_id string, work_order_id string, machine_id string, d string, q double",
    ).select("run_id", "work_order_id", "machine_id", F.to_timestamp("d").alias("run_start_datetime"),
             *[F.col("q").alias(c) for c in ("runtime_minutes", "idle_minutes", "setup_minutes", "output_quantity",
                                             "scrap_quantity", "good_quantity", "speed_standard_ppm")])
    orders = spark.createDataFrame([("W1", "P1", "L1")], "work_order_id string, plant_id string, line_id string")
    got = marts.oee_daily_line(runs, orders).collect()
    assert [(r["plant_id"], r["run_count"], r["active_machine_count"]) for r in got] == [(None, 2, 1)]
    assert got[0]["availability"] == 20 / 60 and got[0]["performance"] == 20 / 200


def test_several_inspections_fan_out(spark):
    one = lambda **v: spark.createDataFrame([tuple(v.values())], list(v))
    runs = one(run_id="R1", work_order_id="W1", machine_id="M1", run_start_datetime=dt.datetime(2026, 1, 1),
               setup_minutes=1.0, runtime_minutes=1.0, idle_minutes=1.0, speed_ratio=1.0, scrap_rate=0.0)
    runs = runs.unionByName(runs.withColumn("run_id", F.lit("R2")))
    orders = one(work_order_id="W1", plant_id="P1", line_id="L1", product_id="X")
    products = one(product_id="X", product_family="F", complexity_score=1.0)
    machines = one(machine_id="M1", machine_age_years=1.0, criticality="low")
    inspections = spark.createDataFrame([("R1", 0.1, 1), ("R1", 0.2, 0)], "run_id string, defect_rate double, high_defect_risk int")
    hourly = spark.createDataFrame([], "sensor_hour timestamp, machine_id string, avg_temperature_c double, "
                                       "max_vibration_mm_s double, sensor_valid_rate double")
    got = marts.quality_features(runs, orders, products, machines, inspections, hourly).collect()
    assert sorted((r["run_id"], r["defect_rate"]) for r in got) == [("R1", 0.1), ("R1", 0.2), ("R2", 0.0)]
    assert {(r["sensor_valid_rate"], r["avg_temperature_c"]) for r in got} == {(1.0, 0.0)}


def test_unshipped_line_is_on_time_and_copies_multiply(spark):
    orders = spark.createDataFrame(
        [(1, 1, 10.0, 2.0, 50.0), (1, 1, 10.0, 2.0, 50.0), (2, 1, 1.0, 1.0, None)],
        "sales_order_id int, order_line_id int, ordered_quantity double, unit_price double, discount_pct double",
    ).withColumns({c: F.lit(None).cast("string") for c in
                   ("customer_id", "product_id", "order_date", "promised_delivery_date", "customer_priority")})
    shipped = spark.createDataFrame(
        [(1, 1, 10.0, 1.0, 3.0, "logistics")],
        "sales_order_id int, order_line_id int, shipped_quantity double, late_delivery_flag double, delay_days double, root_cause string",
    ).withColumn("ship_date", F.lit(None).cast("timestamp"))
    got = sorted((r["sales_order_id"], r["net_order_value"], r["late_delivery_flag"], r["delay_days"])
                 for r in marts.delivery_order(orders, shipped).collect())
    assert got == [(1, 10.0, 1.0, 3.0), (1, 10.0, 1.0, 3.0), (2, 1.0, 0.0, 0.0)]


def test_access(spark):
    plants = spark.createDataFrame([("P01",), ("P02",)], "plant_id string")
    facts = spark.createDataFrame([("P01", 1), ("P02", 2), (None, 3), ("P03", 4)], "plant_id string, x int")
    users = access.user_plant_map(plants)
    see = lambda user: sorted(column(access.visible_to(facts, users, user), "x"))
    assert see("admin") == [1, 2] and see("plant_p01_user") == [1] and see("nobody' or '1'='1") == []
    assert semantic.secured(semantic.GOVERNANCE, facts, users, "nobody").count() == 4


def test_average_of_rates_is_not_rate_of_sums(spark):
    oee = spark.createDataFrame([("P", "L", 10.0, 1.0, 0.1), ("P", "L", 90.0, 0.0, 0.0)],
                                "plant_id string, line_id string, output_quantity double, scrap_quantity double, scrap_rate double")
    assert oee.agg(round_half_up(exact_avg("scrap_rate")).alias("r")).first()["r"] == 0.05
    metric = semantic.evaluate(oee, [semantic.metric_named("scrap_rate")]).first()["scrap_rate"]
    assert metric == 0.01


def test_registries_resolve(spark):
    assert {n: semantic.registry(spark, n).count() for n in semantic.REGISTRIES} == {
        "superset_dataset_registry": 5, "superset_metric_layer": 12, "superset_chart_registry": 6,
        "superset_dashboard_registry": 2, "superset_rls_policy_registry": 3}
    assert semantic.dashboard_charts(spark).count() == 7
    assert column(semantic.listing(spark, "superset_metric_layer", 1), "metric_name") == ["dq_issue_count"]


def test_limits(spark):
    df = spark.range(3000)
    assert dashboard.top(df, ["id"]).count() == 3000 and dashboard.top(df, ["id"], 2500).count() == 2500
    assert dashboard.page(df, ["id"], 0).count() == 1 and dashboard.page(df, ["id"], 9999).count() == 2000
    for refused in (lambda: dashboard.top(df, ["id"], 0), lambda: qr.first(df, 0), lambda: qr.first(df, -1)):
        with pytest.raises(ValueError, match="limit"):
            refused()


def test_shipments_without_delay_are_refused(spark):
    orders = spark.createDataFrame([(1, 1)], "sales_order_id int, order_line_id int")
    with pytest.raises(ValueError, match="delay_days"):
        marts.delivery_order(orders, orders)


def test_timestamps_with_zones_and_fine_fractions(spark):
    texts = ["2025-08-01T00:00:00Z", "2025-08-01T07:00:00+07:00", "2025-08-01 00:00:00.123456789"]
    got = [r["t"] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(fx.to_timestamp("x").alias("t")).collect()]
    assert got == [dt.datetime(2025, 8, 1), dt.datetime(2025, 8, 1), dt.datetime(2025, 8, 1, 0, 0, 0, 123456)]


def test_infinite_readings_are_missing(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.5,)], "x double")
    assert column(fx.coerce(df, numbers=("x",)), "x") == [None, None, 1.5]


@pytest.fixture
def total(spark):
    from plantlens.functions.numeric import exact_sum

    return lambda values, **kw: spark.createDataFrame([(v,) for v in values], "x double").agg(
        exact_sum("x", **kw).alias("s")).first()["s"]


def test_exact_sum_is_order_free(total):
    assert total([0.1] * 10) == 1.0 and total([0.1, 0.2, 0.3, -0.6]) == 0.0
    assert total([0.15, -0.25, 0.35], places=1) == 0.3   # ties away from zero: 0.2 - 0.3 + 0.4
    assert total([None, None]) is None
    mixed = [5e12, 5e12, -5e12, -5e12] + [0.1] * 10
    assert total(mixed) == total(mixed[::-1]) == total(mixed[2:] + mixed[:2]) == 1.0


def test_exact_sum_equals_decimals(total):
    for values, places in (([1e13], 6), ([1e15], 6), ([1e13, -5.0], 6), ([1e15, 1.0], 6), ([9e12, 9e12], 6), ([2e9], 10),
                           ([1e-7] * 10, 10), ([-1e15, 0.000001, 1e15], 6), ([123456.789012, -0.000001] * 7, 6)):
        want = sum(Decimal(repr(v)).quantize(Decimal(1).scaleb(-places)) for v in values)
        assert total(values, places=places) == float(want), values


def test_exact_sum_leaves_out_what_is_no_number(total):
    assert total([float("inf"), 2.5, float("nan"), float("-inf")]) == 2.5
    assert total([float("nan")]) is None
    with pytest.raises(Exception, match="too large"):
        total([1e30, 1.0])


def test_plain_times_are_cast_as_the_formats_read_them(spark, conf):
    """The cast of usual export texts gives what the formats give, and no formatter is asked for them."""
    texts = [f"{d}{t}" for d in ("2020-02-29", "2021-02-29", "2021-02-30", "2021-13-01", "2021-00-10", "0999-01-01", "0000-01-01",
                                 "9999-12-31", "1582-10-10", "2021-03-28", "2021-10-31", "2021-3-14", " 2020-01-01")
             for t in ("", " 00:00:00.000000", " 02:30:00", "T02:30:00.000001", " 24:00:00", " 23:60:00", " 23:59:60", " 02:30",
                       " 02:30:00.5", " 02:30:00.000000\n", " 02:30:00+01:00", "T", " ", " 02:30:00.000000 ")] + ["", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for zone in ("UTC", "Europe/Berlin", "America/New_York"):
        conf(spark__sql__session__timeZone=zone)
        for strict, tried in ((False, fx.TIMESTAMP_FORMATS), (True, fx.TIMESTAMP_FORMATS[:1])):
            read = F.coalesce(*[F.try_to_timestamp(F.trim("s"), F.lit(f)) for f in tried])
            differ = df.filter(~F.unix_micros(read).eqNullSafe(F.unix_micros(fx.to_timestamp("s", strict=strict))))
            assert differ.collect() == []
    assert "try_cast" in str(fx.to_timestamp("s")).lower()


def test_lists_of_findings_are_made_of_broken_rows_only(spark):
    """A filter stands before the lists of rejected values and of issues."""
    raw = spark.createDataFrame([("1", "2", "a"), ("x", "2", "b"), (None, "y", "c"), ("z", "w", "d")], "n string, m string, k string")
    found = fx.rejected_values(raw, numbers=("n", "m"), keep=("k",))
    assert sorted(map(tuple, found.collect())) == [("b", "n", "x"), ("c", "m", "y"), ("d", "m", "w"), ("d", "n", "z")]
    assert fx.rejected_values(raw, numbers=("nothing",)).collect() == []
    rule = qr.Rule("t", "R", "low", "negative", ("k",), predicate="n < 0")
    frame = spark.createDataFrame([(1, "a"), (-1, "b"), (None, "c")], "n int, k string")
    issues = qr.table_issues("t", frame, [rule])
    assert [r["business_key"] for r in issues.collect()] == ["b"]
    for df in (found, issues):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" in plan and "Filter" in plan.split("Generate", 1)[1]
