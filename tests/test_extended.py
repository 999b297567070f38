"""Golden values and brute-force checks of the declared outputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plantlens.operators import integrity
from plantlens.operators.joins import left_join_many
from plantlens.operators.running import running_total
from plantlens.plans import dashboard, extended

# The published defect Pareto.
PARETO = [
    ("SOLDER_VOID", 11133.0, 0.194, 0.194), ("DIMENSION", 10687.0, 0.1862, 0.3801),
    ("SURFACE_DENT", 10217.0, 0.178, 0.5581), ("SCRATCH", 10126.0, 0.1764, 0.7346),
    ("CONTAMINATION", 8276.0, 0.1442, 0.8787), ("MISSING_PART", 6960.0, 0.1213, 1.0),
]


def test_pareto_matches_published_values(spark):
    totals = spark.createDataFrame([(c, n) for c, n, _, _ in PARETO], "defect_code string, defect_count double")
    got = dashboard.pareto_shares(totals, "defect_code", "defect_count").collect()
    assert sorted(map(tuple, got)) == sorted(PARETO)


def test_running_total_matches_brute_force(spark):
    random.seed(3)
    data = [(i, float(random.choice([1, 1, 1, 5, 9]))) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, v double").repartition(8)
    got = {r["k"]: r["t"] for r in running_total(df, "v", [F.desc("v"), F.asc("k")], "t").collect()}
    total, want = 0.0, {}
    for k, v in sorted(data, key=lambda r: (-r[1], r[0])):
        total += v
        want[k] = total
    assert got == want


@pytest.mark.parametrize("day, week, weekend, holiday, fiscal", [
    ("2025-08-01", 30, 0, 0, 2025), ("2025-08-02", 30, 1, 0, 2025), ("2025-08-18", 33, 0, 1, 2025),
    ("2025-10-01", 39, 0, 0, 2026), ("2026-01-01", 0, 0, 0, 2026), ("2026-01-04", 1, 1, 0, 2026),
])
def test_calendar_rules(spark, day, week, weekend, holiday, fiscal):
    got = spark.sql(f"select date '{day}' as d").select(*extended.calendar_columns("d")).first()
    assert (got["week_of_year"], got["is_weekend"], got["is_holiday"], got["fiscal_year"]) == (week, weekend, holiday, fiscal)
    assert int(dt.date.fromisoformat(day).strftime("%U")) == week


def test_left_join_many_is_a_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (4, "e")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (None, "n")], "k int, r string")
    want = left.join(right, ["k"], "left")
    key = lambda rows: sorted(map(str, rows))
    assert key(left_join_many(left, right, ["k"]).collect()) == key(want.collect())


def test_failure_label_and_rolling_maximum(spark):
    at = lambda text: dt.datetime.fromisoformat(text)
    hourly = spark.createDataFrame([
        ("M1", at("2026-01-01 23:00"), 9.0, 50.0, 1), ("M1", at("2026-01-02 22:00"), 1.0, 60.0, 1),
        ("M1", at("2026-01-03 23:00"), 2.0, 70.0, 1), ("M1", at("2026-01-20 00:00"), 3.0, 70.0, 1),
    ], "machine_id string, sensor_hour timestamp, max_vibration_mm_s double, max_temperature_c double, reading_count long")
    failures = spark.createDataFrame([("M1", at("2026-01-09 05:00")), ("M2", at("2026-01-21 05:00"))],
                                     "machine_id string, failure_time timestamp")
    got = {r["feature_date"].day: r for r in extended.machine_failure_features(hourly, failures).collect()}
    assert {d: r["max_vibration_24h"] for d, r in got.items()} == {1: 9.0, 2: 9.0, 3: 2.0, 20: 3.0}
    assert {d: r["failure_within_7d"] for d, r in got.items()} == {1: 0, 2: 1, 3: 1, 20: 0}


def test_watchlist_counts_seven_days(spark):
    day = lambda d: (f"M1", dt.datetime(2026, 1, d, 12))
    alarms = spark.createDataFrame([day(1), day(7), day(8), day(20)], "machine_id string, alarm_time timestamp")
    got = {r["alarm_date"].day: r["alarms_7d"] for r in extended.alarm_watchlist(alarms).collect()}
    assert got == {7: 2, 8: 2}


def test_group_size_matches_missing_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, None)], "p string, q string")
    got = sorted((str(r["p"]), str(r["q"]), r["k_anonymity_group_size"])
                 for r in extended.with_group_size(df, ["p", "q"]).collect())
    assert got == [("None", "None", 1), ("a", "None", 2), ("a", "None", 2), ("a", "x", 1)]


def test_operator_codes(spark):
    runs = spark.createDataFrame([("R1", "OP-1"), ("R2", " "), ("R3", None), ("R4", "OP-9")], "run_id string, operator_id string")
    master = spark.createDataFrame([("OP-1",)], "operator_id string")
    got = sorted((r["run_id"], r["operator_id"]) for r in integrity.unknown_operators(runs, master).collect())
    assert got == [("R2", "UNKNOWN_OPERATOR"), ("R3", "UNKNOWN_OPERATOR"), ("R4", "OP-9")]


def test_chain(spark):
    t = lambda h: dt.datetime(2026, 1, 1, h)
    chain = spark.createDataFrame([("a", None, t(1)), ("b", "a", t(2)), ("c", "b", t(1)), ("d", "zz", t(3))],
                                  "transaction_hash string, previous_hash string, at timestamp")
    assert [r["transaction_hash"] for r in integrity.broken_links(chain).collect()] == ["d"]
    assert [r["transaction_hash"] for r in integrity.out_of_sequence(chain, "at").collect()] == ["c"]


def test_drift_of_equal_windows_is_zero(spark):
    df = spark.range(1000).select((F.col("id") % 17).cast("double").alias("x"))
    got = extended.drift_report(df, df, ["x"]).first()
    assert abs(got["psi"]) < 1e-12 and got["mean_shift"] == 0.0 and got["ref_rows"] == 1000


def test_dense_demand(spark):
    orders = spark.createDataFrame(
        [("A", dt.date(2026, 1, 1), 5.0), ("A", dt.date(2026, 1, 3), 7.0), ("B", dt.date(2026, 1, 2), 1.0)],
        "product_id string, order_date date, ordered_quantity double")
    got = sorted((r["product_id"], r["demand_date"].day, r["demand_quantity"], r["lag_1"], r["mean_prior_7d"])
                 for r in extended.daily_demand(orders).collect())
    assert got == [("A", 1, 5.0, None, None), ("A", 2, 0.0, 5.0, 5.0), ("A", 3, 7.0, 0.0, 2.5),
                   ("B", 1, 0.0, None, None), ("B", 2, 1.0, 0.0, 0.0), ("B", 3, 0.0, 1.0, 0.5)]
