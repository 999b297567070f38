"""Plan shapes: pruning before shuffles, splitting of hot keys, pushed filters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from plantlens.operators import dedup, quality_rules as qr
from plantlens.plans import extended, marts, semantic
from plantlens.workbook.core import Shop
from test_lake_and_streams import plan


@pytest.fixture
def tight(conf):
    """Thresholds small enough for AQE to see skew in test-sized data."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
         spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__session__timeZone="UTC")


def facts(spark, n=200_000):
    """A third of the rows share key 0."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).select("id", key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def finished(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def test_dedup_prunes_before_the_shuffle(spark):
    text = plan(dedup.keep_last(facts(spark), ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_cap_prunes_before_the_shuffle(spark):
    shop = Shop(spark, SMALL)
    log = qr.issue_log({"production_run": shop.raw("production_run")}, cap=500,
                       order={"production_run": ("run_id",)}, pass_row=False)
    assert "WindowGroupLimit" in plan(log)


def test_hot_duplicate_group_is_split(spark, tight):
    assert "skew=true" in finished(dedup.flag_duplicates(facts(spark), ["k"]))
    assert "skew=true" in finished(dedup.duplicate_members(facts(spark), ["k"]))


def test_hot_anonymity_group_is_split(spark, tight):
    assert "skew=true" in finished(extended.with_group_size(facts(spark), ["k"]))


def test_hot_work_order_is_split(spark, tight):
    orders = dedup.keep_last(
        spark.range(200_000).select(F.col("id").alias("work_order_id"), F.lit("P").alias("plant_id"),
                                    F.lit("L").alias("line_id"), F.lit(1).alias("o")), ["work_order_id"], ["o"])
    runs = facts(spark).withColumnRenamed("k", "work_order_id")
    assert "skew=true" in finished(marts.runs_with_orders(runs, orders))


def test_hot_order_line_is_split(spark, tight):
    shipped = facts(spark).select(F.col("k").alias("sales_order_id"), F.lit(1).alias("order_line_id"),
                                  F.col("pad").alias("ship_date"), F.lit(1.0).alias("shipped_quantity"),
                                  F.lit(1).alias("late_delivery_flag"), F.lit("x").alias("root_cause"),
                                  F.lit(0.5).alias("delay_days"))
    orders = spark.range(200_000).select(
        F.col("id").alias("sales_order_id"), F.lit(1).alias("order_line_id"),
        *[F.lit(1.0).alias(c) for c in ("customer_id", "product_id", "order_date", "promised_delivery_date",
                                        "ordered_quantity", "unit_price", "discount_pct", "customer_priority")])
    assert "skew=true" in finished(marts.delivery_order(orders, shipped))


def test_hot_machine_day_is_split(spark, tight):
    hourly = spark.range(200_000).select(
        F.lit("2026-01-01 08:00:00").cast("timestamp").alias("sensor_hour"), F.col("id").alias("machine_id"),
        *[F.lit(1.0).alias(c) for c in ("avg_temperature_c", "max_vibration_mm_s", "sensor_valid_rate")])
    runs = facts(spark).select(F.col("k").alias("machine_id"), F.to_date(F.lit("2026-01-01")).alias("sensor_date"), "pad")
    assert "skew=true" in finished(runs.join(marts.machine_day(hourly), ["sensor_date", "machine_id"], "left"))


def test_masters_broadcast_only_below_the_threshold(spark, conf):
    shop = Shop(spark, SMALL)
    assert "BroadcastHashJoin" in plan(shop.features)
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    assert "BroadcastHashJoin" not in plan(Shop(spark, SMALL).features)


def test_no_cross_join_and_no_python(spark):
    shop = Shop(spark, SMALL)
    for df in (shop.features, shop.delivery, shop.quality, shop.oee, shop.issue_counts):
        text = plan(df)
        assert not any(word in text for word in ("Cartesian", "NestedLoop", "Python"))


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "q")
    Shop(spark, SMALL).quality.write.parquet(path)
    where = semantic.dashboard_filter(time_column="inspection_date", start=dt.date(1997, 1, 1), plants=["P01", "P02"])
    chart = semantic.chart_query("Pareto - Defect count by defect code",
                                 {semantic.QUALITY: spark.read.parquet(path)}, where)
    text = plan(chart)
    assert "GreaterThanOrEqual(inspection_date" in text and "In(plant_id" in text
    assert "ReadSchema: struct<inspection_date:date,plant_id:string,defect_code:string,defect_count:double>" in text


def test_oee_needs_no_row_expansion(spark):
    assert "Expand" not in plan(Shop(spark, SMALL).oee)


def test_shuffles_and_scans_are_sized_for_rows_in_memory(spark, tmp_path):
    """A gigabyte of files makes more shuffle partitions than cores, and no scan task takes 128 MB."""
    from unittest import mock

    from plantlens import session
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        with mock.patch.object(session, "input_bytes", return_value=1 << 30):
            assert session.size_shuffles(spark, str(tmp_path)) >= 64
        spark.conf.set(keys[1], "128m")
        session.configure(spark)
        assert int(spark.conf.get(keys[1])) == session.SCAN_SPLIT_BYTES
        spark.conf.set(keys[1], "4m")
        session.configure(spark)
        assert int(spark.conf.get(keys[1])) == 4 << 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_features_write_the_columns_they_read(spark, monkeypatch):
    """The written clean tables behind the feature table hold no column that it doesn't read."""
    from plantlens.workbook import core, tables
    written = []
    kept = core.Shop.kept
    monkeypatch.setattr(core.Shop, "kept", lambda shop, df, label: written.append((label, df.columns)) or kept(shop, df, label))
    core.Shop(spark, "/root/testdata/sf0.001").features_with("operator_id")
    assert dict(written) == {"runs": [*marts.FEATURE_RUNS, "operator_id"], "inspections": [*marts.FEATURE_INSPECTIONS]}
    written.clear()
    tables.s13(core.Shop(spark, "/root/testdata/sf0.001"))
    assert sorted(label for label, _ in written) == ["inspections", "runs", "work-orders"]


def test_dedup_shuffles_no_hash_of_the_key(spark):
    """Rows go through the shuffle without 8 bytes of hash, sorted by their key; the join on the key still shuffles them."""
    rows = facts(spark, 1000)
    once = dedup.keep_last(rows, ["k"], ["id"])
    text = once._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in text and "xxhash64(k#" not in text.split("Exchange hashpartitioning(")[1].split("\n")[0]
    joined = once.join(rows.select("k", F.lit(1).alias("x")).hint("merge"), "k")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(k#") == 3


def test_features_join_machine_days_of_known_size(spark, monkeypatch):
    """Machine-days, order contexts and inspected runs are written, so the last plan shuffles no reading."""
    from plantlens.workbook import core
    steps = []
    step = core.Shop.step
    monkeypatch.setattr(core.Shop, "step", lambda shop, df, label="step": steps.append(label) or step(shop, df, label))
    text = plan(core.Shop(spark, SMALL).features_with("operator_id"))
    assert steps == ["machine_day", "order_context", "inspected_runs"]
    assert "events.parquet" not in text and "Window" not in text


def test_kpis_stand_on_narrow_tables_and_one_row_a_part(spark, monkeypatch):
    from plantlens.workbook import core, reports
    written, steps = [], []
    kept, step = core.Shop.kept, core.Shop.step
    monkeypatch.setattr(core.Shop, "kept", lambda shop, df, label: written.append((label, df.columns)) or kept(shop, df, label))
    monkeypatch.setattr(core.Shop, "step", lambda shop, df, label="step": steps.append(step(shop, df, label)) or steps[-1])
    for run in (reports.a06, reports.m06):
        written.clear(), steps.clear()
        text = plan(run(core.Shop(spark, SMALL)))
        assert dict(written) == {"runs": [*marts.OEE_RUNS], "work-orders": ["work_order_id", "plant_id", "line_id"],
                                 "inspections": [*marts.QUALITY_INSPECTIONS]}
        assert len(steps) == 6 and all(s.count() == 1 for s in steps) and "lineitem" not in text
