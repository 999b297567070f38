"""Sources, sinks, refresh and streaming on small folders."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plantlens import session
from plantlens.plans import marts, refresh
from plantlens.sources import csv_source
from plantlens.sources.lake import Lake, upsert
from plantlens.streaming import telemetry


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), prefix=f"t{abs(hash(str(tmp_path)))}_")


def test_csv_headers_nulls_and_order(spark, tmp_path):
    put(tmp_path / "t.csv", ' Run ID,Work-Order/No,Note\nR1,NA,"a, ""b"""\nR2,7,\nR1,8,null\n')
    df = csv_source.read_csv(spark, str(tmp_path / "t.csv"), required=["run_id"])
    assert df.columns[:3] == ["run_id", "work_order_no", "note"]
    assert [tuple(r)[:3] for r in csv_source.first_rows(df, 2).collect()] == [("R1", None, 'a, "b"'), ("R2", "7", None)]
    with pytest.raises(ValueError):
        csv_source.read_csv(spark, str(tmp_path / "t.csv"), required=["machine_id"])
    with pytest.raises(AnalysisException):
        csv_source.read_csv(spark, str(tmp_path / "absent.csv"))


def test_first_rows_across_files(spark, tmp_path):
    for part in range(5):
        put(tmp_path / "many" / f"part-{part}.csv",
            "id\n" + "".join(f"{part * 100 + i}\n" for i in range(100 if part else 3)))
    df = csv_source.read_csv(spark, str(tmp_path / "many"))
    got = [int(r["id"]) for r in csv_source.first_rows(df, 150).collect()]
    assert got == [0, 1, 2, *range(100, 200), *range(200, 247)]


def test_documents(spark, tmp_path):
    put(tmp_path / "d.jsonl", '{"doc_id": "D1", "title": "T", "text": "x"}\n{"doc_id": "D2", "text": null}\n')
    assert [tuple(r) for r in csv_source.read_documents(spark, str(tmp_path / "d.jsonl")).collect()] == [
        ("D1", "T", "x"), ("D2", None, None)]


def test_upsert_and_duplicate_keys(spark, lake):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    lake.write("lab", "m", target)
    updates = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, lake.upsert("lab", "m", updates, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, updates.unionByName(updates), ["k"]).collect()


def test_catalog_listing(spark, lake):
    lake.write("raw", "b", spark.range(3))
    lake.write("raw", "a", spark.range(3).withColumn("p", F.col("id") % 2), partition_by=["p"])
    for table in ("a", "b"):
        lake.register("raw", table)
    assert [tuple(r) for r in lake.tables().collect()] == [("raw", "a"), ("raw", "b")]
    assert spark.table(f"{lake.database('raw')}.a").count() == 3


def test_failed_writes_leave_the_table(spark, lake):
    """A task that fails midway, an upsert that fails, and a version that was cut off."""
    lake.write("lab", "m", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    kept = [(1, "a"), (2, "b")]
    broken = spark.range(4, numPartitions=4).select(
        F.col("id").cast("int").alias("k"),
        F.when(F.col("id") == 3, F.raise_error(F.lit("midway")).cast("string")).otherwise("x").alias("v"))
    for attempt in (lambda: lake.write("lab", "m", broken), lambda: lake.upsert("lab", "m", broken, ["k"])):
        with pytest.raises(Exception, match="midway"):
            attempt()
        assert sorted(map(tuple, lake.read("lab", "m").collect())) == kept
    highest = max(int(n[1:]) for n in lake._children(lake.folder("lab", "m")))
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{lake.folder('lab', 'm')}/v{highest + 1}")
    assert sorted(map(tuple, lake.read("lab", "m").collect())) == kept
    lake.write("lab", "m", lake.read("lab", "m").where("k = 1"))
    assert [tuple(r) for r in lake.read("lab", "m").collect()] == [(1, "a")]


def test_registered_table_follows_its_versions(spark, lake):
    lake.write("raw", "a", spark.range(3))
    name = lake.register("raw", "a")
    lake.write("raw", "a", spark.range(5))
    assert spark.table(name).count() == 5


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_run_log_failure_is_swallowed(spark, tmp_path):
    put(tmp_path / "lake", "a file where the folder should be")
    assert Lake(spark, str(tmp_path / "lake")).log("step", "ok", {}) is False


FILES = {
    "plant_master": "plant_id,plant_name\nP01,North\nP02,East\n",
    "line_master": "line_id,plant_id\nL1,P01\n",
    "machine_master": "machine_id,line_id,machine_age_years,criticality\nM1,L1,3.5,high\n",
    "product_master": "product_id,product_family,complexity_score\nX,fam,2\n",
    "customer_master": "customer_id\nC1\n",
    "operator_master": "operator_id\nOP-1\n",
    "sales_order": "sales_order_id,order_line_id,customer_id,product_id,order_date,promised_delivery_date,"
                   "ordered_quantity,unit_price,discount_pct,customer_priority\n"
                   "S1,1,C1,X,2026-01-01,2026-01-09,10,2,50,high\nS2,1,C1,X,2026-01-01,2026-01-09,1,2,,high\n",
    "work_order": "work_order_id,plant_id,line_id,product_id,work_order_status,priority_level,planned_quantity,"
                  "actual_quantity,rejected_quantity,rework_quantity,planned_start_datetime,planned_end_datetime,"
                  "actual_start_datetime,actual_end_datetime,load_timestamp\n"
                  "W1,P01,L1,X, Completed ,Urgent,100,90,5,0,2026-01-01 00:00:00,2026-01-02 00:00:00,"
                  "2026-01-01 00:00:00,2026-01-01 12:00:00,2026-01-03 00:00:00\n"
                  "W1,P01,L1,X,planned,Urgent,100,1,0,0,2026-01-01 00:00:00,2026-01-02 00:00:00,"
                  "2026-01-01 00:00:00,,2026-01-02 00:00:00\n",
    "production_run": "run_id,work_order_id,machine_id,operator_id,run_start_datetime,run_end_datetime,input_quantity,"
                      "output_quantity,scrap_quantity,rework_quantity,setup_minutes,runtime_minutes,idle_minutes,"
                      "speed_actual_ppm,speed_standard_ppm,run_status\n"
                      "R1,W1,M1,OP-1,2026-01-01 08:00:00,2026-01-01 10:00:00,100,80,8,0,10,100,10,1,1, DONE\n"
                      "R1,W1,M1,OP-1,2026-01-01 08:00:00,2026-01-01 10:00:00,100,90,9,0,10,100,10,1,1, DONE\n",
    "quality_inspection": "inspection_id,run_id,work_order_id,product_id,inspection_datetime,defect_code,sample_size,"
                          "defect_count,measurement_1,measurement_2,lower_spec_limit,upper_spec_limit,pass_fail\n"
                          "I1,R1,W1,X,2026-01-01 09:00:00, scratch,100,4,2,1,1,3,PASS\n",
    "machine_state_event": "machine_id,state_code,event_start,event_end,reason_code\n"
                           "M1,down,2026-01-01 00:00:00,2026-01-01 00:30:00,\n",
    "downtime_event": "downtime_id,machine_id\nD1,M1\n",
    "shipment": "sales_order_id,order_line_id,ship_date,promised_delivery_date,shipped_quantity,distance_km,"
                "late_delivery_flag,delay_days,root_cause\nS1,1,2026-01-10,2026-01-09,10,5,1,1,logistics\n",
    "data_quality_rules": "rule_id,severity\nDQ001,high\n",
    "sensor_reading": "timestamp,machine_id,sensor_id,plant_id,line_id,operating_state,temperature_c,vibration_mm_s,"
                      "pressure_bar,current_amp,speed_rpm,humidity_pct\n"
                      "2026-01-01 08:10:00,M1,T1,P01,L1,run,20,1,1,1,100,40\n"
                      "2026-01-01 08:10:00,M1,T1,P01,L1,run,30,1,1,1,100,40\n"
                      "2026-01-01 08:50:00,M1,T1,P01,L1,run,200,2,1,1,100,40\n",
}


def test_full_refresh_and_rerun(spark, tmp_path, lake):
    for table, text in FILES.items():
        put(tmp_path / "src" / csv_source.RAW_FILES[table], text)
    for _ in range(2):  # a second run replaces everything
        audits = refresh.run_all(spark, str(tmp_path / "src"), lake, issue_cap=500, sensor_rows=200_000,
                                 register=True)
    listed = {tuple(r) for r in lake.tables().collect()}
    assert {("raw", "work_order"), ("clean", "dq_issue_log"), ("mart", "fact_oee_daily_line"),
            ("mart", "v_dataset_oee_operational"), ("mart", "v_dataset_dq_governance")} <= listed
    view = spark.table(f"{lake.database('mart')}.v_dataset_dq_governance")
    assert view.agg(F.sum("issue_count")).first()[0] == 3
    clean_rows = {r["table_name"]: r["row_count"] for r in audits["clean_and_validate"].collect()}
    assert (clean_rows["work_order"], clean_rows["production_run"], clean_rows["sensor_reading"]) == (1, 1, 2)
    oee = lake.read("mart", "fact_oee_daily_line").first()
    assert (oee["plant_id"], oee["output_quantity"], oee["good_quantity"]) == ("P01", 90.0, 81.0)
    assert oee["oee"] == (100 / 120) * (90 / 100) * (81 / 90)
    feature = lake.read("mart", "feature_quality_model").first()
    assert (feature["avg_temperature_c"], feature["max_vibration_mm_s"], feature["sensor_valid_rate"]) == (115.0, 2.0, 0.5)
    assert feature["defect_rate"] == 0.04 and feature["high_defect_risk"] == 0
    delivery = {r["sales_order_id"]: r["net_order_value"] for r in lake.read("mart", "fact_delivery_order").collect()}
    assert delivery == {"S1": 10.0, "S2": 2.0}
    issues = sorted(r["rule_id"] for r in lake.read("clean", "dq_issue_log").collect())
    assert issues == ["DQ-SENSOR-RANGE", "DQ-WO-DUP", "DQ-WO-DUP"]
    kpi = spark.sql("select * from v_dashboard_kpis").first()
    assert (kpi["work_orders"], kpi["production_runs"], kpi["dq_issues_high_medium"], kpi["late_delivery_rate"]) == (1, 1, 3, 0.5)
    assert spark.sql("select sum(issue_count) as n from v_data_quality_summary").first()["n"] == 3
    log = lake.read("lab", "run_log").collect()
    assert len(log) == 6 and json.loads(log[0]["detail"])["status"] == "ok"


def test_contracts_through_the_refresh(spark, tmp_path, lake):
    """Work orders written month first, runs in seconds, sensors with a zone of their own; rejects are listed."""
    import re

    from plantlens.functions.coerce import Contract

    files = dict(FILES)
    files["work_order"] = re.sub(r"2026-(\d\d)-(\d\d)", r"\1/\2/2026", FILES["work_order"])
    files["production_run"] = FILES["production_run"].replace(",100,10,1,1, DONE", ",6000,ten,1,1, DONE")
    for table, text in files.items():
        put(tmp_path / "src" / csv_source.RAW_FILES[table], text)
    contracts = {
        "work_order": Contract(formats=("MM/dd/yyyy HH:mm:ss",), strict=True),
        "production_run": Contract(units={"runtime_minutes": (1 / 60, 0.0)}),
    }
    refresh.run_all(spark, str(tmp_path / "src"), lake, contracts=contracts, line_breaks=True)
    order = lake.read("clean", "work_order").first()
    assert (str(order["actual_end_datetime"]), order["schedule_delay_minutes"]) == ("2026-01-01 12:00:00", -720.0)
    run = lake.read("clean", "production_run").first()
    assert (run["runtime_minutes"], run["idle_minutes"]) == (100.0, None)
    assert sorted(r["rule_id"] for r in lake.read("clean", "dq_issue_log").collect()).count("DQ-WO-DUP") == 2
    rejected = lake.read("clean", "rejected_value").collect()
    assert [(r["table_name"], r["column_name"], r["value"]) for r in rejected] == [("production_run", "idle_minutes", "ten")] * 2
    assert {r["_ingest_row"] for r in rejected} == {0, 1}
    assert ("clean", "rejected_value") in {tuple(r) for r in lake.tables().collect()}


def test_contract_in_the_stream(spark, lake, tmp_path):
    from plantlens.functions.coerce import Contract

    put(tmp_path / "in" / "p.jsonl", json.dumps(
        {**READING, "timestamp": "02/01/2026 08:10", "temperature_c": "212", "seq": 1}))
    contract = Contract(formats=("MM/dd/yyyy HH:mm",), strict=True, units={"temperature_c": (1 / 1.8, -32 / 1.8)})
    stream = telemetry.read_telemetry(spark, str(tmp_path / "in"), extra="seq int")
    telemetry.merge_hourly(stream, lake, ["seq"], str(tmp_path / "c"), contract=contract).awaitTermination()
    hour = lake.read("mart", "fact_sensor_hourly_live").first()
    assert (str(hour["sensor_hour"]), round(hour["avg_temperature_c"], 6)) == ("2026-02-01 08:00:00", 100.0)


def test_streamed_hours_equal_the_batch(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    lines = []
    for i in range(600):
        row = dict(timestamp=(start + dt.timedelta(minutes=i)).isoformat(sep=" "), machine_id=f"M{i % 3}",
                   sensor_id="T1", plant_id="P01", line_id="L1", operating_state="run", temperature_c=str(i % 170),
                   vibration_mm_s="1.5", pressure_bar=None, current_amp="2", speed_rpm="100", data_quality_flag="ok")
        lines += [json.dumps(row)] * (2 if i % 7 == 0 else 1)
    for part in range(3):
        put(tmp_path / "in" / f"p{part}.jsonl", "\n".join(lines[part::3]))
    stream = telemetry.hourly_stream(telemetry.read_telemetry(spark, str(tmp_path / "in")))
    got = telemetry.drain(stream, "t").drop("hour")
    raw = spark.read.schema(telemetry.TELEMETRY_SCHEMA).json(str(tmp_path / "in")).distinct()
    from plantlens.plans.clean import sensor_readings
    batch = marts.sensor_hourly(sensor_readings(raw.withColumn("_ingest_row", F.lit(1))))
    closed = batch.filter(F.col("sensor_hour") <= F.lit("2026-01-01 06:00:00").cast("timestamp"))
    columns = sorted(batch.columns)
    key = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    assert key(got) == key(closed) and got.count() == 21


def test_latest_record_stream(spark, lake, tmp_path):
    schema = "k int, at int, v string"
    source = str(tmp_path / "s")
    spark.createDataFrame([(1, 1, "old"), (1, 3, "new"), (2, 1, "x")], schema).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    args = (lake, "clean", "latest", ["k"], ["at"], str(tmp_path / "c"))
    telemetry.upsert_latest(stream(), *args).awaitTermination()
    spark.createDataFrame([(1, 2, "late"), (2, 5, "y"), (3, 1, "z")], schema).write.mode("append").parquet(source)
    telemetry.upsert_latest(stream(), *args).awaitTermination()
    assert sorted(map(tuple, lake.read("clean", "latest").collect())) == [(1, 3, "new"), (2, 5, "y"), (3, 1, "z")]


def test_latest_record_stream_rewrites_touched_parts_only(spark, lake, tmp_path):
    schema, source = "k int, at int", str(tmp_path / "s")
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    args = (lake, "clean", "latest", ["k"], ["at"], str(tmp_path / "c"))
    spark.range(100).selectExpr("cast(id as int) k", "1 at").coalesce(1).write.mode("append").parquet(source)
    telemetry.upsert_latest(stream(), *args, parts=8).awaitTermination()
    before = set(lake.paths("clean", "latest"))
    spark.createDataFrame([(5, 2)], schema).coalesce(1).write.mode("append").parquet(source)
    telemetry.upsert_latest(stream(), *args, parts=8).awaitTermination()
    assert len(before) == 8 and len(before - set(lake.paths("clean", "latest"))) == 1
    assert lake.read("clean", "latest").where("k = 5").first()["at"] == 2 and lake.read("clean", "latest").count() == 100


def test_upsert_keeps_the_files_of_untouched_parts(spark, lake):
    lake.write("lab", "m", spark.range(200).selectExpr("id as k", "'old' as v"))
    lake.upsert("lab", "m", spark.createDataFrame([(500, "new")], "k int, v string"), ["k"], parts=8)
    before = set(lake.paths("lab", "m"))
    lake.upsert("lab", "m", spark.createDataFrame([(7, "new"), (900, "new")], "k int, v string"), ["k"])
    after = set(lake.paths("lab", "m"))
    assert len(before) == len(after) == 8 and 1 <= len(before - after) <= 2
    rows = dict(map(tuple, lake.read("lab", "m").collect()))
    assert len(rows) == 202 and {k for k, v in rows.items() if v == "new"} == {7, 500, 900}
    assert lake.read("lab", "m").schema["k"].dataType.simpleString() == "bigint"
    # What neither of the last two versions names is gone; a plain write ends the layout.
    for k in range(6):
        lake.upsert("lab", "m", spark.createDataFrame([(7, f"v{k}")], "k int, v string"), ["k"])
    held = [f"{v}/{p}" for v in lake._children(lake.folder("lab", "m"))
            for p in lake._children(f"{lake.folder('lab', 'm')}/{v}/parts") if p.startswith("_part=")]
    assert len(held) == 9 and lake.read("lab", "m").count() == 202
    with pytest.raises(ValueError, match="lies in parts"):
        lake.append("lab", "m", spark.createDataFrame([(1000, "x")], "k long, v string"))
    lake.write("lab", "m", lake.read("lab", "m").where("k < 5"))
    assert lake.manifest("lab", "m") is None and lake.read("lab", "m").count() == 5


def test_half_done_merge_leaves_the_table(spark, lake, monkeypatch):
    """The parts are written, the manifest isn't: readers see the version before."""
    lake.write("lab", "m", spark.range(50).selectExpr("id as k", "'old' as v"))
    lake.upsert("lab", "m", spark.createDataFrame([(1, "one")], "k long, v string"), ["k"], parts=4)
    kept = sorted(map(tuple, lake.read("lab", "m").collect()))
    updates = spark.createDataFrame([(k, "x") for k in range(50)], "k long, v string")
    with monkeypatch.context() as broken:
        broken.setattr(lake, "_put_manifest", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError, match="cut off"):
            lake.upsert("lab", "m", updates, ["k"])
    assert sorted(map(tuple, lake.read("lab", "m").collect())) == kept
    lake.upsert("lab", "m", updates, ["k"])
    assert {r["v"] for r in lake.read("lab", "m").collect()} == {"x"}


def test_table_in_parts_is_registered(spark, lake):
    lake.write("mart", "m", spark.range(20).selectExpr("id as k", "cast(id as string) as v"))
    lake.upsert("mart", "m", spark.createDataFrame([(3, "three")], "k long, v string"), ["k"], parts=3)
    name = lake.register("mart", "m")
    assert ("mart", "m") in {tuple(r) for r in lake.tables().collect()}
    assert spark.table(name).where("v = 'three'").count() == 1
    lake.upsert("mart", "m", spark.createDataFrame([(3, "3rd"), (77, "new")], "k long, v string"), ["k"])
    rows = {r["k"]: r["v"] for r in spark.table(name).collect()}
    assert len(rows) == 21 and (rows[3], rows[77]) == ("3rd", "new")


def test_merge_can_empty_a_part(spark, lake):
    part = F.col("k") % 3
    rows = spark.range(9).withColumnRenamed("id", "k")
    assert lake.merge("lab", "m", rows, part, lambda old, new: old.unionByName(new)) == [0, 1, 2]
    gone = rows.where("k = 4")
    assert lake.merge("lab", "m", gone, part, lambda old, new: old.where("k < 0")) == [1]
    assert sorted(r["k"] for r in lake.read("lab", "m").collect()) == [0, 2, 3, 5, 6, 8]
    assert lake.read_parts("lab", "m", [1]).count() == 0 and lake.read_parts("lab", "m", [2]).count() == 3
    assert lake.merge("lab", "m", rows.limit(0), part, lambda old, new: new) == []


READING = dict(machine_id="M1", sensor_id="T1", plant_id="P01", line_id="L1", operating_state="run", vibration_mm_s="1",
               pressure_bar="1", current_amp="2", speed_rpm="100", data_quality_flag="ok")


def _revisions(spark, lake, folder, batches):
    """Hours of the live mart after each batch of (time, temperature, seq, machine)."""
    for i, batch in enumerate(batches):
        put(folder / f"p{i}.jsonl", "\n".join(json.dumps(
            {**READING, "timestamp": at, "temperature_c": str(t), "seq": q, "machine_id": m}) for at, t, q, m in batch))
        stream = telemetry.read_telemetry(spark, str(folder), extra="seq int")
        telemetry.merge_hourly(stream, lake, ["seq"], str(folder.parent / "ckpt")).awaitTermination()
        yield {(r["machine_id"], str(r["sensor_hour"])): (r["reading_count"], r["avg_temperature_c"])
               for r in lake.read("mart", "fact_sensor_hourly_live").collect()}


def test_late_and_conflicting_readings_revise_their_hours(spark, lake, tmp_path):
    day = "2026-01-0"
    batches = [
        [(f"{day}1 08:10:00", 20, 1, "M1"), (f"{day}1 08:50:00", 40, 1, "M1"), (f"{day}1 08:10:00", 5, 1, "M2")],
        [(f"{day}9 00:00:00", 70, 1, "M1"), (f"{day}1 08:10:00", 30, 2, "M1")],   # a correction days later
        [(f"{day}1 08:50:00", 99, 0, "M1"), ("no time", 1, 1, "M3")],              # older than what is kept
    ]
    first, second, third = _revisions(spark, lake, tmp_path / "in", batches)
    eight = f"{day}1 08:00:00"
    assert first == {("M1", eight): (2, 30.0), ("M2", eight): (1, 5.0)}
    assert second == {**first, ("M1", eight): (2, 35.0), ("M1", f"{day}9 00:00:00"): (1, 70.0)}
    assert third == {**second, ("M3", "None"): (1, 1.0)}


def test_repeated_batch_changes_nothing(spark, lake, tmp_path):
    batch = [("2026-01-01 08:10:00", 20, 1, "M1"), ("2026-01-01 08:10:00", 25, 2, "M1")]
    assert len({str(got) for got in _revisions(spark, lake, tmp_path / "in", [batch, batch, batch])}) == 1


def test_last_reading_counts_in_closed_hours(spark, tmp_path):
    rows = [("2026-01-01 08:10:00", 20, 1), ("2026-01-01 08:10:00", 30, 3), ("2026-01-01 08:10:00", 25, 2),
            ("2026-01-01 12:00:00", 1, 1)]
    put(tmp_path / "in" / "p.jsonl", "\n".join(json.dumps(
        {**READING, "timestamp": at, "temperature_c": str(t), "seq": q}) for at, t, q in rows))
    stream = telemetry.read_telemetry(spark, str(tmp_path / "in"), extra="seq int")
    got = telemetry.drain(telemetry.hourly_stream(stream, order=["seq"]), "t").collect()
    assert [(r["reading_count"], r["avg_temperature_c"]) for r in got] == [(1, 30.0)]


def test_drain_goes_on_where_it_stopped(spark, tmp_path):
    source, schema = str(tmp_path / "s"), "k int"
    places = dict(checkpoint=str(tmp_path / "c"), target=str(tmp_path / "t"))
    for k in (1, 2):
        spark.createDataFrame([(k,)], schema).write.mode("append").parquet(source)
        got = telemetry.drain(spark.readStream.schema(schema).parquet(source), "d", **places)
    assert sorted(r["k"] for r in got.collect()) == [1, 2]


def test_date_filter_opens_few_files(spark, lake, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    hours = spark.range(0, 24 * 400, numPartitions=8).select(
        F.timestamp_seconds(F.col("id") * 3600).alias("sensor_hour"), (F.col("id") % 7).alias("machine_id"))
    mart = lake.write("mart", "hours", hours.repartition(8), sort_by=["sensor_hour"])
    files = mart.select(F.input_file_name().alias("f"), "sensor_hour")
    day = F.col("sensor_hour").between(F.lit("1970-03-01").cast("timestamp"), F.lit("1970-03-02").cast("timestamp"))
    assert files.select("f").distinct().count() >= 4 and files.where(day).select("f").distinct().count() <= 2


def test_shuffle_width():
    tera = 1 << 40
    assert session.shuffle_partitions_for(1000, 8) == 8
    assert session.shuffle_partitions_for(tera, 8) == 4096
    assert session.shuffle_partitions_for(100 * tera, 4000) == session.SHUFFLE_CEILING


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_root(spark) == session.shared_root(spark)
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


def test_exports_and_tables_are_compressed_and_keep_rows_and_order(spark, tmp_path):
    """Exports in arrival order stay in it over several compressed files; layer tables are zstd files."""
    from unittest import mock

    from plantlens.sources.csv_source import read_csv
    from plantlens.workbook import core
    shop = core.Shop(spark, "/root/testdata/sf0.001")
    with mock.patch.object(core, "EXPORT_RECORDS", 40):
        shop.export_csv("sensor_reading", str(tmp_path / "csv"), order=("sensor_id", "seq"))
    files = [p.name for p in (tmp_path / "csv").iterdir() if p.name.startswith("part-")]
    assert len(files) > 2 and all(n.endswith(".csv.gz") for n in files)
    rows = read_csv(spark, str(tmp_path / "csv")).orderBy(*core.clean.INGEST_ORDER).collect()
    assert len(rows) == shop.raw("sensor_reading").count()
    keys = [(int(r["sensor_id"]), int(r["seq"])) for r in rows]
    assert keys == sorted(keys)
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.write("raw", "t", spark.range(5))
    written = [p.name for p in (tmp_path / "lake/raw/t/v1").iterdir() if p.name.startswith("part-")]
    assert written and all("zstd" in n for n in written)


def test_telemetry_batches_are_written_by_many_tasks(spark, tmp_path):
    """A batch is not one file that one task writes and reads; records a file are bounded and none is lost."""
    from unittest import mock

    from plantlens.workbook import core, extended
    shop = core.Shop(spark, "/root/testdata/sf0.001")
    readings = shop.raw("sensor_reading")
    with mock.patch.object(extended, "TELEMETRY_RECORDS", 25):
        extended._telemetry_files(readings, str(tmp_path / "t"))
    files = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]
    sizes = [len(p.read_text().splitlines()) for p in files]
    assert len(files) > 2 and max(sizes) <= 25 and sum(sizes) == readings.count()


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    """Steps of a plan leave no shuffle behind for the driver's garbage collector."""
    session.configure(spark)
    master = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = master.size()
    spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "t"))
    assert master.size() <= before


def test_batch_ingest_keeps_tables_and_no_exports(spark, monkeypatch):
    """Each export goes once its raw table is written; all rows are in the tables."""
    from pathlib import Path

    from plantlens.workbook import core, tables
    made = []
    scratch = core.Shop.scratch
    monkeypatch.setattr(core.Shop, "scratch", lambda shop, label: made.append((label, scratch(shop, label))) or made[-1][1])
    shop = core.Shop(spark, "/root/testdata/sf0.001")
    counts = {r["table_name"]: r["row_count"] for r in tables.s03(shop).collect()}
    assert counts == {t: shop.raw(t).count() for t in tables._COUNTED}
    folders = {label: Path(path.removeprefix("file:")) for label, path in made}
    assert list(folders["lake"].rglob("*.parquet")) and not list(folders["exports"].rglob("part-*"))


def test_calls_at_once_have_local_properties_of_their_own(spark):
    """A property that one call sets stays out of the calls beside it."""
    from threading import Barrier
    met = Barrier(4, timeout=60)

    def one(n):
        spark.sparkContext.setLocalProperty("plantlens.test", str(n))
        met.wait()
        return spark.sparkContext.getLocalProperty("plantlens.test")

    assert session.together(spark, one, range(4), 4) == ["0", "1", "2", "3"]
