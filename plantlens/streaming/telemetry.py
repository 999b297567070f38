"""Streaming versions of the hourly sensor mart and the alarm watchlist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import DEFAULT, Contract
from ..operators.dedup import keep_last
from ..plans import clean
from ..plans.clean import derive_sensor_columns
from ..plans.marts import sensor_hourly, sensor_measures
from ..session import scratch_path

# Payload of the telemetry documents; numbers arrive as JSON numbers or text.
TELEMETRY_SCHEMA = (
    "timestamp string, machine_id string, sensor_id string, plant_id string, line_id string, "
    "operating_state string, temperature_c string, vibration_mm_s string, pressure_bar string, "
    "current_amp string, speed_rpm string, data_quality_flag string"
)


READING_KEYS = ["timestamp", "machine_id", "sensor_id"]


def read_telemetry(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, extra: str = "",
) -> DataFrame:
    """JSON-lines telemetry as a stream; ``extra`` names further payload fields, as in a schema text."""
    reader = spark.readStream.schema(TELEMETRY_SCHEMA + (f", {extra}" if extra else ""))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def hourly_stream(
    readings: DataFrame, lateness: str = "2 hours", order: Sequence[str] = (), contract: Contract = DEFAULT,
) -> DataFrame:
    """Hourly sensor aggregates of closed hours.

    Of readings that repeat a time, machine and sensor, the last one by
    ``order`` counts (as in the batch plan) if it arrives while the watermark
    still covers it; ``merge_hourly`` also takes later ones.  Without an
    ``order`` the first arrival counts, which is the same when copies are
    exact.  ``lateness`` is our choice.
    """
    typed = clean.typed("sensor_reading", readings, contract).withWatermark("timestamp", lateness)
    if order:
        rest = [c for c in typed.columns if c not in READING_KEYS]
        unique = typed.groupBy(*READING_KEYS).agg(
            F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*READING_KEYS, "_last.*")
    else:
        unique = typed.dropDuplicatesWithinWatermark(READING_KEYS)
    return (
        derive_sensor_columns(unique)
        .groupBy(F.window("timestamp", "1 hour").alias("hour"), "plant_id", "line_id", "machine_id")
        .agg(*sensor_measures())
        .withColumn("sensor_hour", F.col("hour.start"))
        .drop("hour")
    )


def alarm_stream(alarms: DataFrame, threshold: int = 2, lateness: str = "1 day") -> DataFrame:
    """Machines with repeated alarms in a seven-day window that slides by a day.

    Alarms are counted per machine and day first, so a reading updates one day
    of state instead of the seven windows it falls into.
    """
    daily = (
        alarms.withWatermark("alarm_time", lateness)
        .groupBy(F.window("alarm_time", "1 day").alias("day"), "machine_id")
        .agg(F.count(F.lit(1)).alias("alarms"))
    )
    return (
        daily.groupBy(F.window(F.window_time("day"), "7 days", "1 day").alias("week"), "machine_id")
        .agg(F.sum("alarms").alias("alarms_7d"))
        .filter(F.col("alarms_7d") >= threshold)
        .select(
            "machine_id",
            F.col("week.start").alias("window_start"),
            F.col("week.end").alias("window_end"),
            "alarms_7d",
        )
    )


def drain(
    stream: DataFrame, label: str, *, checkpoint: str | None = None, target: str | None = None,
) -> DataFrame:
    """Process everything available into Parquet and read it back.

    With a ``checkpoint`` and a ``target`` of the caller's, a later call (or a
    restart after a failure) goes on where the last one stopped and adds to the
    same output.  Otherwise both are fresh paths in the shared folder.
    """
    spark = stream.sparkSession
    target = target or scratch_path(spark, f"{label}-out")
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint or scratch_path(spark, f"{label}-ckpt"))
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def upsert_latest(
    stream: DataFrame, lake, layer: str, table: str, keys: list[str], order: list[str], checkpoint: str, *, parts: int = 16,
):
    """Keep the newest record per key of an unbounded stream in a layer table.

    Latest-record dedup has no append form; each batch is merged with the rows
    already kept, so a late older record does not replace a newer one.  The
    table lies in ``parts`` by key hash (fixed for the table's life); a batch
    reads and rewrites only the parts that it has rows for, as one version.
    Merging a batch twice gives the same rows, so a restart is harmless.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))

    def merge(batch: DataFrame, _batch_id: int) -> None:
        lake.merge(layer, table, keep_last(batch, keys, order), part,
                   lambda old, new: keep_last(old.unionByName(new), keys, order),
                   layout=f"hash of {', '.join(keys)} in {parts}")

    return _merging(stream, merge, checkpoint)


def _merging(stream: DataFrame, merge, checkpoint: str):
    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def machine_days(time_column: str, machine_parts: int) -> Column:
    """Part of a reading or an hour: its day and a hash of its machine; no usable time is day -1."""
    day = F.coalesce(F.unix_date(F.to_date(time_column)), F.lit(-1)).cast("bigint")
    return day * machine_parts + F.pmod(F.xxhash64(F.col("machine_id").cast("string")), F.lit(machine_parts))


def merge_hourly(
    stream: DataFrame, lake, order: list[str], checkpoint: str, *,
    readings: str = "sensor_reading_latest", mart: str = "fact_sensor_hourly_live", machine_parts: int = 4,
    contract: Contract = DEFAULT,
):
    """Hourly mart that late and conflicting readings revise, however late they are.

    The newest reading (by ``order``) of each time, machine and sensor is kept
    in a clean table that lies in parts of a day and some machines.  A batch is
    merged into the parts that it touches, and the hours of these parts are
    computed again and replace those of the mart.  So the mart equals the batch
    plan over everything that has arrived, in whatever order it came, and a
    batch costs what its parts hold: choose ``machine_parts`` (fixed for the
    tables' life) so that a day of one part is some gigabytes at most.  A batch
    that is repeated after a failure finds its rows merged and writes the same
    hours.
    """
    layout = f"day and hash of machine_id in {machine_parts}"

    def merge(batch: DataFrame, _batch_id: int) -> None:
        typed = clean.typed("sensor_reading", batch, contract)
        touched = lake.merge(
            "clean", readings, keep_last(typed, READING_KEYS, order), machine_days("timestamp", machine_parts),
            lambda old, new: keep_last(old.unionByName(new), READING_KEYS, order), layout=layout)
        if touched:
            hours = sensor_hourly(derive_sensor_columns(lake.read_parts("clean", readings, touched)))
            lake.merge("mart", mart, hours, machine_days("sensor_hour", machine_parts),
                       lambda _old, new: new, layout=layout)

    return _merging(stream, merge, checkpoint)
