"""Kinds of injected defects: exact duplicates, conflicting keys, missing values, spikes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import hour_of
from .dedup import flag_duplicates, join_side, null_safe_on


def row_fingerprint(columns: Sequence[str]) -> Column:
    """Digest of a whole row; missing and empty values differ, and no two values run together."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary"), 256)


def exact_duplicates(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Every row that stands more than once, all copies included (by ``columns``, else all)."""
    marked = df.withColumn("_fingerprint", row_fingerprint(columns or df.columns))
    return flag_duplicates(marked, ["_fingerprint"], "_copies").filter("_copies = 1").drop("_fingerprint", "_copies")


def conflicting_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key stands with different contents; exact copies alone are no conflict."""
    contents = df.select(*keys, row_fingerprint(df.columns).alias("_fingerprint")).groupBy(*keys, "_fingerprint").agg(
        F.count(F.lit(1)).alias("_copies"))
    repeated = join_side(contents, keys, "_n").filter(F.col("_n") > 1)
    return df.join(repeated, null_safe_on(df, repeated, keys), "left_semi")


def _median_of(values: Column) -> Column:
    """Median of a short array of numbers."""
    ordered, n = F.sort_array(values), F.size(values)
    at = lambda place: F.get(ordered, place.cast("int"))
    return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2


def spikes(
    readings: DataFrame, measure: str, *, by: str = "machine_id", time: str = "timestamp", hours: int = 12, limit: float = 6.0,
) -> DataFrame:
    """Readings far from the rolling median of their machine, with ``level`` and ``spread``.

    The level of a machine-hour is the median of the hourly medians from
    ``hours`` before to ``hours`` after it, the spread the median distance of
    these medians from their levels, times 1.4826 (a standard deviation, if
    the values are normal).  A reading is a spike when it is farther than
    ``limit`` spreads from the level.  Without any spread nothing is judged.

    Readings are reduced to machine-hours first, so a window holds at most
    ``2 * hours + 1`` rows, and the hours are joined back by machine and hour.
    """
    timed = readings.filter(F.col(time).isNotNull() & F.col(measure).isNotNull())
    hourly = timed.groupBy(F.col(by).alias("_by"), hour_of(time).alias("_hour")).agg(F.median(measure).alias("_median"))
    around = Window.partitionBy("_by").orderBy(
        F.floor(F.unix_seconds(F.col("_hour").cast("timestamp")) / 3600)).rangeBetween(-hours, hours)
    levels = hourly.withColumn("level", _median_of(F.collect_list("_median").over(around)))
    levels = levels.withColumn(
        "spread", 1.4826 * _median_of(F.collect_list(F.abs(F.col("_median") - F.col("level"))).over(around))
    ).filter(F.col("spread") > 0).drop("_median")
    keyed = timed.withColumn("_at", hour_of(time))
    return keyed.join(levels, (F.col(by) == F.col("_by")) & (F.col("_at") == F.col("_hour"))).filter(
        F.abs(F.col(measure) - F.col("level")) > limit * F.col("spread")).drop("_by", "_hour", "_at")
