"""Deduplication and profiling.

``keep_last`` filters ``row_number() = 1``: Spark prunes each task to its own
best row per key before the shuffle (WindowGroupLimit), so a key that holds a
third of the table sends one row per task, not the group.

Grouping happens by ``spread(keys)`` next to the keys.  A join on the keys then
shuffles the (smaller) grouped side once more, and in return stands between two
plain shuffles, the only place where AQE can split a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Written by the CSV source: file, split and row position of each record.
INGEST_ORDER = ("_ingest_file", "_ingest_block", "_ingest_row")


def spread(keys: Sequence[str]) -> Column:
    """Hash that keeps a grouping by ``keys`` from standing in for a join shuffle."""
    return F.xxhash64(*keys)


def apart(keys: Sequence[str]) -> Column:
    """Like ``spread``, in one bit: for rows that are shuffled whole, where 8 bytes of hash would not compress.

    It goes behind the keys, so that rows are sorted by key and like values stand together.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(2)) == 0


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key under ``order``; a null order value sorts last and wins.

    ``order`` has to be total within a key, otherwise the survivor is arbitrary.
    """
    window = Window.partitionBy(*keys, apart(keys)).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of ``left.k`` and ``right._k`` in which missing matches missing."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def join_side(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Group sizes ready to join back: keys as ``_key``, count as ``name``."""
    sizes = df.groupBy(spread(keys).alias("_spread"), *keys).agg(F.count(F.lit(1)).alias(name))
    return sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], name)


def flag_duplicates(df: DataFrame, keys: Sequence[str], name: str = "is_duplicate") -> DataFrame:
    """Mark every member of a duplicate group (missing keys form one group).

    Counts per key and joins the repeated keys back instead of a window count:
    the count combines map-side and the join can split a hot key, while a
    window would put the whole group into one task.
    """
    repeated = join_side(df, keys, "_n").filter(F.col("_n") > 1).withColumn("_hit", F.lit(1)).drop("_n")
    joined = df.join(repeated, null_safe_on(df, repeated, keys), "left")
    return joined.withColumn(name, F.coalesce(F.col("_hit"), F.lit(0))).drop(
        "_hit", *[f"_{k}" for k in keys]
    )


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the rows whose key occurs more than once."""
    repeated = join_side(df, keys, "_n").filter(F.col("_n") > 1)
    return df.join(repeated, null_safe_on(df, repeated, keys), "left_semi")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (
        group_sizes(df, keys, "row_count")
        .filter(F.col("row_count") > 1)
        .orderBy(F.desc("row_count"), *keys)
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """One row per column: rows and missing rows, from a single pass."""
    columns = list(df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return counts.unpivot("_rows", columns, "column_name", "missing_rows").select(
        "column_name", F.col("_rows").alias("row_count"), "missing_rows"
    )


def invalid_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.col(end) < F.col(start))


def sensor_out_of_range(df: DataFrame) -> DataFrame:
    """Readings outside the profiling limits, cast leniently from text."""
    temperature = F.col("temperature_c").try_cast("double")
    vibration = F.col("vibration_mm_s").try_cast("double")
    return df.filter((temperature < 0) | (temperature > 150) | (vibration < 0))
