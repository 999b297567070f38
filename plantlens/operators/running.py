"""Running totals over an order that spans all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_total(df: DataFrame, value: str, order: list[Column], name: str) -> DataFrame:
    """Exact running sum of ``value`` along ``order``, which must be total.

    A window without partitions would put every row into one task.  Here the
    rows are range-partitioned by the order, each range sums its own rows, and
    the totals of the ranges before it (one row per range) are added.  The
    ranges are pinned by a checkpoint, so both steps see the same ones.
    """
    exact = F.col(value).cast("decimal(28,6)")
    ranged = cut_lineage(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    )
    totals = ranged.groupBy("_range").agg(F.sum(exact).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        ranged.join(offsets, "_range", "left")
        .withColumn(name, (F.sum(exact).over(within) + F.col("_before")).cast("double"))
        .drop("_range", "_before")
    )
