"""Star schema: dimensions with repeatable surrogate keys, and three facts.

A surrogate key is 60 bits of the digest of the natural key, so every run and
every site gives a member the same key without numbering rows or asking a
table of keys.  Two members of one key fail the build.  Each dimension has the
unknown member ``-1``, which facts point at where a natural key is missing or
not in the master.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import date_of
from ..functions.numeric import exact_sum
from ..operators.dedup import spread

UNKNOWN = -1


def surrogate_key(natural: str | Column) -> Column:
    """Number from 0 to 2**60 - 1 of a natural key's text; null stays null."""
    key = F.col(natural) if isinstance(natural, str) else natural
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")


def dimension(master: DataFrame, natural: str, key: str) -> DataFrame:
    """Master rows under a surrogate key, plus the unknown member with empty attributes.

    Rows without a natural key are the unknown member.  A natural key that
    occurs twice, or two keys of one digest, fail the query.
    """
    rest = [c for c in master.columns]
    grouped = master.filter(F.col(natural).isNotNull()).groupBy(surrogate_key(natural).alias(key)).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    single = F.when(F.col("_n") == 1, F.col("_row")).otherwise(
        F.raise_error(F.concat(F.lit(f"members share {key} "), F.col(key).cast("string"))))
    members = grouped.select(key, single.alias("_row")).select(key, "_row.*")
    spark = master.sparkSession
    unknown = spark.range(1).select(
        F.lit(UNKNOWN).cast("bigint").alias(key), *[F.lit(None).cast(master.schema[c].dataType).alias(c) for c in rest])
    return members.unionByName(unknown)


def with_keys(facts: DataFrame, **dimensions: tuple[DataFrame, str]) -> DataFrame:
    """``facts`` with ``<name>_key`` of each named (dimension, natural key); unknown ones get -1.

    Only the keys of a dimension are joined.  Facts without a natural key need
    no partner, so they can't gather in one task: their join key is spread.
    """
    for name, (dim, natural) in dimensions.items():
        key, own = f"{name}_key", facts[natural]
        known = dim.filter(F.col(natural).isNotNull()).select(F.col(natural).cast("string").alias("_natural"), key)
        nowhere = F.concat(F.lit("\0"), F.pmod(spread(facts.columns), F.lit(1024)).cast("string"))
        joined = facts.withColumn("_own", F.coalesce(own.cast("string"), nowhere))
        facts = joined.join(known, joined["_own"] == known["_natural"], "left").withColumn(
            key, F.coalesce(F.col(key), F.lit(UNKNOWN).cast("bigint"))).drop("_own", "_natural")
    return facts


def sales_fact(delivery: DataFrame, customer: DataFrame, product: DataFrame) -> DataFrame:
    """Order value and lines by customer, product and order day."""
    lines = delivery.groupBy("customer_id", "product_id", date_of("order_date").alias("order_day")).agg(
        exact_sum("net_order_value").alias("value"), F.count(F.lit(1)).alias("lines"))
    keyed = with_keys(lines, customer=(customer, "customer_id"), product=(product, "product_id"))
    return keyed.groupBy("customer_key", "product_key", "order_day").agg(
        exact_sum("value").alias("net_order_value"), F.sum("lines").alias("order_lines"))


def _context(orders: DataFrame, *columns: str) -> DataFrame:
    return orders.select("work_order_id", *columns)


def production_fact(
    runs: DataFrame, orders: DataFrame, plant: DataFrame, machine: DataFrame, product: DataFrame,
) -> DataFrame:
    """Runs, quantities and minutes by plant, machine, product of the work order, and day."""
    measures = ("output_quantity", "good_quantity", "scrap_quantity", "runtime_minutes", "idle_minutes")
    context = _context(orders, "plant_id", F.col("product_id").alias("_product_id"))
    joined = runs.drop("product_id", "plant_id").join(context, "work_order_id", "left")
    # Summed by natural keys first: few rows go on to the key lookups.
    by_day = joined.groupBy("plant_id", "machine_id", F.col("_product_id").alias("product_id"),
                            F.col("run_date").alias("production_day")).agg(
        F.count(F.lit(1)).alias("run_count"), *[exact_sum(m).alias(m) for m in measures])
    keyed = with_keys(by_day, plant=(plant, "plant_id"), machine=(machine, "machine_id"), product=(product, "product_id"))
    return keyed.groupBy("plant_key", "machine_key", "product_key", "production_day").agg(
        F.sum("run_count").alias("run_count"), *[exact_sum(m).alias(m) for m in measures])


def quality_fact(inspections: DataFrame, orders: DataFrame, plant: DataFrame, product: DataFrame) -> DataFrame:
    """Inspections, samples and defects by plant, product, day and defect code."""
    joined = inspections.join(_context(orders, "plant_id"), "work_order_id", "left")
    by_day = joined.groupBy("plant_id", "product_id", date_of("inspection_datetime").alias("inspection_day"), "defect_code").agg(
        F.count(F.lit(1)).alias("inspection_count"), exact_sum("sample_size").alias("sample_size"),
        exact_sum("defect_count").alias("defect_count"), F.sum("high_defect_risk").alias("high_risk_count"))
    keyed = with_keys(by_day, plant=(plant, "plant_id"), product=(product, "product_id"))
    return keyed.groupBy("plant_key", "product_key", "inspection_day", "defect_code").agg(
        F.sum("inspection_count").alias("inspection_count"), exact_sum("sample_size").alias("sample_size"),
        exact_sum("defect_count").alias("defect_count"), F.sum("high_risk_count").alias("high_risk_count"))
