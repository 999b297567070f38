"""Mergeable quantile sketches: counts by log-linear bucket.

A value's bucket is its binary exponent and the first ``BITS`` bits of its
fraction, so a bucket is narrower than ``2**-BITS`` of the values in it.  The
sketch of a column is one row a bucket with an exact count.  Sketches of parts,
days or windows merge by adding counts, in any order and with the same result,
and their size is bounded by the value range, not by the number of rows (some
hundred buckets a power of ten).

Quantiles are right to half a bucket's width, relative to the value.  Shares
between bucket borders are exact.  Missing, NaN and infinite values are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import finite

BITS = 7
_LEAST_EXPONENT = 1100  # above that of the smallest double, so that codes are positive


def bucket_of(x: Column, bits: int = BITS) -> Column:
    """Whole number that grows with the value; 0 is the value 0.

    The logarithm only guesses the exponent, comparisons with powers of two
    settle it, and everything after that is exact in binary arithmetic.
    """
    size, two = F.abs(x), F.lit(2.0)
    guess = F.floor(F.log2(size))
    power = F.pow(two, guess)
    exponent = guess + F.when(power > size, -1).when(power * two <= size, 1).otherwise(0)
    fraction = F.floor((size / F.pow(two, exponent) - 1) * F.lit(float(1 << bits)))
    code = (exponent + _LEAST_EXPONENT) * F.lit(1 << bits) + fraction + 1
    return F.when(x == 0, F.lit(0)).when(x < 0, -code).otherwise(code).cast("bigint")


def middle_of(bucket: Column, bits: int = BITS) -> Column:
    """The value in the middle of a bucket."""
    code = F.abs(bucket) - 1
    steps = F.lit(1 << bits)
    exponent = F.floor(code / steps) - _LEAST_EXPONENT
    value = F.pow(F.lit(2.0), exponent) * (1 + (F.pmod(code, steps) + F.lit(0.5)) / steps)
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.signum(bucket.cast("double")) * value)


def sketch(df: DataFrame, features: Sequence[str], by: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """(*by, feature, bucket, n) of the listed columns; combined in the map tasks."""
    values = df.select(*by, *[finite(F.col(c).cast("double")).alias(c) for c in features])
    return (
        values.unpivot(list(by), list(features), "feature", "_x").filter(F.col("_x").isNotNull())
        .groupBy(*by, "feature", bucket_of(F.col("_x"), bits).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One sketch for each ``by`` out of several."""
    return sketches.groupBy(*by, "feature", "bucket").agg(F.sum("n").alias("n"))


def quantiles(
    sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = (), bits: int = BITS,
) -> DataFrame:
    """(*by, feature, rows, q_0, q_1, ...): the values at these shares of the rows, one column each.

    The value at share p is that of the row with rank ceil(p * rows), as its
    bucket's middle.  Windows hold the buckets of one feature.
    """
    along = Window.partitionBy(*by, "feature").orderBy("bucket")
    counted = sketches.withColumns({
        "_below": F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)),
        "_rows": F.sum("n").over(Window.partitionBy(*by, "feature")),
    })
    at = lambda p: F.min(F.when(F.col("_below") >= F.ceil(F.lit(p) * F.col("_rows")), F.col("bucket")))
    return counted.groupBy(*by, "feature").agg(
        F.max("_rows").alias("rows"), *[middle_of(at(p), bits).alias(f"q_{i}") for i, p in enumerate(probabilities)])


def quantile_bins(reference: DataFrame, current: DataFrame, bins: int = 10) -> DataFrame:
    """(feature, bin, ref_n, cur_n): both sketches counted in bins of equal reference share.

    A bucket belongs to the bin that the reference rows below it have reached,
    so bin edges are the reference quantiles moved to a bucket border, and a
    value that many rows share is never torn apart.
    """
    side = lambda df, ref: df.select("feature", "bucket", F.when(F.lit(ref), F.col("n")).otherwise(0).alias("ref_n"),
                                     F.when(F.lit(not ref), F.col("n")).otherwise(0).alias("cur_n"))
    both = side(reference, True).unionByName(side(current, False)).groupBy("feature", "bucket").agg(
        F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
    along = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = both.withColumns({
        "_below": F.coalesce(F.sum("ref_n").over(along), F.lit(0)),
        "_rows": F.sum("ref_n").over(Window.partitionBy("feature")),
    })
    slot = F.when(F.col("_rows") > 0, F.expr(f"_below * {bins} div _rows")).otherwise(0)
    return placed.groupBy("feature", F.least(F.lit(bins - 1), slot).cast("int").alias("bin")).agg(
        F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
