"""Quantile sketches against numpy, and drift over their bins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlens.operators import sketches
from plantlens.plans import extended

WIDTH = 2.0 ** -sketches.BITS


def _frame(spark, columns):
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"{c} double" for c in columns))


def test_buckets_keep_order_and_are_narrow(spark):
    random.seed(1)
    values = [0.0, 5e-324, 1.7e308, 1.0, 2.0, 8.0, 1 - 2 ** -53, 1000.0, 1 / 3] + [
        math.ldexp(random.random() + 0.5, random.randint(-60, 60)) for _ in range(3000)]
    values = sorted(values + [-v for v in values])
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", sketches.bucket_of(F.col("x")).alias("b")).withColumn("m", sketches.middle_of(F.col("b"))).collect()
    rows.sort(key=lambda r: r.x)
    assert [r.b for r in rows] == sorted(r.b for r in rows)
    for r in rows:
        assert abs(r.m - r.x) <= WIDTH * abs(r.x) or abs(r.x) < 1e-300
        e = math.frexp(abs(r.x))[1] - 1
        want = 0 if r.x == 0 else (e + 1100) * 128 + math.floor((math.ldexp(abs(r.x), -e) - 1) * 128) + 1
        assert abs(r.b) == want or abs(r.x) < 1e-300


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_within_the_stated_error(spark, seed):
    draw = np.random.default_rng(seed)
    columns = {"a": draw.lognormal(size=4000), "b": -draw.exponential(size=4000), "c": draw.integers(0, 5, size=4000)}
    shares = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r.feature: r for r in sketches.quantiles(sketches.sketch(_frame(spark, columns), list(columns)), shares).collect()}
    for name, values in columns.items():
        ordered = np.sort(values)
        for i, p in enumerate(shares):
            exact = ordered[max(0, math.ceil(p * len(ordered)) - 1)]
            assert abs(got[name][f"q_{i}"] - exact) <= WIDTH / 2 * abs(exact) + 1e-12
        assert got[name]["rows"] == 4000


def test_sketches_of_days_merge_to_that_of_all(spark):
    draw = np.random.default_rng(4)
    frame = _frame(spark, {"a": draw.normal(size=2000), "b": draw.lognormal(size=2000)}).withColumn(
        "day", F.spark_partition_id())
    whole = sketches.sketch(frame, ["a", "b"])
    days = sketches.merged(sketches.sketch(frame, ["a", "b"], by=["day"]))
    assert sorted(whole.collect()) == sorted(days.collect())


def _psi_by_hand(reference, current, bins):
    """Bins by bucket, one value at a time."""
    def bucket(x):
        if x == 0:
            return 0
        e = math.frexp(abs(x))[1] - 1
        return int(math.copysign((e + 1100) * 128 + math.floor((math.ldexp(abs(x), -e) - 1) * 128) + 1, x))

    ref, cur = sorted(map(bucket, reference)), sorted(map(bucket, current))
    place = lambda b: min(bins - 1, sum(r < b for r in ref) * bins // len(ref))
    count = lambda side: [sum(place(b) == k for b in side) for k in range(bins)]
    total = 0.0
    for r, c in zip(count(ref), count(cur), strict=True):
        if r or c:
            p, q = max(r / len(ref), 0.0001), max(c / len(cur), 0.0001)
            total += (q - p) * math.log(q / p)
    return total


def test_drift_by_hand(spark):
    draw = np.random.default_rng(6)
    early, late = draw.lognormal(size=300), draw.lognormal(0.3, 1.2, size=200)
    ties = np.repeat([1.0, 2.0, 3.0], 100)
    one = sketches.sketch(_frame(spark, {"a": early, "t": ties}), ["a", "t"])
    two = sketches.sketch(_frame(spark, {"a": late, "t": ties[100:]}), ["a", "t"])
    got = {r.feature: r for r in extended.quantile_drift(one, two).collect()}
    assert got["a"].psi == pytest.approx(_psi_by_hand(early, late, 10))
    assert got["t"].psi == pytest.approx(_psi_by_hand(ties, ties[100:], 10))
    assert (got["a"].ref_rows, got["a"].cur_rows) == (300, 200)
    assert got["a"].ref_median == pytest.approx(np.sort(early)[149], rel=WIDTH)
    bins = {r.bin: r.ref_n for r in sketches.quantile_bins(one, two).where("feature = 'a'").collect()}
    assert len(bins) == 10 and all(abs(n - 30) <= 3 for n in bins.values())


def test_missing_values_and_empty_windows(spark):
    frame = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (2.0,)], "x double")
    assert sketches.sketch(frame, ["x"]).collect()[0]["n"] == 1
    some, none = sketches.sketch(frame, ["x"]), sketches.sketch(frame.limit(0), ["x"])
    assert extended.quantile_drift(none, none).count() == 0
    got = extended.quantile_drift(none, some).first()
    assert (got.ref_rows, got.cur_rows, got.ref_median) == (0, 1, None)
