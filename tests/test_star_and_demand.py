"""Star schema keys and gap-encoded demand against brute force."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plantlens.plans import extended, star


def key_of(natural):
    return int(hashlib.md5(str(natural).encode()).hexdigest()[:15], 16)


def test_dimension_has_repeatable_keys_and_an_unknown_member(spark):
    master = spark.createDataFrame([(1, "a"), (2, "b"), (None, "lost")], "product_id int, family string")
    rows = {r.product_key: (r.product_id, r.family) for r in star.dimension(master, "product_id", "product_key").collect()}
    assert rows == {key_of(1): (1, "a"), key_of(2): (2, "b"), -1: (None, None)}
    again = star.dimension(master.repartition(3), "product_id", "product_key").collect()
    assert {r.product_key for r in again} == set(rows)


def test_members_that_share_a_key_fail(spark):
    master = spark.createDataFrame([(1, "a"), (1, "b")], "product_id int, family string")
    with pytest.raises(Exception, match="members share product_key"):
        star.dimension(master, "product_id", "product_key").collect()


def test_facts_point_at_the_unknown_member(spark):
    customers = spark.createDataFrame([(7,)], "customer_id int")
    products = spark.createDataFrame([("X",)], "product_id string")
    delivery = spark.createDataFrame(
        [(7, "X", 1.0), (7, "gone", 2.0), (8, "X", 4.0), (None, None, 8.0), (None, None, 16.0), (9, "gone", 32.0)],
        "customer_id int, product_id string, net_order_value double").withColumn("order_date", F.lit("2026-01-01").cast("date"))
    got = {(r.customer_key, r.product_key): (r.net_order_value, r.order_lines) for r in star.sales_fact(
        delivery, star.dimension(customers, "customer_id", "customer_key"),
        star.dimension(products, "product_id", "product_key")).collect()}
    assert got == {(key_of(7), key_of("X")): (1.0, 1), (key_of(7), -1): (2.0, 1), (-1, key_of("X")): (4.0, 1), (-1, -1): (56.0, 3)}


def _orders(spark, rows):
    return spark.createDataFrame(
        [(p, dt.datetime(2026, 1, 1) + dt.timedelta(days=d, hours=5), q) for p, d, q in rows],
        "product_id string, order_date timestamp, ordered_quantity double")


def _key(row):
    return tuple("" if v is None else str(v) for v in row)


@pytest.mark.parametrize("seed", range(3))
def test_expanded_runs_equal_dense_demand(spark, seed):
    random.seed(seed)
    rows = [(random.choice("abc"), random.choice([random.randrange(90), 40 + random.randrange(4)]), float(random.randrange(1, 9)))
            for _ in range(25)]
    orders = _orders(spark, [*rows, ("z", 0, 1.0), ("y", 89, 2.0)])
    dense = extended.daily_demand(orders)
    runs = extended.demand_runs(orders)
    got = extended.expand_runs(runs).select(*dense.columns)
    assert sorted(map(_key, got.collect())) == sorted(map(_key, dense.collect()))
    idle = runs.where("from_date < to_date").collect()
    assert idle and all(r.demand_quantity == r.mean_prior_7d == 0 for r in idle)
    # Runs are as long as they can be: two idle ones never touch.
    ends = {(r.product_id, r.to_date) for r in runs.where("demand_quantity = 0 and lag_7 = 0 and mean_prior_7d = 0").collect()
            if r.from_date < r.to_date}
    assert not any((r.product_id, r.from_date - dt.timedelta(days=1)) in ends for r in idle)


def test_demand_runs_stay_small_over_a_long_calendar(spark):
    orders = _orders(spark, [("a", 0, 1.0), ("a", 30_000, 2.0), ("b", 15_000, 3.0)])
    assert extended.demand_runs(orders).count() < 50
    assert extended.demand_runs(orders.limit(0)).count() == 0


def test_demand_runs_move_order_days_and_not_the_days_around_them(spark):
    """Days that look back at an order are made after the last shuffle; one sort serves all windows."""
    orders = _orders(spark, [("a", 0, 1.0), ("a", 3, 2.0), ("b", 40, 3.0)])
    plan = extended.demand_runs(orders)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("HashAggregate")
    assert plan.count("Window") <= 8
