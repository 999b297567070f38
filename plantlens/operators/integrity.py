"""Checks across tables: references, order lines, operators, hash chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum
from ..session import stored


@dataclass(frozen=True)
class Relation:
    parent: str
    parent_key: str
    child: str
    child_key: str


# The declared entity map.
ENTITY_MAP = (
    Relation("plant_master", "plant_id", "line_master", "plant_id"),
    Relation("line_master", "line_id", "machine_master", "line_id"),
    Relation("product_master", "product_id", "sales_order", "product_id"),
    Relation("sales_order", "sales_order_id", "work_order", "sales_order_id"),
    Relation("work_order", "work_order_id", "production_run", "work_order_id"),
    Relation("production_run", "run_id", "quality_inspection", "run_id"),
    Relation("machine_master", "machine_id", "sensor_reading", "machine_id"),
    Relation("machine_master", "machine_id", "maintenance_log", "machine_id"),
    Relation("sales_order", "sales_order_id", "shipment", "sales_order_id"),
    Relation("shipment", "shipment_id", "customer_complaint", "shipment_id"),
    Relation("supply_chain_transaction", "transaction_hash",
             "supply_chain_transaction", "previous_hash"),
)


def audit_relations(
    tables: Mapping[str, DataFrame], relations: Sequence[Relation] = ENTITY_MAP
) -> DataFrame:
    """Row counts of every relation whose two tables are present.

    Each table is read once: a row gives its keys for all relations it takes
    part in.  The keys of both sides are counted together by relation and key:
    one shuffle with map-side combine, no join, and a hot key costs one row per
    task.
    """
    known = [r for r in relations if r.parent in tables and r.child in tables]
    spark = tables[known[0].child].sparkSession
    stacked = []
    for table in dict.fromkeys(t for r in known for t in (r.child, r.parent)):
        sides = [(i, r.child_key, 1) for i, r in enumerate(known) if r.child == table]
        sides += [(i, r.parent_key, 0) for i, r in enumerate(known) if r.parent == table]
        keys = [F.struct(F.lit(i).alias("_relation"), F.col(k).cast("string").alias("_k"), F.lit(child).alias("_child"))
                for i, k, child in sides]
        stacked.append(tables[table].select(F.explode(F.array(*keys)).alias("_side")).select("_side.*"))
    keys = reduce(DataFrame.unionByName, stacked).groupBy("_relation", "_k").agg(
        F.sum("_child").alias("_n"), F.max(F.lit(1) - F.col("_child")).alias("_found"))
    missing = F.col("_k").isNull()
    orphan = ~missing & (F.col("_found") == 0)
    total = lambda condition: F.sum(F.when(condition, F.col("_n")))
    counted = keys.groupBy("_relation").agg(
        F.sum("_n").alias("child_rows"),
        total(missing).alias("missing_key_rows"),
        total(orphan).alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )
    listed = spark.createDataFrame(
        [(i, r.parent, r.child, r.child_key) for i, r in enumerate(known)],
        "_relation int, from_table string, to_table string, to_key string")
    counts = ("child_rows", "missing_key_rows", "orphan_rows", "orphan_keys")
    return listed.join(counted, "_relation", "left").select(
        "from_table", "to_table", "to_key", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts])


def over_shipped_lines(sales_orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """DQ007: order lines whose shipments together exceed the ordered quantity.

    Our reading: shipments of a line add up; the export may repeat an order
    line, so the ordered quantity is the largest one stated for it.
    """
    keys = ["sales_order_id", "order_line_id"]
    ordered = sales_orders.groupBy(*keys).agg(F.max("ordered_quantity").alias("ordered_quantity"))
    shipped = shipments.groupBy(*keys).agg(
        exact_sum("shipped_quantity").alias("shipped_quantity")
    )
    return shipped.join(ordered, keys, "inner").filter(
        F.col("shipped_quantity") > F.col("ordered_quantity")
    )


def code_operator(c: str = "operator_id"):
    """Blank operator ids carry the fixed code ``UNKNOWN_OPERATOR``."""
    return F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit("UNKNOWN_OPERATOR"))


def unknown_operators(runs: DataFrame, operators: DataFrame) -> DataFrame:
    """DQ008: runs whose operator is not in the master; blank ids are coded."""
    coded = runs.withColumn("operator_id", code_operator())
    return coded.join(operators.select("operator_id"), "operator_id", "left_anti")


def broken_links(chain: DataFrame) -> DataFrame:
    """Transactions whose previous hash names no transaction; roots have none."""
    known = chain.select(F.col("transaction_hash").alias("previous_hash"))
    return chain.filter(F.col("previous_hash").isNotNull()).join(known, "previous_hash", "left_anti")


def out_of_sequence(chain: DataFrame, time_column: str) -> DataFrame:
    """Linked transactions stamped before the transaction they point at."""
    earlier = chain.select(
        F.col("transaction_hash").alias("previous_hash"), F.col(time_column).alias("previous_time")
    )
    return chain.join(earlier, "previous_hash", "inner").filter(
        F.col(time_column) < F.col("previous_time")
    )


def chain_order(chain: DataFrame) -> DataFrame:
    """Origin and position of every transaction of hash chains, with forks and cycles.

    Returns (transaction_hash, origin_hash, position, children, state).  Each
    round replaces a transaction's ancestor by that ancestor's ancestor and adds
    the distances, so a longest chain of n takes log2(n) rounds; what has
    reached its origin takes part in no more joins, and a round in which nothing
    does leaves only what has none.  A fork is a transaction with several
    ``children``.  ``state`` is ``linked``; ``broken`` for an origin whose
    previous hash names no transaction; ``cycle`` for the members of a cycle
    and ``into_cycle`` for what leads to one, both without origin and position.

    Of rows that share a hash the least previous hash counts; rows without a
    hash have no place.  Rounds work on numbers given to the transactions and
    are written out, so neither rows nor plans grow with them.
    """
    links = stored(
        chain.filter(F.col("transaction_hash").isNotNull()).groupBy("transaction_hash").agg(
            F.min("previous_hash").alias("previous_hash")).withColumn("node", F.monotonically_increasing_id()),
        "chain-links")
    known = links.select(F.col("transaction_hash").alias("previous_hash"), F.col("node").alias("_previous"))
    nodes = stored(
        links.join(known, "previous_hash", "left").select(
            "node", "transaction_hash", F.coalesce("_previous", "node").alias("at"),
            F.col("_previous").isNull().alias("done"),
            (F.col("previous_hash").isNotNull() & F.col("_previous").isNull()).alias("broken")),
        "chain-nodes", partition_by=("done",))
    children = nodes.filter("not done").groupBy(F.col("at").alias("node")).agg(F.count(F.lit(1)).alias("children"))
    origins = nodes.filter("done").select(
        F.col("node").alias("at"), F.col("transaction_hash").alias("origin_hash"), "broken")

    steps = nodes.select("node", "at", F.when(F.col("done"), 0).otherwise(1).cast("bigint").alias("distance"), "done")
    placed, active = steps.filter("done"), steps.filter("not done")
    reached = True
    while reached and not active.isEmpty():
        ahead = placed.unionByName(active).select(
            F.col("node").alias("at"), F.col("at").alias("_at"), F.col("distance").alias("_distance"), "done")
        moved = stored(active.drop("done").join(ahead, "at").select(
            "node", F.col("_at").alias("at"), (F.col("distance") + F.col("_distance")).alias("distance"), "done"),
            "chain-round", partition_by=("done",))
        # The round takes in distances from 2**k up to 2**(k+1); where one of them is missing, all larger ones are.
        now = moved.filter("done")
        reached = not now.isEmpty()
        placed, active = placed.unionByName(now), moved.filter("not done")

    # What is left leads into cycles.  The places that 2**k steps lead to are fewer every round until
    # only members of cycles, whose steps go round, are among them.
    active = active.select("node", "at")
    members = active.select(F.col("at").alias("node")).distinct()
    count, before = members.count(), None
    while count != before:
        ahead = active.select(F.col("node").alias("at"), F.col("at").alias("_at"))
        active = stored(active.join(ahead, "at").select("node", F.col("_at").alias("at")), "chain-cycles")
        members = active.select(F.col("at").alias("node")).distinct()
        count, before = members.count(), count
    unrooted = active.join(members.withColumn("_member", F.lit(True)), "node", "left").select(
        "node", F.lit(None).cast(chain.schema["transaction_hash"].dataType).alias("origin_hash"),
        F.lit(None).cast("bigint").alias("position"),
        F.when(F.col("_member"), "cycle").otherwise("into_cycle").alias("state"))
    rooted = placed.join(origins, "at").select(
        "node", "origin_hash", F.col("distance").alias("position"),
        F.when(F.col("broken") & (F.col("distance") == 0), "broken").otherwise("linked").alias("state"))
    return rooted.unionByName(unrooted).join(nodes.select("node", "transaction_hash"), "node").join(
        children, "node", "left").select(
        "transaction_hash", "origin_hash", "position",
        F.coalesce("children", F.lit(0).cast("bigint")).alias("children"), "state")
