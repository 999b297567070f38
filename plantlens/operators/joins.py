"""Join forms that stay even when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import apart


def left_join_many(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join whose right side may hold most of its rows under one key.

    AQE may split only the preserved side of an outer join, so a hot key on the
    right would land in one task.  Matched rows therefore come from an inner
    join, where either side can be split, and unmatched left rows from an anti
    join against the distinct keys.  Same rows as a left join.

    Rows without a key match nothing and pass by both joins; with the same
    filter in front of them the two joins share one shuffle of the left side.
    A key that is hot on the left is split in both.
    """
    keys = list(keys)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed = left.filter(complete)
    matched = keyed.join(right, keys, "inner")
    # Grouped by their hash too, so the join shuffles the keys again and can split the left side.
    known = right.select(*keys, apart(keys).alias("_apart")).distinct().drop("_apart")
    unmatched = keyed.join(known, keys, "left_anti")
    return matched.unionByName(
        unmatched.unionByName(left.filter(~complete)), allowMissingColumns=True
    )
