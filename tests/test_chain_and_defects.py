"""Chain order, subsets of quasi-identifiers and defect finders against brute force."""

import datetime as dt
import itertools
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plantlens.operators import defects, integrity
from plantlens.plans import extended


def _order_by_hand(links):
    """Origin, position, children and state, one transaction at a time."""
    before = {}
    for h, p in links:
        if h is not None:
            known = before.get(h)
            before[h] = p if known is None else known if p is None else min(known, p)
    children, made = Counter(p for p in before.values() if p is not None), {}
    for h in before:
        path = [h]
        while before[path[-1]] in before and before[path[-1]] not in path:
            path.append(before[path[-1]])
        last = path[-1]
        if before[last] in before:  # came round
            state = "cycle" if h in path[path.index(before[last]):] else "into_cycle"
            made[h] = (None, None, children[h], state)
        else:
            state = "broken" if last == h and before[h] is not None else "linked"
            made[h] = (last, len(path) - 1, children[h], state)
    return made


@pytest.mark.parametrize("seed", range(3))
def test_chain_order_by_hand(spark, seed):
    random.seed(seed)
    names = [f"h{i}" for i in range(60)]
    links = [(h, random.choice([None, "gone", f"h{max(0, i - 1)}", f"h{max(0, i - 1)}", random.choice(names)]))
             for i, h in enumerate(names)] + [("h3", "h9"), (None, "h1"), (None, None)]
    links += [(f"long{i}", f"long{i - 1}" if i else None) for i in range(50)]
    got = integrity.chain_order(spark.createDataFrame(links, "transaction_hash string, previous_hash string"))
    rows = {r.transaction_hash: (r.origin_hash, r.position, r.children, r.state) for r in got.collect()}
    assert rows == _order_by_hand(links)
    assert rows["long49"] == ("long0", 49, 0, "linked")


def test_chain_of_one_cycle_and_none(spark):
    schema = "transaction_hash string, previous_hash string"
    ring = [(f"r{i}", f"r{(i + 1) % 5}") for i in range(5)] + [("self", "self"), ("tail", "r2"), ("end", "tail")]
    rows = {r.transaction_hash: r.state for r in integrity.chain_order(spark.createDataFrame(ring, schema)).collect()}
    assert rows == {**{f"r{i}": "cycle" for i in range(5)}, "self": "cycle", "tail": "into_cycle", "end": "into_cycle"}
    assert integrity.chain_order(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_subsets_equal_brute_force(spark, seed):
    random.seed(seed)
    names = ["a", "b", "c", "d", "e"]
    records = [tuple(random.choice([None, "x", "y", "z"][:k + 2]) for k in (0, 1, 2, 2, 2)) for _ in range(120)]
    got = extended.subset_anonymity(spark.createDataFrame(records, ", ".join(f"{n} string" for n in names)), names).collect()
    assert len(got) == 31 and any(not r.computed for r in got) and any(r.computed for r in got)
    for r in got:
        picked = [names.index(n) for n in r.identifiers.split(",")]
        groups = Counter(tuple(rec[i] for i in picked) for rec in records)
        assert r.smallest_group == min(groups.values())
        if r.computed:
            assert (r.groups, r.rows_alone) == (len(groups), sum(n == 1 for n in groups.values()))
    none = extended.subset_anonymity(spark.createDataFrame([], "a string, b string"), ["a", "b"]).collect()
    assert [r.smallest_group for r in none] == [None] * 3


def test_copies_and_conflicts(spark):
    rows = [(1, "a", None), (1, "a", None), (2, "a", ""), (2, "a", None), (3, "b", "c"), (None, "n", "n"), (None, "n", "m")]
    df = spark.createDataFrame(rows, "k int, v string, w string")
    assert [tuple(r) for r in defects.exact_duplicates(df).collect()] == rows[:2]
    found = defects.conflicting_keys(df, ["k"]).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [rows[2], rows[3], rows[5], rows[6]]))


def _spikes_by_hand(rows, hours, limit):
    by_hour = {}
    for m, at, x, _ in rows:
        if at is not None and x is not None:
            by_hour.setdefault((m, at.replace(minute=0, second=0)), []).append(x)
    medians = {k: statistics.median(v) for k, v in by_hour.items()}
    near = lambda k: [o for o in medians if o[0] == k[0] and abs((o[1] - k[1]).total_seconds()) <= hours * 3600]
    level = {k: statistics.median(medians[o] for o in near(k)) for k in medians}
    spread = {k: 1.4826 * statistics.median(abs(medians[o] - level[o]) for o in near(k)) for k in medians}
    return sorted(i for m, at, x, i in rows if at is not None and x is not None
                  for k in [(m, at.replace(minute=0, second=0))] if spread[k] > 0 and abs(x - level[k]) > limit * spread[k])


def test_spikes_by_hand(spark):
    random.seed(9)
    start = dt.datetime(2026, 1, 1)
    rows = []
    for i in range(400):
        at = start + dt.timedelta(minutes=random.randrange(60 * 24 * 4))
        x = 20 + 5 * (at.hour / 24) + random.gauss(0, 1) + (80 if i % 50 == 0 else 0)
        rows.append((random.choice(["M1", "M2"]), at, x, i))
    rows += [("M1", None, 500.0, 1000), ("M1", start, None, 1001), ("M3", start, 9.0, 1002)]
    df = spark.createDataFrame(rows, "machine_id string, timestamp timestamp_ntz, x double, i int")
    got = sorted(r.i for r in defects.spikes(df, "x", hours=6, limit=8.0).collect())
    assert got == _spikes_by_hand(rows, 6, 8.0)
    assert set(range(0, 400, 50)) <= set(got)


def test_chain_rounds_neither_repeat_nor_swell_the_plan(spark, monkeypatch):
    """A cycle behind a long lead among many short chains: few rounds, and sizes that are those of files."""
    rows = [(f"n{i}", f"n{i - 1}" if i % 3 else None) for i in range(600)]
    rows += [("c0", "c2"), ("c1", "c0"), ("c2", "c1"), ("t0", "c0")] + [(f"t{i}", f"t{i - 1}") for i in range(1, 12)]
    written = []
    kept = integrity.stored
    monkeypatch.setattr(integrity, "stored", lambda df, label, **more: written.append(label) or kept(df, label, **more))
    ordered = integrity.chain_order(spark.createDataFrame(rows, "transaction_hash string, previous_hash string"))
    size = ordered._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)).bit_length() < 400
    assert written.count("chain-round") <= 4 and written.count("chain-cycles") <= 4
    found = {r["transaction_hash"]: r for r in ordered.collect()}
    assert len(found) == len(rows)
    assert all((found[f"n{i}"]["origin_hash"], found[f"n{i}"]["position"]) == (f"n{i - i % 3}", i % 3) for i in range(600))
    assert {found[f"c{i}"]["state"] for i in range(3)} == {"cycle"}
    assert {found[f"t{i}"]["state"] for i in range(12)} == {"into_cycle"}
    assert found["c0"]["children"] == 2 and found["n5"]["children"] == 0 and found["n4"]["children"] == 1
