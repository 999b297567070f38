"""Filter interaction audit by a Gray-code walk over filter subsets (operator 13).

One scan gives each document a mask of the filters that it fails.  A part's
documents then fall into at most 32 mask cells, each with its counts of
documents, good ones and toxic ones.  The walk visits all 32 filter subsets in
Gray-code order, so each move switches one filter on or off: every cell holds
the number of active filters that it fails, and the running survivors change
only by cells whose number leaves or reaches zero.  The 32 survivor states give
every step of every order as the difference of two of them.

Texts meet in shuffles by digest only: the least doc_id of each repeated text
is an aggregate (combined in the map tasks), joined back to narrow rows, so a
text that a third of the rows hold is a hot left key that AQE splits.

Defined results: null texts are empty, so all empty texts are identical; empty
texts fail A alone (and E).  Only a strictly smaller doc_id makes a row fail E,
so repeated rows of one id don't, and a null id is neither smaller nor larger
than any.  A null part is the empty string.  Labels count once an id however
often they are repeated; null labels and ids without labels count as 0.  Empty
tables have no parts and give no rows.  Distinct words are told apart by 64-bit
hashes, equal texts by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import map_arrow, map_batches, table, written
from .textarrays import IS_SPACE, byte_table, pieces, row_of, span_hash, spans

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
MARKS = b"#$%&*|"

_IS_CAPITAL = byte_table(bytes(range(ord("A"), ord("Z") + 1)))
_IS_MARK = byte_table(MARKS)
_BEGINS_CHAR = byte_table(bytes([*range(0x80), *range(0xC0, 0x100)]))

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _inside(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags in each text."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def text_failures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mask of the failed filters A to D (bits 0 to 3) of each text."""
    starts, ends, first = spans(~IS_SPACE[data], offsets)
    n_words, row = np.diff(first), row_of(first)
    word = span_hash(data, starts, ends)
    order = np.lexsort((word, row))
    row, word = row[order], word[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1])
    n_distinct = np.bincount(row[new], minlength=len(n_words))
    failed = (
        n_words < MIN_WORDS,
        100 * n_distinct < MIN_DISTINCT_PERCENT * n_words,
        100 * _inside(_IS_CAPITAL[data], offsets) > MAX_CAPITALS_PERCENT * _inside(_BEGINS_CHAR[data], offsets),
        _inside(_IS_MARK[data], offsets) > 0,
    )
    return sum(f.astype(np.int32) << bit for bit, f in enumerate(failed))


def with_text_failures(docs: DataFrame, text: str = "text", out: str = "failed") -> DataFrame:
    """``docs`` with the mask of filters A to D that each text fails."""
    def columns(batch: pa.RecordBatch):
        made = [text_failures(data, offsets)
                for _, _, data, offsets in pieces(batch.column(batch.schema.get_field_index(text)))]
        yield pa.array(np.concatenate(made) if made else np.empty(0, np.int32), type=pa.int32())

    return map_batches(docs, f"`{out}` int", columns)


def with_failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part and failed (mask of A to E) of each row; its texts are read once."""
    rows = written(
        with_text_failures(docs.select(
            "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
        ).select("doc_id", "part", "failed", F.unhex(F.sha2("text", 256)).alias("digest")), "filter-failures")
    repeated = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    return rows.join(repeated.drop("n"), "digest", "left").select(
        "doc_id", "part", F.col("failed").bitwiseOR(F.shiftleft(copy, len(FILTERS) - 1)).alias("failed"))


def cells(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones of each part and mask: at most 32 rows a part."""
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    ).where("doc_id is not null and (good = 1 or toxic = 1)")
    return rows.join(known, "doc_id", "left").groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.expr("count_if(good = 1)").alias("good"), F.expr("count_if(toxic = 1)").alias("toxic"))


def survivors(masks: list[int], counts: np.ndarray, n_filters: int = len(FILTERS)) -> np.ndarray:
    """Sums of ``counts`` (a row a cell) that survive each filter subset, by Gray-code walk.

    Row s of the result belongs to the filters whose bits are set in s.
    """
    states = np.zeros((1 << n_filters, counts.shape[1]), dtype=np.int64)
    active = [0] * len(masks)
    running = counts.sum(axis=0)
    states[0] = running
    subset = 0
    for move in range(1, 1 << n_filters):
        bit = (move & -move).bit_length() - 1
        subset ^= 1 << bit
        on = subset >> bit & 1
        for cell, mask in enumerate(masks):
            if not mask >> bit & 1:
                continue
            if on and active[cell] == 0:
                running = running - counts[cell]
            active[cell] += 1 if on else -1
            if not on and active[cell] == 0:
                running = running + counts[cell]
        states[subset] = running
    return states


def _orders(n: int) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """All orders, and of each step the filter and the subset active before it."""
    orders = list(permutations(range(n)))
    at = np.array(orders, dtype=np.int64).reshape(len(orders), n)
    bits = 1 << at
    return orders, at, np.cumsum(bits, axis=1) - bits


def steps(states: np.ndarray) -> dict[str, np.ndarray]:
    """Measures of each step of each order, in the order of ``permutations``, from the survivor states."""
    n = len(states).bit_length() - 1
    _, at, before = _orders(n)
    lost = states[before] - states[before | 1 << at]
    single = 1 << np.arange(n)
    failing = states[0, 0] - states[single, 0]
    unique = states[len(states) - 1 - single, 0] - states[-1, 0]
    shapley = np.zeros(n, dtype=np.int64)
    np.add.at(shapley, at.ravel(), lost[:, :, 0].ravel())
    made = (states[before | 1 << at][:, :, 0], lost[:, :, 0], failing[at] - lost[:, :, 0], unique[at],
            lost[:, :, 1], lost[:, :, 2], shapley[at])
    return {name: values.ravel() for name, values in zip(MEASURES, made, strict=True)}


def audit(counted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Every step of every order of ``filters`` for each part of ``cells``'s rows.

    A part's cells (at most 2^filters) are one array; parts are spread over tasks.
    """
    n = len(filters)
    orders = ["".join(filters[i] for i in order) for order in permutations(range(n))]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = np.array([[c["n"], c["good"], c["toxic"]] for c in held], dtype=np.int64)
                made = steps(survivors([c["failed"] for c in held], counts, n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (len(orders) * n)), pa.array([o for o in orders for _ in range(n)]),
                     pa.array(list(range(1, n + 1)) * len(orders), type=pa.int32()),
                     *(pa.array(made[m]) for m in MEASURES)],
                    names=["part", "filter_order", "step", *MEASURES])

    return map_arrow(parts, run, schema)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(cells(with_failures(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")))


OP13_ORACLE = r"""
with texts as (select coalesce(source, '') as part, doc_id, coalesce(text, '') as t,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
known as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good,
                 max(case when toxic = 1 then 1 else 0 end) as toxic
          from labels where doc_id is not null group by 1),
failed as (
    select texts.part, coalesce(known.good, 0) as good, coalesce(known.toxic, 0) as toxic,
           {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
            'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
            'D': regexp_matches(t, '[#$%&*|]'),
            'E': coalesce(texts.doc_id > min(texts.doc_id) over (partition by t), false)} as f
    from texts left join known on texts.doc_id = known.doc_id),
letters as (
    select part, good, toxic, (case when f['A'] then 'A' else '' end) || (case when f['B'] then 'B' else '' end)
           || (case when f['C'] then 'C' else '' end) || (case when f['D'] then 'D' else '' end)
           || (case when f['E'] then 'E' else '' end) as fails from failed),
cells as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from letters group by all),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e
    where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (
    select filter_order, step, substr(filter_order, step, 1) as letter, substr(filter_order, 1, step - 1) as earlier
    from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
met as (
    select part, filter_order, step, letter, n, good, toxic, fails, contains(fails, letter) as now,
           earlier <> '' and regexp_matches(fails, '[' || earlier || '_]') as before
    from cells, steps),
counted as (
    select part, filter_order, step, letter,
           sum(case when not now and not before then n else 0 end) as kept,
           sum(case when now and not before then n else 0 end) as removed,
           sum(case when now and before then n else 0 end) as redundant,
           sum(case when fails = letter then n else 0 end) as unique_fails,
           sum(case when now and not before then good else 0 end) as good_lost,
           sum(case when now and not before then toxic else 0 end) as toxic_lost
    from met group by all)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
       redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
       toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, letter))::bigint as shapley
from counted
"""
