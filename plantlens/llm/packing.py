"""Best-fit packing by large-item matching (operator 12).

Token counts are whole numbers up to the capacity, so a packing is planned from
one number a length: how many pieces have it.  The plan is what a packer over
single pieces would do, in runs of equal ones:

* A piece above a third of the capacity shares a sequence with at most one
  other such piece.  Those above half are taken from long to short and matched
  with the longest remaining one of the others that fits; the others left
  over are matched among themselves, longest first.  Fitting partners of a
  longer piece fit every shorter one too, so no matching has more pairs.
* Smaller pieces go, longest first, to the sequence with the least gap that
  holds them; new sequences are begun when none does.

A run says: pieces of this length with ranks from r on go to sequences from s
on, k in each, at this offset.  A run ends a gap class or a length class, so
the plan has a few thousand runs at any corpus size.  Tasks number the pieces
of each length that they read; counts by task and length, added up in Spark,
make these numbers ranks of the whole corpus; each piece then looks up its run.
No group of pieces ever meets in one task.

Ids are those of the named vocabulary of `tokenizers`: the file's merges are
replayed by the `tiktoken` library, which gives the same ids several times
faster when each token's merge is the one of its id (checked on loading).  The
vocabulary's special tokens are ordinary text inside documents.

Defined results: a null text is empty, and an empty text is one piece, its end
token.  Repeated rows are pieces of their own; null ids stay.  Equal lengths
are placed in the order in which tasks read them.  Empty tables give no rows.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import bounded, map_arrow, map_batches, table, written

CAPACITY = 1024
END = 2
TEXT_BYTES = 1 << 20  # of text encoded at a time

_RANK_BITS = 50  # of a run's key; the length stands above them


# --- tokens -----------------------------------------------------------------

def _byte_of_char() -> dict[str, int]:
    """Bytes behind the printable characters that byte-level vocabularies are written in."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """Encoder for the vocabulary and merges of a `tokenizers` file."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    model, byte = content["model"], _byte_of_char()
    special = {t["content"] for t in content["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    first = len(ranks) - len(merges)
    if any(model["vocab"][a + b] != first + i for i, (a, b) in enumerate(merges)):
        raise ValueError(f"{path}: merges aren't in the order of their ids")
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first may be shorter than full."""
    head = n % capacity or min(n, capacity)
    return [(0, head), *((at, capacity) for at in range(head, n, capacity))]


def pieces(
    docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end: int = END, ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece, the task that read it and its
    number among this task's pieces of the same length; with ``ids`` also the token ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, piece int, start long, length int, ids_crc32 long, task int, number long"
              + (", ids array<int>" if ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path, pattern).encode_ordinary, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in bounded(batches, "text", TEXT_BYTES):
            row, piece, start, length, check, held = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                coded = np.array([*encode(text or ""), end], dtype="<u4")
                for k, (at, n) in enumerate(cut(len(coded), capacity)):
                    part = coded[at:at + n]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    check.append(zlib.crc32(part.tobytes()))
                    if ids:
                        held.append(part.astype(np.int32))
            n = np.array(length, dtype=np.int64)
            order = np.argsort(n, kind="stable")
            begin = np.searchsorted(n[order], n[order])
            number = np.empty(len(n), dtype=np.int64)
            number[order] = np.arange(len(n)) - begin
            number += seen[n]
            seen += np.bincount(n, minlength=capacity + 1)
            arrays = [batch.column(0).take(pa.array(row, type=pa.int64())), pa.array(piece, type=pa.int32()),
                      pa.array(start, type=pa.int64()), pa.array(length, type=pa.int32()), pa.array(check, type=pa.int64()),
                      pa.array([task] * len(n), type=pa.int32()), pa.array(number)]
            if ids:
                arrays.append(pa.array(held, type=pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "number", "ids"][:len(arrays)])

    return map_arrow(docs.select("doc_id", "text"), run, schema)


# --- the plan ---------------------------------------------------------------

class Plan:
    """Runs of equal pieces in equal sequences, from the number of pieces of each length."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.left, self.rank = capacity, Counter(counts), Counter()
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, rank, sequence, pieces in each, offset
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, number of them)
        self.sorted_gaps: list[int] = []
        self._large()
        self._small()

    def _put(self, length: int, sequence: int, n: int, each: int, offset: int) -> None:
        if n * each:
            self.runs.append((length, self.rank[length], sequence, each, offset))
            self.rank[length] += n * each
            self.left[length] -= n * each

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _gap(self, gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in self.gaps:
                insort(self.sorted_gaps, gap)
            self.gaps.setdefault(gap, []).append((sequence, n))

    def _pair(self, a: int, b: int | None, n: int) -> None:
        """n new sequences of a piece of length a and, unless none, one of length b."""
        sequence = self._open(n)
        self._put(a, sequence, n, 1, 0)
        if b is not None:
            self._put(b, sequence, n, 1, a)
        self._gap(self.capacity - a - (b or 0), sequence, n)

    def _large(self) -> None:
        capacity = self.capacity
        middle = [m for m in range(capacity // 2, capacity // 3, -1) if 3 * m > capacity]
        for a in range(capacity, capacity // 2, -1):
            for b in middle:
                if a + b <= capacity and self.left[a] and self.left[b]:
                    self._pair(a, b, min(self.left[a], self.left[b]))
            if self.left[a]:
                self._pair(a, None, self.left[a])
        for i, a in enumerate(middle):
            if self.left[a] > 1:
                self._pair(a, a, self.left[a] // 2)
            if self.left[a]:
                b = next((b for b in middle[i + 1:] if self.left[b]), None)
                self._pair(a, b, 1)

    def _small(self) -> None:
        capacity = self.capacity
        for length in range(capacity // 3, 0, -1):
            while self.left[length]:
                at = bisect_left(self.sorted_gaps, length)
                if at == len(self.sorted_gaps):
                    fit = capacity // length
                    self._gap(capacity, self._open(-(-self.left[length] // fit)), -(-self.left[length] // fit))
                    continue
                self._fill(self.sorted_gaps[at], length)

    def _fill(self, gap: int, length: int) -> None:
        """As many pieces of this length as there are into the sequences with this gap."""
        offset, each = self.capacity - gap, gap // length
        held = self.gaps.pop(gap)
        self.sorted_gaps.remove(gap)
        for sequence, n in held:
            full = min(n, self.left[length] // each)
            self._put(length, sequence, full, each, offset)
            self._gap(gap - each * length, sequence, full)
            rest = self.left[length] if full < n else 0  # fewer than fill one more sequence
            if rest:
                self._put(length, sequence + full, 1, rest, offset)
                self._gap(gap - rest * length, sequence + full, 1)
                full += 1
            self._gap(gap, sequence + full, n - full)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Runs in the order of (length, rank): key, rank, sequence, pieces in each, offset."""
        runs = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 5)
        return (runs[:, 0] << _RANK_BITS | runs[:, 1], *runs[:, 1:].T)


def pack(numbered: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces``'s rows (written, as their numbers are a task's) with sequence_id and offset."""
    counts = numbered.groupBy("task", "length").agg(F.count("*").alias("n"))
    # Tasks by length: a window holds one row a task.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-counts")
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most a row a length
    shared = numbered.sparkSession.sparkContext.broadcast(Plan(total, capacity).arrays())

    def columns(batch: pa.RecordBatch):
        at = {name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)
              for name in ("length", "number", "first")}
        rank = at["first"] + at["number"]
        key, begin, sequence, each, offset = shared.value
        run = np.searchsorted(key, at["length"] << _RANK_BITS | rank, side="right") - 1
        place = rank - begin[run]
        yield pa.array(sequence[run] + place // each[run])
        yield pa.array(offset[run] + place % each[run] * at["length"])

    placed = map_batches(
        numbered.join(counts.drop("n"), ["task", "length"]), "sequence_id long, offset long", columns)
    return placed.drop("task", "number", "first")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each sequence, from ``pack``'s rows with ids; at most the capacity's pieces meet."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def vocabulary() -> tuple[str, str]:
    """Path of the production vocabulary and the splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = written(pieces(table(spark, sf_dir, "documents"), *vocabulary()), "packing-pieces")
    return pack(made).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                             "sequence_id", "offset")
