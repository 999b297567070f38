"""Byte-level BPE by corpus-level merge replay (operator 7).

The texts that a task reads are taken as one corpus.  Their distinct pieces
(matches of the splitting pattern) are laid out as one array of byte symbols,
linked to their neighbours.  An inverted index leads from the rank of a token
pair to all positions where the pair stands; the ranks are replayed in
ascending order over the whole corpus, and each merge re-ranks only the pairs
that touch it.  A piece of a thousand occurrences is therefore merged once.

Pieces are independent, so applying the least rank of the corpus next also
applies the least rank of each piece next, which is the library's rule.  Where
a merge can give rise to a pair of lower rank, that rank is applied to the
leftmost position of a piece only, before the others are looked at again.

Null and empty texts have no tokens.  Columns with the names of the new ones
are replaced; repeated rows are encoded alike.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import digest, map_arrow, table, with_columns

CORPUS_BYTES = 4_000_000  # of text replayed together; bounds a task's memory


class Merges:
    """Ranks of a vocabulary file and the pairs that merge into each token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            lines = (line.split() for line in f if line.strip())
            self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs, self.stepwise = [], set()
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is None or right is None:
                    continue
                pairs.append((left << 32 | right, rank))
                if min(self.rank.get(token + token[:cut], rank), self.rank.get(token[cut:] + token, rank)) < rank:
                    self.stepwise.add(rank)
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self.ranks = np.array([r for _, r in pairs], dtype=np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it doesn't merge."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.ranks[at], np.int32(-1))


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def token_array(path: str) -> np.ndarray:
    return np.array(merges(path).token, dtype=object)


@lru_cache(maxsize=2)
def splitter(pattern: str):
    """The pattern with white space as Unicode defines it, as the tiktoken library reads it."""
    import regex

    exact = pattern.replace(r"\s+(?!\S)", r"\p{White_Space}+(?!\P{White_Space})").replace(r"\s", r"\p{White_Space}")
    return regex.compile(exact)


def _groups(values: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, members) with members ascending."""
    order = np.lexsort((of, values))
    values, of = values[order], of[order]
    cuts = np.flatnonzero(np.diff(values)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True):
        yield int(values[start]), of[start:end]


def replay(pieces: list[bytes], table: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces, and where each piece's ids start."""
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    n = int(bounds[-1])
    if n == 0:
        return np.empty(0, dtype=np.int32), bounds
    symbol = np.empty(n + 1, dtype=np.int32)
    symbol[:n] = table.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    symbol[n] = -1  # neighbour of the ends of every piece
    following = np.arange(1, n + 2, dtype=np.int32)
    preceding = np.arange(-1, n, dtype=np.int32)
    full = sizes > 0
    following[bounds[1:][full] - 1] = n
    preceding[bounds[:-1][full]] = n
    standing = np.ones(n, dtype=bool)
    at_rank = np.full(n + 1, -1, dtype=np.int32)
    at_rank[:n] = table.rank_of(symbol[:n], symbol[following[:n]])

    places = np.flatnonzero(at_rank[:n] >= 0)
    index: dict[int, list[np.ndarray]] = {}
    if len(places):
        index = {rank: [at] for rank, at in _groups(at_rank[places], places)}
    waiting = list(index)
    heapq.heapify(waiting)
    while waiting:
        rank = heapq.heappop(waiting)
        found = index.pop(rank)
        at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        at = at[at_rank[at] == rank]
        if not len(at):
            continue
        if rank in table.stepwise and len(at) > 1:
            piece = np.searchsorted(bounds, at, side="right")
            leftmost = np.concatenate(([True], piece[1:] != piece[:-1]))
            if not leftmost.all():
                index[rank] = [at[~leftmost]]
                heapq.heappush(waiting, rank)
                at = at[leftmost]
        right = following[at]
        if len(at) > 1:
            chained = np.concatenate(([False], right[:-1] == at[1:]))
            if chained.any():  # overlapping places: every second one from the left
                order = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(chained, 0, order))
                keep = (order - begin) % 2 == 0
                at, right = at[keep], right[keep]
        after = following[right]
        symbol[at] = rank
        following[at] = after
        preceding[after] = at
        standing[right] = False
        at_rank[right] = -1
        before = preceding[at]
        touched = np.unique(np.concatenate((at, before[before < n])))
        now = table.rank_of(symbol[touched], symbol[following[touched]])
        at_rank[touched] = now
        merging = now >= 0
        if merging.any():
            for value, members in _groups(now[merging], touched[merging]):
                if value in index:
                    index[value].append(members)
                else:
                    index[value] = [members]
                    heapq.heappush(waiting, value)
    kept = np.concatenate(([0], np.cumsum(standing)))
    return symbol[:n][standing], kept[bounds]


def encode_texts(texts: list[str | None], table: Merges, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and where each text's ids start."""
    find = splitter(pattern).findall
    known: defaultdict[str, int] = defaultdict()
    known.default_factory = known.__len__  # the next free number
    order, counts = [], np.zeros(len(texts) + 1, dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            found = find(text)
            counts[i + 1] = len(found)
            order.append(np.fromiter(map(known.__getitem__, found), dtype=np.int32, count=len(found)))
    ids, starts = replay([x.encode() for x in known], table)
    used = np.concatenate(order) if order else np.empty(0, dtype=np.int32)
    lengths = np.diff(starts)[used]
    ends = np.cumsum(lengths)
    taken = ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[:-1][used] - (ends - lengths), lengths)]
    return taken, np.concatenate(([0], ends))[np.cumsum(counts)]


def joined_tokens(ids: pa.Array, path: str) -> pa.Array:
    """The bytes that lists of ids stand for; a null list gives empty bytes."""
    token = token_array(path)
    at = ids.offsets.to_numpy()
    values = ids.values.slice(at[0], at[-1] - at[0]).to_numpy(zero_copy_only=False)
    valid = ids.is_valid().to_numpy(zero_copy_only=False)
    at = at - at[0]
    return pa.array([b"".join(token[values[a:b]]) if ok else b""
                     for a, b, ok in zip(at[:-1], at[1:], valid, strict=True)], type=pa.binary())


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 200) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", decoded: str | None = None,
) -> DataFrame:
    """``docs`` with the token ids of ``text`` as an array of int, and, if
    ``decoded`` names a column, the bytes that these ids decode to."""
    schema = with_columns(docs, f"`{out}` array<int>" + (f", `{decoded}` binary" if decoded else ""))
    kept = schema.names[:-2] if decoded else schema.names[:-1]

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in held for t in b.column(b.schema.get_field_index(text)).to_pylist()]
        ids, starts = encode_texts(texts, merges(path), pattern)
        row = 0
        for b in held:
            at = starts[row:row + b.num_rows + 1]
            row += b.num_rows
            made = [pa.ListArray.from_arrays(
                pa.array((at - at[0]).astype(np.int32)), pa.array(ids[at[0]:at[-1]], type=pa.int32()))]
            if decoded:
                made.append(joined_tokens(made[0], path))
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(k)) for k in kept] + made, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in _slices(batches):
            held.append(part)
            size += part.column(part.schema.get_field_index(text)).nbytes
            if size >= CORPUS_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return map_arrow(docs, run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for; null ids give empty bytes."""
    schema = with_columns(df, f"`{out}` binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            made = joined_tokens(part.column(part.schema.get_field_index(ids)), path)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(k)) for k in schema.names[:-1]] + [made], names=schema.names)

    return map_arrow(df, run, schema)


def vocabulary() -> tuple[str, str]:
    """Path of the production ranks and the splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def tokenised(docs: DataFrame) -> DataFrame:
    """doc_id, number of tokens and the digests of ids and decoded bytes."""
    path, pattern = vocabulary()
    coded = encode(docs.select("doc_id", "text"), path, pattern, decoded="decoded").drop("text")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents"))
