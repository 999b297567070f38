"""LM scoring with an interpolated modified Kneser-Ney bigram model (operator 5).

Counting.  Each task counts pairs of neighbouring tokens (64-bit hashes), and
hands on one packed row for each bucket of contexts.  A bucket's task adds the
counts up, which gives the pair counts, each context's total and its numbers
of followers seen once, twice and more often, and, for each token, in how many
contexts it stands.  The latter are added up by token in the same way.  Pairs
are counted before the shuffle, so a pair or word that holds a third of the
corpus is one number a task.

Model.  Each bucket becomes one file in the shared folder: sorted hash arrays
with their numbers.  Scoring tasks map the files into memory and look up the
distinct pairs of some texts at a time, so a task's own memory doesn't grow
with the corpus.  A folder that isn't a file system of the machine is read
through its client and mapped from an unlinked local copy.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and an end.  The
first word's context is the begin of the text.  Unseen tokens share one unit
of the uniform part, so probabilities add up to 1.  Null and empty texts are
an end only.  Without training rows every token has probability 1 / (V + 1) = 1.
Repeated rows count and score as often as they stand there.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.session import scratch_path

from .frames import held_out, map_arrow, map_batches, table
from .textarrays import mix, pieces, words

HELD = 1 << 21          # tokens that a task collects before it counts them
BEGIN, END = np.uint64(0x0B0B0B0B0B0B0B0B), np.uint64(0x0E0E0E0E0E0E0E0E)

_PAIRS = [("pair", "<u8"), ("count", "<u4"), ("context", "<u8"), ("total", "<u8"), ("once", "<u4"), ("twice", "<u4"), ("more", "<u4")]
_TOKENS = [("token", "<u8"), ("n", "<u8"), ("contexts", "<u4")]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of some texts, each text's end included, and each
    text's first token."""
    hashed, first = words(data, offsets)
    n = len(first) - 1
    ends = first[1:] + np.arange(n)
    out = np.empty(len(hashed) + n, dtype=np.uint64)
    inner = np.ones(len(out), dtype=bool)
    inner[ends] = False
    out[inner] = hashed
    out[ends] = END
    return out, first + np.arange(n + 1)


def contexts_of(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first[:-1]] = BEGIN
    return before


def pair_hash(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(context * np.uint64(0x9E3779B97F4A7C15) + token)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal rows in sorted arrays."""
    if not len(keys[0]):
        return np.empty(0, dtype=np.int64)
    new = np.zeros(len(keys[0]) - 1, dtype=bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    return np.flatnonzero(np.concatenate(([True], new)))


def _packed(bucket: np.ndarray, buckets: int, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket each; the arrays are sorted by bucket."""
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([b], type=pa.int32())]
            + [pa.array([c[cuts[b]:cuts[b + 1]].tobytes()], type=pa.binary()) for c in columns.values()],
            names=["bucket", *columns])


def _unpacked(group: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(group.column(name).to_pylist()), dtype=kind)


def _save(folder: str, name: str, layout: list, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays behind their lengths; a file appears whole or not at all."""
    fs, root = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    part = f"{root}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(np.array([len(arrays[k]) for k, _ in layout], dtype="<u8").tobytes())
        for k, kind in layout:
            out.write(np.ascontiguousarray(arrays[k], dtype=kind).tobytes())
    fs.move(part, f"{root}/{name}")


def _load(folder: str, name: str, layout: list) -> dict[str, np.ndarray]:
    """Memory-mapped arrays of a file; empty ones if it doesn't exist."""
    fs, root = pa.fs.FileSystem.from_uri(folder)
    path = f"{root}/{name}"
    if fs.get_file_info(path).type == pa.fs.FileType.NotFound:
        return {k: np.empty(0, dtype=kind) for k, kind in layout}
    if isinstance(fs, pa.fs.LocalFileSystem):
        data = np.memmap(path, dtype=np.uint8, mode="r")
    else:
        with tempfile.NamedTemporaryFile() as copy:
            with fs.open_input_stream(path) as source:
                while chunk := source.read(1 << 24):
                    copy.write(chunk)
            copy.flush()
            data = np.memmap(copy.name, dtype=np.uint8, mode="r")
    head = 8 * len(layout)
    at, arrays = head, {}
    for (k, kind), n in zip(layout, np.frombuffer(data[:head], dtype="<u8"), strict=True):
        size = int(n) * np.dtype(kind).itemsize
        arrays[k] = data[at:at + size].view(kind) if size else np.empty(0, dtype=kind)
        at += size
    return arrays


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from the numbers of entries with count 1 to 4."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    found = [k - (k + 1) * y * (b / a) if a else 0.5 * k for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    # Small corpora can give values outside of the range that is a probability.
    return tuple(float(min(max(d, 0.1), k - 0.1)) for k, d in zip((1, 2, 3), found, strict=True))


@dataclass
class Model:
    folder: str
    buckets: int
    n_tokens: int          # N, all training tokens
    n_distinct: int        # V
    n_pairs: int           # distinct pairs
    of_pairs: tuple[float, float, float]
    of_tokens: tuple[float, float, float]
    spare: float           # mass that the discounts of the token level leave

    def open(self) -> Lookup:
        return Lookup(self)


class Lookup:
    """A model's files, opened where they are needed."""

    def __init__(self, model: Model):
        self.model = model
        self.files: dict[str, dict[str, np.ndarray]] = {}

    def _find(self, kind: str, layout: list, key: str, values: np.ndarray, bucket: np.ndarray, wanted: tuple[str, ...]) -> list[np.ndarray]:
        """Numbers of the values (sorted by bucket and value), 0 where unknown."""
        found = [np.zeros(len(values), dtype=np.float64) for _ in wanted]
        cuts = _runs(bucket)
        for start, end in zip(cuts, np.append(cuts[1:], len(values)), strict=True):
            name = f"{kind}-{bucket[start]}"
            if name not in self.files:
                self.files[name] = _load(self.model.folder, name, layout)
            arrays = self.files[name]
            if not len(arrays[key]):
                continue
            at = np.minimum(np.searchsorted(arrays[key], values[start:end]), len(arrays[key]) - 1)
            hit = arrays[key][at] == values[start:end]
            for out, column in zip(found, wanted, strict=True):
                out[start:end] = np.where(hit, arrays[column][at], 0)
        return found

    def by_value(self, kind: str, layout: list, key: str, values: np.ndarray, of: np.ndarray, wanted: tuple[str, ...]) -> list[np.ndarray]:
        """The same for values in any order; ``of`` decides the bucket."""
        bucket = of % np.uint64(self.model.buckets)
        order = np.lexsort((values, bucket))
        found = self._find(kind, layout, key, values[order], bucket[order], wanted)
        out = [np.empty_like(f) for f in found]
        for o, f in zip(out, found, strict=True):
            o[order] = f
        return out

    def score(self, token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each text: tokens, known tokens, base score, model score."""
        m = self.model
        # Distinct tokens and contexts, then distinct pairs.
        names, at = np.unique(token, return_inverse=True)
        n, held = self.by_value("tokens", _TOKENS, "token", names, names, ("n", "contexts"))
        before = contexts_of(token, first)
        whence, whence_at = np.unique(before, return_inverse=True)
        total, once, twice, more = self.by_value(
            "pairs", _PAIRS, "context", whence, whence, ("total", "once", "twice", "more"))
        pair = whence_at * np.int64(len(names)) + at
        pairs, pair_at = np.unique(pair, return_inverse=True)
        c_at, t_at = pairs // len(names), pairs % len(names)
        count, = self.by_value("pairs", _PAIRS, "pair", pair_hash(whence[c_at], names[t_at]), whence[c_at], ("count",))

        low = np.maximum(held - _discount(held, m.of_tokens), 0) / max(m.n_pairs, 1) + m.spare / (m.n_distinct + 1)
        own, ways = total[c_at], np.stack([once, twice, more])[:, c_at]
        back = np.array(m.of_pairs) @ ways
        safe = np.maximum(own, 1)
        p = np.where(own > 0, np.maximum(count - _discount(count, m.of_pairs), 0) / safe + back / safe * low[t_at], low[t_at])
        base = np.log10((n + 0.5) / (m.n_tokens + 0.5 * (m.n_distinct + 1)))
        add = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else np.zeros(0)
        return np.diff(first), add((n[at] > 0).astype(np.int64)), add(base[at]), add(np.log10(p)[pair_at])


def _discount(count: np.ndarray, of: tuple[float, float, float]) -> np.ndarray:
    return np.array((0.0, *of))[np.minimum(count, 3).astype(np.int64)]


def train(docs: DataFrame) -> Model:
    """Model of the rows' ``text``, written to the shared folder."""
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_path(spark, "kneser-ney")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            context = np.concatenate([h[0] for h in held])
            token = np.concatenate([h[1] for h in held])
            order = np.lexsort((token, context, context % np.uint64(buckets)))
            context, token = context[order], token[order]
            cuts = _runs(context, token)
            counts = np.diff(np.append(cuts, len(token))).astype("<u4")
            context, token = context[cuts], token[cuts]
            yield from _packed((context % np.uint64(buckets)).astype(np.int64), buckets,
                               {"context": context, "token": token, "n": counts})

        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                token, first = tokens(data, offsets)
                held.append((contexts_of(token, first), token))
                size += len(token)
                if size >= HELD:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def add_pairs(key, group):
        return pa.Table.from_batches(list(_add_pairs(key, group)))

    def _add_pairs(key: tuple, group: pa.Table) -> Iterator[pa.RecordBatch]:
        context, token = _unpacked(group, "context", "<u8"), _unpacked(group, "token", "<u8")
        n = _unpacked(group, "n", "<u4").astype(np.int64)
        order = np.lexsort((token, context))
        context, token, n = context[order], token[order], n[order]
        del order
        cuts = _runs(context, token)
        context, token, n = context[cuts], token[cuts], np.add.reduceat(n, cuts)
        of_pairs = np.bincount(np.minimum(n, 5), minlength=6)[1:5]
        pair = pair_hash(context, token)
        by_pair = np.argsort(pair)
        starts = _runs(context)
        ways = [np.add.reduceat((n == 1).astype("<u4"), starts), np.add.reduceat((n == 2).astype("<u4"), starts),
                np.add.reduceat((n > 2).astype("<u4"), starts)]
        _save(folder, f"pairs-{key[0].as_py()}", _PAIRS, {
            "pair": pair[by_pair], "count": n[by_pair], "context": context[starts], "total": np.add.reduceat(n, starts),
            "once": ways[0], "twice": ways[1], "more": ways[2]})
        del pair, by_pair, context
        order = np.lexsort((token, token % np.uint64(buckets)))
        token, n = token[order], n[order]
        cuts = _runs(token)
        token, seen = token[cuts], np.add.reduceat(n, cuts)
        held = np.diff(np.append(cuts, len(n)))
        row = lambda b, t, s, h, o: pa.RecordBatch.from_arrays(
            [pa.array([b], type=pa.int32()), *(pa.array([x.tobytes()], type=pa.binary()) for x in (t, s, h)),
             pa.array([o], type=pa.list_(pa.int64()))], names=["bucket", "token", "n", "contexts", "of_pairs"])
        bucket = (token % np.uint64(buckets)).astype(np.int64)
        ends = np.searchsorted(bucket, np.arange(buckets + 1))
        for i, b in enumerate(np.flatnonzero(np.diff(ends)).tolist()):
            s = slice(ends[b], ends[b + 1])
            yield row(b, token[s], seen[s].astype("<u8"), held[s].astype("<u4"), of_pairs.tolist() if i == 0 else [0] * 4)

    def add_tokens(key, group):
        token = _unpacked(group, "token", "<u8")
        order = np.argsort(token)
        token = token[order]
        cuts = _runs(token)
        n = np.add.reduceat(_unpacked(group, "n", "<u8")[order], cuts)
        held = np.add.reduceat(_unpacked(group, "contexts", "<u4")[order].astype(np.int64), cuts)
        _save(folder, f"tokens-{key[0].as_py()}", _TOKENS, {"token": token[cuts], "n": n, "contexts": held})
        of_tokens = np.bincount(np.minimum(held, 5), minlength=6)[1:5]
        of_pairs = np.array(group.column("of_pairs").to_pylist(), dtype=np.int64).sum(axis=0)
        ways = [int((held == 1).sum()), int((held == 2).sum()), int((held > 2).sum())]
        return pa.table({
            name: pa.array([x], type=pa.list_(pa.int64())) for name, x in (
                ("sizes", [int(n.sum()), len(cuts), int(held.sum())]), ("of_pairs", of_pairs.tolist()),
                ("of_tokens", of_tokens.tolist()), ("ways", ways))})

    packed = map_arrow(docs.select("text"), count, "bucket int, context binary, token binary, n binary")
    by_token = packed.groupBy("bucket").applyInArrow(
        add_pairs, "bucket int, token binary, n binary, contexts binary, of_pairs array<long>")
    counted = by_token.groupBy("bucket").applyInArrow(
        add_tokens, "sizes array<long>, of_pairs array<long>, of_tokens array<long>, ways array<long>").collect()  # a row a bucket
    add = lambda name, k: np.sum([getattr(r, name) for r in counted] or [[0] * k], axis=0).tolist()
    n_tokens, n_distinct, n_pairs = add("sizes", 3)
    of_tokens = discounts(*add("of_tokens", 4))
    spare = float(np.dot(of_tokens, add("ways", 3))) / n_pairs if n_pairs else 1.0
    return Model(folder, buckets, n_tokens, n_distinct, n_pairs, discounts(*add("of_pairs", 4)), of_tokens, spare)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score and score (log10)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    opened: list[Lookup] = []  # one in each task

    def columns(batch: pa.RecordBatch):
        if not opened:
            opened.append(shared.value.open())
        found = [opened[0].score(*tokens(data, offsets))
                 for _, _, data, offsets in pieces(batch.column(batch.schema.get_field_index(text)))]
        for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64())):
            yield pa.array(np.concatenate([f[i] for f in found]) if found else [], type=kind)

    return map_batches(docs, "n_tokens long, n_known long, base_score double, score double", columns)


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs.where(~held_out(1, 5)))
    return score(docs, model).select(
        "doc_id", held_out(1, 5).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
