"""N-gram Jaccard join, size-aware (operator 9).

A document's set holds its distinct 4-word shingles (64-bit hashes); documents
with equal sets form one class (node).  Two nodes link when 100 * intersection
>= 85 * union.  Heavy and light parts:

* Shingles are ordered by rarity: those that stand in one set only, then the
  shared ones, then the frequent ones by their count.  Counts cover all rows;
  what the tasks get of them has a fixed size (a bitmap of shared shingles and
  at most ``FREQUENT`` frequent ones), and any such order is right.
* Large sets scan inverted lists: a set of n shingles enters the lists of its
  first n - ceil(0.85 n) + 1 shingles, and only of those that are shared.
* Small sets enumerate all subsets of the sizes that a link would have in
  common, which needs no list at all.  The boundary is the largest size for
  which the subsets are fewer than the list entries read.

Lists are not expanded into pairs.  Each member is compared with eight pivots
of its list; links make components; then only members outside a list's largest
component meet the others of that list, so no link between different
components is missed.  There, a sketch of ``SKETCH`` parity bits a set bounds
the symmetric difference from below, so pairs that cannot link leave the join
at once and a group of n near copies costs about n verifications.  Candidates
are verified on the whole sets.

Links are counted within components, outside of which there are none.  A
component's nodes are dealt into blocks of about ``BLOCK`` sets; each pair of
blocks meets in a cell that takes all intersections as one matrix product.  So
every pair of a component is compared, and what travels is a set for each
block.  The time still grows with the square of a component, which only the
callers that ask for ``n_links`` pay.

Null texts and texts without words have empty sets and link with nothing.
Repeated rows share a node.  A null doc_id takes part but is never the least
id unless its whole component has none.  Rows link, so the other rows of a
node count among the links of each of its rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.session import scratch_path

from .components import components
from .frames import map_arrow, table
from .textarrays import mix, pieces, row_of, words

GRAM = 4
PERCENT = 85
BITMAP_BITS = 1 << 26    # of the broadcast bitmap of shared shingles: 8 MB at any input
FREQUENT = 1 << 16       # frequent shingles that are broadcast with their counts
FREQUENT_FROM = 8        # sets, at least, that a frequent shingle stands in
HELD = 1 << 21           # shingles that a task collects before it hands them on

SKETCH = 512             # parity bits of a set
BLOCK = 1 << 10          # sets of a component that a cell takes from each side
BLOCK_SHINGLES = 1 << 20  # and about as many shingles
CELL_WIDTH = 1 << 22     # numbers in a matrix of a cell

# Patterns that turn the least id into another member of a list.
_PIVOTS = tuple(int(f"{i:04b}" * 16, 2) & (1 << 63) - 1 for i in (3, 5, 6, 9, 10, 12))


def needed(s: int, t: int, percent: int = PERCENT) -> int:
    """Least intersection of linked sets of s and t shingles."""
    return -(-percent * (s + t) // (100 + percent))


def prefix_length(n, percent: int = PERCENT):
    return n - -(-percent * n // 100) + 1


def subset_sizes(s: int, boundary: int, percent: int = PERCENT) -> list[int]:
    """Sizes of the subsets that a small set enumerates, for all small partners."""
    partners = range(-(-percent * s // 100), min(boundary, 100 * s // percent) + 1)
    return sorted({c for t in partners if t > 0 and (c := needed(s, t, percent)) <= min(s, t)})


def choose_boundary(list_length: float, percent: int = PERCENT) -> int:
    """Largest size up to which subsets cost less than scanning inverted lists."""
    size = 1
    while size < 64:
        n = size + 1
        subsets = sum(math.comb(n, c) for c in subset_sizes(n, n + n // 4, percent))
        if subsets > prefix_length(n, percent) * (1 + list_length):
            return size
        size = n
    return size


def shingle_sets(data: np.ndarray, offsets: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, and each text's first index."""
    hashed, first = words(data, offsets)
    counts = np.diff(first)
    rows = row_of(first)
    at = np.arange(len(hashed)) - first[:-1][rows]
    with np.errstate(over="ignore"):
        whole = hashed.copy()
        for step in range(1, gram):
            nxt = np.zeros_like(hashed)
            nxt[:-step or None] = hashed[step:]
            inside = at + step < counts[rows]
            whole = np.where(inside, mix(whole * np.uint64(0x9E3779B97F4A7C15) + nxt + np.uint64(step)), whole)
    keep = (at + gram <= counts[rows]) | ((at == 0) & (counts[rows] < gram))
    shingles, rows = whole[keep], rows[keep]
    order = np.lexsort((shingles, rows))
    shingles, rows = shingles[order], rows[order]
    fresh = np.ones(len(shingles), dtype=bool)
    fresh[1:] = (shingles[1:] != shingles[:-1]) | (rows[1:] != rows[:-1])
    shingles, rows = shingles[fresh], rows[fresh]
    return shingles, np.searchsorted(rows, np.arange(len(first)))


def node_ids(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit id for each set, equal for equal sets."""
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)))))
        return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


def sketches(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Parity of each set's shingles in ``SKETCH`` cells, as 64-bit words.

    Two sets differ in at least as many shingles as their sketches in bits.
    """
    n = len(first) - 1
    cell = (mix(shingles ^ np.uint64(0x1234567890ABCDEF)) % np.uint64(SKETCH)).astype(np.int64)
    odd = np.bincount(row_of(first) * SKETCH + cell, minlength=n * SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).reshape(n, SKETCH // 64)


def _bucket(shingles: np.ndarray, buckets: int) -> np.ndarray:
    return (shingles >> np.uint64(32)) % np.uint64(buckets)


def _bit(shingles: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Place in the bitmap; each bucket of shingles owns a stretch of it."""
    share = bits // buckets
    return _bucket(shingles, buckets) * np.uint64(share) + (shingles & np.uint64(0xFFFFFFFF)) % np.uint64(share)


def _unseen(nodes: np.ndarray, seen: set[int]) -> np.ndarray:
    """True at the first of equal nodes in a task; forgetting some is harmless."""
    if len(seen) > 1 << 19:
        seen.clear()
    fresh = np.zeros(len(nodes), dtype=bool)
    for i, node in enumerate(nodes.tolist()):
        if node not in seen:
            seen.add(node)
            fresh[i] = True
    return fresh


def _marks(shingles: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """32 bits that tell a shingle's sets apart; the bits of two sets agree for each shingle anew."""
    with np.errstate(over="ignore"):
        return mix(shingles * np.uint64(0x9E3779B97F4A7C15) ^ nodes) & np.uint64(0xFFFFFFFF)


def rarity(docs: DataFrame, gram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Bitmap of shared shingles, the frequent ones with counts, and the mean
    number of sets that a shingle stands in.

    A shingle's sets are told apart by 32 bits of their node's hash with the
    shingle, so that copies count once.  What is shuffled is 8 bytes a shingle.
    A link is missed only if these bits agree for all of the listed shingles
    that the two sets share with no third one: a chance of 2^-32 for each.
    """
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, seen = 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([h[0] for h in held])
            marks = np.concatenate([h[1] for h in held])
            bucket = _bucket(keys, buckets).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            packed = (keys << np.uint64(32) | marks)[order]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts))
            for some in np.array_split(full, max(1, len(full) // 256)):
                yield pa.RecordBatch.from_arrays([
                    pa.array(some.astype(np.int32)),
                    pa.array([packed[cuts[b]:cuts[b + 1]].tobytes() for b in some], type=pa.binary())],
                    names=["bucket", "packed"])

        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                shingles, first = shingle_sets(data, offsets, gram)
                nodes = node_ids(shingles, first)
                fresh = _unseen(nodes, seen)
                every = np.repeat(fresh, np.diff(first))
                held.append((shingles[every], _marks(shingles[every], np.repeat(nodes, np.diff(first))[every])))
                size += len(held[-1][0])
                if size >= HELD:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    share = BITMAP_BITS // buckets

    def count(key: tuple, group: pa.Table) -> pa.Table:
        held = np.unique(np.frombuffer(b"".join(group.column("packed").to_pylist()), dtype=np.uint64))
        keys, sets = np.unique(held >> np.uint64(32), return_counts=True)
        bits = np.zeros(share, dtype=bool)
        bits[(keys[sets > 1] % np.uint64(share)).astype(np.int64)] = True
        often = sets >= FREQUENT_FROM
        return pa.table({
            "bucket": pa.array([key[0].as_py()], type=pa.int32()),
            "distinct": pa.array([len(keys)], type=pa.int64()),
            "total": pa.array([len(held)], type=pa.int64()),
            "bits": pa.array([np.packbits(bits).tobytes()], type=pa.binary()),
            "frequent": pa.array([keys[often].astype(np.int64)], type=pa.list_(pa.int64())),
            "sets": pa.array([sets[often].astype(np.int32)], type=pa.list_(pa.int32())),
        })

    path = scratch_path(docs.sparkSession, "shingle-counts")
    (map_arrow(docs.select("text"), spread, "bucket int, packed binary")
     .groupBy("bucket").applyInArrow(
         count, "bucket int, distinct long, total long, bits binary, frequent array<long>, sets array<int>")
     .write.parquet(path))
    counted = docs.sparkSession.read.parquet(path)
    bitmap = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    for row in counted.select("bucket", "bits").toLocalIterator():
        bitmap[row.bucket * share // 8:(row.bucket + 1) * share // 8] = np.frombuffer(row.bits, dtype=np.uint8)
    total, distinct = counted.agg(F.sum("total"), F.sum("distinct")).first()
    often = counted.select("bucket", F.explode(F.arrays_zip("frequent", "sets")).alias("f")).select(
        "bucket", F.col("f.frequent").alias("low"), F.col("f.sets").alias("sets"))
    least, kept = 0, 0
    for row in often.groupBy("sets").count().orderBy(F.desc("sets")).collect():  # at most 65,536 counts
        if kept + row["count"] > FREQUENT:
            break
        least, kept = row.sets, kept + row["count"]
    frequent = often.where(F.col("sets") >= least).toPandas() if kept else None
    if frequent is None:
        return bitmap, np.empty(0, np.uint64), np.empty(0, np.int32), (total or 0) / max(1, distinct or 1)
    keys = frequent["bucket"].to_numpy().astype(np.uint64) << np.uint64(32) | frequent["low"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    return bitmap, keys[order], frequent["sets"].to_numpy()[order].astype(np.int32), total / distinct


def emit(docs: DataFrame, gram: int, percent: int) -> DataFrame:
    """Rows of three kinds, written under one path.

    doc: doc_id, node and size of every row; entry: key, node, size and place
    in the order, for each list or subset that a node enters; set: the whole
    set of a node that enters any.
    """
    spark = docs.sparkSession
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = min(1 << (buckets - 1).bit_length(), 1 << 15)
    bitmap, often, sets, mean_list = rarity(docs, gram, buckets)
    boundary = choose_boundary(mean_list, percent)
    shared = spark.sparkContext.broadcast((bitmap, often, sets))
    plans = {s: subset_sizes(s, boundary, percent) for s in range(1, boundary + 1)}

    def subsets(members: np.ndarray) -> np.ndarray:
        values = mix(members ^ np.uint64(0x0F0F0F0F0F0F0F0F))
        keys = []
        with np.errstate(over="ignore"):
            for c in plans[len(members)]:
                salt = np.uint64(0xC2B2AE3D27D4EB4F * c & 0xFFFFFFFFFFFFFFFF)
                keys += [np.sum(values[list(some)], dtype=np.uint64) ^ salt
                         for some in itertools.combinations(range(len(members)), c)]
        return mix(np.array(keys, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, keys, counts = shared.value
        seen: set[int] = set()

        def rows(kind: str, n: int, **columns) -> pa.RecordBatch:
            types = {"doc_id": pa.int64(), "node": pa.int64(), "size": pa.int32(),
                     "key": pa.int64(), "place": pa.int32(), "shingles": pa.list_(pa.int64()),
                     "sketch": pa.list_(pa.int64())}
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, type=pa.string())]
                + [columns.get(k) if columns.get(k) is not None else pa.nulls(n, t) for k, t in types.items()],
                names=["kind", *types])

        for batch in batches:
            for start, end, data, offsets in pieces(batch.column(1)):
                shingles, first = shingle_sets(data, offsets, gram)
                nodes = node_ids(shingles, first)
                sizes = np.diff(first)
                yield rows("doc", end - start, doc_id=batch.column(0).slice(start, end - start).cast(pa.int64()),
                           node=pa.array(nodes.view(np.int64)), size=pa.array(sizes.astype(np.int32)))
                rows_at = row_of(first)
                bit = _bit(shingles, buckets, BITMAP_BITS)
                order_class = ((bits[(bit >> np.uint64(3)).astype(np.int64)] >> (7 - (bit & np.uint64(7)).astype(np.uint8))) & 1).astype(np.int64)
                if len(keys):
                    look = _bucket(shingles, buckets) << np.uint64(32) | shingles & np.uint64(0xFFFFFFFF)
                    found = np.minimum(np.searchsorted(keys, look), len(keys) - 1)
                    order_class = np.where(keys[found] == look, counts[found], order_class)
                order = np.argsort(rows_at << 32 | order_class, kind="stable")
                ordered, classes = shingles[order], order_class[order]
                place = np.arange(len(shingles)) - first[:-1][rows_at]
                length = prefix_length(sizes, percent)
                fresh = _unseen(nodes, seen) & (sizes > 0)
                listed = fresh[rows_at] & (classes > 0) & (place < length[rows_at]) & (
                    sizes[rows_at] >= -(-percent * (boundary + 1) // 100))
                small = np.flatnonzero(fresh & (sizes <= boundary))
                entry_key, entry_row, entry_place = [mix(ordered[listed])], [rows_at[listed]], [place[listed]]
                for i in small:
                    made = subsets(shingles[first[i]:first[i + 1]])
                    entry_key.append(made)
                    entry_row.append(np.full(len(made), i))
                    entry_place.append(np.zeros(len(made), dtype=np.int64))
                key, row = np.concatenate(entry_key), np.concatenate(entry_row)
                if not len(key):
                    continue
                yield rows("entry", len(key), node=pa.array(nodes[row].view(np.int64)),
                           size=pa.array(sizes[row].astype(np.int32)), key=pa.array(key.view(np.int64)),
                           place=pa.array(np.concatenate(entry_place).astype(np.int32)))
                sketch = sketches(shingles, first)
                for some in np.array_split(np.unique(row), max(1, len(row) // 2000)):
                    lengths = sizes[some]
                    ends = np.cumsum(lengths)
                    if not len(ends):
                        continue
                    take = np.arange(ends[-1]) + np.repeat(first[:-1][some] - (ends - lengths), lengths)
                    yield rows("set", len(some), node=pa.array(nodes[some].view(np.int64)),
                               size=pa.array(lengths.astype(np.int32)),
                               shingles=pa.ListArray.from_arrays(
                                   pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                                   pa.array(shingles[take].view(np.int64))),
                               sketch=pa.ListArray.from_arrays(
                                   pa.array(np.arange(len(some) + 1, dtype=np.int32) * (SKETCH // 64)),
                                   pa.array(sketch[some].ravel())))

    path = scratch_path(spark, "jaccard")
    map_arrow(docs.select("doc_id", "text"), run,
              "kind string, doc_id long, node long, size int, key long, place int, shingles array<long>, sketch array<long>"
              ).write.partitionBy("kind").parquet(path)
    return spark.read.schema(
        "doc_id long, node long, size int, key long, place int, shingles array<long>, sketch array<long>, kind string").parquet(path)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose whole sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(
        100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def linked(
    shingles: np.ndarray, first: np.ndarray, copies: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int,
) -> np.ndarray:
    """For each set, the copies of the sets on the other side that it links with.

    ``left`` and ``right`` are the row numbers of the sides, which are the same
    or have none in common.
    """
    sizes, rows = np.diff(first), row_of(first)
    known, at = np.unique(shingles, return_inverse=True)
    side = np.full(len(sizes), -1)
    side[left] = np.arange(len(left))
    across = np.full(len(sizes), -1)
    across[right] = np.arange(len(right))
    width = max(1, CELL_WIDTH // max(len(left), len(right)))
    order = np.argsort(at, kind="stable")
    at, rows = at[order], rows[order]
    common = np.zeros((len(left), len(right)), dtype=np.float32)  # exact up to 16 million
    for low in range(0, len(known), width):
        some = slice(*np.searchsorted(at, (low, low + width)))
        x, y = side[rows[some]], across[rows[some]]
        a = np.zeros((len(left), min(width, len(known) - low)), dtype=np.float32)
        b = np.zeros((len(right), a.shape[1]), dtype=np.float32)
        a[x[x >= 0], at[some][x >= 0] - low] = 1
        b[y[y >= 0], at[some][y >= 0] - low] = 1
        common += a @ b.T
    common = common.astype(np.int64)
    links = 100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common)
    links &= left[:, None] != right[None, :]
    out = np.zeros(len(sizes), dtype=np.int64)
    out[left] = (links * copies[right][None, :]).sum(axis=1)
    if not np.array_equal(left, right):
        out[right] = (links * copies[left][:, None]).sum(axis=0)
    return out


def link_counts(labels: DataFrame, sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, partners): rows of other nodes that a node of ``labels`` links with."""
    held = labels.join(sets.select("node", "shingles"), "node").join(classes.select("node", "copies"), "node")
    blocks = held.groupBy("label").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.size("shingles")) / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = held.join(blocks, "label").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).select(
        "label", "node", "copies", "shingles", "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = dealt.select(
        "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "copies", "shingles"
    ).repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        made: list[tuple[np.ndarray, np.ndarray]] = []
        key, size = None, 0

        def flush() -> None:
            nonlocal size
            cell = pa.Table.from_batches(held).combine_chunks()
            lists = cell.column("shingles").combine_chunks()
            first = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            own = cell.column("own").to_numpy()
            nodes, copies = cell.column("node").to_numpy(), cell.column("copies").to_numpy()
            left, right = np.flatnonzero(own == key[1]), np.flatnonzero(own == key[2])
            if len(left) and len(right):
                made.append((nodes, linked(lists.flatten().to_numpy(), first, copies, left, right, percent)))
                size += len(nodes)

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([m[k] for m in made])) for k in (0, 1)], names=["node", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1, 2)])
            cuts = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
            for start, end in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                now = tuple(at[:, start].tolist())
                if now != key:
                    if held:
                        flush()
                    held, key = [], now
                held.append(batch.slice(start, end - start))
            if size > 1 << 16:
                yield result()
                made, size = [], 0
        if held:
            flush()
        if made:
            yield result()

    return map_arrow(cells, run, "node long, n long").groupBy("node").agg(F.sum("n").alias("partners"))


def link(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, n_links: bool = True) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (the least doc_id that links reach) and, unless switched
    off, n_links (the other rows that the row itself links with)."""
    spark = docs.sparkSession
    rows = emit(docs, gram, percent)
    path = scratch_path(spark, "jaccard-links")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    # A node that several tasks saw is held once.
    entries = kept(rows.where("kind = 'entry'").groupBy("key", "node").agg(
        F.max("size").alias("size"), F.min("place").alias("place")), "entries")
    sets = kept(rows.where("kind = 'set'").select("node", "shingles", "sketch").dropDuplicates(["node"]), "sets")

    pivots = entries.groupBy("key").agg(
        F.min("node").alias("p0"), F.max("node").alias("p1"),
        *[F.min(F.col("node").bitwiseXOR(F.lit(c))).bitwiseXOR(F.lit(c)).alias(f"p{i + 2}")
          for i, c in enumerate(_PIVOTS)]).where("p0 <> p1")
    near = entries.select("key", "node").join(pivots, "key").select(
        "node", F.explode(F.array_distinct(F.array(*[c for c in pivots.columns if c != "key"]))).alias("pivot")).where("node <> pivot")
    pairs = near.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = kept(verified(pairs, sets, percent), "first")
    labels = components(links)

    # Lists that still hold several components: all but the largest meet the rest.
    own = entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).select(
        "key", "node", "size", "place", "label")
    own = kept(own, "labelled")
    divided = own.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    open_ = kept(own.join(divided, "key", "left_semi").join(sets.select("node", "sketch"), "node"), "open")
    largest = open_.groupBy("key", "label").count().groupBy("key").agg(
        F.max(F.struct("count", "label")).alias("top")).select("key", F.col("top.label").alias("major"))
    minor = open_.join(largest, "key").where("label <> major").select(
        "key", F.col("node").alias("x"), F.col("size").alias("sx"), F.col("place").alias("px"),
        F.col("label").alias("lx"), F.col("sketch").alias("kx"))
    common = F.ceil(F.lit(percent) * (F.col("sx") + F.col("size")) / F.lit(100 + percent))
    apart = sum((F.bit_count(F.get("kx", F.lit(i)).bitwiseXOR(F.get("sketch", F.lit(i)))) for i in range(SKETCH // 64)), F.lit(0))
    met = minor.join(open_, (minor["key"] == open_["key"]) & (F.col("lx") != F.col("label"))
                     & (100 * F.least("sx", "size") >= percent * F.greatest("sx", "size"))
                     & (F.least(F.col("sx") - F.col("px"), F.col("size") - F.col("place")) >= common)
                     & (apart <= F.col("sx") + F.col("size") - 2 * common))
    rest = met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    more = kept(verified(rest.join(links, ["a", "b"], "left_anti"), sets, percent), "second")
    every = links.union(more)
    if not more.isEmpty():
        labels = components(every)

    documents = rows.where("kind = 'doc'").select("doc_id", "node", "size")
    classes = kept(documents.where("size > 0").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies")), "classes")
    joined = classes.join(labels.withColumn("apart", F.lit(False)), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "least", "copies", F.coalesce("apart", F.lit(True)).alias("apart"))
    components_ = joined.where("not apart").groupBy("label").agg(F.min("least").alias("reached"))
    by_node = joined.join(components_, "label", "left").select(
        "node", F.coalesce("reached", "least").alias("component_id"), "copies")
    columns = [
        "doc_id", F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")]
    if n_links:
        partners = kept(link_counts(labels, sets, classes, percent), "partners")
        by_node = by_node.join(partners, "node", "left")
        own = F.coalesce("partners", F.lit(0)) + F.col("copies") - 1
        columns.append(F.coalesce(own, F.lit(0)).alias("n_links"))
    return documents.join(by_node, "node", "left").select(*columns)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents").select("doc_id", "text"), n_links=False)


def op9_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the number of links of every document."""
    return link(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_ORACLE = r"""
with recursive tokens as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then []::varchar[]
    when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' '))) end as s
  from tokens),
shingles as (select doc_id, unnest(s) as g from sets),
pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as common
  from shingles x join shingles y on x.g = y.g and x.doc_id <> y.doc_id group by all),
links as (
  select a, b from pairs join sets sa on sa.doc_id = a join sets sb on sb.doc_id = b
  where 100 * common >= 85 * (len(sa.s) + len(sb.s) - common)),
reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles,
  least(s.doc_id, coalesce((select min(b) from reach r where r.a = s.doc_id), s.doc_id)) as component_id
from sets s
"""

OP9_LINKS_ORACLE = OP9_ORACLE.replace(
    "as component_id\n", "as component_id,\n  (select count(*) from links l where l.a = s.doc_id) as n_links\n")
