"""Line dedup by a log-template tree (operator 4).

Lines are cut into messages (at line ends and after ``.``, ``!`` or ``?``).  A
message's way through the tree is of fixed depth: its number of tokens, then
its first ``LEAD`` tokens.  Tokens with a digit are a wildcard, also on the way.
The messages of a leaf form groups that agree but for one field:

* in messages of fewer than ``LONG`` tokens the field is a run of a fifth of
  the tokens, at least one, wherever it stands behind the leading tokens, so
  at least four tokens in five agree;
* in longer messages it is either half behind the leading tokens.

Each group is a template with the field as a wildcard; messages that agree
wholly are one too.  A first pass finds the leaves that two different texts or
more reach; the second gives each message of such a leaf its groups' keys, so
no neighbour is needed to compute them and no leaf is ever held in one place.
A group whose members all agree wholly says nothing new and is left out.

A template recurs if it stands in two different texts or more.  Its messages
are dropped everywhere but in the text of least hash, so the passage stays
once; copies of a text count as one text and are treated alike.  Messages of
fewer than ``LEAST`` tokens have no template of their own and are dropped
between two dropped longer ones.

With ``whole_lines``, which the query and the pipeline ask for, a line of any
length is a template too: its number of tokens and all of them, with the same
wildcards; a line of wildcards only has to agree in its characters.  A line
that recurs loses all its messages in the same way.

The counts are minima and maxima of text hashes by key, so they combine before
the shuffle and a line that a third of all documents hold is a few rows.  The
leaves and the keys that recur are handed to the tasks as bitmaps of fixed
size, which thin out the messages that are given keys and joined with them; the
exact counts decide.

Null and empty texts stay as they are.  Repeated rows are treated alike.  A
column of the input called like a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import free_name, map_arrow, table, with_columns, written
from .textarrays import byte_table, mix, pieces, row_of, span_hash, spans

LEAD = 3
LEAST = 5
LONG = 13
FIELD = 5               # one token in so many may vary in shorter messages
BITMAP_BITS = 1 << 26   # 8 MB at any input
HELD = 1 << 20          # keys that a task collects before it combines them
CACHED = 1 << 17        # bytes cut at a time, so that their 64-bit values stay in a core's cache

_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_STOP = byte_table(b".!?")
_WILD = np.uint64(0x5DEECE66D)


def cut(data: np.ndarray, offsets: np.ndarray):
    """Token bounds and messages of some texts.

    Returns token starts and ends, each message's first token (one entry more
    than messages), each text's first message, and each line's first message
    (one entry more than lines that hold tokens).
    """
    starts, ends, first = spans((data != 0x20) & (data - np.uint8(0x09) > 4), offsets)
    n = len(starts)
    if n == 0:
        none = np.zeros(1, dtype=np.int64)
        return starts, ends, none, np.zeros(len(offsets), dtype=np.int64), none
    ended = np.zeros(n, dtype=bool)
    before = np.searchsorted(starts, np.flatnonzero(data == 0x0A)) - 1
    ended[before[before >= 0]] = True
    ended[first[1:][np.diff(first) > 0] - 1] = True
    bounds = np.concatenate(([0], np.flatnonzero(_STOP[data[ends - 1]] | ended) + 1))
    lines = np.searchsorted(bounds, np.concatenate(([0], np.flatnonzero(ended) + 1)))
    return starts, ends, bounds, np.searchsorted(bounds, first), lines


def messages(data: np.ndarray, offsets: np.ndarray):
    """What ``cut`` returns, with the masked token hashes behind the token bounds."""
    starts, ends, *rest = cut(data, offsets)
    hashed = span_hash(data + ((data - np.uint8(0x41) < 26) * np.uint8(0x20)), starts, ends)
    hashed[np.searchsorted(starts, np.flatnonzero(data - np.uint8(0x30) < 10), side="right") - 1] = _WILD
    return starts, ends, hashed, *rest


def leaf_keys(hashed: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(message, leaf) of the messages that are long enough."""
    size = np.diff(bounds)
    usable = np.flatnonzero(size >= LEAST)
    begin = bounds[:-1][usable]
    with np.errstate(over="ignore"):
        return usable, mix(span_hash(hashed, begin, begin + LEAD) + size[usable].astype(np.uint64))


def template_keys(
    hashed: np.ndarray, bounds: np.ndarray, at: np.ndarray, leaf: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(message, key, form) of all templates of these messages and their
    leaves; the form is the key of agreeing wholly."""
    begin, end = bounds[at], bounds[at + 1]
    size = end - begin
    lead, middle = begin + LEAD, begin + LEAD + (size - LEAD) // 2
    long = size >= LONG
    field = np.maximum(1, size // FIELD)
    count = np.where(long, 0, size - LEAD - field + 1)
    each = np.repeat(np.arange(len(at)), count)
    open_ = lead[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    with np.errstate(over="ignore"):
        exact = mix(leaf * np.uint64(3) + span_hash(hashed, lead, end))
        late = mix(leaf * np.uint64(5) + span_hash(hashed, middle, end))[long]
        early = mix(leaf * np.uint64(7) + span_hash(hashed, lead, middle))[long]
        before = mix(leaf[each] * np.uint64(17) + span_hash(hashed, lead[each], open_))
        run = mix(before * np.uint64(19) + span_hash(hashed, open_ + field[each], end[each]))
    return (np.concatenate((at, at[long], at[long], at[each])), np.concatenate((exact, late, early, run)),
            np.concatenate((exact, exact[long], exact[long], exact[each])))


def line_keys(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashed: np.ndarray, bounds: np.ndarray, lines: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first message, number of messages, key) of the lines whose template is
    not that of their only message."""
    begin, end = bounds[lines[:-1]], bounds[lines[1:]]
    usable = np.flatnonzero((np.diff(lines) > 1) | (end - begin < LEAST))
    begin, end = begin[usable], end[usable]
    at, count = lines[usable], lines[usable + 1] - lines[usable]
    if not len(usable):
        return at, count, np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        keys = mix(mix(span_hash(hashed, begin, end) + (end - begin).astype(np.uint64)) * np.uint64(11))
        fixed = np.concatenate(([0], np.cumsum(hashed != _WILD, dtype=np.int64)))
        bare = fixed[end] == fixed[begin]
        if bare.any():
            keys[bare] = mix(span_hash(data, starts[begin[bare]], ends[end[bare] - 1]) * np.uint64(13))
    return at, count, keys


def _marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
    return (bitmap[place >> 6] >> (place & 63)) & 1 == 1


def _combined(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row a key, with the least and the greatest of each other value."""
    keys, *values = (np.concatenate(column).view(np.int64) for column in zip(*held, strict=True))
    order = np.argsort(keys)
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    ends = [f.reduceat(v[order], cuts) for v in values for f in (np.minimum, np.maximum)]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[cuts]), *map(pa.array, ends)], names=["key", "lo", "hi", "form_lo", "form_hi"][:1 + len(ends)])


def _by_key(texts: DataFrame, keyed: Callable, forms: bool) -> DataFrame:
    """Least and greatest text hash, and form, of each key.  ``keyed`` gives
    the row, key and form of each message from what ``messages`` returns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            for start, end, data, offsets in pieces(batch.column(0), CACHED):
                found = messages(data, offsets)
                at, keys, *form = keyed(data, *found)
                if len(keys):
                    held.append((keys, marks[start:end][row_of(found[4])[at]], *form))
                    size += len(keys)
                if size >= HELD:
                    yield _combined(held)
                    held, size = [], 0
        if size:
            yield _combined(held)

    ends = ["lo", "hi", "form_lo", "form_hi"][:4 if forms else 2]
    return map_arrow(texts.select("text", "h"), run, "key long, " + ", ".join(f"{c} long" for c in ends)).groupBy("key").agg(
        *[(F.min if c.endswith("lo") else F.max)(c).alias(c) for c in ends])


def leaves(texts: DataFrame) -> np.ndarray:
    """Bitmap of the leaves that two different texts or more reach."""
    return _bitmap(_by_key(texts, lambda _data, _s, _e, hashed, bounds, *_: leaf_keys(hashed, bounds), False).where("lo <> hi"))


def recurring(texts: DataFrame, shared: Broadcast, whole_lines: bool = False) -> DataFrame:
    """(key, keep): templates of two different texts or more, and the hash of
    the text that keeps them.  ``texts`` has text and its hash ``h``; ``shared``
    is the bitmap of ``leaves``."""
    def keyed(data, starts, ends, hashed, bounds, first, lines):
        at, leaf = leaf_keys(hashed, bounds)
        likely = _marked(shared.value, leaf)
        at, keys, form = template_keys(hashed, bounds, at[likely], leaf[likely])
        if whole_lines:
            line_at, _, more = line_keys(data, starts, ends, hashed, bounds, lines)
            at, keys, form = (np.concatenate(c) for c in ((at, line_at), (keys, more), (form, more)))
        return at, keys, form

    # A key that is its own form agrees wholly; another counts if its field varies.
    return _by_key(texts, keyed, True).where("lo <> hi and (form_lo <> form_hi or form_lo = key)").selectExpr("key", "lo as keep")


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bit for each key's place, folded on the executors to 64-bit words."""
    place = f"(key & {BITMAP_BITS - 1})"
    words = keys.selectExpr(f"shiftright({place}, 6) as word", f"shiftleft(1L, cast({place} & 63 as int)) as bit").groupBy(
        "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bitmap


def drops(texts: DataFrame, again: DataFrame, shared: Broadcast, whole_lines: bool = False) -> DataFrame:
    """(doc_id, h, gone): numbers of the messages that each row loses."""
    templates = texts.sparkSession.sparkContext.broadcast(_bitmap(again))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(2).to_numpy(zero_copy_only=False)
            for start, end, data, offsets in pieces(batch.column(1), CACHED):
                starts, ends, hashed, bounds, first, lines = messages(data, offsets)
                at, leaf = leaf_keys(hashed, bounds)
                likely = _marked(shared.value, leaf)
                at, keys, _ = template_keys(hashed, bounds, at[likely], leaf[likely])
                likely = _marked(templates.value, keys)
                at, keys = at[likely], keys[likely]
                if whole_lines:
                    line_at, count, more = line_keys(data, starts, ends, hashed, bounds, lines)
                    likely = _marked(templates.value, more)
                    line_at, count, more = line_at[likely], count[likely], more[likely]
                    # A line's key goes with each of its messages.
                    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at = np.concatenate((at, np.repeat(line_at, count) + within))
                    keys = np.concatenate((keys, np.repeat(more, count)))
                rows = row_of(first)[at]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start).take(pa.array(rows)), pa.array(marks[start:end][rows]),
                     pa.array((at - first[rows]).astype(np.int32)), pa.array(keys.view(np.int64))],
                    names=["doc_id", "h", "message", "key"])

    id_type = texts.schema["doc_id"].dataType.simpleString()
    likely = map_arrow(texts.select("doc_id", "text", "h"), run, f"doc_id {id_type}, h long, message int, key long")
    return likely.join(again, "key").where("h <> keep").groupBy("doc_id", "h").agg(
        F.collect_set("message").alias("gone"))


def without(texts: pa.Array, gone: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts without their messages of these numbers and short ones between
    them, and how many went of each.  Where whole lines go, one line end stays."""
    at = np.concatenate(([0], np.cumsum(pc.list_value_length(gone).to_numpy())))
    numbers = gone.flatten().to_numpy()
    made, went = [], []
    for row, row_end, data, offsets in pieces(texts, CACHED):
        starts, ends, bounds, first, _ = cut(data, offsets)
        n, rows = len(bounds) - 1, row_of(first)
        drop = np.zeros(n, dtype=bool)
        of, number = row_of(at[row:row_end + 1]), numbers[at[row]:at[row_end]]
        known = number < np.diff(first)[of]
        drop[first[of[known]] + number[known]] = True
        fixed = np.flatnonzero(np.diff(bounds) >= LEAST)
        left, right = fixed[:-1], fixed[1:]
        both = drop[left] & drop[right] & (rows[left] == rows[right])
        drop |= _covered(left[both], right[both], n)
        begin = starts[bounds[:-1]]
        stop = np.minimum(np.concatenate((begin[1:], [len(data)]))[:n], offsets[rows + 1])
        out = np.flatnonzero(drop)
        keep = ~_covered(begin[out], stop[out], len(data))
        # Of each run of such messages the first line end, if text that ends no line stands before the run.
        head = np.ones(len(out), dtype=bool)
        head[1:] = (np.diff(out) > 1) | (np.diff(rows[out]) > 0)
        breaks = np.concatenate((np.flatnonzero(data == 0x0A), [len(data)]))
        line_end = breaks[np.searchsorted(breaks, ends[bounds[1:] - 1][out])]
        run = np.cumsum(head) - 1
        ending = np.flatnonzero(line_end < stop[out])
        ending = ending[np.diff(run[ending], prepend=-1) > 0]
        opens = begin[out[head]][run[ending]]
        ending = ending[(opens > offsets[rows[out[ending]]]) & (data[opens - 1] != 0x0A)]
        keep[line_end[ending]] = True
        size = np.where(drop, stop - begin, 0)
        size[out[ending]] -= 1
        less, fewer = (np.diff(np.concatenate(([0], np.cumsum(x)))[first]) for x in (size, drop))
        ends_at = np.concatenate(([0], np.cumsum(np.diff(offsets) - less)))
        made.append(pa.Array.from_buffers(
            pa.large_string(), row_end - row, [None, pa.py_buffer(ends_at), pa.py_buffer(data[keep])]))
        went.append(fewer)
    return pc.utf8_rtrim(pa.concat_arrays(made), characters=_BLANKS), np.concatenate(went)


def _covered(begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of these ranges, which don't overlap."""
    edges = np.zeros(n + 1, dtype=np.int8)
    edges[begin] += 1
    edges[end] -= 1
    return np.cumsum(edges[:-1], dtype=np.int8) > 0


def dedup_lines(docs: DataFrame, whole_lines: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) with recurring messages, and recurring
    lines of any length if ``whole_lines``, removed from ``text`` and the
    number of messages that went as ``n_dropped``."""
    base = docs.drop("n_dropped")
    texts = base.select("doc_id", "text", F.xxhash64("text").alias("h"))
    shared = docs.sparkSession.sparkContext.broadcast(leaves(texts))
    again = written(recurring(texts, shared, whole_lines), "line-templates")
    gone = drops(texts, again, shared, whole_lines).select(F.col("doc_id").alias("of"), F.col("h").alias("of_h"), "gone")
    # The row travels as one value, so its names meet no others.
    whole = base.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("row"), F.xxhash64("text").alias("h"))
    extra = free_name(base, "gone")
    joined = whole.join(
        gone, F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left"
    ).select("row.*", F.col("gone").alias(extra))
    schema = with_columns(base, "n_dropped int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = schema.names.index("text")
        for batch in batches:
            gone_ = batch.column(batch.schema.get_field_index(extra))
            texts_ = batch.column(at)
            lost = np.zeros(batch.num_rows, dtype=np.int32)
            changed = pc.fill_null(pc.greater(pc.list_value_length(gone_), 0), False)
            if changed.true_count:
                cut_texts, went = without(texts_.filter(changed), gone_.filter(changed))
                lost[changed.to_numpy(zero_copy_only=False)] = went
                texts_ = pc.replace_with_mask(texts_, changed, cut_texts.cast(texts_.type))
            columns = [texts_ if i == at else batch.column(i) for i in range(len(schema) - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lost)], names=schema.names)

    return map_arrow(joined, run, schema)


def op4_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), whole_lines=True)
