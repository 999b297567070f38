"""Benchmark decontamination by a prefix-filtered set join (operator 8).

A window is ``window`` consecutive words of an item (all words of a shorter
item).  A window occurs in a document where all its shingles stand in order,
so the shingles of a window form a set that has to be contained whole, and one
shingle, the rarest, is a sufficient prefix:

1. shingles (``gram`` words, all words of a shorter window) of the items are
   counted over all documents;
2. each window is indexed under its rarest shingle and that shingle's offset;
3. the shingles of the documents meet that index; position and length bounds
   drop places where the window would stick out of the document;
4. what is left is verified word by word over a span of the window's size.

Everything is built-in column expressions.  The index is broadcast if it has
at most ``BROADCAST_WINDOWS`` windows, which is checked; a larger one is
joined by shuffling the shingles.  The words of a document are gathered per
document only, so a frequent passage is spread as its documents are.

Null and empty texts have no words, are never hit and hit nothing.  Repeated
rows of a document get equal results, repeated items count by their ids, an
empty benchmark hits nothing.  Items without an id hit like others and count
as one item together, which has no name among the item ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import digest, table, written

WINDOW = 13
GRAM = 3
BROADCAST_WINDOWS = 100_000  # about 30 MB of windows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def _shingle(words: str, at: Column, size: int) -> Column:
    """Hash of ``size`` words from 0-based place ``at``, null beyond the end."""
    parts = [F.get(F.col(words), at + i) for i in range(size)]
    return F.when(at + size <= F.size(words), F.xxhash64(F.lit(size), *parts))


def windows_of(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(w_id, window, w_size, items, unnamed): the distinct windows, the ids of
    their items and whether an item without an id has them."""
    spread = items.where(F.size("words") > 0).select("item_id", "words", F.explode(
        F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))).alias("start"))
    return spread.select("item_id", F.slice("words", F.col("start") + 1, F.lit(window)).alias("window")).groupBy(
        "window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"),
        F.bool_or(F.col("item_id").isNull()).alias("unnamed")).select(
        F.xxhash64("window").alias("w_id"), "window", F.size("window").alias("w_size"), "items", "unnamed")


def _spread(df: DataFrame, words: str, sizes: list[int]) -> DataFrame:
    """A row for each place and shingle size, with the shingle's hash as ``shingle``."""
    placed = df.select("*", F.posexplode(words).alias("place", "_word")).drop("_word")
    every = [_shingle(words, F.col("place"), s) for s in sizes]
    made = every[0] if len(every) == 1 else F.explode(F.array(*every))
    return placed.withColumn("shingle", made).where("shingle is not null")


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
) -> tuple[DataFrame, DataFrame]:
    """(key, place, w_size, w_id): where windows occur in documents.

    ``docs`` has a ``key`` and ``words``; ``items`` has item_id and words.
    The distinct windows are returned as a second frame.
    """
    index = written(windows_of(items, window, gram), "benchmark-windows")
    sizes = sorted({min(r.w_size, gram) for r in index.select("w_size").distinct().collect()})  # at most ``window``
    if not sizes:
        return docs.select("key", F.lit(0).alias("place"), F.lit(0).alias("w_size"), F.lit(0).cast("long").alias("w_id")).limit(0), index
    small = index.count() <= BROADCAST_WINDOWS

    # Every shingle of every window, and how often each stands in documents.
    inside = index.select("w_id", "window", "w_size", F.posexplode("window").alias("offset", "_word")).select(
        "w_id", "w_size", "offset", F.coalesce(*[
            F.when(F.least("w_size", F.lit(gram)) == s, _shingle("window", F.col("offset"), s)) for s in sizes
        ]).alias("shingle")).where("shingle is not null")
    known = inside.select("shingle").distinct()
    counted = _spread(docs.select("words"), "words", sizes).select("shingle").join(
        F.broadcast(known) if small else known, "shingle", "left_semi").groupBy("shingle").count()
    # A shingle without a count never occurs, so neither does its window.
    rarest = inside.join(counted, "shingle", "left").groupBy("w_id", "w_size").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "shingle", "offset")).alias("first"))
    prefix = written(
        rarest.where("first.n > 0").join(index.select("w_id", "window"), "w_id").select(
            "w_id", "window", "w_size", F.col("first.shingle").alias("shingle"), F.col("first.offset").alias("offset")),
        "benchmark-index")

    placed = _spread(docs.select("key", "words"), "words", sizes)
    begin = F.col("place") - F.col("offset")
    fits = (begin >= 0) & (begin + F.col("w_size") <= F.size("words"))
    met = placed.join(F.broadcast(prefix), "shingle") if small else _by_shuffle(placed, prefix, docs)
    found = met.where(fits).where(F.slice("words", begin + 1, F.col("w_size")) == F.col("window"))
    return found.select("key", begin.alias("place"), "w_size", "w_id"), index


def _by_shuffle(placed: DataFrame, prefix: DataFrame, docs: DataFrame) -> DataFrame:
    """The same meeting without a broadcast: places travel without their words,
    which are fetched again for the documents that met a window."""
    met = placed.select("key", "place", "shingle").join(prefix, "shingle")
    return met.join(docs.select("key", "words"), "key")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_hit,
    n_items, the sorted item ids, and whether 20 * n_hit >= n_words > 0 hits."""
    keyed = docs.select(
        "doc_id", F.struct("doc_id", F.xxhash64("text").alias("h"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("c")).alias("key"),
        words_of(F.col("text")).alias("words"))
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words"))
    found, index = occurrences(keyed, items, window, gram)
    # A document's places, each with the furthest end, then merged from the left.
    spans = written(found.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("place", F.col("w_size").alias("size")))).alias("spans"),
        F.collect_set("w_id").alias("w_ids")), "benchmark-hits")
    start = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reached"))

    def cover(so_far: Column, span: Column) -> Column:
        end = span["place"] + span["size"]
        return F.struct(
            (so_far["hit"] + F.greatest(end - F.greatest(so_far["reached"], span["place"]), F.lit(0))).alias("hit"),
            F.greatest(so_far["reached"], end).alias("reached"))

    hits = spans.select("key", F.aggregate("spans", start, cover)["hit"].alias("n_hit"))
    small = index.count() <= BROADCAST_WINDOWS
    by_window = index.select("w_id", "items", "unnamed")
    named = spans.select("key", F.explode("w_ids").alias("w_id")).join(
        F.broadcast(by_window) if small else by_window, "w_id").select("key", "unnamed", F.explode_outer("items").alias("item")).groupBy(
        "key").agg(F.array_sort(F.collect_set("item")).alias("items"), F.bool_or("unnamed").cast("int").alias("unnamed"))
    flagged = hits.join(named, "key")
    return keyed.select("doc_id", "key", F.size("words").cast("long").alias("n_words")).join(
        flagged.select(F.col("key").alias("_key"), "n_hit", "items", "unnamed"), F.col("key").eqNullSafe(F.col("_key")), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items") + F.col("unnamed"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items",
        digest(F.array_join("items", ",").cast("binary")).alias("items_sha256"), "contaminated")


OP8_ORACLE = r"""
with words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
items as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 13) as size, array_to_string(w[i:i + 12], ' ') as g
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) as i from items where len(w) > 0)),
sizes as (select distinct size from windows),
places as (
  select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as g
  from (select doc_id, size, w, unnest(generate_series(1, len(w) - size + 1)) as i from words, sizes where len(w) >= size)),
hits as (select p.doc_id, p.i, p.size, x.item_id from places p join windows x on p.size = x.size and p.g = x.g),
covered as (
  select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(generate_series(i, i + size - 1)) as k from (select distinct doc_id, i, size from hits)) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select w.doc_id, cast(len(w.w) as bigint) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(n.n_items, 0) as n_items,
  sha256(coalesce(n.ids, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 and 20 * coalesce(c.n_hit, 0) >= len(w.w) as contaminated
from words w left join covered c using (doc_id) left join named n using (doc_id)
"""
