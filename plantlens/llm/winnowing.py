"""Document fingerprints by winnowing (operator 2).

The ``GRAM`` characters from every position on are hashed, blanks included.  Of
every ``WINDOW`` consecutive hashes the least is chosen, the rightmost of equal
ones, and its position is kept.  So a passage of ``GRAM + WINDOW - 1``
characters that stands in two texts, wherever it stands and whatever script it
is in, gives both a hash in common for sure, and nothing shorter than a gram
does.

A chosen hash and its position are one long: 40 bits of hash above 24 bits of
position counted down, so the least long is the least hash, rightmost at a tie.
(Beyond 16 million characters the positions start over.)

Everything is built-in column expressions.  Grams are cut from the text's code
points as fixed-width bytes, where a position costs no search, and a text is
worked on in stretches of ``STRETCH`` windows, so that memory holds what is
chosen and one stretch's hashes.  An edited text shares the windows of its
unchanged beginning with the text, and only the rest is hashed again.

Each row is handled alone; only the neighbour by descending id takes a shuffle:
ids are cut into ranges at exact ids, a window runs over each range, and the
document at a range's edge is also sent to the range above.

Null texts count as empty; texts shorter than a gram are one gram, empty ones
none.  Two empty fingerprints are alike (1), an empty and another are not (0).
Rows of equal ids are ordered by text, null ids come last; a lone row is its
own next one.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import digest, table

GRAM = 12
WINDOW = 16  # a power of two
STRETCH = 4096
RANGES_PER_PARTITION = 4

_PLACES = (1 << 24) - 1
_WIDTH = 4  # bytes of a code point in UTF-32


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _window_minima(hashes: Column, step: int = 1) -> Column:
    """Least of each hash and those after it: of 2, of 4, ... up to ``WINDOW``; cut short at the end."""
    if step == WINDOW:
        return hashes
    return _with(hashes, lambda h: _window_minima(
        F.zip_with(h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.least(a, b)), step * 2))


def chosen(text: Column, first: Column | int = 0) -> Column:
    """The chosen (hash, position) longs of a text in their order; positions count from ``first``."""
    first = F.lit(first) if isinstance(first, int) else first

    def of_points(points: Column) -> Column:
        length = F.floor(F.octet_length(points) / _WIDTH).cast("int")
        n_grams = F.greatest(length - (GRAM - 1), F.least(length, F.lit(1)))
        n_windows = F.greatest(n_grams - (WINDOW - 1), F.least(n_grams, F.lit(1)))

        def gram(at: Column) -> Column:
            place = (first + at).bitwiseAND(F.lit(_PLACES))
            return F.shiftleft(F.xxhash64(F.substring(points, at * _WIDTH + 1, F.lit(GRAM * _WIDTH))), 24).bitwiseOR(
                F.lit(_PLACES) - place)

        def stretch(begin: Column) -> Column:
            windows = F.least(F.lit(STRETCH), n_windows - begin)
            last = F.least(begin + windows + (WINDOW - 2), n_grams - 1)
            minima = _window_minima(F.transform(F.sequence(begin, last), gram))
            return F.array_distinct(F.slice(minima, F.lit(1), windows))

        begins = F.sequence(F.lit(0), n_windows - 1, F.lit(STRETCH))
        none = F.array().cast("array<bigint>")
        return F.when(n_windows > 0, F.array_distinct(F.flatten(F.transform(begins, stretch)))).otherwise(none)

    return _with(F.encode(text, "UTF-32"), of_points)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the chosen (hash, position) longs of a text in their order."""
    return df.withColumn(out, chosen(F.col(text)))


def with_edited_fingerprint(df: DataFrame, fingerprint: str, edited: str, kept: Column, out: str) -> DataFrame:
    """``df`` with the fingerprint of ``edited``, whose first ``kept`` characters are
    those of the text that has ``fingerprint``.

    The last window inside the kept part is common to both, and so is all that
    was chosen before; from there on the edited text is hashed.
    """
    common = kept - (GRAM + WINDOW - 1)  # start of that window
    begin = F.greatest(common, F.lit(0))
    rest = chosen(F.substr(F.col(edited), begin + 1), begin)
    before = F.slice(F.col(fingerprint), F.lit(1), F.array_position(F.col(fingerprint), F.get("_rest", F.lit(0))).cast("int") - 1)
    return df.withColumn("_rest", rest).withColumn(
        out, F.when(common >= 0, F.concat(before, F.col("_rest"))).otherwise(F.col("_rest"))).drop("_rest")


def likeness(a: str, b: str) -> Column:
    """Share of common hashes among all hashes of two fingerprints."""
    x, y = (F.array_distinct(F.transform(c, lambda v: F.shiftright(v, 24))) for c in (a, b))
    common = F.size(F.array_intersect(x, y))
    every = F.size(x) + F.size(y) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def places(c: str) -> Column:
    """Positions at which a fingerprint's hashes were chosen."""
    return F.transform(c, lambda v: F.lit(_PLACES) - v.bitwiseAND(F.lit(_PLACES)))


def _range_of(c: Column, bounds: list[int]) -> Column:
    """Number of bounds up to ``c``: first among every m-th one, then within a stretch."""
    if not bounds:
        return F.lit(0)
    m = max(1, math.isqrt(len(bounds)))
    stretches = [bounds[i:i + m] for i in range(0, len(bounds), m)]
    heads = F.lit([s[0] for s in stretches])
    at = F.size(F.filter(heads, lambda b: b <= c)) - 1
    inside = F.size(F.filter(F.get(F.lit(stretches), at), lambda b: b <= c))
    return F.when(at < 0, F.lit(0)).otherwise(at * m + inside)


def neighbours(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the text of the next document by
    descending id (after the last: the first) as ``next_text``.

    Also has the columns ``_range``, ``_apart``, ``_lent`` and ``_mark``, by
    which the rows lie sorted in each range.  ``_lent`` rows are copies of a
    neighbour from the range below (or, for the lowest range, of the first
    row), which the last row of a range needs.  Rows without an id are
    ``_apart`` and follow themselves.
    """
    spark = docs.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], max(10_000, 4 * ranges))).first()[0]
    number = _range_of(F.col("doc_id"), sorted(set(cuts or [])))
    tops = {r.n: r.top for r in docs.where("doc_id is not null").groupBy(number.alias("n")).agg(
        F.max("doc_id").alias("top")).collect()}  # one row a range
    order = sorted(tops)
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("_own", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(ranges)).cast("int"))
                           .otherwise(number))
    targets = F.array("_own")
    if order:
        # The first row of a range follows the last row of the next range up.
        up = {n: order[(i + 1) % len(order)] for i, n in enumerate(order)}
        top_of = F.lit([tops.get(n, 0) for n in range(order[-1] + 1)])
        up_of = F.lit([up.get(n, 0) for n in range(order[-1] + 1)])
        lends = F.col("doc_id").isNotNull() & (F.col("doc_id") == F.get(top_of, F.col("_own")))
        targets = F.when(lends, F.array("_own", F.get(up_of, F.col("_own")))).otherwise(targets)
    dealt = base.select("doc_id", "text", F.posexplode(targets).alias("_lent", "_range")).select(
        "doc_id", "text", "_range", "_lent", F.col("doc_id").isNull().alias("_apart"), F.xxhash64("text").alias("_mark"))
    along = Window.partitionBy("_range").orderBy("_apart", "_lent", F.desc("doc_id"), "_mark")
    return dealt.withColumn("next_text", F.when(F.col("_apart"), F.col("text")).otherwise(F.lead("text").over(along)))


def compared(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its fingerprint, that
    of its edited text, and how alike the edited and the next text are."""
    rows = neighbours(docs)
    length = F.char_length("text")
    third = F.floor(length / 3).cast("int")
    rows = rows.select(
        "doc_id", (length - third).alias("_kept"), "_range", "_apart", "_lent", "_mark", "text", length.cast("long").alias("n_chars"),
        F.when(F.col("_lent") == 0, F.concat(
            F.substr("text", F.lit(1), length - third), F.substr("next_text", F.lit(1), third))).otherwise("").alias("edited"))
    rows = with_fingerprint(rows, "text", "chosen")
    rows = with_edited_fingerprint(rows, "chosen", "edited", F.col("_kept"), "edited_chosen").withColumn("edited_sha256", digest(F.col("edited").cast("binary")))
    along = Window.partitionBy("_range").orderBy("_apart", "_lent", F.desc("doc_id"), "_mark")
    rows = rows.drop("text", "edited", "_kept").withColumn(
        "next_chosen", F.when(F.col("_apart"), F.col("chosen")).otherwise(F.lead("chosen").over(along))).where("_lent = 0")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "chosen", "edited_chosen",
        likeness("chosen", "edited_chosen").alias("near_edited"), likeness("chosen", "next_chosen").alias("near_next"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    def as_text(c: str) -> Column:
        return digest(F.array_join(F.col(c).cast("array<string>"), ",").cast("binary"))

    return compared(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_chars", "edited_sha256", as_text("chosen").alias("fingerprint"),
        as_text("edited_chosen").alias("edited_fingerprint"), "near_edited", "near_next")
