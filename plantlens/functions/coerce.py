"""Lenient coercion and normalisation of raw text columns (Column in, Column out).

Nothing here raises on bad input: text that does not parse becomes null, so
that the audit rules and not an exception decide what happens to the row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text tokens a CSV export uses for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Tried in this order.  Day-first slashes and dashes are a per-table choice:
# pass another list where a source writes month first.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd[ ]['T'][HH:mm[:ss[.SSSSSS]]]",
    "yyyy-MM-dd[ ]['T']HH:mm[:ss[.SSSSSSSSS]][XXX]",  # zones and finer fractions
    "yyyy/MM/dd[ HH:mm[:ss]]",
    "dd/MM/yyyy[ HH:mm[:ss]]",
    "dd-MM-yyyy[ HH:mm[:ss]]",
)

# Text that the first of those formats reads and a cast reads alike, without a formatter's time for each value.
_PLAIN_TIME = "^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{6})?)?\\z"


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Contract:
    """How a source writes the values of one table.

    ``formats`` are tried in this order, ``strict`` takes only the first, and
    ``column_formats`` has the lists of columns that differ.  ``units`` gives a
    column's (factor, offset) into the unit of the clean table: 1/60 and 0 turn
    seconds into minutes.
    """

    formats: tuple[str, ...] = TIMESTAMP_FORMATS
    strict: bool = False
    column_formats: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    units: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    def timestamp(self, name: str) -> Column:
        return to_timestamp(name, self.column_formats.get(name, self.formats), strict=self.strict)

    def number(self, name: str, value: Column) -> Column:
        if name not in self.units:
            return value
        factor, offset = self.units[name]
        return value * F.lit(float(factor)) + F.lit(float(offset))


DEFAULT = Contract()


def normalize_name(name: str) -> str:
    """Header text to column name: trimmed, lower case, separators to ``_``."""
    return re.sub(r"[ \-/]", "_", name.strip().lower())


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def tokens_to_null(c: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    text = column(c)
    return F.when(~text.isin(*tokens), text)


def to_timestamp(
    c: str | Column,
    formats: Sequence[str] = TIMESTAMP_FORMATS,
    *,
    strict: bool = False,
) -> Column:
    """First format that parses the text; ``strict`` tries only the first.

    ``strict`` is the one-format-per-column behaviour; the default accepts a
    column that mixes formats.  The usual text of an export is cast, which gives
    what the first of ``TIMESTAMP_FORMATS`` does; no other of them reads it.
    """
    text = F.trim(column(c))
    tried = formats[:1] if strict else formats
    read = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in tried])
    if tuple(tried) not in (TIMESTAMP_FORMATS, TIMESTAMP_FORMATS[:1]):
        return read
    return F.when(text.rlike(_PLAIN_TIME), text.try_cast("timestamp")).otherwise(read)


def finite(value: Column) -> Column:
    """A double that is a number; NaN and the infinities become null."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def to_number(c: str | Column) -> Column:
    """Text to double; anything that is not a finite number becomes null."""
    return finite(F.trim(column(c)).try_cast("double"))


def coerce(
    df: DataFrame, *, timestamps: Sequence[str] = (), numbers: Sequence[str] = (), contract: Contract = DEFAULT,
) -> DataFrame:
    """Coerce the listed columns that exist; already typed columns are cast."""
    changed: dict[str, Column] = {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for name in timestamps:
        if isinstance(kinds.get(name), T.StringType):
            changed[name] = contract.timestamp(name)
        elif name in kinds:
            changed[name] = F.col(name).cast("timestamp")
    for name in numbers:
        if isinstance(kinds.get(name), T.StringType):
            changed[name] = contract.number(name, to_number(name))
        elif name in kinds:
            changed[name] = contract.number(name, finite(F.col(name).cast("double")))
    return df.withColumns(changed) if changed else df


def rejected_values(
    df: DataFrame, *, timestamps: Sequence[str] = (), numbers: Sequence[str] = (), contract: Contract = DEFAULT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(*keep, column_name, value) of every text that ``coerce`` turns into null; one scan, no shuffle.

    Rows without such a text are left out first, by compiled code; lists are made of the others only.
    """
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    read = {n: contract.timestamp(n) for n in timestamps if n in texts} | {n: to_number(n) for n in numbers if n in texts}
    unread = {n: F.col(n).isNotNull() & value.isNull() for n, value in read.items()}
    bad = [F.when(c, F.struct(F.lit(n).alias("column_name"), F.col(n).alias("value"))) for n, c in unread.items()]
    none = F.array().cast("array<struct<column_name:string,value:string>>")
    found = df.filter(reduce(lambda a, b: a | b, unread.values(), F.lit(False)))
    return found.select(*keep, F.explode(F.array_compact(F.array(*bad)) if bad else none).alias("_bad")).select(*keep, "_bad.*")


def text_or_literal(c: str | Column, parity: bool) -> Column:
    """``parity`` turns a missing text into the word the pandas cast leaves."""
    text = column(c).cast("string")
    return F.coalesce(text, F.lit("None")) if parity else text


def lower_text(c: str | Column, *, parity: bool = False) -> Column:
    return F.lower(F.trim(text_or_literal(c, parity)))


def upper_text(c: str | Column, *, parity: bool = False) -> Column:
    return F.upper(F.trim(text_or_literal(c, parity)))


def holds(condition: Column) -> Column:
    """A comparison with a missing operand counts as not true."""
    return F.coalesce(condition, F.lit(False))


def flag(*conditions: Column, any_of: bool = False) -> Column:
    """0/1 flag over conditions, each made two-valued before combining."""
    result = holds(conditions[0])
    for condition in conditions[1:]:
        result = (result | holds(condition)) if any_of else (result & holds(condition))
    return result.cast("int")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    begin, finish = column(start).cast("timestamp"), column(end).cast("timestamp")
    return (F.unix_micros(finish) - F.unix_micros(begin)) / F.lit(60_000_000.0)


def date_of(c: str | Column) -> Column:
    return F.to_date(column(c))


def hour_of(c: str | Column) -> Column:
    return F.date_trunc("hour", column(c))


def composite_key(*parts: str | Column, sep: str = "@") -> Column:
    """Text key; a missing part is spelled out so the key keeps its shape."""
    return F.concat_ws(sep, *[F.coalesce(column(p).cast("string"), F.lit("None")) for p in parts])


def severity_rank(c: str | Column = "severity") -> Column:
    level = column(c)
    return F.when(level == "high", 1).when(level == "medium", 2).when(level == "low", 3).otherwise(4)


def json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """One JSON object per row: NaN as null, timestamps as ISO text."""
    safe = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        safe.append(c.alias(f.name))
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "ignoreNullFields": "false"}
    return df.select(F.to_json(F.struct(*safe), options).alias(name))
