"""Arithmetic shared by the clean tables and the marts.

Measures are fixed-point quantities written to doubles by the exporting
systems.  A sum rounds each value to a number of places that is fixed for the
column, splits it into two whole numbers of 64 bits, adds those up and joins
the totals as a decimal.  So it is exact at that resolution and independent of
the order in which partitions arrive; a retried task or another partitioning
gives the same bits.  Values that are not finite count as missing.  A value or
total that does not fit fails the query; nothing is switched at run time.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .coerce import column, finite

MEASURE = 6   # decimal places kept of a measured quantity
RATE = 10     # decimal places kept of a ratio

_LOW_BITS = 26                      # the low parts of 10**11 rows fit into 64 bits
_WHOLE_FROM = float(1 << 52)        # doubles from here on are whole numbers
_LARGEST = float(1 << (62 + _LOW_BITS))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that answers null for a zero or missing denominator."""
    return F.try_divide(column(numerator), column(denominator))


def clamp_zero(c: str | Column) -> Column:
    """Negative to zero; null stays null (``greatest`` would lose it)."""
    value = column(c)
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def _parts(c: str | Column, places: int) -> tuple[Column, Column]:
    """High and low part of the value in units of ``10**-places``; ties go away
    from zero, also where binary noise puts them just below."""
    raised = finite(column(c).cast("double")) * F.lit(float(10 ** places))
    size = F.abs(raised)
    whole = F.when(size < F.lit(_WHOLE_FROM), F.signum(raised) * F.floor(size + F.lit(0.5 + 1e-9))).otherwise(raised)
    high = F.when(F.abs(whole) < F.lit(_LARGEST), F.floor(whole / F.lit(float(1 << _LOW_BITS)))).when(
        whole.isNotNull(), F.raise_error(F.lit("value too large for an exact sum")).cast("bigint"))
    return high, (whole - high.cast("double") * F.lit(float(1 << _LOW_BITS))).cast("bigint")


def exact_sum(c: str | Column, places: int = MEASURE, over: WindowSpec | None = None) -> Column:
    """Order-independent sum to ``places`` decimals, as a double."""
    of = (lambda aggregate: aggregate) if over is None else (lambda aggregate: aggregate.over(over))
    high, low = (of(F.try_sum(part)) for part in _parts(c, places))
    decimal = lambda part: part.cast("decimal(19,0)")
    total = decimal(high) * F.lit(Decimal(1 << _LOW_BITS)) + decimal(low)
    given = of(F.count(finite(column(c).cast("double")))) > 0
    checked = F.when(given & (high.isNull() | low.isNull()), F.raise_error(F.lit("exact sum out of range")).cast("double"))
    return checked.otherwise(total.cast("double") / F.lit(float(10 ** places)))


def exact_avg(c: str | Column, places: int = MEASURE) -> Column:
    return F.try_divide(exact_sum(c, places), F.count(finite(column(c).cast("double"))))


def round_half_up(c: str | Column, places: int = 4) -> Column:
    """Decimal rounding, ties away from zero, as a double."""
    return F.round(column(c).cast("decimal(38,10)"), places).cast("double")
