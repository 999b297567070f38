"""Texts of an Arrow batch as flat arrays: word bounds and 64-bit hashes.

Everything here works on the bytes of many texts at once, so a task spends a
few nanoseconds per byte and never loops over words.  Texts are grouped into
pieces of about ``PIECE`` bytes; a longer text is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SPACE = bytes([0x20, *range(0x09, 0x0E)])

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


IS_SPACE = byte_table(SPACE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def _power(kind: str, factor: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(kind)
    if known is None or len(known) < n:
        size = max(n, PIECE + 1)
        steps = np.full(size, factor, dtype=np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            known = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * PIECE:
            _powers[kind] = known
    return known[:n]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for each span, by prefix sums."""
    n = len(values)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power("up", _ODD, n), out=sums[1:])
        raw = (sums[ends] - sums[starts]) * _power("down", _ODD_INVERSE, n + 1)[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``size`` bytes; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        at = offsets[row:end + 1]
        yield row, end, data[at[0]:at[-1]], at - at[0]
        row = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that stay within a text.

    Returns starts, ends and, for each text, the index of its first run (one
    entry more than there are texts).
    """
    n = len(inside)
    if n == 0:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    border = np.zeros(n + 1, dtype=bool)
    border[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | border[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and
    each text's first word index."""
    starts, ends, first = spans(~IS_SPACE[data], offsets)
    return span_hash(LOWER[data], starts, ends), first


def row_of(first: np.ndarray) -> np.ndarray:
    """Row number of each element, from the first indices of the rows."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
