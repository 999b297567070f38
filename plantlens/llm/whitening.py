"""Embedding whitening by QDWH spectral divide and conquer (operator 11).

Entries are turned into whole numbers x, so counts, sums and centred products
are exact: each task sums its rows, Spark adds the tasks' whole numbers.  The
covariance of the distinct vectors is split by spectral projectors: the polar
factor of V - s*I (QR-based dynamically weighted Halley iterations) is +1 on
the eigenspace above the shift s and -1 below it, and the two invariant
subspaces are split again until components remain.  Means and components, a
few vectors, are broadcast to whiten every row.

Only dimension-sized things reach the driver: the sums and a dimension-squared
covariance.  Copies of a vector are merged by the map tasks before they meet.

Defined results: vectors that are null, empty, or hold null or non-finite
entries are left out, also vectors whose length isn't that of most rows (the
longer of tied lengths); null ids stay.  Repeated rows and equal vectors get
equal results.  Components whose eigenvalue is 0 to double precision can't be
scaled and are left out, so a table of one distinct vector, or an empty one,
gives no rows.  A deviation beyond 64 bits is null, and x ends at the bounds of
64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import free_name, map_arrow, map_batches, table, written

SCALE = 256
COMPONENTS = 4
UNIT = 1 << 60  # parts of 1 in which whitened products are added, to be the same in any order

HALF = 10 ** 18  # sums travel as two numbers, so that decimals hold them at any input

_EPS = np.finfo(float).eps
_SHIFTS = (0.0, 0.125, -0.125, 0.3, -0.3, 0.6, -0.6)


# --- spectral divide and conquer -------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QR-based dynamically weighted Halley steps."""
    m = len(a)
    x = a / np.linalg.norm(a)
    low, eye = 1e-16, np.eye(m)
    for _ in range(40):
        root = np.cbrt(4 * (1 - low * low) / low ** 4) if low < 1 else 0.0
        h = math.sqrt(1 + root)
        p = h + 0.5 * math.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - low * low) / (low * low * h)))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        basis, _ = np.linalg.qr(np.vstack([math.sqrt(r) * x, eye]))
        new = (q / r) * x + (p - q / r) / math.sqrt(r) * (basis[:m] @ basis[m:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (p + q * low * low) / (1 + r * low * low))
        moved = np.linalg.norm(new - x)
        x = new
        if moved <= (5 * _EPS) ** (1 / 3) and abs(1 - low) < 1e-8:
            return x
    return x


def _range_of(projector: np.ndarray, rank: int, random: np.random.Generator) -> np.ndarray:
    basis = random.standard_normal((len(projector), rank))
    for _ in range(3):
        basis, _ = np.linalg.qr(projector @ basis)
    return basis


def _split(a: np.ndarray, scale: float, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenspaces above and below a shift near the
    mean eigenvalue; none if the eigenvalues can't be told apart."""
    m = len(a)
    mean = np.trace(a) / m
    spread = np.linalg.norm(a - mean * np.eye(m)) / math.sqrt(m)
    if spread <= 8 * _EPS * scale:
        return None
    best = None
    for t in _SHIFTS:
        projector = (polar(a - (mean + t * spread) * np.eye(m)) + np.eye(m)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < m:
            continue
        above, below = _range_of(projector, rank, random), _range_of(np.eye(m) - projector, m - rank, random)
        left = np.linalg.norm(above.T @ a @ below) + scale * np.linalg.norm(above.T @ below)
        if best is None or left < best[0]:
            best = left, above, below
        if left <= 16 * m * _EPS * scale:
            break
    return best and best[1:]


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    scale, random = max(np.linalg.norm(a), np.finfo(float).tiny), np.random.default_rng(0)
    found, waiting = [], [np.eye(len(a))]
    while waiting and sum(f.shape[1] for f in found) < wanted:
        basis = waiting.pop()
        block = basis.T @ a @ basis
        parts = _split((block + block.T) / 2, scale, random) if len(block) > 1 else None
        if parts is None:
            found.append(basis)
        else:
            above, below = (np.linalg.qr(basis @ p)[0] for p in parts)
            waiting += [below, above]  # the larger eigenvalues are next
    vectors = np.column_stack(found) if found else np.zeros((len(a), 0))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


# --- sums over rows ---------------------------------------------------------

def _matrix(batch: pa.RecordBatch, vector: str, width: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(vector)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min()), 0) if x.size else 0


def _minus(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """Differences, in 64 bits where that holds them."""
    kind = np.int64 if _largest(x) + max(map(abs, centre), default=0) < 1 << 62 else object
    return x.astype(kind) - np.array(centre, dtype=kind)


def _added(df: DataFrame, size: int, of_batch: Callable[[pa.RecordBatch], np.ndarray]) -> list[int]:
    """Sums of the whole numbers ``of_batch`` gives, by place; one row a task and place is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * size
        for batch in batches:
            total = [a + int(b) for a, b in zip(total, of_batch(batch).ravel().tolist(), strict=True)]
        held = [(i, *divmod(v, HALF)) for i, v in enumerate(total) if v]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _, _ in held], type=pa.int32()), pa.array([str(v) for _, v, _ in held], type=pa.string()),
             pa.array([v for _, _, v in held], type=pa.int64())], names=["place", "high", "low"])

    total = [0] * size
    for r in map_arrow(df, run, "place int, high string, low long").groupBy("place").agg(
            F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
            F.sum(F.col("low").cast("decimal(20,0)")).alias("low")).collect():  # at most `size` rows
        total[r.place] = int(r.high) * HALF + int(r.low)
    return total


def _exact_sum(x: np.ndarray) -> np.ndarray:
    fits = _largest(x) * len(x) < 1 << 63
    return (x if fits else x.astype(object)).sum(axis=0)


def _exact_products(y: np.ndarray) -> np.ndarray:
    """Sum of y y^T over rows of whole numbers: blocks of doubles below 2^53, or Python numbers."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    if not len(y):
        return total
    largest = max(1, _largest(y))
    rows = (1 << 53) // (largest * largest)
    if not rows:
        y = y.astype(object)
        return y.T @ y
    for start in range(0, len(y), rows):
        block = y[start:start + rows].astype(float)
        total = total + (block.T @ block).astype(np.int64)
    return total


# --- the operator -----------------------------------------------------------

def whole_numbers(rows: DataFrame, vector: str = "embedding", out: str = "x") -> DataFrame:
    """Rows with usable vectors, which become ``out``: floor(256 * entry) of each entry."""
    usable = F.col(vector).isNotNull() & ~F.exists(
        vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    made = rows.where(F.coalesce(usable, F.lit(False)) & (F.size(vector) > 0)).withColumn(
        out, F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long")))
    size = F.size(vector)
    lengths = made.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return made.where(size == (lengths[0].size if lengths else 0))


@dataclass
class Whitening:
    """Exact moments of the fit list and its components."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors as columns
    trace: float
    identity_error: float = 0.0

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in 64 bits where that holds it."""
        largest = max([1, *map(abs, self.sums)]) + self.n * _largest(x)
        if largest < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        off = self.offsets(x)
        if off.dtype != object and _largest(off) ** 2 * off.shape[1] < 1 << 63:
            return (off * off).sum(axis=1).tolist()
        total = (off.astype(object) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in total]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centred = (self.offsets(x) / self.n).astype(float)
        return centred @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, vector: str = "x", wanted: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors; none if there are none."""
    distinct = written(rows.select(vector).distinct(), "whitening-fit")
    first = distinct.first()
    if first is None:
        return None
    width = len(first[0])

    def count_and_sums(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch, vector, width)
        return np.concatenate([np.array([len(x)], dtype=object), _exact_sum(x).astype(object)])

    n, *sums = _added(distinct, width + 1, count_and_sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]  # nearest whole number to the mean
    products = _added(distinct, width * width, lambda batch: _exact_products(
        _minus(_matrix(batch, vector, width), centre)))
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    # (sum of y y^T) / n - mean(y) mean(y)^T, from whole numbers until the one division.
    covariance = np.array([
        [(n * products[i * width + j] - rest[i] * rest[j]) / (n * n) for j in range(width)] for i in range(width)])
    values, vectors = components(covariance, wanted)
    usable = values > width * _EPS * max(np.linalg.norm(covariance), np.finfo(float).tiny)
    model = Whitening(n, sums, values[usable], vectors[:, usable], float(np.trace(covariance)))
    model.identity_error = identity_error(distinct, model, vector)
    return model


def identity_error(distinct: DataFrame, model: Whitening, vector: str = "x") -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, width = len(model.values), len(model.sums)
    if not k:
        return 0.0
    shared = distinct.sparkSession.sparkContext.broadcast(model)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        z = shared.value.whitened(_matrix(batch, vector, width))  # centred by the exact mean
        sums = np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
        return np.array([int(round(v * UNIT)) for v in sums.tolist()], dtype=object)

    total = np.array([v / UNIT / model.n for v in _added(distinct, k + k * k, moments)])
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening, vector: str = "x") -> DataFrame:
    """``rows`` with ``whitened`` (one number a component) and ``deviation``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    k, width = len(model.values), len(model.sums)

    def columns(batch: pa.RecordBatch):
        x = _matrix(batch, vector, width)
        z = shared.value.whitened(x)
        yield pa.ListArray.from_arrays(
            pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(z.ravel(), type=pa.float64()))
        yield pa.array(shared.value.deviation(x), type=pa.int64())

    return map_batches(rows, "whitened array<double>, deviation long", columns)


def whitened_components(rows: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row for each usable row of ``rows`` and component."""
    x = free_name(rows, "x")
    usable = whole_numbers(rows.select("vec_id", vector), vector, x).select("vec_id", x)
    model = fit(usable, x, wanted)
    if model is None:
        model = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
        usable = usable.limit(0)
    shares = [float(v / model.trace) for v in model.values]
    return whiten(usable, model, x).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened",
        F.element_at(F.array(*map(F.lit, shares or [0.0])), F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"))
