"""Quality classifier on random Fourier features (operator 3).

A text becomes a few dozen statistics (shares of character classes, word and
line lengths, repetition).  Random Fourier features of the standardised
statistics approximate a Gaussian kernel; ridge regression on them is solved
from normal equations that each partition sums and that add up to one small
matrix.  Isotonic regression over the training scores turns the result into a
probability.

The statistics of all rows are computed once and written; fitting reads only
them.  All labelled rows outside the held-out fold are used.

Null and empty texts have zero statistics and score like any text.  Columns
named like the new ones are replaced; equal texts score alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import held_out, map_arrow, map_batches, table, written
from .textarrays import IS_SPACE, LOWER, byte_table, mix, pieces, row_of, span_hash, spans

FEATURES = 256
BANDWIDTH = 4.0      # of the kernel, in standard deviations of the statistics
RIDGE = 1.0
STEPS = 1000         # resolution of the calibration's score axis
THRESHOLD = 0.3
SEED = 20240
PART = 1 << 16         # parts of 1 in which statistics are added up
SUM_PART = 1 << 32     # the same of the sums that a task hands on

_CLASSES = {
    "upper": bytes(range(0x41, 0x5B)), "lower": bytes(range(0x61, 0x7B)), "digit": b"0123456789",
    "space": b" \t", "line": b"\n", "stop": b".!?", "comma": b",;:", "wide": bytes(range(0xC0, 0x100)),
    "quote": b"\"'()[]{}<>", "mark": b"!", "bar": b"|", "sign": b"#$%&*+-/=@\\^_`~",
}
_TABLES = [byte_table(members) for members in _CLASSES.values()]
N_STATISTICS = len(_CLASSES) + 13


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return sums[first[1:]] - sums[first[:-1]]


def _repeats(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: distinct keys and the count of its most frequent key."""
    rows = row_of(first)
    n = len(first) - 1
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    cuts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1]))))
    counts = np.diff(np.concatenate((cuts, [len(keys)])))
    distinct = np.bincount(rows[cuts], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, rows[cuts], counts)
    return distinct, most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers for each text."""
    size = np.maximum(np.diff(offsets), 1).astype(np.float64)
    shares = [_per_row(t[data], offsets) / size for t in _TABLES]
    starts, ends, first = spans(~IS_SPACE[data], offsets)
    n_words = np.diff(first).astype(np.float64)
    words = np.maximum(n_words, 1)
    lengths = (ends - starts).astype(np.float64)
    rows = row_of(first)
    hashed = span_hash(LOWER[data], starts, ends)
    mean = _per_row(lengths, first) / words
    spread = np.sqrt(np.maximum(_per_row(lengths ** 2, first) / words - mean ** 2, 0))
    distinct, most = _repeats(hashed, first)
    same = np.zeros(len(hashed), dtype=bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (rows[1:] == rows[:-1])
    pair = hashed.copy()
    with np.errstate(over="ignore"):
        pair[1:] = mix(hashed[1:] * np.uint64(3) + hashed[:-1])
    pairs, _ = _repeats(pair, first)
    shape = np.zeros(len(starts), dtype=bool)
    if len(starts):
        tail = data[ends - 1]
        shape = ~(_TABLES[0][tail] | _TABLES[1][tail] | (tail >= 0x80) | _TABLES[2][tail])
    capital = _TABLES[0][data[starts]] if len(starts) else shape
    line_starts, line_ends, line_first = spans(data != 0x0A, offsets)
    n_lines = np.maximum(np.diff(line_first), 1).astype(np.float64)
    distinct_lines, _ = _repeats(span_hash(data, line_starts, line_ends), line_first)
    ratio = lambda x: np.where(n_words > 0, x / words, 0.0)
    return np.column_stack([
        *shares, np.log1p(n_words), np.log1p(n_lines), mean, spread, ratio(distinct), ratio(most),
        ratio(_per_row(same, first)), ratio(pairs), ratio(_per_row(shape, first)), ratio(_per_row(capital, first)),
        distinct_lines / n_lines, np.log1p(size / n_lines), ratio(distinct) * np.log1p(n_words)])


def with_statistics(docs: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    def columns(batch: pa.RecordBatch):
        made = [statistics(data, offsets) for _, _, data, offsets in pieces(batch.column(batch.schema.get_field_index(text)))]
        flat = np.concatenate(made) if made else np.zeros((0, N_STATISTICS))
        yield pa.ListArray.from_arrays(
            pa.array(np.arange(len(flat) + 1, dtype=np.int32) * N_STATISTICS), pa.array(flat.ravel()))

    return map_batches(docs, f"`{out}` array<double>", columns)


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)


@dataclass
class Model:
    """Standardisation, random features, ridge weights and calibration steps."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    levels: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        made = np.cos(z @ self.directions + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.column_stack([np.ones(len(x)), made])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.levels), 0.0, 1.0)


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit by pooling neighbours; returns block ends and levels."""
    blocks: list[list[float]] = []  # mean, weight, first, last
    for x, y, w in zip(at, mean, weight, strict=True):
        blocks.append([y, w, x, x])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            y1, w1, _, last = blocks.pop()
            y0, w0, begin, _ = blocks.pop()
            blocks.append([(y0 * w0 + y1 * w1) / (w0 + w1), w0 + w1, begin, last])
    xs = [x for b in blocks for x in (b[2], b[3])]
    ys = [b[0] for b in blocks for _ in range(2)]
    return np.array(xs), np.array(ys)


def _moments(row) -> tuple[float, float]:
    """Mean and standard deviation from whole sums, exact until the last division."""
    total, squares = int(row.sum), int(row.squares)
    return total / row.n / PART, math.sqrt((row.n * squares - total * total) / (row.n * row.n)) / PART


def fit(train: DataFrame, features: int = FEATURES, bandwidth: float = BANDWIDTH, ridge: float = RIDGE) -> Model:
    """Model from rows with ``statistics`` and a 0/1 ``label``; null labels are left out."""
    train = train.where("label is not null").select("statistics", F.col("label").cast("double").alias("label"))
    # Whole numbers add up to the same in any order, so a rerun after a loss gives the same model.
    whole = F.round(F.col("v") * float(PART)).cast("decimal(18,0)")
    spread = {r.i: _moments(r) for r in train.select(F.posexplode("statistics").alias("i", "v")).groupBy("i").agg(
        F.count("v").alias("n"), F.sum(whole).alias("sum"), F.sum((whole * whole).cast("decimal(38,0)")).alias("squares")
    ).collect()}  # one row a statistic
    random = np.random.default_rng(SEED)
    model = Model(
        centre=np.array([spread[i][0] if i in spread else 0.0 for i in range(N_STATISTICS)]),
        scale=np.array([max(spread[i][1], 1e-6) if i in spread else 1.0 for i in range(N_STATISTICS)]),
        directions=random.normal(0.0, 1.0 / bandwidth, (N_STATISTICS, features)),
        phases=random.uniform(0.0, 2 * np.pi, features), weights=np.zeros(features + 1))
    shared = train.sparkSession.sparkContext.broadcast(model)
    width = features + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            z = shared.value.features(_matrix(batch, "statistics"))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(np.rint(total.ravel() * SUM_PART).astype(np.int64))], names=["cell", "v"])

    cells = map_arrow(train, sums, "cell long, v long").groupBy("cell").agg(
        (F.sum(F.col("v").cast("decimal(20,0)")).cast("double") / float(SUM_PART)).alias("v")).toPandas()
    if not len(cells):
        return model
    total = np.zeros(width * (width + 1))
    total[cells["cell"].to_numpy()] = cells["v"].to_numpy()  # (features + 1) * (features + 2) cells
    total = total.reshape(width, width + 1)
    penalty = ridge * np.eye(width)
    penalty[0, 0] = 1e-6
    model.weights = np.linalg.solve(total[:, :width] + penalty, total[:, width])
    fitted = train.sparkSession.sparkContext.broadcast(model)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = np.clip(np.rint(fitted.value.raw(_matrix(batch, "statistics")) * STEPS), -STEPS, 2 * STEPS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(steps.astype(np.int64)), batch.column(1)], names=["step", "label"])

    steps = map_arrow(train, raw, "step long, label double").groupBy("step").agg(
        F.avg("label").alias("mean"), F.count("*").alias("n")).orderBy("step").toPandas()  # at most 3 * STEPS + 1
    model.levels = isotonic(steps["step"].to_numpy() / STEPS, steps["mean"].to_numpy(), steps["n"].to_numpy())
    return model


def score(measured: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Rows with ``statistics`` and a score from 0 to 1."""
    shared = measured.sparkSession.sparkContext.broadcast(model)
    return map_batches(measured, f"`{out}` double", lambda batch: [
        pa.array(shared.value.score(_matrix(batch, "statistics")))])


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = written(with_statistics(docs).drop("text"), "quality-statistics")
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    train = measured.where(~held_out(0, 5)).join(known, F.col("doc_id") == F.col("id"))
    return score(measured, fit(train)).select(
        "doc_id", held_out(0, 5).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
