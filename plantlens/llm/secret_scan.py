"""Secret scan by character Markov models (operator 6).

Rules find the plain cases: assignments to a password-like name, access keys
and long hexadecimal strings.  Two first-order Markov models of characters,
one of random strings and one of ordinary identifiers, find more: a token of
``LEAST`` characters or more is a secret if its log-likelihood ratio is at
least ``TOTAL`` in all and ``EACH`` a character.

The models are trained from labelled samples of the whole corpus: the strings
that the rules found are the random ones, all other words the ordinary ones.
Each task counts character pairs in one fixed table; the tables' sums are the
models.

Spans are (kind, start, end) in code points, end exclusive; those of the rules
are all matches that pass, a token that overlaps one of them is not added.
Null and empty texts have no spans.  A corpus without samples adds none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import digest, map_arrow, map_batches, table

LEAST = 16
TOTAL = 20.0
EACH = 0.6
BACK = 200.0   # weight of single characters in the models, in pairs

# The rules.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_SIZE = len(_ALPHABET) + 1  # 0: anything else
_CODE = np.zeros(256, dtype=np.int64)
_CODE[list(_ALPHABET.encode())] = np.arange(1, _SIZE)

Span = tuple[int, int, str]


def by_rules(text: str) -> list[Span]:
    """(start, end, kind) of the rules' matches, each kind on its own."""
    found: list[Span] = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _pairs(raw: bytes) -> np.ndarray:
    """Numbers of character pairs, as a flat table; words begin and end with 0."""
    codes = _CODE[np.frombuffer(raw, dtype=np.uint8)]
    return np.bincount(codes[:-1] * _SIZE + codes[1:], minlength=_SIZE * _SIZE)


def pair_counts(docs: DataFrame) -> DataFrame:
    """(cell, n_random, n_ordinary) over the texts of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, every = (np.zeros(_SIZE * _SIZE, dtype=np.int64) for _ in range(2))
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    every += _pairs(b" " + text.encode() + b" ")
                    values = [text[s:e] for s, e, _ in by_rules(text)]
                    if values:
                        random += _pairs((" " + " ".join(v.rpartition("=")[2] or v for v in values) + " ").encode())
        cells = np.flatnonzero(random + every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(random[cells]), pa.array(np.maximum(every - random, 0)[cells])],
            names=["cell", "n_random", "n_ordinary"])

    return map_arrow(docs.select("text"), run, "cell long, n_random long, n_ordinary long").groupBy("cell").agg(
        F.sum("n_random").alias("n_random"), F.sum("n_ordinary").alias("n_ordinary"))


def train(docs: DataFrame) -> np.ndarray | None:
    """Log-likelihood ratio of each character after each; None without samples."""
    counts = np.ones((2, _SIZE * _SIZE))
    for row in pair_counts(docs).collect():  # at most one row a pair of characters
        counts[0, row.cell] += row.n_random
        counts[1, row.cell] += row.n_ordinary
    if (counts.sum(axis=1) <= _SIZE * _SIZE).any():
        return None
    inside = counts.reshape(2, _SIZE, _SIZE)[:, :, 1:] - 1
    alone = inside.sum(axis=1, keepdims=True) + 1
    alone /= alone.sum(axis=2, keepdims=True)
    # A character's own frequency stands in for pairs that are rare.
    chance = np.log((inside + BACK * alone) / (inside.sum(axis=2, keepdims=True) + BACK))
    ratio = np.zeros((_SIZE, _SIZE))
    ratio[:, 1:] = chance[0] - chance[1]
    return ratio


def by_model(text: str, ratio: np.ndarray, taken: list[Span]) -> list[Span]:
    found, apart = [], []
    for s, e, _ in taken:  # by start; joined where they overlap
        if apart and s <= apart[-1][1]:
            apart[-1][1] = max(e, apart[-1][1])
        else:
            apart.append([s, e])
    at = 0  # both tokens and taken stretches go forward, so each is looked at once
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while at < len(apart) and apart[at][1] <= start:
            at += 1
        if at < len(apart) and apart[at][0] < end:
            continue
        codes = _CODE[np.frombuffer(b" " + m[0].encode(), dtype=np.uint8)]
        total = float(ratio[codes[:-1], codes[1:]].sum())
        if total >= TOTAL and total >= EACH * (end - start):
            found.append((start, end, "markov"))
    return found


def scan(docs: DataFrame, ratio: np.ndarray | None, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with an array of (kind, start, end), by start and then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def columns(batch: pa.RecordBatch):
        rows = []
        for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
            spans = by_rules(value) if value else []
            if value and shared.value is not None:
                spans = sorted(spans + by_model(value, shared.value, spans), key=lambda s: (s[0], KINDS.index(s[2])))
            rows.append([{"kind": k, "start": s, "end": e} for s, e, k in spans])
        yield pa.array(rows, type=pa.list_(span))

    return map_batches(docs, f"`{out}` array<struct<kind:string,start:int,end:int>>", columns)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", of_kind("assign").alias("n_assign"), of_kind("access").alias("n_access"), of_kind("hex").alias("n_hex"),
        digest(joined(F.filter("spans", lambda s: s["kind"] != "markov")).cast("binary")).alias("base_sha256"),
        joined("spans").alias("spans"))
