"""Toxicity by a weighted lexicon (operator 1).

A text is folded (case, homoglyphs, digit substitutions, zero-width marks) to
words of plain letters.  The lexicon's entries are whole words and word
beginnings with weights; an Aho-Corasick automaton finds all entries in one
pass over the folded text.  Occurrences inside exception phrases don't count.
The weighted sum, normalised by the text's length, gives the score through a
logistic curve.

``learn`` makes the lexicon from labelled texts: counts of folded words and
their beginnings by label over distinct texts, then a greedy choice of the
entry that explains most toxic texts not yet explained.  Labelled texts are
bounded by ``SAMPLE`` (documented bound of the fit; drawn by hash of the text,
so copies count once and a rerun draws the same ones); scoring covers all rows.

Null and empty texts have no words and score the curve's value at 0.  Columns
named like the new ones are replaced; equal texts score alike.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import held_out, map_arrow, map_batches, table, written

SAMPLE = 20_000          # labelled texts that the fit may use
POOL = 100_000           # features of toxic texts whose clean counts are looked up
CANDIDATES = 4_000       # lexicon entries considered, by support among toxic texts
BEGINNINGS = (4, 5, 6, 7)  # lengths of word beginnings that can be entries
LEAST_SUPPORT = 3        # toxic texts that an entry has to explain
AGAIN_SHARE = 0.005      # share of the toxic texts, for entries in texts already explained
THRESHOLD = 0.3
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish")

# Look-alike letters and digit substitutions.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "α": "a", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ſ": "s",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
UNSEEN = "­​‌‍⁠﻿"

_letters = str.maketrans({**HOMOGLYPHS, **{c: "" for c in UNSEEN}})
_digits = str.maketrans(DIGITS)
_foreign = re.compile("[" + "".join(HOMOGLYPHS) + UNSEEN + "]")
_word = re.compile(r"[\w@$]+")
_accents = re.compile("[\u0300-\u036f]")
_masked = re.compile(r"[\d_@$]")


def _unmask(word: str) -> str:
    """Substituted digits and signs read as letters, wherever they stand in a word that holds a letter."""
    if not any(c.isalpha() for c in word):
        return word.strip("@$_")
    return word.translate(_digits).replace("_", "")


def fold(text: str | None) -> str:
    """Folded words with one blank before, between and after them."""
    if not text:
        return " "
    folded = text.lower()
    if not folded.isascii():
        # Letters and their marks apart, marks left out, what is left put together again.
        folded = unicodedata.normalize("NFKC", _accents.sub("", unicodedata.normalize("NFKD", folded)))
        if _foreign.search(folded):
            folded = folded.translate(_letters)
    words = _word.findall(folded)
    if _masked.search(folded):
        words = [w if w.isalpha() else _unmask(w) for w in words]
    return f" {' '.join(words)} " if words else " "


def features(folded: str) -> set[str]:
    """Words (" word ") and word beginnings (" begi") of a folded text."""
    words = set(folded.split())
    found = {f" {w} " for w in words}
    for n in BEGINNINGS:
        found.update(f" {w[:n]}" for w in words if len(w) > n)
    return found


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the curve of the score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 4.0, 1.0)  # intercept, of log(1 + sum), of density
    _automaton: object = field(default=None, repr=False, compare=False)

    def automaton(self):
        if self._automaton is None:
            made = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                made.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                made.add_word(phrase, (len(phrase), None))
            made.make_automaton()
            self._automaton = made
        return self._automaton

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def hits(self, folded: str) -> tuple[float, int]:
        """Weighted sum and number of words that hold an entry.

        Of the entries that begin at one word, the heaviest counts.
        """
        made = self.automaton()
        if not len(made):
            return 0.0, 0
        at: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in made.iter(folded):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > at.get(start, 0.0):
                at[start] = weight
        if spared:
            at = {s: w for s, w in at.items() if not any(a <= s < b for a, b in spared)}
        return sum(at.values()), len(at)

    def measure(self, text: str | None) -> tuple[float, float]:
        """log(1 + weighted sum) and the sum's share of the text's length."""
        folded = fold(text)
        total, _ = self.hits(folded)
        return math.log1p(total), total / math.sqrt(1.0 + folded.count(" "))

    def score(self, text: str | None) -> float:
        summed, density = self.measure(text)
        a, b, c = self.curve
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, a + b * summed + c * density))))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic fit by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def choose(held: dict[str, np.ndarray], toxic: np.ndarray) -> dict[str, float]:
    """Greedy choice of entries with log-odds weights.

    ``held``: the texts (indices) that hold each candidate.  An entry is worth
    the toxic texts it explains, each time a text is explained again half as
    much, less three for each clean text that it would accuse.  Beginnings and
    longer forms of a chosen entry are left out.
    """
    clean = ~toxic
    odds = math.log((toxic.sum() + 1) / (clean.sum() + 1))
    counts = {k: (int(toxic[v].sum()), int(clean[v].sum())) for k, v in held.items()}
    worth = toxic.astype(float)
    first = toxic.copy()
    again = max(LEAST_SUPPORT, AGAIN_SHARE * float(toxic.sum()))
    weights: dict[str, float] = {}

    def gain(k: str) -> float:
        fresh = float(first[held[k]].sum()) - 3.0 * counts[k][1]
        total = float(worth[held[k]].sum()) - 3.0 * counts[k][1]
        return total if fresh >= LEAST_SUPPORT or total >= again else 0.0

    queue = [(-float(t), -len(k), k) for k, (t, c) in counts.items() if t >= LEAST_SUPPORT and t > 4 * c]
    heapq.heapify(queue)
    while queue:  # lazy greedy: a gain never grows
        _, size, k = heapq.heappop(queue)
        now = gain(k)
        if now <= 0 or any(k.startswith(w) or w.startswith(k) for w in weights):
            continue
        if queue and (-now, size, k) > queue[0]:
            heapq.heappush(queue, (-now, size, k))
            continue
        t, c = counts[k]
        weights[k] = round(math.log((t + 0.5) / (c + 0.5)) - odds, 6)
        worth[held[k]] /= 2
        first[held[k]] = False
    return {k: w for k, w in weights.items() if w > 0}


def _counts(rows: DataFrame, pool: frozenset[str] | None) -> DataFrame:
    """(feature, n): texts of ``rows`` that hold each feature (of the pool)."""
    shared = rows.sparkSession.sparkContext.broadcast(pool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for t in batch.column(0).to_pylist():
                found = features(fold(t))
                seen.update(found if shared.value is None else found & shared.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), type=pa.string()), pa.array(list(seen.values()), type=pa.int64())],
                names=["feature", "n"])

    return map_arrow(rows.select("text"), run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def learn(train: DataFrame, exceptions: tuple[str, ...] = (), sample: int = SAMPLE) -> Lexicon:
    """Lexicon from rows with ``text`` and ``toxic``; rows without a label are left out."""
    rows = train.where(F.col("toxic").isNotNull()).select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, sample / max(1, train.where(F.col("toxic").isNotNull()).count()))
    # Copies count once, with the label of most of them.
    drawn = written(
        rows.withColumn("key", F.xxhash64("text")).where(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)))
        .groupBy("key").agg(F.min("text").alias("text"), (F.avg("toxic") > 0.5).alias("toxic")), "toxicity-sample")
    pool = dict(
        (r.feature, r.n) for r in _counts(drawn.where("toxic"), None)
        .where(F.col("n") >= LEAST_SUPPORT).orderBy(F.desc("n"), "feature").limit(POOL).collect())
    clean = {r.feature: r.n for r in _counts(drawn.where("not toxic"), frozenset(pool)).collect()}
    usable = sorted((k for k in pool if pool[k] > 4 * clean.get(k, 0)),
                    key=lambda k: (3 * clean.get(k, 0) - pool[k], k))[:CANDIDATES]
    shared = drawn.sparkSession.sparkContext.broadcast({k: i for i, k in enumerate(usable)})

    def columns(batch: pa.RecordBatch):
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        at = shared.value
        yield pa.array([sorted(at[k] for k in features(fold(t)) & at.keys()) for t in texts], type=pa.list_(pa.int32()))

    found = map_batches(drawn, "held array<int>", columns).select("key", "toxic", "held").toPandas().sort_values("key")
    toxic = found["toxic"].to_numpy(dtype=bool)
    places: dict[int, list[int]] = {}
    for i, ks in enumerate(found["held"]):
        for k in ks:
            places.setdefault(int(k), []).append(i)
    lexicon = Lexicon(choose({usable[k]: np.array(v) for k, v in places.items()}, toxic), tuple(fold(e) for e in exceptions))
    if not toxic.any() or toxic.all():
        return lexicon
    measured = _measures(drawn, lexicon).select("key", "toxic", "summed", "density").toPandas().sort_values("key")
    lexicon.curve = tuple(float(b) for b in _logistic(
        measured[["summed", "density"]].to_numpy(), measured["toxic"].to_numpy(dtype=float)))
    return lexicon


def _measures(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def columns(batch: pa.RecordBatch):
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        got = [shared.value.measure(t) for t in texts]
        yield pa.array([g[0] for g in got], type=pa.float64())
        yield pa.array([g[1] for g in got], type=pa.float64())

    return map_batches(docs, "summed double, density double", columns)


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def columns(batch: pa.RecordBatch):
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        yield pa.array([shared.value.score(t) for t in texts], type=pa.float64())

    return map_batches(docs, f"`{out}` double", columns)


def trained(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The production lexicon: labels of documents outside the held-out fold."""
    known = labels.select(F.col("doc_id").alias("id"), "toxic").where(F.col("toxic").isNotNull())
    train = docs.where(~held_out(2, 4)).select("doc_id", "text").join(known, F.col("doc_id") == F.col("id"))
    return learn(train, EXCEPTIONS)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = trained(docs, table(spark, sf_dir, "labels"))
    return score(docs, lexicon).select(
        "doc_id", held_out(2, 4).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
