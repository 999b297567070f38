"""Trained models against plain re-computations: language model, secret models, quality fit."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from llm_fixtures import docs  # noqa: F401
from plantlens.llm import kneser_ney, quality, secret_scan
from plantlens.llm.frames import held_out

BEGIN, END = object(), object()


def _tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), END]


class ByHand:
    """Interpolated modified Kneser-Ney over pairs of tokens, from dictionaries."""

    def __init__(self, texts):
        self.pairs, self.count = Counter(), Counter()
        for text in texts:
            tokens = _tokens(text)
            self.count.update(tokens)
            self.pairs.update(zip([BEGIN, *tokens], tokens))
        self.followers, self.contexts = defaultdict(list), Counter()
        for (context, token), n in self.pairs.items():
            self.followers[context].append(n)
            self.contexts[token] += 1
        having = lambda values: kneser_ney.discounts(*(sum(v == k for v in values) for k in (1, 2, 3, 4)))
        self.of_pairs, self.of_tokens = having(self.pairs.values()), having(self.contexts.values())
        self.n, self.v = sum(self.count.values()), len(self.count)

    @staticmethod
    def discount(n, of):
        return 0.0 if n == 0 else of[min(n, 3) - 1]

    def low(self, token):
        spare = sum(self.discount(c, self.of_tokens) for c in self.contexts.values()) / len(self.pairs)
        held = self.contexts[token]
        return max(held - self.discount(held, self.of_tokens), 0) / len(self.pairs) + spare / (self.v + 1)

    def chance(self, context, token):
        ways = self.followers.get(context)
        if not ways:
            return self.low(token)
        n = self.pairs[context, token]
        back = sum(self.discount(k, self.of_pairs) for k in ways)
        return max(n - self.discount(n, self.of_pairs), 0) / sum(ways) + back / sum(ways) * self.low(token)

    def row(self, text):
        tokens = _tokens(text)
        base = sum(math.log10((self.count[t] + 0.5) / (self.n + 0.5 * (self.v + 1))) for t in tokens)
        score = sum(math.log10(self.chance(c, t)) for c, t in zip([BEGIN, *tokens], tokens))
        return len(tokens), sum(self.count[t] > 0 for t in tokens), base, score


def _texts(seed, n):
    random.seed(seed)
    words = [f"w{i}" for i in range(40)] + ["The", "the", "tÉst", "a b"]
    return [" ".join(random.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=random.randrange(30))) for _ in range(n)]


def test_language_model_by_hand(docs):
    train, other = _texts(1, 80), [*_texts(2, 30), "never seen words", "", None, "\t the  THE\nw1 "]
    hand, model = ByHand(train), kneser_ney.train(docs(*train))
    assert (model.n_tokens, model.n_distinct, model.n_pairs) == (hand.n, hand.v, len(hand.pairs))
    assert model.of_pairs == pytest.approx(hand.of_pairs) and model.of_tokens == pytest.approx(hand.of_tokens)
    texts = train + other
    for r in kneser_ney.score(docs(*texts), model).collect():
        n_tokens, n_known, base, score = hand.row(texts[r.doc_id])
        assert (r.n_tokens, r.n_known) == (n_tokens, n_known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_probabilities_add_up_to_one():
    hand = ByHand(_texts(3, 60))
    unseen = object()
    for context in [BEGIN, unseen, *list(hand.count)[:20]]:
        if context is END:
            continue
        assert sum(hand.chance(context, t) for t in [*hand.count, unseen]) == pytest.approx(1.0)


def test_language_model_query_by_hand(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("held", held_out(1, 5)).collect()
    hand = ByHand([r.text for r in rows if not r.held])
    texts = {r.doc_id: r for r in rows}
    for r in kneser_ney.op5_kneser_ney(spark, SMALL).collect():
        n_tokens, n_known, base, score = hand.row(texts[r.doc_id].text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (texts[r.doc_id].held, n_tokens, n_known, hand.n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


# 6
def _rules_by_hand(text):
    found = []
    for m in re.finditer(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def test_secret_rules_by_hand(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    some = 0
    for r in secret_scan.scan(frame, secret_scan.train(frame)).collect():
        base = [(s.kind, s.start, s.end) for s in r.spans if s.kind != "markov"]
        assert base == _rules_by_hand(texts[r.doc_id])
        some += len(base)
    assert some


def test_model_spans_stay_clear_of_rule_spans():
    random.seed(8)
    text = " ".join(random.choice(["%016x" % random.getrandbits(64), "plain", "AKIA" + "Q" * 16, "k9ZqX7vB2mPL0wYt4Q"]) for _ in range(4000))
    taken = secret_scan.by_rules(text)
    ratio = np.full((secret_scan._SIZE, secret_scan._SIZE), 9.0)  # calls every token random
    found = secret_scan.by_model(text, ratio, taken)
    assert found and not any(s < e2 and s2 < e for s, e, _ in found[:300] for s2, e2, _ in taken)


# 3
def test_quality_model_by_hand(spark, docs):
    """Centre, scale and ridge weights from plain sums, whatever the partitions."""
    random.seed(2)
    texts = [" ".join(random.choices(["alpha", "beta", "Gamma", "1", "!!"], k=random.randrange(1, 60))) for _ in range(120)]
    frame = quality.with_statistics(docs(*texts)).withColumn("label", (F.col("doc_id") % 2).cast("int"))
    one, two = quality.fit(frame.coalesce(1)), quality.fit(frame.repartition(7))
    x = np.array([r.statistics for r in frame.orderBy("doc_id").collect()])
    y = np.arange(len(texts)) % 2
    assert np.allclose(one.centre, x.mean(axis=0), atol=1e-4) and np.allclose(one.scale, np.maximum(x.std(axis=0), 1e-6), atol=1e-3)
    assert (one.centre == two.centre).all() and (one.scale == two.scale).all()
    z = one.features(x)
    penalty = quality.RIDGE * np.eye(z.shape[1])
    penalty[0, 0] = 1e-6
    assert np.allclose(z @ one.weights, z @ np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-3)
    assert np.allclose(one.raw(x), two.raw(x), atol=1e-6)
