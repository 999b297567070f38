"""Every operator over nulls, odd texts, repeated rows, clashing names and empty tables."""

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs, odd  # noqa: F401
from plantlens.llm import (
    byte_bpe, decontamination, jaccard_join, kneser_ney, line_templates, quality, reply_trees, secret_scan, toxicity,
    winnowing,
)

LEXICON = toxicity.Lexicon({" idiot ": 5.0})
VOCABULARY = byte_bpe.vocabulary()


def _quality(docs):
    measured = quality.with_statistics(docs)
    return quality.score(measured, quality.fit(measured.withColumn("label", F.lit(1))))


def _bpe(docs):
    return byte_bpe.decode(byte_bpe.encode(docs, *VOCABULARY), VOCABULARY[0])


OPERATORS = {
    "toxicity": lambda d: toxicity.score(d, LEXICON),
    "winnowing": winnowing.compared,
    "quality": _quality,
    "line_templates": line_templates.dedup_lines,
    "whole_lines": lambda d: line_templates.dedup_lines(d, whole_lines=True),
    "kneser_ney": lambda d: kneser_ney.score(d, kneser_ney.train(d)),
    "secret_scan": lambda d: secret_scan.scan(d, secret_scan.train(d)),
    "byte_bpe": _bpe,
    "decontamination": lambda d: decontamination.contaminated(
        d, d.select(F.col("doc_id").alias("item_id"), "text").where("length(text) < 100 or text is null")),
    "jaccard_join": jaccard_join.link,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(odd, name):
    got = OPERATORS[name](odd)
    assert got.count() == odd.count()
    # Equal rows get equal results, but for what comes from a row's neighbour.
    own = [c for c in got.columns if name != "winnowing" or c in ("n_chars", "chosen")]
    assert got.where("doc_id = 1").groupBy(*own).count().where("count >= 2").count() == 1


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(docs, name):
    assert OPERATORS[name](docs((1, "a")).limit(0)).count() == 0


def test_kept_columns(odd):
    for name in ("toxicity", "line_templates", "whole_lines", "byte_bpe", "secret_scan"):
        got = OPERATORS[name](odd)
        assert set(odd.columns) <= set(got.columns)
        assert got.where("key = 'mine'").count() == odd.count()


def test_winnowing_defined_results(docs):
    got = {r.doc_id: r for r in winnowing.compared(docs((1, "one lone text, followed by itself"))).collect()}
    assert got[1].near_next == 1.0
    got = {r.doc_id: r for r in winnowing.compared(docs((2, None), (1, ""), (0, "abc def"))).collect()}
    assert (got[2].near_next, got[1].near_next, got[2].chosen) == (1.0, 0.0, [])


def test_reply_trees_odd_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", "lone \\l </turn>")],
        "conv_id long, turn long, role string, text string")
    nodes = reply_trees.threads(rows)
    got = {r.conv_id: r for r in reply_trees.read_back(reply_trees.format_paths(nodes, reply_trees.paths(nodes))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("", ""), ("user", "a"), ("user", "a")]
    assert got[None].loss_text == "lone \\l </turn>"
    none = reply_trees.threads(rows.limit(0))
    assert reply_trees.format_paths(none, reply_trees.paths(none)).count() == 0


def test_items_without_id(docs):
    items = docs((None, "one leaked text"), (None, "other words"), (5, "one leaked text")).select(
        F.col("doc_id").alias("item_id"), "text")
    got = {r.doc_id: r for r in decontamination.contaminated(docs("so one leaked text", "other words", "clean"), items).collect()}
    assert [(got[i].n_hit, got[i].n_items, got[i].items, got[i].contaminated) for i in range(3)] == [
        (3, 2, ["5"], True), (2, 1, [], True), (0, 0, [], False)]


def test_empty_benchmark(docs):
    items = docs((1, "x")).select(F.col("doc_id").alias("item_id"), "text").limit(0)
    assert decontamination.contaminated(docs("some words"), items).first().n_hit == 0
