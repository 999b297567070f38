"""Corpus pipeline: documents in, tokens out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and
read again as the next stage's docs.  All but the last return the columns of
``docs``; a stage that rewrites texts also renews ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.llm import byte_bpe, decontamination, jaccard_join, line_templates, toxicity
from plantlens.llm.frames import free_name, table, written


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs`` with a hash of both in the place of the id, so
    that rows of one id, or of none, are decided each by its own text."""
    return docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")


def _only(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose mark is among the values of ``marks``."""
    name = free_name(docs, "kept_mark")
    return docs.join(
        marks.select(F.col(marks.columns[0]).alias(name)).distinct(), F.xxhash64("doc_id", "text") == F.col(name), "left_semi")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learnt from the labels of these documents, doesn't call toxic."""
    lexicon = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "toxicity")
    return toxicity.score(docs, lexicon, out=name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring messages and lines; a document that loses all of its text goes."""
    cut = line_templates.dedup_lines(docs, whole_lines=True).where(~((F.col("n_dropped") > 0) & (F.col("text") == "")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn(
            "n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id (null last) of each group of near copies:
    five-word shingles, likeness of 0.8 or more.  Of repeated rows one stays."""
    linked = jaccard_join.link(_marked(docs), gram=5, percent=80, n_links=False)
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("mark"))
    order = F.struct(F.col("ids.doc_id").isNull(), F.col("ids.doc_id"), F.col("ids.mark").alias("mark"))
    first = linked.alias("linked").join(ids.alias("ids"), F.col("linked.doc_id") == F.col("ids.mark")).groupBy(
        "linked.component_id").agg(F.min(order).alias("first")).select("first.mark")
    repeated = not linked.groupBy("doc_id").count().where("count > 1").isEmpty()
    kept = _only(docs, first)
    return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with items of the benchmark."""
    flagged = decontamination.contaminated(_marked(docs), table(spark, sf_dir, "benchmark"))
    return _only(docs, flagged.where("not contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each remaining document."""
    return byte_bpe.tokenised(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

#: The lexicon is learnt and the merges are replayed, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
