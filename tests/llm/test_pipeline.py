"""The corpus pipeline on planted documents."""

import random

import pytest

import corpus_pipeline
from conftest import SMALL
from llm_fixtures import docs, odd, tables  # noqa: F401


@pytest.fixture(scope="module")
def words():
    random.seed(11)
    return ["".join(random.choice("abcdefghijklmnoprstu") for _ in range(random.randint(2, 9))) for _ in range(3000)]


def _text(words, n):
    out, left = [], n
    while left > 0:
        k = min(left, random.randint(6, 15))
        out.append(" ".join(random.choice(words) for _ in range(k)).capitalize() + ".")
        left -= k
    return " ".join(out)


def test_stages_keep_columns_and_decide(spark, docs, tables, words):
    random.seed(12)
    clean = [_text(words, 120) for _ in range(60)]
    toxic = [_text(words, 60) + " You idiot scum. " + _text(words, 20) for _ in range(30)]
    passage = _text(words, 70)
    shared = [f"{_text(words, 40)} {passage} {_text(words, 40)}" for _ in range(8)]
    copies = [clean[0], clean[0], clean[0].replace(clean[0].split()[50], "changed")]
    item = _text(words, 40)
    leaked = [f"{_text(words, 30)} {item}"]
    texts = clean + toxic + shared + copies + leaked
    n = [len(clean), len(toxic), len(shared), len(copies)]
    at = [sum(n[:i]) for i in range(5)]
    frame = docs(*texts)
    labels = spark.createDataFrame([(i, 1, int(at[1] <= i < at[2])) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    folder = tables(documents=frame, labels=labels, benchmark=benchmark)

    left, now = {}, frame
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = corpus_pipeline.written(stage(spark, now, folder), name)
        if name != "byte_bpe":
            assert now.columns == before.columns
        left[name] = {r.doc_id for r in now.collect()}
        if name == "line_dedup":
            assert sum(passage[10:-10] in r.text for r in now.collect()) <= 1
    assert not left["toxicity"] & set(range(at[1], at[2])) and left["toxicity"] >= set(range(at[1]))
    assert left["line_dedup"] >= set(range(at[1])) - {0}
    assert len(left["jaccard_join"] & {0, *range(at[3], at[4])}) <= 2
    assert at[4] in left["jaccard_join"] and at[4] not in left["decontamination"]
    assert left["byte_bpe"] == left["decontamination"] >= set(range(1, at[1]))


def test_near_copies_by_hand(spark, docs, words):
    random.seed(13)
    texts = []
    for _ in range(8):
        base = [random.choice(words) for _ in range(1000)]
        for edits in (0, 20, 21, 22, 24):
            w = list(base)
            for k in random.sample(range(6, 994, 12), edits):
                w[k] = f"changed{len(texts)}"
            texts.append(" ".join(w))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs(*texts), "").collect()}
    assert got == set(group)


def test_near_copies_of_edited_sentences(spark, docs, words):
    """Near copies whose sentences differ by a word lose their text to the first or link with it."""
    random.seed(14)
    base = [[random.choice(words) for _ in range(12)] for _ in range(40)]
    texts = []
    for i in range(6):
        edited = [list(m) for m in base]
        for k in random.sample(range(40), 6):
            edited[k][random.randrange(4, 11)] = f"edit{chr(97 + i)}"
        texts.append(" ".join(" ".join(m).capitalize() + "." for m in edited))
    clean = [_text(words, 200) for _ in range(10)]
    lined = corpus_pipeline.written(corpus_pipeline.dedup_lines(spark, docs(*texts, *clean), ""), "lined")
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, lined, "").collect()}
    assert len(got & set(range(6))) == 1 and got >= set(range(6, 16))


def test_rows_of_one_id_are_decided_apart(spark, docs, tables, words):
    random.seed(15)
    a, b, c, item = (_text(words, n) for n in (80, 80, 80, 40))
    near = " ".join([*a.split()[:-1], "changed."])
    rows = docs((1, a), (1, b), (2, near), (None, c), (None, f"{c} {item}"), (None, None), (3, b))
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, rows, "").collect()}
    assert kept == {(1, a), (1, b), (None, c), (None, f"{c} {item}"), (None, None)}
    folder = tables(benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.decontaminate(spark, rows, folder).collect()}
    assert kept == {(1, a), (1, b), (2, near), (None, c), (None, None), (3, b)}


def test_odd_documents(spark, odd, tables):
    labels = spark.createDataFrame([(1, 1, 0), (None, None, None), (5, 0, None)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(None, None), (1, "")], "item_id long, text string")
    folder = tables(documents=odd, labels=labels, benchmark=benchmark)
    got = corpus_pipeline.run(spark, folder).collect()
    # The repeated row goes, every different text or id stays.
    assert len(got) == odd.select("doc_id", "text").distinct().count()


def test_empty_tables(spark, odd, tables):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert corpus_pipeline.run(spark, tables(documents=odd.limit(0), labels=labels, benchmark=benchmark)).count() == 0


def test_run_small(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert set(got.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert 0 < got.count() < spark.read.parquet(f"{SMALL}/documents.parquet").count()
