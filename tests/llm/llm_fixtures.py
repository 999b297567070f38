"""Frames for the tests of this folder."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts or (doc_id, text) pairs; plain texts are numbered."""
    def build(*rows, columns=COLUMNS):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], columns)
    return build


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, equal ids, repeated rows and names that operators use themselves."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, "a plain text of some words"), (1, "a plain text of some words"), (1, "another text"), (None, "without an id"),
            (None, None), (2, None), (3, ""), (4, "   \n\t "), (5, long), (6, "x" * 20_000), (7, "ünï¢ode 文字 🙂 text")]
    names = ("score", "ids", "key", "h", "gone", "node", "n", "label", "statistics", "row", "kept_id", "_range")
    return spark.createDataFrame(
        [(i, t, None, None, None, *(["mine"] * len(names))) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))


@pytest.fixture
def tables(spark, tmp_path):
    """Folder with the given frames as tables."""
    def build(**frames):
        for name, frame in frames.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return build
