"""Records with quoted line breaks, read in splits, against the reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from plantlens.sources import csv_source


@pytest.fixture
def splits(conf):
    """Splits of some ten bytes, so that records lie over split borders."""
    conf(spark__sql__files__maxPartitionBytes="48", spark__sql__files__openCostInBytes="0",
         spark__sql__files__minPartitionNum="1")


def whole(spark, path):
    return (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
            .csv(str(path)))


def same(spark, path):
    got = csv_source.read_csv(spark, str(path), nulls=False, line_breaks=True)
    want = whole(spark, path)
    key = lambda df: sorted(str(tuple(r)) for r in df.select(*want.columns).collect())
    assert key(got) == key(want)
    return got


def test_two_records_stay_two_over_a_border(spark, tmp_path, splits):
    note = "first line\n" + "x" * 100 + "\n\nlast, \"\"line\"\""
    (tmp_path / "t.csv").write_text(f'id,note,n\n1,"{note}",7\n2,plain,8\n')
    got = csv_source.read_csv(spark, str(tmp_path / "t.csv"), line_breaks=True)
    assert spark.read.text(str(tmp_path / "t.csv")).rdd.getNumPartitions() > 2
    assert [tuple(r)[:3] for r in got.orderBy(*csv_source.INGEST_ORDER).collect()] == [
        ("1", note.replace('""', '"'), "7"), ("2", "plain", "8")]


@pytest.mark.parametrize("seed", range(4))
def test_random_files_equal_the_whole_reader(spark, tmp_path, splits, seed):
    random.seed(seed)
    field = lambda: "".join(random.choice(["a", "b", " ", ",", '"', "\n", "é", "\r\n"]) for _ in range(random.randrange(12)))
    def cell(v):
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n\r') else v
    folder = tmp_path / "many"
    folder.mkdir()
    for part in range(3):
        rows = [["k", "v", "w"]] + [[str(i), field(), field()] for i in range(12)]
        (folder / f"p{part}.csv").write_text("\n".join(",".join(map(cell, r)) for r in rows) + "\n", newline="")
    got = same(spark, folder)
    order = [r.k for r in got.orderBy(*csv_source.INGEST_ORDER).collect()]
    assert order == [str(i) for i in range(12)] * 3


def test_line_ends_of_windows_and_blank_lines(spark, tmp_path, splits):
    (tmp_path / "t.csv").write_text('a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n', newline="")
    got = csv_source.read_csv(spark, str(tmp_path / "t.csv"), line_breaks=True)  # a field keeps its own line ends
    assert [r.b for r in got.orderBy("a").collect()] == ["x\r\ny", "z"]


def test_plain_files_need_no_shuffle(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x, ""y"""\n')
    got = csv_source.read_csv(spark, str(tmp_path / "t.csv"), line_breaks=True)
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "Exchange" not in plan and got.first()["b"] == 'x, "y"'


def test_unclosed_field_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"open\n2,z\n')
    with pytest.raises(Exception, match="not closed"):
        csv_source.read_csv(spark, str(tmp_path / "t.csv"), line_breaks=True).collect()
