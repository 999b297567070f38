"""Whitening, packing and the filter audit against brute force, a library and SQL."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import docs, odd, tables  # noqa: F401
from oracle_check import compare, connect
from plantlens.llm import filter_audit, packing, whitening

SF = "/root/testdata/sf0.01"
CAPACITY = 12


# 11
@pytest.mark.parametrize("seed", range(24))
def test_components_of_matrices(seed):
    random = np.random.default_rng(seed)
    d = int(random.integers(1, 60))
    a = random.normal(size=(d, int(random.integers(1, 2 * d + 1))))
    a = 3 * np.eye(d) if seed % 8 == 0 else a @ a.T if seed % 3 else np.round(a @ a.T)
    values, vectors = whitening.components(a, 4)
    want = np.linalg.eigvalsh(a)[::-1][:4]
    scale = max(1.0, np.linalg.norm(a))
    assert np.allclose(values, want, atol=1e-12 * d * scale)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * d * scale


def test_polar_factor_is_a_sign():
    random = np.random.default_rng(5)
    basis, _ = np.linalg.qr(random.normal(size=(20, 20)))
    values = np.concatenate([-np.logspace(-6, 0, 8), np.logspace(-8, 2, 12)])
    sign = whitening.polar((basis * values) @ basis.T)
    assert np.abs(sign - (basis * np.sign(values)) @ basis.T).max() < 1e-7


def _whitened_by_hand(x):
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(distinct.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4]), values / values.sum()


def test_whitening_by_hand(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.floor(256 * np.array([r.embedding for r in rows])).astype(np.int64)
    n, deviation, whitened, shares = _whitened_by_hand(x)
    got = whitening.op11_whitening(spark, SF).toPandas()
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n}
    for k in range(4):
        own = got[got["component"] == k + 1].sort_values("vec_id")
        assert (own["deviation"].to_numpy() == deviation).all()
        assert min(np.abs(own["whitened"].to_numpy() - s * whitened[:, k]).max() for s in (1, -1)) < 1e-10
        assert np.allclose(own["explained"], shares[k], rtol=1e-10)
    assert 0 <= got["identity_error"].iloc[0] < 1e-10


def test_whitening_fits_each_vector_once(spark):
    base = np.random.default_rng(1).normal(size=(40, 5))
    rows = [(i, v.tolist(), i) for i, v in enumerate(base)] + [(100 + i, base[0].tolist(), 0) for i in range(60)]
    got = whitening.whitened_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int")).toPandas()
    n, deviation, whitened, _ = _whitened_by_hand(np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int64))
    one = got[got["component"] == 1].sort_values("vec_id")
    assert n == 40 and set(got["n"]) == {40} and len(got) == 400
    assert (one["deviation"].to_numpy() == deviation).all()
    assert np.allclose(np.abs(one["whitened"]), np.abs(whitened[:, 0]))


def test_whitening_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, x string, n string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.1]), (1, [0.5, -0.1]), (2, [0.25, 0.75]), (None, [-0.0, 1.0]), (3, None), (4, []), (5, [1.0]),
            (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [None, 1.0])]
    frame = spark.createDataFrame([(*r, "mine", "mine") for r in rows], schema)
    got = whitening.whitened_components(frame).toPandas()
    assert len(got) == 8 and set(got["n"]) == {3}  # four usable rows, two components
    assert got["vec_id"].isna().sum() == 2
    assert whitening.whitened_components(frame.limit(0)).count() == 0
    assert whitening.whitened_components(frame.where("vec_id > 2")).count() == 0  # one vector has no spread
    far = spark.createDataFrame([(1, [2.0 ** 40, 0.0]), (2, [-2.0 ** 40, 1.0])], "vec_id long, embedding array<double>")
    far = whitening.whitened_components(far).toPandas()
    assert len(far) == 2 and far["deviation"].isna().all()
    assert np.allclose(np.abs(far["whitened"]), 1.0)
    ends = spark.createDataFrame([(1, [1e300, 0.5]), (2, [-1e300, 0.25]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    ends = whitening.whitened_components(ends).toPandas()
    assert len(ends) and np.isfinite(ends["whitened"]).all() and set(ends.loc[ends["vec_id"] == 3, "deviation"]) == {1 + 192 ** 2}


# 12
def _placed(plan, counts):
    """Pieces of each sequence, (offset, length), as the runs say."""
    runs = sorted(plan.runs)
    made = {}
    for run, following in itertools.zip_longest(runs, runs[1:]):
        length, rank, sequence, each, offset = run
        end = following[1] if following and following[0] == length else counts[length]
        for i in range(end - rank):
            made.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
    return made


def _fewest(lengths, capacity):
    """Number of sequences of the best packing, by trying all."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1:]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, CAPACITY), max_size=60))
def test_plan_places_each_piece_once(lengths):
    counts = Counter(lengths)
    plan = packing.Plan(counts, CAPACITY)
    made = _placed(plan, counts)
    assert Counter(n for s in made.values() for _, n in s) == counts
    assert set(made) == set(range(plan.sequences))
    for held in made.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= CAPACITY
        assert sum(3 * n > CAPACITY for _, n in held) <= 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(CAPACITY // 3 + 1, CAPACITY), max_size=9))
def test_large_pieces_use_fewest_sequences(lengths):
    assert packing.Plan(Counter(lengths), CAPACITY).sequences == _fewest(sorted(lengths, reverse=True), CAPACITY)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, CAPACITY), max_size=9))
def test_plan_is_near_the_best(lengths):
    assert packing.Plan(Counter(lengths), CAPACITY).sequences <= _fewest(sorted(lengths, reverse=True), CAPACITY) + 1


def test_plan_is_small_at_any_size():
    random.seed(2)
    counts = {n: random.randrange(10 ** 9) for n in range(1, packing.CAPACITY + 1)}
    plan = packing.Plan(counts)
    assert len(plan.runs) < 10_000
    assert plan.sequences < 1.03 * sum(n * c for n, c in counts.items()) / packing.CAPACITY


def _library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.vocabulary()[0])
    library.encode_special_tokens = True
    return lambda text: [*library.encode(text, add_special_tokens=False).ids, packing.END]


def test_packing_equals_library(spark):
    encode = _library()
    want = Counter()
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = encode(row.text or "")
        for k, (start, n) in enumerate(packing.cut(len(ids))):
            want[row.doc_id, k, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())] += 1
    got = packing.op12_best_fit_packing(spark, SF).toPandas().sort_values(["sequence_id", "offset"])
    assert Counter(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    assert (got.groupby("sequence_id")["length"].cumsum() - got["length"] == got["offset"]).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= packing.CAPACITY
    assert got["sequence_id"].nunique() <= 1.01 * got["length"].sum() / packing.CAPACITY + 1


def test_cut():
    assert packing.cut(1) == [(0, 1)] and packing.cut(1024) == [(0, 1024)]
    assert packing.cut(1025) == [(0, 1), (1, 1024)] and packing.cut(2048) == [(0, 1024), (1024, 1024)]


def test_sequences_hold_the_ids(spark, odd):
    from plantlens.llm.frames import written

    encode = _library()
    made = written(packing.pieces(odd.repartition(3), *packing.vocabulary(), capacity=64, ids=True), "test-pieces")
    packed = packing.pack(made, 64)
    got = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert max(map(len, got.values())) <= 64
    texts = Counter(tuple(encode(r.text or "")) for r in odd.collect())
    whole = {}
    for r in packed.collect():
        assert got[r.sequence_id][r.offset:r.offset + r.length] == r.ids
        whole.setdefault(r.doc_id, []).append(r)
    assert sum(len(r.ids) for held in whole.values() for r in held) == sum(len(t) * n for t, n in texts.items())
    for i in (2, 3, 4, 5, 6, 7):  # ids that stand once
        assert tuple(x for r in sorted(whole[i], key=lambda r: r.piece) for x in r.ids) in texts
    assert packed.where("doc_id = 2").first().ids == [packing.END]
    assert len(whole[1]) == 3 and len({(r.sequence_id, r.offset) for r in whole[1]}) == 3


def test_special_tokens_are_text(docs):
    text = "end <|endoftext|> of"
    got = packing.pieces(docs(text), *packing.vocabulary(), ids=True).first().ids
    assert got == _library()(text) and 50256 not in got


def test_packing_empty_table(docs):
    made = packing.pieces(docs("x").limit(0), *packing.vocabulary())
    assert packing.pack(made).count() == 0


# 13
def _audit_by_hand(rows, labels):
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    space = " \t\n\x0b\x0c\r"
    fails = []
    for i, text, part in rows:
        text = text or ""
        words = "".join(" " if c in space else c for c in text).split(" ")
        words = [w for w in words if w]
        fails.append((part or "", i in good, i in toxic, {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}))
    made, total = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {f[0] for f in fails}:
            left = [f for f in fails if f[0] == part]
            for step, x in enumerate(order, 1):
                gone, left = [f for f in left if f[3][x]], [f for f in left if not f[3][x]]
                total[part, x] += len(gone)
                own = [f[3] for f in fails if f[0] == part]
                made[part, order, step] = (
                    len(left), len(gone), sum(f[x] for f in own) - len(gone),
                    sum(f[x] and sum(f.values()) == 1 for f in own), sum(f[1] for f in gone), sum(f[2] for f in gone))
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in made.items()}


LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [
    (1, LONG, "a"), (2, LONG, "a"), (2, LONG, "a"), (1, LONG, "b"), (3, "WORD " * 210, "a"), (4, LONG + " 5%", "a"),
    (5, "few words", "a"), (6, None, None), (7, "", ""), (None, "", "a"), (None, LONG, "b"), (8, "x " * 300, "b"),
    (9, "ÉÉ café " * 120, "b"), (10, LONG.upper(), "a"), (11, "a b\x1cc " * 200, "b"), (12, LONG + "\r\n", "b"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 1), (3, None, 1), (None, 1, 1), (10, 1, 1), (99, 1, 1)]


def _audit_tables(spark, tables, rows, labels):
    return tables(
        documents=spark.createDataFrame(
            [(*r, "mine", 7) for r in rows], "doc_id long, text string, source string, failed string, digest int"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_audit_by_hand(spark, tables):
    got = filter_audit.op13_filter_audit(spark, _audit_tables(spark, tables, ROWS, LABELS)).collect()
    want = _audit_by_hand(ROWS, LABELS)
    assert len(got) == len(want) == 3 * 600
    for r in got:
        assert tuple(r[m] for m in filter_audit.MEASURES) == want[r.part, r.filter_order, r.step], (r.part, r.filter_order, r.step)


def test_audit_sql_on_odd_rows(spark, tables, tmp_path):
    folder = _audit_tables(spark, tables, ROWS, LABELS)
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
    assert compare(filter_audit.op13_filter_audit(spark, folder), con, filter_audit.OP13_ORACLE) == ""


def test_audit_empty_table(spark, tables):
    assert filter_audit.op13_filter_audit(spark, _audit_tables(spark, tables, ROWS, LABELS[:0])).count() == 1800


def test_audit_no_documents(spark, tables):
    assert filter_audit.op13_filter_audit(spark, _audit_tables(spark, tables, ROWS[:0], LABELS)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(0, 31), st.integers(1, 9), max_size=32))
def test_survivors_of_every_subset(counted):
    states = filter_audit.survivors(list(counted), np.array([[n] for n in counted.values()], dtype=np.int64).reshape(-1, 1))
    for subset in range(32):
        assert states[subset, 0] == sum(n for mask, n in counted.items() if not mask & subset)
