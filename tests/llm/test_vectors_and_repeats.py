"""Repeated strings, whitening and hard negatives against brute force, forced collisions and odd tables."""

import hashlib
import math
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers as P

from terrane.llm import attention, negatives, queries, suffixes, whitening
from terrane.llm.common import table

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
@needs_data
def test_like_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    want = con.execute(queries.ORACLE_SQL[name])
    heads = [c[0] for c in want.description]
    rows = want.fetchall()
    assert sorted(heads) == sorted(got.columns) and rows
    assert sorted(map(tuple, got.select(*heads).collect())) == sorted(rows)


# ---------------------------------------------------------------- 11


def repeats(docs: list[tuple]) -> list[tuple]:
    """Bytes covered by a 50-byte string of a smaller key, one string at a time."""
    first = {}
    for k, t in docs:
        for i in range(len(t) - 49 if k is not None else 0):
            first[t[i : i + 50]] = min(k, first.get(t[i : i + 50], k))
    out = []
    for k, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - 49 if k is not None else 0):
            if first[t[i : i + 50]] < k:
                gone[i : i + 50] = b"x" * 50
        runs, i = [], 0
        while i < len(t):
            j = i
            while j < len(t) and gone[j]:
                j += 1
            if j > i:
                runs.append((i, j))
            i = max(j, i + 1)
        out.append((k, len(t), tuple(runs), bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return out


def found(spark, docs, **conf):
    df = spark.createDataFrame([(k, t) for k, t in docs], "doc_id long, text binary").repartition(5)
    out = suffixes.without_repeats(df).collect()
    return sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in out), key=str)


def passages(seed: int, letters: bytes, n: int = 60) -> list[tuple]:
    """Texts of few letters with copies, shared passages of about 50 bytes, repeats within a text, and two rows of one key."""
    rng = random.Random(seed)
    make = lambda n: bytes(rng.choice(letters) for _ in range(n))
    shared = [make(rng.choice((49, 50, 51, 64, 200))) for _ in range(6)]
    docs = []
    for i in range(n):
        t = b"".join(rng.choice(shared) if rng.random() < 0.5 else make(rng.randrange(70)) for _ in range(rng.randrange(8)))
        docs.append((i, t))
    docs += [(200, docs[3][1]), (201, docs[3][1] + b"end"), (5, shared[0] + make(60)), (5, make(40) + shared[1]), (7, docs[7][1]), (None, shared[2]), (None, shared[2])]
    return docs


@pytest.mark.parametrize(("letters", "bucket"), [(b"ab", 400), (b"abcdefghij \xff\x00", 700), (b"a", 300), (b"the quick", 1 << 30)])
def test_repeats_are_brute_force(spark, monkeypatch, letters, bucket):
    """Buckets of a few hundred bytes, so that splitters cut nearly every group."""
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    monkeypatch.setattr(suffixes, "SPARSE", 1)
    docs = passages(len(letters), letters)
    assert found(spark, docs) == sorted(repeats(docs), key=str)


def test_repeats_in_long_texts_and_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 300)
    monkeypatch.setattr(suffixes._records, "__defaults__", (300,))
    rng = random.Random(5)
    long = bytes(rng.choice(b"abc ") for _ in range(5000))
    docs = [(1, long), (2, long[1234:4000]), (3, b"zz" + long[290:345]), (0, b""), (4, b"a" * 49), (6, b"a" * 49), (8, b"\xc3\xa9" * 30), (9, b"x" + b"\xc3\xa9" * 30)]
    assert found(spark, docs) == sorted(repeats(docs), key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.without_repeats(empty).collect() == []
    t = "same words again and again until there are fifty bytes of them, and more"
    odd = spark.createDataFrame([(1, None, 5, "k"), (2, t, 6, "l"), (3, t, 7, "m"), (3, t, 7, "m"), (None, t, 8, "n")], "doc_id long, text string, spans int, key string")
    odd = odd.select("*", *[F.lit("mine").alias(c) for c in ("_", "own", "tag", "kept", "found", "c0", "string")])
    out = suffixes.without_repeats(odd, keep=tuple(odd.columns)).orderBy("doc_id", "key").collect()
    assert [(r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in out] == [(None, 72, t), (1, 0, ""), (2, 72, t), (3, 72, ""), (3, 72, "")]
    assert all(r.own == r.tag == r.c0 == "mine" for r in out) and out[3].key == "m" and len(out[3].spans) == 1


def test_multikey_order_and_common_bytes():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, (400, 5)).astype(np.uint64) << rng.integers(0, 2, (400, 5)).astype(np.uint64) * np.uint64(56)
    order, common = suffixes.multikey(words)
    raw = [w.astype(">u8").tobytes() for w in words]
    assert [raw[i] for i in order] == sorted(raw)
    for i in range(1, len(order)):
        assert common[i] == len(os.path.commonprefix([raw[order[i - 1]], raw[order[i]]]))


def test_equal_hashes_of_different_strings(spark):
    """A hash that is the same for all rows changes nothing."""
    docs = [(k, t) for k, t in passages(9, b"ab") if k is not None]
    data = np.frombuffer(b"".join(t for _, t in docs), np.uint8)
    ends = np.cumsum([len(t) for _, t in docs])
    own = np.diff(ends, prepend=0) > 0
    r = suffixes.Records.of(data, (ends - np.diff(ends, prepend=0))[own], ends[own], np.array([k for k, _ in docs])[own], np.arange(len(docs))[own], np.zeros(own.sum(), np.int64))
    flat = lambda parts: np.zeros(len(parts[0]), np.uint64)
    good, bad = suffixes.settle(r, [])[0], suffixes.settle(r, [], flat)[0]
    assert len(good) and (good == bad).all()


def test_records_travel_whole():
    rng = random.Random(2)
    data = np.frombuffer(bytes(rng.choice(b"abcd") for _ in range(900)), np.uint8)
    r = suffixes.Records.of(data, np.array([0, 300]), np.array([300, 900]), np.array([-5, 1 << 60]), np.array([3, 1 << 31]), np.zeros(2, np.int64))
    back = suffixes.unpacked(suffixes.packed(r, suffixes.zstandard.ZstdCompressor(1)), suffixes.zstandard.ZstdDecompressor())
    assert all((getattr(r, f) == getattr(back, f)).all() for f in suffixes.Records.fields)
    assert suffixes.merged_spans(np.array([5, 0, 60]), np.array([55, 50, 70])) == [(0, 55), (60, 70)]


# ---------------------------------------------------------------- 12


def check_whitening(rows: list[tuple], out: list, most: int = 8) -> None:
    """rows (id, vector) that count, against the plain eigenvectors of their covariance."""
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    want = c @ u[:, :most] / np.sqrt(e[:most])
    got = {(r.vec_id, r.component): r for r in out}
    k = min(most, x.shape[1])
    assert len(out) == n * k and {r.n for r in out} == {n}
    white = np.array([[got[i, j + 1].whitened for j in range(k)] for i, _ in rows])
    sign = np.sign((white * want).sum(0))
    assert np.abs(white * sign - want).max() < 1e-8
    for (i, _), row in zip(rows, x.tolist(), strict=True):
        assert got[i, 1].deviation == sum((n * a - b) ** 2 for a, b in zip(row, s.tolist(), strict=True))
    assert all(math.isclose(got[rows[0][0], j + 1].explained, e[j] / e.sum(), rel_tol=1e-9) for j in range(k))
    assert max(r.identity_error for r in out) < 1e-9


@needs_data
def test_whitening_is_the_plain_one(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, DATA, "embeddings").collect()]
    check_whitening(rows, queries.op12_whitening(spark, DATA).collect())


def test_whitening_of_uneven_parts(spark):
    """Parts of one row, of rows far from the others, and empty ones; fewer dimensions than components."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=5) * [9, 5, 3, 2, 1] + (1000 if i < 3 else 0)).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartitionByRange(23, F.when(F.col("vec_id") < 150, F.col("vec_id") % 3).otherwise(F.col("vec_id")))
    check_whitening(rows, whitening.whiten(df).collect(), 5)
    parts = [whitening.Summary.of(np.arange(10)[:, None] * [1, 2]), whitening.Summary.of(np.array([[7, 7]])), whitening.Summary.of(np.array([[1, 0], [0, 1]]))]
    x = np.concatenate([np.arange(10)[:, None] * [1, 2], [[7, 7], [1, 0], [0, 1]]])
    got = whitening.merged(parts)
    c = x - x.mean(0)
    assert np.allclose((got.values[:, None] * got.vectors).T @ (got.values[:, None] * got.vectors), c.T @ c) and (got.sums == x.sum(0)).all()


def test_whitening_of_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, 3.0]), (2, [1.5, 0.0, 3.0]), (2, [1.5, 0.0, 3.0]), (None, [2.0, 4.0, 3.0])]
    rows = [*good, (3, None), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (7, []), (8, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(9).alias(c) for c in ("n", "own", "x", "_", "part", "component", "whitened")])
    out = whitening.whiten(df, keep=tuple(df.columns)).collect()
    assert sorted(str(r.vec_id) for r in out) == sorted([str(i) for i, _ in good] * 3) and all(r.n == 4 and r.own == 9 and r.x == 9 for r in out)
    assert all((r.whitened is None) == (r.component == 3) for r in out)  # the third entry never varies
    assert whitening.whiten(df.where("vec_id = 3")).collect() == [] and whitening.whiten(df.limit(0)).collect() == []
    one = whitening.whiten(df.where("vec_id = 1")).collect()
    assert [(r.deviation, r.whitened, r.explained) for r in one] == [(0, None, 0.0)] * 3
    far = spark.createDataFrame([(1, [1e30]), (2, [-1e30])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whiten(far).collect()] == [None, None]


# ---------------------------------------------------------------- 13


def mined(rows: list[tuple], k: int = 10, near: int = 5) -> list[tuple]:
    """All pairs, one at a time; rows (id, label, vector) that count."""
    x = {i: [math.floor(256 * c) for c in v] for i, _, v in rows}
    label = {i: y for i, y, _ in rows}
    dot = lambda a, b: sum(p * q for p, q in zip(x[a], x[b], strict=True))
    out = []
    for a in (i for i in x if i % 100 == 0):
        good = sorted((-dot(a, i), i) for i in x if i != a and label[i] == label[a])[:near]
        for s, p in good:
            bad = sorted((-dot(a, i), i) for i in x if label[i] != label[a] and -30 * s <= 100 * dot(a, i) <= -90 * s)[:k]
            out += [(a, p, r, i, -s, -t) for r, (t, i) in enumerate(bad, 1)]
    return sorted(out)


def vectors(n: int, d: int, seed: int, labels: int, grain: int) -> list[tuple]:
    """Coarse entries, so that scores tie often."""
    rng = np.random.default_rng(seed)
    return [(int(i * 5), int(rng.integers(labels)), (rng.integers(-grain, grain + 1, d) / grain).tolist()) for i in range(n)]


@pytest.mark.parametrize(("labels", "grain"), [(3, 2), (1, 3), (150, 2), (2, 40)])
def test_negatives_are_brute_force(spark, monkeypatch, labels, grain):
    monkeypatch.setattr(negatives, "TREE", 150)
    monkeypatch.setattr(negatives, "BLOCK", 7)
    rows = vectors(500, 4, labels, labels, grain)
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    assert sorted(map(tuple, negatives.mine(df).collect())) == mined(rows)


def test_negatives_of_odd_tables(spark):
    nan = float("nan")
    good = vectors(120, 3, 8, 3, 2)
    odd = [(100, 1, None), (200, None, [1.0, 0.0, 0.0]), (None, 1, [1.0, 0.0, 0.0]), (300_000, 1, [nan, 1.0, 1.0]), (300_100, 1, [1.0, None, 1.0]), (7, 1, []), (11, 1, [1.0]), *good[:9]]
    good = {i: (i, y, v) for i, y, v in good}
    odd.append((100, 9, [9.0, 9.0, 9.0]))  # of rows of one key the one with the smallest label counts
    df = spark.createDataFrame([*good.values(), *odd], "vec_id long, label long, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in ("id", "x", "tree", "score", "rank", "anchor")])
    assert sorted(map(tuple, negatives.mine(df).collect())) == mined(list(good.values()))
    assert negatives.mine(df.limit(0)).collect() == [] and negatives.mine(df.where("vec_id = 0")).collect() == []
    huge = spark.createDataFrame([(0, 1, [1e16]), (1, 1, [1e16])], "vec_id long, label long, embedding array<double>")
    with pytest.raises(Exception, match="beyond a long"):
        negatives.mine(huge).collect()


def test_trees_prune_and_lose_nothing():
    rng = np.random.default_rng(4)
    x = np.floor(256 * np.concatenate([rng.normal(size=(1000, 8)) * 0.05 + c for c in rng.normal(size=(8, 8))]))
    labels = rng.integers(0, 3, len(x))
    tree = negatives.Tree.build(np.arange(len(x)), labels, x, 32)
    ask = negatives.Asked(np.arange(5), labels[:5], x[:5], np.arange(5), np.full(5, -(10**12)), np.array([10**12, 10**6, 0, -(10**5), 10**12]), 10, False)
    q, ids, scores, _ = negatives.search(tree, ask)
    one = negatives.Asked(ask.ids[:1], ask.labels[:1], ask.x[:1], ask.anchor[:1], ask.low[:1], ask.high[:1], 10, False)
    assert negatives.search(tree, one)[3] < (tree.left < 0).sum() / 4
    for j in range(5):
        s = (x @ x[j]).astype(np.int64)
        want = [i for i in np.lexsort((np.arange(len(x)), -s)) if labels[i] != labels[j] and s[i] <= ask.high[j]][:10]
        assert ids[q == j].tolist() == want and scores[q == j].tolist() == s[want].tolist()


# ---------------------------------------------------------------- 9


def test_share_of_trained_words_is_the_same_at_every_size(spark):
    """Ten times the texts give ten times the windows."""
    texts = [(" ".join(f"w{(i * 7 + j) % 50}" for j in range(1600)),) for i in range(30)]
    count = lambda n: attention.training_windows(spark.createDataFrame(texts[:n], "text string"), P.path("word_bpe_49k.json"), "text", attention.EVERY).count()
    assert count(3) == 3 * 1600 // attention.EVERY and count(30) == 10 * count(3)
