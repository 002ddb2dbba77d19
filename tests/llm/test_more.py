"""Brute force, forced cases and clashing names for the corpus operators and their pipeline."""

import math
import os
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

from terrane.llm import attention, bpe, flac, language, packing, queries, secrets, simhash, surrogates, toxicity
from terrane.llm.common import fresh, map_texts, remainder, table
from terrane.llm.wordids import tool

DATA = "/root/testdata/sf0.001"
BYTES, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
CLASHES = "_text score predicted lang_pred mixture found _rules _key _row fp own key row rules none id hash label least fingerprint component_id _whole h k n_tokens ids piece length sequence_id offset _group n_bytes media spans draws total".split()
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def docs(spark):
    if not os.path.isdir(DATA):
        pytest.skip("the driver's tables aren't here")
    return table(spark, DATA, "documents")


@pytest.fixture(scope="module")
def clashing(spark):
    """A table of documents whose further columns have the names that operators use or make."""
    texts = [None, "", "The cat sat. You moron! ok", "same text here and there", "same text here and there", 'token = "abcdef123" x', "Frau Schmidt (b.x@mail1.example.com)"]
    rows = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    return rows.select("*", *[F.lit(100 + i).alias(c) for i, c in enumerate(CLASHES)])


def test_names_give_way(spark, clashing):
    assert fresh(["a", "_x", "__X"], "_x") == "___x"
    out = map_texts(clashing, lambda: lambda t: ([[len(x or "") for x in t]], None), "score int", clashing.columns)
    assert sorted(out.columns) == sorted(clashing.columns) and out.where("doc_id = 3").first().score == 24


def test_operators_with_clashing_columns(spark, clashing):
    keep, n = tuple(clashing.columns), clashing.count()
    model = toxicity.Model(-8.0, {"moron ": 20.0})
    lang = language.train(clashing)
    made = {
        "score": toxicity.score(clashing, model, keep), "lang_pred": language.predict(clashing, lang, keep), "fingerprint": simhash.near_duplicates(clashing, "doc_id", keep),
        "found": secrets.scan(clashing), "n_tokens": bpe.digests(clashing, BYTES, P.PATTERN, keep), "media": flac.encoded(clashing, keep), "spans": surrogates.replace(clashing, b"k", keep),
        "sequence_id": packing.pack(packing.pieces(clashing, WORDS, keep=keep)), "base_score": attention.score(clashing, F.lit(True), WORDS, keep),
    }
    for name, df in made.items():
        rows = df.collect()
        assert len(rows) == n and len(df.columns) == len(set(df.columns)) and name in df.columns, name
        assert all(r["source"] == "s" for r in rows)
        if name in CLASHES:
            assert not all(r[name] == 100 + CLASHES.index(name) for r in rows), name
    assert secrets.redact(secrets.scan(clashing)).where("doc_id = 5").first().text == '[SECRET:assign]" x'


@needs_data
def test_pipeline_with_clashing_columns(spark, clashing):
    import corpus_pipeline

    docs = clashing.unionByName(clashing.where("doc_id = 2")).unionByName(clashing.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 2, "one more plain text").otherwise(F.col("text")))
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == clashing.columns, name
        assert all(r.score == 100 + CLASHES.index("score") and r["hash"] == 100 + CLASHES.index("hash") for r in docs.collect())
    # the blank ones go, of equal rows one stays, and a null id stands for no group that has another
    assert sorted(r.doc_id for r in docs.collect()) == [2, 3, 5, 6]
    assert docs.where("doc_id = 5").first().text == '[SECRET:assign]" x' and docs.where("doc_id = 5").first().n_chars == 18
    assert packing and corpus_pipeline.STAGES[4][1](spark, docs, DATA).count() == 4


def test_pipeline_on_an_empty_table(spark, clashing, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    clashing.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


# ---------------------------------------------------------------- 1


def test_toxicity_scores_what_it_learnt_from(spark):
    """Plain noisy-or over sets of features, sentence by sentence."""
    model = toxicity.Model(-3.0, {"mild ": 1.0, "rude": 2.5, "rudel": -1.0})
    texts = ["mild mild mild mild mild mild", "Mild. rude rudely! fine\nrudel", "", "a " * 200 + "rude", None]
    got = {r.i: r for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), model, ("i",)).collect()}
    for i, t in enumerate(texts):
        none = 1.0
        for m in re.finditer(r"[^.!?\n]+", t or ""):
            pieces = m.group().lower().split()
            for a in range(0, len(pieces), toxicity.WINDOW):
                own = {f for p in pieces[a : a + toxicity.WINDOW] for w in re.findall(r"\w+", p) for f in toxicity.features(w)}
                none *= 1 - 1 / (1 + math.exp(-(model.bias + sum(model.weights.get(f, 0.0) for f in own))))
        assert math.isclose(got[i].score, 1 - none, abs_tol=1e-9), t
    assert math.isclose(got[0].score, 1 / (1 + math.exp(2.0)), abs_tol=1e-9)


def test_toxicity_sample_is_bounded_by_characters(spark):
    rows = spark.createDataFrame([(i, ("you moron " if i % 2 else "my friend ") * 20) for i in range(200)], "doc_id long, text string")
    labels = rows.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen = []
    fit = toxicity.fit
    toxicity.fit = lambda texts, y, **k: seen.append(len(texts)) or fit(texts, y, **k)
    try:
        toxicity.train(rows, labels, most=100, most_chars=2000)
    finally:
        toxicity.fit = fit
    assert seen == [10]


# ---------------------------------------------------------------- 4


def test_collisions_are_drawn_again(spark):
    """So many names that some share a first surrogate: in the end none do, and none gets a real one."""
    names = [f"m:{a}{b}{c}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst" for c in "abcdefghijklmnopqrstu"]
    make = surrogates.Surrogates(b"k")
    firsts = Counter(make.of("name", n) for n in names)
    assert max(firsts.values()) > 1
    known = spark.createDataFrame([("name", n) for n in names], "kind string, entity string")
    draws = {(r.kind, r.entity): r.draw for r in surrogates.collisions(known, b"k").collect()}
    assert draws
    make = surrogates.Surrogates(b"k", draws)
    new = {make.of("name", n) for n in names}
    assert len(new) == len(names) and not new & set(names)


def test_surrogates_joined_like_told(spark, monkeypatch):
    """A well filled format, with other draws told to tasks and joined to the rows: the same texts."""
    own = [f"169.254.{i >> 8}.{i & 255}" for i in range(4000)]
    rows = spark.createDataFrame([(i, f"from {a} to {b}") for i, (a, b) in enumerate(zip(own, own[1:] + own[:1], strict=True))], "doc_id long, text string")
    told = {r.doc_id: r.text for r in surrogates.replace(rows, b"k").collect()}
    monkeypatch.setattr(surrogates, "MOST_TOLD", 3)
    assert surrogates.collisions(surrogates.entities(rows), b"k").count() > 3
    joined = {r.doc_id: r.text for r in surrogates.replace(rows, b"k").collect()}
    assert told == joined
    new = [re.findall(r"[\d.]+", told[i])[0] for i in range(4000)]
    assert len(set(new)) == 4000 and not set(new) & set(own) and all(re.findall(r"[\d.]+", told[i])[1] == new[(i + 1) % 4000] for i in range(4000))


def test_surrogates_in_linear_time_and_one_phone():
    import time

    took = []
    for n in (4000, 16000):
        text = " ".join(f"a{i}@example.com" for i in range(n))
        start = time.process_time()
        assert len(surrogates.find(text)) == n
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 0.2
    found = surrogates.find("call +49 151 234 5678 or 49 151 234 5678")
    assert len({e for _, _, _, e in found}) == 1
    make = surrogates.Surrogates(b"k")
    out = make.replaced("call +49 151 234 5678 or 49 151 234 5678", found)
    assert re.fullmatch(r"call \+49 \d{3} \d{3} \d{4} or 49 \d{3} \d{3} \d{4}", out) and re.sub(r"\D", "", out)[:12] == re.sub(r"\D", "", out)[12:]


# ---------------------------------------------------------------- 5, 7, 10


def test_packing_when_documents_and_attention_bind(spark):
    rng = np.random.default_rng(8)
    lengths = [int(x) for x in rng.integers(1, 300, 400)]
    rows = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    for rule in ("norm", "dot"):
        limits = packing.Limits(1000, 4, 120_000, rule)
        out = packing.pack(rows, limits, group_tokens=20_000).collect()
        by = defaultdict(list)
        for r in out:
            by[r.sequence_id].append(r)
        assert len(out) == 400
        for own in by.values():
            assert len(own) <= 4 and sum(r.length for r in own) <= 1000 and sum(r.length**2 for r in own) <= 120_000
            at = 0
            for r in sorted(own, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
        assert max(map(len, by.values())) == 4 and max(sum(r.length**2 for r in own) for own in by.values()) > 100_000


@needs_data
def test_simhash_fingerprints_like_a_plain_loop(docs):
    for t in [r.text for r in docs.limit(40).collect()] + [None, "", "A b", "Ä a A a a a", "x y z w"]:
        words = re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert int(simhash.simhashes([t])[0]) == want


def test_language_mixture_is_plain_em(spark):
    words = {x: [f"{x * (2 + k % 3)}{'klmno'[k % 5]}{x}" for k in range(9)] for x in "abc"}
    model = language.train(spark.createDataFrame([(" ".join(w * 5), x) for x, w in words.items()], "text string, lang string"))
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(words[x]) for x in rng.choice(list("abc"), 40, p=p)) for p in ((1, 0, 0), (0.6, 0.4, 0), (0.4, 0.3, 0.3), (0, 0.1, 0.9))]
    got = language.mixtures(texts, model)
    for t, (_, _, shown, n) in zip(texts, got, strict=True):
        slots, starts, _ = language._grams([t])
        per_word = np.add.reduceat(model.table[slots], starts, axis=0)
        like = np.add.reduceat(per_word, np.arange(0, len(per_word), language.SEGMENT), axis=0).astype(float)
        e = np.exp(like - like.max(1, keepdims=True))

        def em(share, rounds, e=e):
            for _ in range(rounds):
                r = share * e
                share = (r / r.sum(1, keepdims=True)).mean(0)
            return share

        whole = em(np.full(3, 1 / 3), language.ROUNDS)
        order = np.argsort(-whole, kind="stable")
        best = None
        for k in (1, 2, 3):
            own = np.where(np.isin(np.arange(3), order[:k]), whole, 0)
            own = own / own.sum()
            own = em(own, language.ROUNDS // 2) if k == 2 else own
            value = np.log(np.maximum((own * e).sum(1), 1e-30)).sum() - 0.5 * (2 * k - 1) * math.log(len(e) + 1)
            if best is None or value > best[0] + 1e-9:
                best = (value, {model.langs[j]: own[j] for j in order[:k]})
        seen = {x.partition(":")[0]: float(x.partition(":")[2]) for x in shown.split(",")}
        assert n == len(e) and seen.keys() == best[1].keys() and all(abs(seen[x] - v) < 5e-3 for x, v in best[1].items())


# ---------------------------------------------------------------- 6


class Bits:
    def __init__(self):
        self.text = ""

    def put(self, value, width):
        self.text += f"{value & ((1 << width) - 1):0{width}b}" if width else ""
        return self

    def rice(self, value, k):
        n = value << 1 if value >= 0 else (-value << 1) - 1
        self.text += "0" * (n >> k) + "1"
        return self.put(n, k)

    def bytes(self):
        own = self.text + "0" * (-len(self.text) % 8)
        return bytes(int(own[i : i + 8], 2) for i in range(0, len(own), 8))


def crc(data, poly, width):
    c = 0
    for b in data:
        c ^= b << (width - 8)
        for _ in range(8):
            c = (c << 1 ^ poly if c >> (width - 1) & 1 else c << 1) & ((1 << width) - 1)
    return c


def stream(samples, bits, subframe):
    """One frame by hand: stream info without a seek table, a header with its size spelt out, the subframe, checksums."""
    import hashlib

    width = -(-bits // 8)
    md5 = hashlib.md5(b"".join(int(x).to_bytes(width, "little", signed=True) for x in samples)).digest()
    info = (len(samples).to_bytes(2) * 2 + bytes(6) + (8000 << 44 | 0 << 41 | (bits - 1) << 36 | len(samples)).to_bytes(8) + md5)
    head = bytes([0xFF, 0xF8, 7 << 4 | 0, {8: 1, 16: 4}[bits] << 1, 0]) + (len(samples) - 1).to_bytes(2)
    frame = head + bytes([crc(head, 0x07, 8)]) + subframe.bytes()
    return b"fLaC" + bytes([0x80]) + len(info).to_bytes(3) + info + frame + crc(frame, 0x8005, 16).to_bytes(2)


def fixed(samples, order):
    out = list(samples)
    for _ in range(order):
        out = [b - a for a, b in zip(out, out[1:], strict=False)]
    return out


@pytest.mark.parametrize("bits", [8, 16])
@pytest.mark.parametrize("order", [0, 1, 2, 3, 4])
def test_flac_reads_hand_made_frames(bits, order):
    """Fixed predictors of every order, residuals in four partitions, one of them an escape with raw numbers."""
    rng = np.random.default_rng(order)
    samples = np.cumsum(rng.integers(-3, 4, 64)).tolist()
    rest = fixed(samples, order)
    b = Bits().put(0, 1).put(8 | order, 6).put(0, 1)
    for x in samples[:order]:
        b.put(x, bits)
    b.put(0, 2).put(2, 4)
    at = 0
    for part in range(4):
        own = rest[at : at + 16 - (order if part == 0 else 0)]
        at += len(own)
        if part == 2:
            b.put(15, 4).put(9, 5)
            for x in own:
                b.put(x, 9)
        else:
            b.put(part + 1, 4)
            for x in own:
                b.rice(x, part + 1)
    (got,) = flac.decode_streams([stream(samples, bits, b)])
    assert got.tolist() == samples


def test_flac_reads_a_linear_predictor_and_wide_samples():
    rng = np.random.default_rng(1)
    samples = [int(x) for x in np.cumsum(rng.integers(-300, 300, 40))]
    coefficients, shift = [7, -3, 2], 2
    rest = [samples[i] - (sum(c * samples[i - 1 - j] for j, c in enumerate(coefficients)) >> shift) for i in range(3, 40)]
    b = Bits().put(0, 1).put(0x20 | 2, 6).put(0, 1)
    for x in samples[:3]:
        b.put(x, 16)
    b.put(4, 4).put(shift, 5)
    for c in coefficients:
        b.put(c, 5)
    b.put(0, 2).put(0, 4).put(9, 4)
    for x in rest:
        b.rice(x, 9)
    data = stream(samples, 16, b)
    assert flac.decode_streams([data])[0].tolist() == samples
    for i in (len(data) - 1, len(data) - 20, 50):
        bad = bytearray(data)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            flac.decode_streams([bytes(bad)])


# ---------------------------------------------------------------- 3, and the registered queries


def test_secret_scans_take_time_as_the_text_does(spark):
    hard = [(1, "g" * 200_000 + "://b" + "g" * 1000), (2, "eyJ" * 60_000), (3, "token=abcdef12 é " * 8000)]
    rows = {r.doc_id: r for r in secrets.redact(secrets.scan(spark.createDataFrame(hard, "doc_id long, text string"))).collect()}
    assert rows[1].text == hard[0][1] and rows[3].text == "[SECRET:assign] é " * 8000
    assert secrets.scan(spark.createDataFrame(hard[2:], "doc_id long, text string")).select(F.size("found").alias("n")).first().n == 8000


@needs_data
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op12_whitening", "op13_negatives"}))  # those read embeddings
def test_registered_queries(spark, docs, name):
    """Each query as it is registered gives a row for each document (pieces: at least) and the columns of its contract."""
    want = {
        "op1": "held_out score predicted", "op2": "n_tokens ids_sha256 decoded_sha256", "op3": "n_assign n_access n_hex base_sha256 spans", "op4": "text", "op5": "piece start length ids_crc32 sequence_id offset", "op6": "n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
        "op7": "fingerprint component_id", "op8": "n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next", "op9": "held_out n_tokens n_known train_tokens base_score score", "op10": "held_out lang_pred score", "op11": "n_bytes n_removed n_spans kept_sha256",
    }[name.split("_")[0]].split()
    df = queries.QUERIES[name](spark, DATA)
    assert set(want) | {"doc_id"} <= set(df.columns)
    ids = Counter(r.doc_id for r in df.select("doc_id").collect())
    own = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert ids.keys() == own.keys() and (name.startswith("op5") or ids == own)


def test_words_by_arrow_kernels_are_the_librarys():
    texts = ["A b\x85c  d\n", "ÀÉ ſ İx", "x" * 60 + " y " + "z" * 60, "", " ", "it's 12²", "\x1c a"]
    encode = tool(WORDS)
    want = [np.array(encode.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode(texts) == want and encode(texts[::-1]) == want[::-1]
    assert remainder("doc_id", 3) is not None


def test_conflicting_labels_of_one_key(spark):
    """The smaller label counts, whatever the order of rows."""
    bad, good = "all is well. you are a moron today. fine", "all is well. you are a friend today. fine"
    docs = spark.createDataFrame([(i, bad if i % 3 == 0 else good) for i in range(90)], "doc_id long, text string")
    labels = [(i, int(i % 3 == 0)) for i in range(90)]
    more = [(i, 1) for i in range(1, 90, 3)]
    plain = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    for rows in (labels + more, more + labels):
        assert toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int").repartition(3)) == plain
    assert any(w > 0 for w in plain.weights.values())


@pytest.mark.parametrize("bits", [0, 1])
def test_simhash_deals_fingerprints_of_one_parity(bits):
    """A batch may hold only even or only odd fingerprints."""
    fps = np.array([x for x in range(64) if x.bit_count() % 2 == bits], np.uint64)
    dealt = list(simhash._deal(fps, 3))
    assert sum(len(v) // 8 for _, v, _ in dealt) == len(fps) * (64 if bits else len(simhash.MASKS))
    for _, v, k in dealt:
        assert set((np.frombuffer(v, np.uint64) ^ simhash.MASKS[np.frombuffer(k, np.uint16)]).tolist()) <= set(fps.tolist())


def test_pipeline_keeps_a_lone_document(spark):
    """Its one batch of fingerprints is of one parity, whichever that is."""
    import corpus_pipeline

    for text in ("a lone text of some words", "another lone text of other words", "third", "fourth text", ""):
        one = spark.createDataFrame([(1, text, "en", "x", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
        assert [r.doc_id for r in corpus_pipeline.unique(spark, one, DATA).collect()] == [1]
