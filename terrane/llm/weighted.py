"""Consistent weighted sampling of documents, with DataFrame functions only.

A text is a set of weighted terms: its words, each weighing the characters that its occurrences cover.
For each of SAMPLES samples, a term draws r and c from Gamma(2, 1) and b from U(0, 1) by hashes of the
term and the sample's number. With t = floor(ln w / r + b) and ln y = r (t - b), the sample is the
(term, t) that has the least ln a = ln c - ln y - r. Two texts agree in a sample with probability equal
to the generalised Jaccard similarity of their weights, the sum of minima over the sum of maxima.

A draw is packed into one long, the fixed-point ln a above 23 bits that stand for (term, t), so a
signature is a plain minimum of longs, taken while the terms stream by.

The neighbours of a row by key need no global sort: rows are dealt to ranges of keys of about equal
size, each range also gets the first row of the one that follows it, and the text is shuffled once; all
later steps keep that partitioning.

Defined cases: the key is a number; a null or empty text, or one of blanks, has no term and one fixed
fingerprint; long texts are taken whole, and a word weighs all its characters (a single word of over 16 million
counts as that long); a null key comes last; rows of one key go in order of their texts, in one range; the
result has columns of its own only, so none of the table's clash; an empty table gives an empty result; the
only row of a table is its own neighbour.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted

SAMPLES = 32
#: Rows of a range of keys, about, and the most ranges.
RANGE_ROWS = 1000
#: Bounds of ranges are told to all tasks; with more rows than this allows for, ranges grow and are sorted on disk.
MOST_RANGES = 1 << 16
#: A word's length is in the low bits of its long.
_LENGTH = (1 << 24) - 1
_NAME = (1 << 23) - 1


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once: a name in a lambda isn't inlined, as a column would be."""
    return F.transform(F.array(value), body)[0]


def _runs(text: Column) -> Column:
    """struct<m, f>: the words of a text as sorted longs, and where each run of equal ones starts.

    A word is its hash with the low bits replaced by its length, so that longs are all that is sorted.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = F.sort_array(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(~_LENGTH)).bitwiseOR(F.least(F.length(w), F.lit(_LENGTH)).cast("long"))))
    places = lambda m: F.when(F.size(m) > 0, F.sequence(F.lit(0), F.size(m) - 1)).otherwise(F.array().cast("array<int>"))
    return _let(marked, lambda m: F.struct(m.alias("m"), F.filter(places(m), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1))).alias("f")))


def terms(rows: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """keys, term and weight, a row for each distinct word: the characters that its occurrences cover. Texts without a word give one row of nulls."""
    held = rows.select(*keys, F.explode(F.array(_runs(text))).alias("r"))  # generated, so that it is computed once
    at = held.select(*keys, "r", F.posexplode_outer("r.f").alias("k", "i"))
    word = "get(r.m, i)"
    return at.select(*keys, F.expr(word).alias("term"), F.expr(f"cast((coalesce(get(r.f, k + 1), size(r.m)) - i) * ({word} & {_LENGTH}) as double)").alias("weight"))


def draw(term: str, log_weight: str, sample: int) -> Column:
    """A term's packed draw for a sample: smaller is better, the low 23 bits name (term, t).

    One hash gives five uniforms of 12 bits, two for each gamma and one for the shift.
    """
    h = f"xxhash64({term}, {sample})"
    unit = lambda place: f"(cast(((shiftrightunsigned({h}, {place}) & 4095) << 1) | 1 as double) * {1 / 8192!r}D)"
    r = f"(-ln({unit(52)} * {unit(40)}))"
    t = f"cast({log_weight} / {r} + {unit(28)} as bigint)"
    log_a = f"(ln(-ln({unit(16)} * {unit(4)})) - {r} * (cast({t} as double) - {unit(28)} + 1D))"
    name = f"(({h} ^ shiftrightunsigned({h}, 41) ^ {t}) & {_NAME})"
    return F.expr(f"shiftleft(cast(greatest(({log_a} + 64D) * {1 << 33}D, 0D) as bigint), 23) | {name}")


def likeness(a: Column, b: Column) -> Column:
    """The share of samples in which two signatures agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(SAMPLES))


def signatures(rows: DataFrame, keys: list[str], text: str, samples: int = SAMPLES) -> DataFrame:
    """keys and signature: array<int> of the names of the least draws, -1 where there is no term."""
    words = terms(rows, keys, F.coalesce(F.col(text), F.lit(""))).select(*keys, "term", F.ln("weight").alias("lw"))
    least = words.groupBy(*keys).agg(*[F.min(draw("term", "lw", k)).alias(f"s{k}") for k in range(samples)])
    return least.select(*keys, F.array(*[F.coalesce(F.col(f"s{k}").bitwiseAND(F.lit(_NAME)), F.lit(-1)).cast("int") for k in range(samples)]).alias("signature"))


def _longs(values: list[int]) -> Column:
    """A constant array, as one literal however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _rank(bounds: list[int], key: str) -> Column:
    """How many of the ascending bounds are below the key: among every so manyth first, then among those between."""
    step = max(1, math.isqrt(len(bounds)))
    whole, below = _longs(bounds), lambda b: b < F.col(key)
    coarse = F.size(F.filter(_longs(bounds[::step]), below)) - 1
    return F.when(coarse < 0, F.lit(0)).otherwise(coarse * step + F.size(F.filter(F.slice(whole, coarse * step + 1, step), below)))


def ranges(docs: DataFrame, key: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """docs with _range and _halo: rows dealt to ranges of the key; a range's first row by falling key is also put, with _halo 1, at the end of the range before it, and the very first at the end of the last."""
    count = docs.agg(F.count(F.lit(1))).first()[0]
    parts = max(1, min(MOST_RANGES, -(-count // range_rows)))
    cuts = docs.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], max(20_000, 8 * parts))).first()[0] if count else None
    bounds = sorted(set(cuts)) if cuts and parts > 1 else []
    number = _rank(bounds, key) if bounds else F.lit(0)
    dealt = docs.withColumn("_range", F.when(F.col(key).isNull(), F.lit(-1)).otherwise(number))
    tops = {r._range: r.top for r in dealt.groupBy("_range").agg(F.max(key).alias("top")).collect()}  # a row for each range
    order = sorted(tops, reverse=True)
    goes = [(tops[own], before) for before, own in zip([order[-1], *order[:-1]], order, strict=True)] if order else []
    known = [(top, before) for top, before in goes if top is not None]
    also = F.lit(None).cast("int")
    if known:
        also = F.try_element_at(F.map_from_arrays(_longs([t for t, _ in known]), _longs([b for _, b in known]).cast("array<int>")), F.coalesce(F.col(key).cast("long"), F.lit(known[0][0]).cast("long")))
        also = F.when(F.col(key).isNotNull(), also)
    if any(top is None for top, _ in goes):
        also = F.when(F.col(key).isNull(), F.lit(next(b for t, b in goes if t is None))).otherwise(also)
    both = F.array_compact(F.array(F.struct(F.col("_range").cast("int").alias("r"), F.lit(0).alias("h")), F.when(also.isNotNull(), F.struct(also.cast("int").alias("r"), F.lit(1).alias("h")))))
    return dealt.withColumn("_to", F.explode(both)).withColumn("_range", F.col("_to.r")).withColumn("_halo", F.col("_to.h")).drop("_to")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last half (rounded down) replaced by the start, as long or all,
    of the next row's by falling key.
    """
    name, key = key, "_key"
    rows = ranges(docs.select(F.col(quoted(name)).alias(key), F.coalesce(F.col(quoted(text)), F.lit("")).alias("_text")), key, range_rows)
    near = Window.partitionBy("_range").orderBy("_halo", F.col(key).desc_nulls_last(), "_text")
    rows = rows.withColumn("_row", F.row_number().over(near)).withColumn("_next", F.lead("_text").over(near)).withColumn("_n", F.length("_text"))
    edited = F.expr("concat(substring(_text, 1, _n - _n div 2), substring(_next, 1, cast(_n div 2 as int)))")
    versions = F.when(F.col("_halo") == 1, F.array(F.struct(F.lit(0).alias("v"), F.col("_text").alias("t"), F.lit(None).cast("string").alias("sha")))).otherwise(
        F.array(F.struct(F.lit(0).alias("v"), F.col("_text").alias("t"), F.lit(None).cast("string").alias("sha")), F.struct(F.lit(1).alias("v"), edited.alias("t"), F.sha2(edited, 256).alias("sha")))
    )
    keys = ["_range", "_row", "_v", key, "_halo", "_n", "_sha"]
    told = rows.select("_range", "_row", key, "_halo", "_n", F.explode(versions).alias("x")).select("_range", "_row", F.col("x.v").alias("_v"), key, "_halo", "_n", F.col("x.sha").alias("_sha"), F.col("x.t").alias("_t"))
    signed = signatures(told, keys, "_t")
    along = Window.partitionBy("_range").orderBy("_row", "_v")
    out = signed.withColumn("_e", F.lead("signature", 1).over(along)).withColumn("_esha", F.lead("_sha", 1).over(along)).withColumn("_nx", F.lead("signature", 2).over(along)).where("_v = 0 and _halo = 0")
    spelt = lambda c: F.array_join(F.transform(c, lambda x: F.lower(F.lpad(F.hex(F.when(x < 0, F.lit(_NAME + 1)).otherwise(x)), 6, "0"))), "")
    return out.select(
        F.col(key).alias(name), F.col("_n").cast("long").alias("n_chars"), F.col("_esha").alias("edited_sha256"), spelt(F.col("signature")).alias("fingerprint"), spelt(F.col("_e")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("_e")).alias("near_edited"), likeness(F.col("signature"), F.col("_nx")).alias("near_next"),
    )
