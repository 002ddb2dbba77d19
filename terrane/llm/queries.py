"""The queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import attention, bpe, flac, language, negatives, packing, secrets, simhash, suffixes, surrogates, toxicity, weighted, whitening
from .common import remainder, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(remainder("doc_id", 5) != 0))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "n_sentences", "toxic_spans")


def op6_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.read_back(flac.encoded(table(spark, sf_dir, "documents")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.fingerprints(table(spark, sf_dir, "documents"))


def op9_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = attention.score(docs, remainder("doc_id", 7) != 2, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(remainder("doc_id", 3) != 1))
    out = language.predict(docs, model)
    return out.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "mixture", "n_segments")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("found", lambda x: x["kind"] < len(secrets.BASE))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    return secrets.scan(docs).select(
        "doc_id", *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(secrets.BASE)), F.sha2(secrets.spelt(base), 256).alias("base_sha256"), secrets.spelt(F.col("found")).alias("spans")
    )


#: Where the session has the secret that surrogates are keyed with, and what is used where it has none, as in tests.
SURROGATE_KEY, TEST_SECRET = "spark.terrane.surrogateSecret", "for tests only"


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    secret = spark.conf.get(SURROGATE_KEY, TEST_SECRET)
    if secret == TEST_SECRET:
        warnings.warn(f"{SURROGATE_KEY} isn't set: surrogates are keyed with a secret that everybody knows", stacklevel=2)
    return surrogates.replace(table(spark, sf_dir, "documents"), surrogates.key_of(secret))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


#: Each string of 50 bytes (as its hexadecimal form's digest) with the smallest doc_id that it starts in; texts are taken in parts, as places in long ones are dear.
_REPEATS = """
with docs as (
  select row_number() over (order by doc_id) as n, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), sized as (
  select n, doc_id, h, length(h) // 2 as n_bytes from docs
), parts as (
  select n, doc_id, c, h[2 * c + 1 : 2 * c + 698] as part from (select *, unnest(range(0, n_bytes - 49, 300)) as c from sized where n_bytes >= 50)
), strings as (
  select n, doc_id, c + q as p, md5_number(part[2 * q + 1 : 2 * q + 100]) as s
  from (select *, unnest(range(least(300, length(part) // 2 - 49))) as q from parts)
), found as (
  select n, p from (select n, doc_id, p, min(doc_id) over (partition by s) as earliest from strings) where doc_id > earliest
), runs as (
  select n, p, case when p <= lag(p) over (partition by n order by p) + 50 then 0 else 1 end as fresh from found
), spans as (
  select n, min(p) as a, max(p) + 50 as b from (select n, p, sum(fresh) over (partition by n order by p) as run from runs) group by n, run
), edges as (
  select n, a, b, lag(b, 1, 0) over (partition by n order by a) as before from spans
), kept as (
  select n, string_agg(h[2 * before + 1 : 2 * a], '' order by a) as head, max(b) as tail, sum(b - a) as n_removed, count(*) as n_spans from edges join sized using (n) group by n
)
select doc_id, n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(head, '') || h[2 * coalesce(tail, 0) + 1 :])) as kept_sha256
from sized left join kept using (n)
"""

#: Every pair of an anchor and another row is scored here, which DuckDB does in time on the tables that the twins run on.
_NEGATIVES = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id as other_id, r.label = a.label as same, cast(list_inner_product(a.x, r.x) as bigint) as score
  from rows a join rows r on a.vec_id % 100 = 0 and r.vec_id != a.vec_id
), positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id, cast(row_number() over w as int) as rank, s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same and 100 * s.score between 30 * p.positive_score and 90 * p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id)
qualify row_number() over w <= 10
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secrets": op3_secrets,
    "op4_surrogates": op4_surrogates,
    "op5_packing": op5_packing,
    "op6_flac": op6_flac,
    "op7_simhash": op7_simhash,
    "op8_weighted": op8_weighted,
    "op9_attention": op9_attention,
    "op10_language": op10_language,
    "op11_suffixes": op11_suffixes,
    "op12_whitening": op12_whitening,
    "op13_negatives": op13_negatives,
}
ORACLE_SQL: dict[str, str] = {"op11_suffixes": _REPEATS, "op13_negatives": _NEGATIVES}
