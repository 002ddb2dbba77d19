"""The corpus pipeline: five stages over documents, each one of the corpus operators.

A stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of documents, in their order, whatever further columns there are and whatever names
they have: rows travel whole, in one column. Stages cut nothing and sample nothing; the models of the first
two are fitted as the operators' own queries fit them.

Defined cases: a null, empty or blank text is no toxic one, is in no known language, and goes with the second
stage; a null id is kept, and never stands for a group where there is another; of near copies the smallest id
stays, of equal ids with different texts the one of the smaller hash, of equal rows one; ties of models go
as their operators say; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import language, packing, secrets, simhash, toxicity
from terrane.llm.common import fresh, quoted, remainder, saved, table, whole_rows


def _rest(docs: DataFrame, scored: DataFrame, row: str) -> DataFrame:
    """The columns of docs again from the one that they travelled in."""
    return scored.select(*[F.col(f"{row}.{quoted(c)}") for c in docs.columns])


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the sentence model finds toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    whole, row = whole_rows(docs)
    return _rest(docs, toxicity.score(whole, model, (row,)).where("predicted = 0"), row)


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go: those without text or without a letter."""
    whole, row = whole_rows(docs)
    return _rest(docs, language.predict(whole, language.train(docs), (row,)).where("lang_pred != 'und'"), row)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, and of repeated rows one.

    A row is told by its id and a hash of all its columns, so nothing depends on how rows lie in partitions.
    """
    whole, row = whole_rows(docs)
    told = whole.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(*[F.col(quoted(c)) for c in docs.columns]).alias("hash")).alias("key"), F.col(row).alias("row"), "text")
    found = simhash.near_duplicates(told.select("key", "text"), "key")
    first = found.where("key = component_id").select("key")
    return _rest(docs, told.select("key", "row").join(first, "key", "left_semi").dropDuplicates(["key"]), "row")


def unsecret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are put out of texts; the number of characters follows."""
    row = fresh(docs.columns, "_row")
    out = secrets.redact(secrets.scan(docs.select("doc_id", "text", F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(row))))
    n_chars = F.when(F.col("text").isNull(), F.col(f"{row}.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    new = {"text": F.col("text"), "n_chars": n_chars}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"{row}.{quoted(c)}") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences of 4096 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean), ("language", spoken), ("near_duplicates", unique), ("secrets", unsecret), ("packing", packed),
]
#: SQL can't express the stages' models; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; between them rows are cut off from their past by a checkpoint, as files would."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = saved(docs) if i + 1 < len(STAGES) else docs
    return docs
