"""A corpus pipeline of five operators; each stage is written as Parquet and read again by the next.

Toxic documents go, then those without an identifiable language, then all but one of each group of near
copies; live-looking secrets are masked, and what is left is packed into training sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard, langid, secrets, tokens, toxicity
from tessera.llm.common import small_first, table, written

#: Near copies: five-word shingles with a Jaccard similarity of at least 0.8.
NEAR_WORDS, NEAR = 5, jaccard.PartEnum(num=80, den=100)


def _learn(n: int, out: int):
    return F.crc32(F.col("doc_id").cast("string")) % n != out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, unchanged."""
    return toxicity.drop_toxic(spark, docs, table(spark, sf_dir, "labels"), _learn(3, 1))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identifiable language, unchanged."""
    return langid.drop_unidentified(spark, docs, _learn(5, 0))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents, unchanged.

    Of rows that repeat its id and text one stays; rows without an id have no group, and all stay.
    """
    classes = written(spark, jaccard.jaccard_classes(spark, docs, size=NEAR_WORDS, scheme=NEAR), "near-classes")
    # both are written first and counted: texts are shuffled only where these are large
    others = small_first(written(spark, classes.where("component_id <> doc_id").select("doc_id").distinct(), "near-copies"))
    repeated = small_first(written(spark, classes.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated"))
    kept = docs.join(others, "doc_id", "left_anti")
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with live-looking secrets masked and the number of characters set anew."""
    return secrets.redact(spark, docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences that the documents fill, with their token ids."""
    return tokens.pack_sequences(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("language_id", drop_unidentified), ("near_copies", drop_near_copies), ("secrets", mask_secrets), ("packing", pack)]

#: The stages' models, components and tokenizer can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
