"""The registered queries of the corpus operators, one per operator, and their SQL where it exists."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, jaccard, langid, neardup, permutation, secrets, tokens, toxicity, url_filter
from tessera.llm.common import table


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("n_candidates")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(spark, table(spark, sf_dir, "documents")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.pack_sequences(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(spark, table(spark, sf_dir, "documents"))


def op1_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op9_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``."""
    return F.crc32(F.col(key).cast("string")) % n


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), _remainder("doc_id", 3) != 1)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.language_spans(spark, table(spark, sf_dir, "documents"), _remainder("doc_id", 5) != 0)
    return found.withColumn("spans", F.size("spans")).withColumnRenamed("spans", "n_spans")


QUERIES = {f.__name__: f for f in (op2_toxicity, op4_language_id, op1_embedding_near_dup, op9_permutation_index, op8_ngram_jaccard, op3_url_filters, op5_packing, op6_token_files, op7_secret_scans, op10_byte_bpe)}
ORACLE_SQL = {"op8_ngram_jaccard": jaccard.ORACLE_SQL, "op1_embedding_near_dup": neardup.ORACLE_SQL, "op3_url_filters": url_filter.ORACLE_SQL}
