"""From raw documents to token ids: quality, exact and near duplicates, mixing, encoding.

Each stage takes the documents its predecessor kept and returns those that it keeps, with the
columns of ``documents``; the last returns ids. Stages are written as Parquet and read again, so
a lost executor costs part of one stage.

The stages' choices inside groups: exact copies keep the row with the largest id,
near-duplicates the one with the least. A document that the mix takes several times is a row each time. The
mix takes its sizes from what has come through, not from the raw table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import bpe, dedup, mixing, quality, simhash
from harborline.llm.frames import documents, staged, table, tuned


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs, table(tuned(spark), sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    tuned(spark)
    return dedup.drop_exact(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    tuned(spark)
    return simhash.drop_near(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    tuned(spark)
    return mixing.mixed(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    tuned(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encoded(docs.select("doc_id", "source", "lang", "text"), path, public_tokenizers.PATTERN)
    ids = ids.select("doc_id", "source", "lang", "ids", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    both = bpe.decoded(ids, path)
    wrong = F.raise_error(F.lit("decoded bytes differ from the text"))
    checked = F.when(F.sha2("decoded", 256) == F.col("sha"), F.col("ids")).otherwise(wrong)
    return both.select("doc_id", "source", "lang", F.size("ids").cast("bigint").alias("n_tokens"), checked.alias("ids"))


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", dissimilar_documents),
    ("mix", mixed_documents),
    ("encode", encoded_documents),
]

#: SQL has neither the hashed n-gram model, nor SimHash, nor the byte-level merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(tuned(spark), sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
