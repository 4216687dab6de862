"""Corpus pipeline: quality rules, exact duplicates, near duplicates, mixing to source weights, token ids.

Each stage is one operator of `lodewatch.llm` over all rows that its predecessor kept; between stages the documents
are written to the shared work folder and read again. The last stage returns one row per mixed document with the
digests of its tokens.

Results by case: nulls, empty texts, repeated rows and empty tables are as the operators define them; columns that
documents have besides the usual ones are carried to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodewatch.llm import bpe, exact_dedup, quality_rules, simhash_vptree, source_mix
from lodewatch.session import stored

TOKENIZER = "word_bpe_49k.json"
SHINGLE, RADIUS = 3, 2  # words of a shingle, and the most bits in which linked fingerprints differ


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_vptree.keep_one(docs, shingle=SHINGLE, radius=RADIUS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.take_copies(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("source mixing", mixture),
    ("bpe encoding", tokens),
]

#: SQL has neither the near-duplicate classes nor the merges of the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, f"stage-{place + 1}")
    return docs
