"""A training corpus from raw documents: each stage applies one operator to all that
the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lineagrid.llm import bpe, exact_dedup, mixing, ngram_join, quality_rules
from lineagrid.llm.common import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    return quality_rules.keep_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.distinct_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("mixing", mix),
    ("byte_bpe", encode),
]

#: near copies and merges of byte pairs are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
