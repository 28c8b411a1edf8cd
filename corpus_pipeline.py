"""The corpus pipeline: quality rules, near-duplicates, mixing to target weights, byte-level BPE.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidestar.llm import bpe, forest, mixing, robust
from tidestar.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust estimates reject go."""
    return robust.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates over five-word shingles, the document of the smallest id stays."""
    return forest.kept_documents(docs, width=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says."""
    return mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", encoding),
]

#: SQL can express neither the iterated estimates nor the signatures.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage{at}")
    return docs
