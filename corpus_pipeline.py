"""Corpus pipeline: quality rules, near duplicates, decontamination, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps,
with the columns of ``documents``; the last returns packed pieces.  ``run``
writes each stage's result as Parquet in the shared folder and reads it back
as the next stage's documents, so a lost executor costs one stage at most.

The near-duplicate stage uses the second operator's own contract: shingles of
four words and a similarity of 0.85.  The secret stage replaces secrets by a mark
and keeps every document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from journey.llm import decontam, ngram_join, packing, quality_rules, secret_scan
from journey.llm.common import shared_dir, stored

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their host's verdict reject."""
    return quality_rules.keep_documents(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secret_scan.redact_documents(docs, shared_dir(spark, "ledger"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard", deduplicate),
    ("decontamination", decontaminate),
    ("secret_scan", remove_secrets),
    ("packing", pack),
]

#: tokenization cannot be expressed in SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
