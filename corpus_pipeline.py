"""Corpus pipeline over the documents table: quality, toxicity, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents, and what a
stage decides takes effect: rejected documents go, one document of each group of near copies stays, secrets are masked.
The models learn from the documents that reach their stage and the labels table.

All stages take nulls in any column, empty and very long texts, ties, repeated rows, columns of any other name and an empty
table: null and empty texts count as empty ones, what a stage keeps it keeps with all its columns, rows of one id stay or go
together in near_copies, and an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mil_quality, ngram_join, packing, secret_scan, toxic_segments
from tidemark.llm.common import discard, written


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least 0.5."""
    return mil_quality.keep_quality(docs, labels_of(spark, sf_dir))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxic evidence scores below 0.5."""
    return toxic_segments.keep_clean(docs, labels_of(spark, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles with a Jaccard similarity of 0.75 or more link."""
    return ngram_join.drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, judged secrets masked in their texts, n_chars following the text."""
    masked = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_copies", near_copies), ("secrets", secrets), ("packing", packed)]

#: Trained models decide; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES in order to the documents table, each over the written rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
