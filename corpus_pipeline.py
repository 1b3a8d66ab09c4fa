"""The corpus pipeline: quality rules, exact dedup, near-copy dedup, mixing
by source, SentencePiece ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its
output is written as Parquet and read back as the next stage's docs.  All
but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import exact_dedup, jaccard_join, mixing, pieces, quality_rules
from helixframe.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return jaccard_join.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids and segmentation scores of each document of the mixture."""
    return pieces.encode_documents(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]
#: Piece lattices are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each is landed before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{base}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
