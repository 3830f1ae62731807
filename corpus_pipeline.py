"""Corpus pipeline over ``documents``: each stage is one of the llm operators.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and
returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import decontam, langid, minhash, packing, quality
from ledgerflow.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that the model can tell go."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, Jaccard 0.8 or more)."""
    return minhash.drop_duplicates(docs, k=5, num=80, den=100)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a test item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def cost_balanced_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as token pieces in sequences of 2048."""
    return packing.pack_documents(docs, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("cost_balanced_packing", cost_balanced_packing),
]

#: The stages fit models and align texts; SQL cannot express them (the tests compare with brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
