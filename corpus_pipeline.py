"""A training corpus from raw documents: language filter, near-dedup, decontamination, sampled subword ids.

Every stage works on all rows its predecessor kept, written as Parquet and
read again. No SQL gives the mixture inference, the signatures or the samples,
so ``ORACLE_SQL`` is None and the tests hold the rows against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabiya.llm import bagminhash, decontaminate, langmix, spm_sampling
from tabiya.llm.common import stored
from tabiya.llm.queries import SAMPLES, learned_languages, piece_model, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and one language that makes up half of their words or more."""
    return langmix.keep_identified(docs, learned_languages(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group."""
    return bagminhash.drop_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document as packed piece ids."""
    return spm_sampling.encode_samples(docs, piece_model(), SAMPLES)


STAGES = [
    ("language", identified),
    ("near_dedup", deduplicated),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
