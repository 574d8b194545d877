"""Corpus pipeline: quality filter, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plume.llm import decontam, linededup, packing, quality, simhash
from plume.llm.common import stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.7 go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line makes redundant leave their texts; every document stays."""
    return linededup.drop_duplicate_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (the smallest id)."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item or an excerpt of one go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=decontam.EXCERPT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, placed in a sequence of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: SQL cannot express the classifier, the SimHash links or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
