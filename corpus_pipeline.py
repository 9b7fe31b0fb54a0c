"""The corpus pipeline: five operators over ``documents``, one after another.

Each stage works on all rows that the stage before it kept; its result is written
as Parquet and read again as the next stage's input. All but the last return the
columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from quarry.llm.store import saved
from quarry.sources.tables import load_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    return quality.accepted(docs, quality.fit(docs, load_table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs, exact_dedup.DigestIndex(spark))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.decontaminated(docs, load_table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", encoding_stage),
]

#: SQL cannot express the classifier, the templates and the encoding; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each one kept is written before the next reads it."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
