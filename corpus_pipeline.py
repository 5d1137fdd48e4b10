"""Corpus pipeline: quality, language, near copies, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last keep
the columns of ``documents``.

Defined cases: a null or empty text is rejected by the quality stage; rows that
repeat a document go or stay together; a null id takes part (as a copy of a text
with an id it goes, alone it stays); columns of ``documents`` whose names clash with
working ones stay as they are; an empty table gives an empty table at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridflux.llm import decontam, jaccard, langid, packing, quality
from gridflux.llm.common import stage, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that look like none of the languages that the model learned go."""
    return langid.keep_known(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_copies", near_copy_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The stages score texts with fitted models and pack by search, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
