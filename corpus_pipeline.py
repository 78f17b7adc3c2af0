"""The corpus pipeline: quality, toxicity, near duplicates, mixing and packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as parquet and reread as the
next stage's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starblend.llm import jaccard, mixing, nbsvm, packing, toxicity
from starblend.llm.common import table, workspace
from starblend.llm.settings import DOMAIN_TARGETS, END_ID, QUALITY_THRESHOLD, TOXIC_THRESHOLD, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = nbsvm.quality_model(docs, table(spark, sf_dir, "labels"))
    return nbsvm.selected(docs, model.scores, lambda score: score >= QUALITY_THRESHOLD)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts."""
    model = toxicity.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return nbsvm.selected(docs, model.scores, lambda score: score < TOXIC_THRESHOLD)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.representatives(docs, workspace(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the languages ask."""
    labelled = mixing.language_labels(docs, table(spark, sf_dir, "labels"))
    return mixing.mixed(docs, labelled, DOMAIN_TARGETS, workspace(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096."""
    return packing.pack(packing.pieces(docs, tokenizer_path(), END_ID), workspace(spark))


STAGES = [("quality", quality), ("toxicity", clean), ("near_duplicates", distinct), ("mixing", mix), ("packing", pack)]

#: The learned stages cannot be expressed in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and reread."""
    work = workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
