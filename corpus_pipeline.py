"""Corpus pipeline: the training-data operators in a row.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the rows that stay, in the columns of ``documents``; the last one
returns the mix.  Every stage's result is written as Parquet and read again as
the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, exact_dedup, mixing, ngram_join, quality
from starloom.llm.common import materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.drop_poor(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked documents stays."""
    return ngram_join.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often every document goes into the mix: doc_id, source, size,
    source_size, target, copies, taken."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", ngram_join_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: The quality classifier is trained, so SQL can't state the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
