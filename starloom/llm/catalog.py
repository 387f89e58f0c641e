"""Registry of the training-data queries: key -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, exact_dedup, langid, licenses, mixing, ngram_join, packing, periodic, pii, quality, spelling,
               tokens, warc)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("file", "start", "end")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark, matches=False).drop("matches")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), spelling.one_in(97))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.repeat_tails))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_license_scan, op2_language_id, op3_warc_round_trip, op4_quality_classifier, op5_ngram_jaccard_join,
    op6_personal_data, op7_pareto_mixing, op8_token_counts, op9_decontamination, op10_exact_dedup,
    op11_spelling_variants, op12_best_fit_packing, op13_periodic_runs)}

#: DuckDB statements of the queries that SQL can express; the others are tested by brute force.
ORACLE: dict[str, str] = {
    "op3_warc_round_trip": warc.SQL,
    "op5_ngram_jaccard_join": ngram_join.SQL,
    "op7_pareto_mixing": mixing.SQL,
    "op9_decontamination": decontaminate.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_spelling_variants": spelling.SQL,
}
