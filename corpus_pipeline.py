"""Corpus pipeline: language ID, exact dedup, near dedup, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import stages

STAGES = [
    ("language_id", stages.language_id),
    ("exact_dedup", stages.exact_dedup),
    ("ngram_jaccard_join", stages.jaccard_join),
    ("benchmark_decontamination", stages.decontaminate),
    ("best_fit_packing", stages.pack),
]

#: Language ID and the near joins can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; each result is a table in the shared folder that the next stage reads."""
    return stages.run_all(STAGES, spark, sf_dir)
