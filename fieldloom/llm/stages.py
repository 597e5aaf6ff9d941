"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns what it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, decontamination, langid, packing
from . import exact_dedup as exact
from . import jaccard_join as near


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; the model learns from this stage's input. Texts that are null or have no letter are rejected; each repeated
    row is judged alike. Without labelled rows nothing can be told, so all go. An empty table gives no rows."""
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest doc_id; null counts as empty. Of repeated rows one stays. An empty table gives no rows."""
    return exact.keep_rows(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document: the text that stands for it, with the smallest doc_id. Rows are told by doc_id and text, as an id may
    come with several texts. Rows without an id or without a word stay; repeated rows stay or go together. An empty table gives no rows."""
    kept = near.link_components(docs).filter("stays").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_text")).distinct()
    on = docs["doc_id"].cast("long").eqNullSafe(kept["_kept_id"]) & (F.xxhash64(docs["text"]) == kept["_kept_text"])
    return docs.join(kept, on, "left_semi")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts stay, each repeated row is judged alike. An empty table gives no rows, an empty
    benchmark takes none."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of documents with different sources and duplicate clusters. Empty and null texts give a row without a bin; repeated rows are of one
    cluster and come into different bins. An empty table gives no rows."""
    return packing.pack(docs)


def run_all(stages, spark: SparkSession, sf_dir: str) -> DataFrame:
    base = common.shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(stages):
        out = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
