"""Stages of the pipeline on small and odd inputs."""

import pytest
from pyspark.sql import functions as F

from fieldloom.llm import jaccard_join, stages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def say(c, n=40):
    return " ".join(f"{c}{i}" for i in range(n))


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA).withColumns({"component_id": F.lit(1), "stays": F.lit("x"), "text_hash": F.lit(2)})


def test_near_copies_are_told_by_text(spark):
    """Row (5, p + z) is a copy of row 1, though another row with id 5 stands alone."""
    p, r, z = say("p"), say("r"), " z0 z1"
    df = docs(spark, [(1, p), (5, p + z), (5, r)])
    assert kept(stages.jaccard_join(spark, df, "")) == [(1, p), (5, r)]


def test_near_copies_of_repeated_ids(spark):
    p, q, r, z = say("p"), say("q"), say("r"), " z0 z1"
    rows = [(5, p), (5, p + z), (5, q), (5, r), (6, r + z), (7, None), (7, ""), (7, "w w w"), (None, p), (None, p), (8, "one"), (9, "ONE"), (9, "one")]
    got = kept(stages.jaccard_join(spark, docs(spark, rows), ""))
    # of (5, p) and (5, p + z) one stays; rows without words or without an id stay
    assert len([x for x in got if x[0] == 5 and x[1].startswith("p")]) == 1
    assert [x for x in got if not (x[0] == 5 and x[1].startswith("p"))] == sorted([(5, q), (5, r), (7, None), (7, ""), (7, "w w w"), (None, p), (None, p), (8, "one")], key=repr)


def test_one_document_of_each_group_stays(spark, hard):
    got = jaccard_join.link_components(hard)
    groups = got.filter("n_shingles > 0").groupBy("component_id").agg(F.count_if("stays").alias("n"), F.min(F.when(F.col("stays"), F.col("doc_id"))).alias("d"))
    assert groups.filter("n <> 1 or d <> component_id").count() == 0
    assert got.filter("n_shingles = 0 and not stays").count() == 0


@pytest.mark.parametrize("stage", ["language_id", "exact_dedup", "jaccard_join", "decontaminate", "pack"])
def test_stages_of_an_empty_table(spark, sf_dir, stage):
    df = spark.createDataFrame([], SCHEMA)
    assert getattr(stages, stage)(spark, df, sf_dir).collect() == []


@pytest.mark.parametrize("stage", ["exact_dedup", "jaccard_join", "decontaminate"])
def test_stages_keep_clean_documents_and_columns(spark, sf_dir, stage):
    rows = [(1, say("a")), (2, None), (3, ""), (4, say("b")), (4, say("b")), (4, say("c")), (None, say("d")), (5, "x " * 200_000)]
    df = docs(spark, rows)
    got = getattr(stages, stage)(spark, df, sf_dir)
    assert got.columns == df.columns
    want = set(rows) - ({(2, None)} if stage == "exact_dedup" else set())  # null counts as empty there
    assert set(kept(got)) == want


def test_language_stage_on_odd_rows(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, "123 456", "en", "s", 7), (-3, "the and of the that " * 30_000, "en", "s", 1)], SCHEMA)
    got = stages.language_id(spark, base.union(odd).union(base.limit(5)), sf_dir)
    ids = [r.doc_id for r in got.collect()]
    assert None not in ids and -1 not in ids and -2 not in ids and len(ids) > 0.9 * base.count()
