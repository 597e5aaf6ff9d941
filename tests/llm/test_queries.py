import pytest

from fieldloom.llm import queries, token_store

from .. import oracle


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    oracle.compare(spark, oracle.tables(sf_dir), sf_dir, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", ["op5_token_store", "op6_best_fit_packing", "op8_language_id", "op9_pii", "op10_decontamination"])
def test_query_has_every_document(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    got = queries.QUERIES[name](spark, sf_dir).select("doc_id").distinct()
    assert got.count() == docs.count() and got.join(docs, "doc_id").count() == docs.count()


def test_small_word_cache_gives_the_same_ids(monkeypatch, spark, sf_dir):
    import numpy as np
    import public_tokenizers

    from fieldloom.llm import common

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).toArrow().column("text")
    big, small = (token_store.WordCoder(public_tokenizers.path("word_bpe_49k.json")) for _ in range(2))
    for k in range(0, 60, 6):
        raw, off = common.utf8(rows.slice(k, 6).combine_chunks())
        want = big.encode(raw, off)
        monkeypatch.setattr(token_store, "CACHE", 300)
        got = small.encode(raw, off)
        monkeypatch.undo()
        assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))
    assert len(small.at) < len(big.at)
