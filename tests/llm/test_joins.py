import pytest
from pyspark.sql import functions as F

from fieldloom.llm import jaccard_join, substring_dedup

from . import brute


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("percent", [75, 90])
def test_components_match_brute_force(spark, hard, percent):
    want = brute.components(rows(hard), percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(hard, percent=percent).collect()}
    assert got == want


def test_components_small_groups_limit(spark, hard):
    """With a small limit nearly every group takes the path of large groups."""
    want = brute.components(rows(hard))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(hard, group=2, held=500, block=5).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == want


@pytest.mark.parametrize("split", [3, 20])
def test_components_hot_keys_dealt_to_several_tasks(spark, hard, split):
    want = brute.components(rows(hard))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(hard, group=2, block=5, split=split).collect()}
    assert got == want


def test_components_one_id_with_several_texts(spark):
    """Each row is a document of its own, by its text."""
    say = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    p, q, z = say("p", 40), say("q", 40), " z0 z1"
    df = spark.createDataFrame([(1, p), (2, p + z), (1, q), (3, q + z), (5, q), (5, say("r", 40)), (4, say("r", 40) + z)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.link_components(df).collect())
    assert got == [(1, 36, 1), (1, 36, 1), (2, 38, 1), (3, 38, 1), (4, 38, 4), (5, 36, 1), (5, 36, 4)]


def test_components_many_templates_share_a_passage(spark):
    """A key that all have, in groups over every limit, with links only inside of each template."""
    import random

    r = random.Random(3)
    say = lambda n: [f"v{r.randrange(9999)}" for _ in range(n)]
    passage, out, k = say(60), [], 0
    for _ in range(6):
        own = say(16)
        for _ in range(9):
            w = own[:]
            w[r.randrange(16)] = f"x{k}"
            out.append((k, " ".join(w + passage)))
            k += 1
    df = spark.createDataFrame(out, "doc_id long, text string")
    want = brute.components(out)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(df, group=4, block=7).collect()}
    assert got == want


def test_sketches_of_very_long_texts_cost_what_they_weigh():
    """Two megabyte sketches among two thousand short ones."""
    import numpy as np

    r = np.random.default_rng(1)
    blobs = [r.bytes(256) for _ in range(2046)] + [r.bytes(1 << 20) for _ in range(2)] + [r.bytes(1024) for _ in range(20)]
    got = jaccard_join._folded(blobs)
    assert sum(m.nbytes for _, m in got.values()) < 3 * sum(map(len, blobs))
    place, rows = got[256]
    wide = np.frombuffer(blobs[2047], np.uint64).reshape(-1, 32)
    assert np.array_equal(rows[place[2047]], np.bitwise_xor.reduce(wide, 0)) and np.array_equal(rows[place[5]], np.frombuffer(blobs[5], np.uint64))
    assert (got[1 << 20][0] >= 0).sum() == 2 and (got[1024][0] >= 0).sum() == 22


def test_components_of_very_long_near_copies(spark):
    """Two long near copies in one group with many short documents; sketches are cut into steps of few bytes."""
    long = " ".join(f"w{k * 7919 % 100_003}" for k in range(60_000))
    rows = [(1, long), (2, long + " and a little more"), *((10 + k, f"w0 w7919 w15838 w23757 w31676 x{k} y{k} z{k} a{k} b{k}") for k in range(300))]
    got = {r.doc_id: r.component_id for r in jaccard_join.link_components(spark.createDataFrame(rows, "doc_id long, text string"), group=4, block=50).collect()}
    assert got[1] == got[2] == 1 and all(got[d] == d for d, _ in rows[2:])


def test_components_in_small_steps(spark, hard, monkeypatch):
    want = brute.components(rows(hard))
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 3000)  # read on the driver
    monkeypatch.setattr(jaccard_join, "PART_SHINGLES", 5000)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link_components(hard, group=2, block=5).collect()}
    assert got == want


@pytest.mark.parametrize("links", [10**6, 40])
def test_components_of_chains_and_stars(spark, monkeypatch, links):
    """Links of one task, and of several, in one long chain, a star and scattered pairs."""
    from fieldloom.llm import common

    monkeypatch.setattr(common, "LINKS", links)  # read on the driver
    pairs = [(k, k + 1) for k in range(100, 400)] + [(1000, k) for k in range(1001, 1100)] + [(k, k + 5000) for k in range(2000, 2040)] + [(7, 7)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(pairs, "a long, b long").repartition(4)).collect()}
    want = {k: 100 for k in range(100, 401)} | {k: 1000 for k in range(1000, 1100)} | {k: k for k in range(2000, 2040)} | {k + 5000: k for k in range(2000, 2040)}
    assert got == want


def test_components_on_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.query(spark, sf_dir).collect()}
    assert got == brute.components(rows(docs))


def test_components_empty_and_nulls(spark, empty):
    assert jaccard_join.link_components(empty).collect() == []
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, "A  b"), (3, None)], "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("fp", F.lit(2))
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in jaccard_join.link_components(df).collect())
    assert got == [(-1, 1, -1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)]


@pytest.mark.parametrize("window", [50, 10])
def test_repeats_match_brute_force(spark, hard, window):
    want = brute.repeats(rows(hard), window)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(hard, window).collect()}
    assert got == want


@pytest.mark.parametrize(("window", "shortest", "levels"), [(100, 16, [25, 50, 100]), (40, 5, [5, 10, 20, 40])])
def test_repeats_over_several_levels(spark, hard, window, shortest, levels, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHORTEST", shortest)  # read on the driver
    assert substring_dedup.lengths(window) == levels
    want = brute.repeats(rows(hard), window)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(hard, window).collect()}
    assert got == want and any(n for _, n, _ in got.values())


def test_repeats_on_table_with_small_buffers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(6)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs, held=1000).collect()}
    assert got == brute.repeats(rows(docs))


def test_repeats_empty_nulls_and_repeated_rows(spark, empty):
    assert substring_dedup.remove_repeats(empty).collect() == []
    t = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, t), (4, t), (4, t), (9, t), (7, None), (8, "")], "doc_id long, text string").withColumn("rid", F.lit(1)).withColumn("hs", F.lit(2))
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect())
    assert got == [(-1, 60, 0), (4, 60, 0), (4, 60, 0), (7, 0, 0), (8, 0, 0), (9, 60, 60)]
