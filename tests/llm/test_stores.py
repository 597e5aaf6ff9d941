"""Exact dedup, token store, packing, WARC audit, pipeline."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import common, exact_dedup, packing, token_store, warc_audit

from . import brute

ODD = [(None, "a b"), (None, "zz"), (None, "ZZ"), (1, "a b"), (1, "a b"), (5, "A B"), (5, "A B"), (2, None), (3, ""), (4, "É"), (6, "é")]


def plain_groups(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(brute.lower(t), []).append(d)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        left = True
        for i in ids:
            kept = i == top and left
            left = left and not kept
            out.append((i, top, len(ids), kept, hashlib.sha256(t).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("memory", [1 << 20, 3000])
def test_exact_dedup_matches_brute_force(spark, hard, memory):
    docs = hard.select("doc_id", "text").union(spark.createDataFrame(ODD, "doc_id long, text string"))
    docs = docs.union(spark.createDataFrame([(9000 + k, "copy " * 300) for k in range(300)], "doc_id long, text string")).repartition(6)
    want = plain_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = exact_dedup.group_equal(docs.withColumns({"part": F.lit(1), "n": F.lit(2)}), memory=memory, fold=20_000)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    kept = exact_dedup.keep_rows(docs.withColumn("h", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "h"]
    assert sorted(str((r.doc_id, hashlib.sha256(brute.lower(r.text)).hexdigest())) for r in kept.collect()) == sorted(str((g[0], g[4])) for g in want if g[3])


def test_exact_dedup_empty_and_keep(spark, empty):
    assert exact_dedup.group_equal(empty).collect() == []
    assert exact_dedup.keep_rows(empty).collect() == []


def test_grace_spills_and_compares_content(tmp_path, monkeypatch):
    import tempfile

    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path))
    records = [(5, b"a" * 50, 1, 1), (5, b"b" * 50, None, 1), (5, b"a" * 50, 9, 2)] * 3 + [(k << 50, b"%d" % k * 40, k, 1) for k in range(200)]
    got = sorted((t, top, n) for _, t, top, n in exact_dedup.grace(records, 2000))
    want = {}
    for _, t, top, n in records:
        a, b = want.get(t, (None, 0))
        want[t] = (top if a is None else a if top is None else max(a, top), b + n)
    assert got == sorted((t, *v) for t, v in want.items())
    assert list(tmp_path.iterdir()) == []


# ---------------------------------------------------------------- tokens


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_tokens_equal_whole_text_encoding(spark, sf_dir, hard):
    from tokenizers import Tokenizer

    odd = [(-3, "It's naïve, été. x, 3.14, <|ENDOFTEXT|>, <|endoftext|>. don't. a b ΣΑΣ. ﬁ, é, é. ß. 中文， 'S. 12,5. a×, ÷."), (10**12, "THE END, the end."), (77777, None), (77778, "")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("doc_id < 60").union(hard.select("doc_id", "text")).union(spark.createDataFrame(odd, "doc_id long, text string"))
    tok = Tokenizer.from_file(tokenizer())
    want, start = [], 0
    for d, t in sorted((r.doc_id, r.text or "") for r in docs.collect()):
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    from fieldloom.llm import common

    folder = common.shared_dir(spark)
    token_store.write_shards(docs, folder, tokenizer(), per_shard=4000)
    assert sorted(map(tuple, token_store.read_documents(spark, folder).collect())) == want
    assert spark.read.parquet(folder).count() > 1


def test_tokens_nulls_repeats_and_empty(spark, empty):
    from fieldloom.llm import common

    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (1, "a b"), (2, None)], "doc_id long, text string").withColumn("part", F.lit(1))
    folder = common.shared_dir(spark)
    token_store.write_shards(df, folder, tokenizer())
    got = sorted(((r.doc_id or -1, r.start, r.n_tokens) for r in token_store.read_documents(spark, folder).collect()), key=lambda r: r[1])
    assert [(d, n) for d, _, n in got] == [(-1, 2), (1, 3), (1, 2), (1, 2), (2, 1)]
    assert [s for _, s, _ in got] == [0, 2, 5, 7, 9]
    folder = common.shared_dir(spark)
    token_store.write_shards(empty, folder, tokenizer())
    assert token_store.read_documents(spark, folder).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 5000])
def test_perfect_hash_is_minimal_and_refuses_strangers(n):
    r = np.random.default_rng(n)
    ids = r.choice(10**9, 2 * n, replace=False)
    keys = np.stack([ids[:n], np.zeros(n, np.int64)], 1)
    lens = r.integers(0, 5, n)
    off = np.concatenate([[0], np.cumsum(lens)])
    shard = token_store.Shard(token_store.image(keys, np.arange(off[-1]), off, 4))
    found, at, size = shard.find(keys)
    assert found.all() and (at == off[:-1]).all() and (size == lens).all()
    found, _, _ = shard.find(np.stack([ids[n:], np.zeros(n, np.int64)], 1))
    assert not found.any()


# ---------------------------------------------------------------- packing


def test_packing_is_best_fit_under_conflicts():
    r = np.random.default_rng(2)
    rows = [(int(k), int(r.integers(0, 150)), r.choice(["a", "b", "c", "d", None]), int(r.integers(0, 40))) for k in range(400)]
    out = packing.pack_group(rows, 100)
    by = {d: (s, c) for d, _, s, c in rows}
    bins = {}
    for d, piece, n, b, _ in out:
        if b is not None:
            bins.setdefault(b, []).append((d, piece, n))
    for b, got in bins.items():
        assert sum(n for *_, n in got) <= 100
        if len(got) > 1:
            assert len({by[d][0] for d, *_ in got}) == len(got) and len({by[d][1] for d, *_ in got}) == len(got)
        assert {x[4] for x in out if x[3] == b} == {100 - sum(n for *_, n in got)}
    for d, n, *_ in rows:
        assert sum(x[2] for x in out if x[0] == d) == n
    # the tightest compatible bin each time, by a plain search
    plain: list = []
    pieces = [x for x in out if x[3] is not None and x[2] < 100]
    for d, _, n, b, _ in pieces:
        fits = [(room, k) for k, (room, s, c) in enumerate(plain) if room >= n and by[d][0] not in s and by[d][1] not in c]
        if fits:
            room, k = min(fits)
        else:
            plain.append((100, set(), set()))
            room, k = 100, len(plain) - 1
        plain[k] = (room - n, plain[k][1] | {by[d][0]}, plain[k][2] | {by[d][1]})
        assert 100 - plain[k][0] <= 100
    assert sorted(r for r, *_ in plain) == sorted(x[0] for x in {(v[4], v[3]) for v in pieces})


def test_packing_table(spark, hard, empty):
    got = packing.pack(hard.withColumn("g", F.lit(1)), capacity=64, group_rows=50).collect()
    want = {r.doc_id: len((r.text or "").encode().split()) for r in hard.collect()}
    words = {}
    for r in got:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.n_words
        assert (r.bin_id is None) == (r.n_words == 0)
    assert words == want
    assert packing.pack(empty).collect() == []
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    bins = [r.bin_id for r in packing.pack(df).collect() if r.n_words]
    assert len(set(bins)) == 3


# ---------------------------------------------------------------- WARC


def plain_audit(a, b):
    slots, out, at_a, at_b = sorted(set(a) | set(b)), [], {}, {}
    for s in slots:
        f = s >> 12
        na, nb = (sum(len(x) for x in side.get(s, [])) for side in (a, b))
        if sorted(a.get(s, [])) != sorted(b.get(s, [])):
            kind = "missing" if s not in b else "extra" if s not in a else "changed"
            out.append((f, s, kind, at_a.get(f, 0), at_b.get(f, 0), na, nb))
        at_a[f], at_b[f] = at_a.get(f, 0) + na, at_b.get(f, 0) + nb
    return out


def test_warc_audit_reads_what_lies_below_damage(spark):
    """Damage in one place: each step's ranges reach the scan of the level below, which lies in order of slots."""
    rows = spark.range(20_000).select(F.col("id").alias("slot"), F.concat(F.lit("r"), "id").alias("record"))
    hurt = rows.withColumn("record", F.when(F.col("slot").isin(777, 780, 9000), "x").otherwise(F.col("record"))).union(spark.createDataFrame([(warc_audit.NULL_SLOT, "null")], "slot long, record string"))
    base = common.shared_dir(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows come into one file
    try:
        a, b = warc_audit.build_tree(rows, f"{base}/a"), warc_audit.build_tree(hurt, f"{base}/b")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.slot, r.kind) for r in warc_audit.audit(a, b).collect()} == {(777, "changed"), (780, "changed"), (9000, "changed"), (warc_audit.NULL_SLOT, "extra")}
    up = spark.createDataFrame([(777 >> 4,), (9000 >> 4,)], "slot long")
    got = b[0].filter(warc_audit.below_any(up))
    assert got.count() == 32 and "PushedFilters: [Or(" in got._jdf.queryExecution().toString()
    spans = b[0].groupBy(F.input_file_name()).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).orderBy("lo").collect()
    assert len(spans) > 3 and all(x.hi < y.lo for x, y in zip(spans, spans[1:]))
    none = spark.createDataFrame([], "slot long")
    assert b[0].filter(warc_audit.below_any(none)).count() == 0
    many = spark.range(0, 5000, 7).select(F.col("id").alias("slot"))
    inside = spark.range(100_000).select(F.col("id").alias("slot")).filter(warc_audit.below_any(many))
    assert spark.range(0, 5000, 7).select(F.explode(F.sequence(F.col("id") * 16, F.col("id") * 16 + 15)).alias("slot")).join(inside, "slot", "left_anti").count() == 0


def test_warc_audit_matches_brute_force(spark, sf_dir):
    from fieldloom.llm import common

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("page_id", F.col("page_id") * 37)
    more = spark.createDataFrame([(None, "u", "h"), (None, "u", "h"), (-5, None, None), (12, "é", "<p>é</p>")], "page_id long, url string, html string")
    archive = warc_audit.records(pages.unionByName(more).withColumn("up", F.lit(1)))
    other = warc_audit.damaged(archive).union(spark.createDataFrame([(10**7, "extra"), (3, "more")], "slot long, record string"))
    sides = []
    for df in (archive, other):
        rows = {}
        for r in df.collect():
            rows.setdefault(r.slot, []).append(r.record.encode())
        sides.append(rows)
    base = common.shared_dir(spark)
    a, b = warc_audit.build_tree(archive, f"{base}/a"), warc_audit.build_tree(other, f"{base}/b")
    got = sorted(map(tuple, warc_audit.audit(a, b).collect()))
    assert got == sorted(plain_audit(*sides)) and got
    assert warc_audit.audit(a, a).collect() == []
    none = warc_audit.build_tree(archive.limit(0), f"{base}/none")
    assert warc_audit.audit(none, none).collect() == []
    assert {r.kind for r in warc_audit.audit(a, none).collect()} == {"missing"}


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline
    from fieldloom.llm import langid

    sf = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r.doc_id: r.text for r in docs.collect()}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, sf)
        if name == "language_id":
            gone = {r.doc_id for r in langid.identify(frame).filter("rejected").collect()}
            want = set(left) - gone
        elif name == "exact_dedup":
            last = {}
            for d, t in left.items():
                last[brute.lower(t)] = max(d, last.get(brute.lower(t), d))
            want = set(last.values())
        elif name == "ngram_jaccard_join":
            want = {c for _, c in brute.components(list(left.items())).values()} | {d for d, t in left.items() if not brute.lower(t).split()}
        elif name == "benchmark_decontamination":
            whole = [b" ".join(brute.lower(r.text).split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            want = {d for d, t in left.items() if not any(w in b" ".join(brute.lower(t).split()) for w in whole)}
        else:
            rows = out.collect()
            assert {r.doc_id for r in rows} == set(left)
            break
        assert out.columns == docs.columns
        got = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "benchmark_decontamination":
            assert got <= want and len(want - got) < 0.02 * len(want)
        else:
            assert got == want
        left = {d: left[d] for d in got}
        frame = docs.filter(F.col("doc_id").isin(list(got)))
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_lookup_over_several_shards(spark, tmp_path):
    """Keys in many shards, repeated ids over a shard's end, absent keys; shards out of range are pruned."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = [(k, f"the text number {k} of a small table") for k in range(0, 400, 2)] + [(100, f"again {j}") for j in range(30)] + [(None, "nobody")]
    out = str(tmp_path / "shards")
    token_store.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), out, path, per_shard=60)
    assert spark.read.parquet(out).count() > 20
    got = {}
    for r in token_store.lookup(spark, out, [0, 7, 100, 398, 900]).collect():
        got.setdefault(r.doc_id, []).append((r.occurrence, list(r.ids)))
    ids = lambda t: tok.encode(t, add_special_tokens=False).ids + [token_store.END_ID]
    texts = sorted(t for k, t in rows if k == 100)
    assert {k: sorted(v) for k, v in got.items()} == {0: [(0, ids(rows[0][1]))], 100: [(n, ids(t)) for n, t in enumerate(texts)], 398: [(0, ids(rows[199][1]))]}
    assert token_store.lookup(spark, out, []).collect() == []
    with pytest.raises(ValueError):
        token_store.lookup(spark, out, list(range(token_store.MOST_KEYS + 1)))


def test_other_tokenizer_files_get_whole_texts(tmp_path):
    """A file with another normaliser isn't encoded word by word, and its ids are the library's."""
    import json

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    spec = json.load(open(public_tokenizers.path("word_bpe_49k.json")))
    assert token_store.parts_at_space(spec)
    spec["normalizer"] = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": "_"}, {"type": "Lowercase"}]}
    p = tmp_path / "other.json"
    p.write_text(json.dumps(spec))
    assert not token_store.parts_at_space(spec)
    texts = ["One two, three.", "", "a  b\nc"]
    raw = [t.encode() for t in texts]
    ids, off = token_store.WordCoder(str(p)).encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    tok = Tokenizer.from_file(str(p))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
