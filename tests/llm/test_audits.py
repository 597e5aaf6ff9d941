"""Toxicity, source divergence, filter interactions."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import filter_audit, source_divergence, toxicity

ODD = [None, "", "  \n", "one", "ONE Two tWo", "é É ÀB c1d2e_f", "x " * 300, "# a", "A" * 50, "a\x0bb\x0cc\x1cd"]

# ---------------------------------------------------------------- source divergence


def plain_divergence(rows, least, top):
    """rows of (text, lang, source)."""
    count, docs, groups = {}, Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        count.setdefault((lang, source), Counter()).update(words)
        docs.update({(lang, w) for w in words})
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for (x, w), n in docs.items() if x == lang and n >= least)
        mine = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in mine:
            whole.update(count[lang, s])

        def p(c, kept=kept):
            n = sum(c[w] for w in kept)
            return {w: 1 + 1_000_000_000 * (c[w] + 5) // (n + 5 * len(kept)) for w in kept}

        q = p(whole)
        for s in mine:
            own = p(count[lang, s])
            pairs = [(-sum(abs(own[w] - x[w]) for w in kept), o.encode(), o) for o in mine if o != s for x in [p(count[lang, o])]]
            out += [(lang, s, "pair", o, -v, r + 1) for r, (v, _, o) in enumerate(sorted(pairs))]
            terms = sorted((-(own[w] - q[w]), w.encode(), w) for w in kept if count[lang, s][w] and own[w] > q[w])
            out += [(lang, s, "term", w, -v, r + 1) for r, (v, _, w) in enumerate(terms[:top])]
    return sorted(out)


def divergence_rows(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdé漢") for _ in range(r.randint(1, 3))) for _ in range(90)]
    rows = []
    for _ in range(260):
        source, lang = r.choice(["s1", "s1", "s1", "s2", "é3", None, ""]), r.choice(["en", "en", "fr", None])
        rows.append((" ".join(r.choice(vocab[: r.choice([20, 90])]).upper() for _ in range(r.randint(0, 25))), lang, source))
    return rows + [(t, "en", "s9") for t in ODD] + [("zz", "xx", "only"), (None, "yy", "a"), ("", "yy", "b"), ("q", "yy", None)]


@pytest.mark.parametrize(("least", "top", "chunk", "block"), [(8, 50, 1024, 128), (3, 4, 7, 2), (1, 1, 3, 1)])
def test_divergence_matches_brute_force(spark, least, top, chunk, block):
    rows = divergence_rows(least)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5).withColumns({"term": F.lit(1), "n": F.lit(2), "total": F.lit(3), "block": F.lit(4)})
    got = sorted(tuple(x) for x in source_divergence.audit(df, least, top, chunk, block).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == plain_divergence(rows, least, top)


def test_divergence_folds_within_a_task(spark, monkeypatch):
    rows = divergence_rows(7)
    batches = [source_divergence.pa.RecordBatch.from_pydict({"lang": [x[1] or "" for x in rows], "source": [x[2] or "" for x in rows], "text": [x[0] or "" for x in rows]})]
    whole = source_divergence.pa.Table.from_batches(list(source_divergence._count(batches))).to_pylist()
    monkeypatch.setattr(source_divergence, "FOLD_ROWS", 10)
    monkeypatch.setattr(source_divergence.C, "CHUNK_BYTES", 20)
    total = Counter()
    for x in source_divergence.pa.Table.from_batches(list(source_divergence._count(batches))).to_pylist():
        total[x["lang"], x["source"], x["term"], "n"] += x["n"]
        total[x["lang"], x["source"], x["term"], "d"] += x["docs"]
    assert all(total[x["lang"], x["source"], x["term"], "n"] == x["n"] and total[x["lang"], x["source"], x["term"], "d"] == x["docs"] for x in whole)


def test_divergence_large_counts(spark):
    """Counts beyond what fits 64 bits when scaled."""
    huge = 4_000_000_000_000
    got = spark.createDataFrame([(huge, 3 * huge, 7)], "n long, t long, v long").select(source_divergence.share(F.col("n"), F.col("t"), F.col("v")).alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (huge + 5) // (3 * huge + 35)


def test_divergence_empty(spark, empty):
    assert source_divergence.audit(empty).collect() == []


# ---------------------------------------------------------------- filters


def plain_filters(docs, labels):
    """docs of (doc_id, text, lang); labels of (doc_id, quality, toxic)."""
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": re.search(r"[#$%&*|]", t) is not None, "E": d is not None and t in first and d > first[t]}
        rows.append((lang or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley, lines = Counter(), []
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order):
                before = set(order[:step])
                removed = [r for r in mine if name in r[1] and not r[1] & before]
                shapley[name] += len(removed)
                lines.append((part, "".join(order), step + 1, sum(not r[1] & (before | {name}) for r in mine), len(removed), sum(name in r[1] and bool(r[1] & before) for r in mine), sum(r[1] == {name} for r in mine), sum(r[2] for r in removed), sum(r[3] for r in removed)))
        out += [(*x, shapley[x[1][x[2] - 1]]) for x in lines]
    return sorted(out)


FIGURES = ["part", "filter_order", "step", *filter_audit.FIGURES]


def test_filters_match_brute_force(spark):
    r = random.Random(2)
    say = lambda n, k: " ".join(r.choice(["a", "b", "Cc", "d#", "é"]) + str(r.randrange(k)) for _ in range(n))
    texts = ODD + [say(n, k) for n in (5, 199, 200, 201, 260) for k in (1, 30, 100, 9999)]
    docs = [(k * 3 % 101, r.choice(texts), r.choice(["en", "fr", None, ""])) for k in range(150)] + [(None, "same", "en"), (None, "same", "en"), (5000, "same", "en"), (5000, "same", "en"), (4, "long " * 90_000, "de")]
    labels = [(d, r.choice([0, 1, None]), r.choice([0, 1, None])) for d in r.sample(range(101), 60)] + [(5000, 1, 0), (5000, 0, 1), (None, 1, 1), (777777, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4).withColumns({"bits": F.lit(1), "digest": F.lit("x"), "toxic": F.lit(3), "part": F.lit("p")})
    got = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1)))
    assert sorted(tuple(x) for x in got.select(*FIGURES).collect()) == plain_filters(docs, labels)


def test_filters_empty(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, none).collect() == []
    docs = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert sorted(tuple(x) for x in filter_audit.audit(docs, none).select(*FIGURES).collect()) == plain_filters([(1, "a", None)], [])


def test_contraction_equals_plain_sums():
    rng = np.random.default_rng(4)
    cells = rng.integers(0, 10**12, (3, 32))
    got = filter_audit.figures(cells, filter_audit.selectors())
    k = filter_audit.ORDERS.index("CADBE") * 5 + 2  # D after C and A
    inside = [m for m in range(32) if m & 8 and not m & 5]
    assert got["removed"][k] == cells[0][inside].sum() and got["toxic_lost"][k] == cells[2][inside].sum()


# ---------------------------------------------------------------- toxicity


def toxic_rows(n=900, seed=3):
    """Toxic rows hold some of twelve stems with varied endings; clean rows seldom hold one. A few labels are wrong."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(3, 9))) for _ in range(1500)]
    stems = ["grolm", "blarga", "snivt"]
    docs, labels = [], []
    for k in range(n):
        bad = r.random() < 0.15
        w = [r.choice(vocab) for _ in range(r.randint(20, 200))]
        for _ in range(r.randint(2, 5) if bad else r.random() < 0.03):
            w[r.randrange(len(w))] = r.choice(stems) + r.choice(["", "en", "ost", "ia", "ul"])
        docs.append((k, " ".join(w), bad))
        if r.random() < 0.6:
            labels.append((k, int(bad) if r.random() > 0.02 else 1 - bad))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_rows()
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(4).withColumns({"y": F.lit(1), "piece": F.lit(2), "words": F.lit("w")})
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df, marks).collect()}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    held = [(got[d].predicted, bad) for d, _, bad in docs if got[d].held_out]
    caught, wrong = [p for p, bad in held if bad], [p for p, bad in held if not bad]
    assert sum(caught) / len(caught) >= 0.85 and sum(wrong) / len(wrong) <= 0.02
    again = {r.doc_id: r.score for r in toxicity.score(df.repartition(7), marks).collect()}
    assert all(abs(again[d] - r.score) < 1e-6 for d, r in got.items())


def test_toxicity_on_table(spark):
    """Held-out labels of the given table; one in sixteen toxic rows there has no sign of it."""
    sf = "/root/testdata/sf0.01"
    got = toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    caught, wrong = [r.predicted for r in got if r.toxic], [r.predicted for r in got if not r.toxic]
    assert sum(caught) / len(caught) >= 0.65 and sum(wrong) <= 1


def test_toxicity_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = toxic_rows(300)
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    held = lambda d: zlib.crc32(str(d).encode()) % 3 == 1
    turned = [(d, 1 - t if held(d) else t) for d, t in labels]
    one, two = ({r.doc_id: r.score for r in toxicity.score(df, spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (labels, turned))
    assert one == two


def test_toxicity_odd_rows(spark, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, none).collect() == []
    df = spark.createDataFrame([(None, "a"), (1, None), (1, ""), (2, "x " * 400_000), (2, "x"), (3, "a b")], "doc_id long, text string")
    assert {(r.score, r.predicted, r.held_out) for r in toxicity.score(df, none).filter("doc_id is null").collect()} == {(0.0, 0, False)}
    marks = spark.createDataFrame([(d, 1) for d in (1, 2, 3, None)], "doc_id long, toxic int")  # one class only
    used = [d for d in (1, 2, 3) if zlib.crc32(str(d).encode()) % 3 != 1]
    assert {r.score for r in toxicity.score(df, marks).collect()} == {1.0 if used else 0.0}
    docs, labels = toxic_rows(200)
    both = spark.createDataFrame([*[d[:2] for d in docs], (None, "a"), (1, None), (1, ""), (2, "x " * 400_000)], "doc_id long, text string")
    again = [*labels, *[(d, None) for d, _ in labels[:5]], *labels[:9]]
    got = toxicity.score(both, spark.createDataFrame(again, "doc_id long, toxic int")).collect()
    assert len(got) == 204 and all(0 <= r.score <= 1 for r in got)


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(8)
    n = 6000
    y = (rng.random(n) < 0.3).astype(int)
    vote = lambda right: np.where(rng.random(n) < 0.3, 0, np.where(rng.random(n) < right, 2 * y - 1, 1 - 2 * y))
    good, fair, poor = vote(0.95), vote(0.8), vote(0.6)
    copies = np.stack([np.where(rng.random(n) < 0.98, poor, 0) for _ in range(6)], 1)  # six voters that repeat a poor one
    votes = np.concatenate([np.stack([good, fair, vote(0.9)], 1), copies], 1)
    given = np.where(rng.random(n) < 0.2, y, -1)
    got = toxicity.label_model(votes, given, np.ones(n))
    assert abs(got["accuracy"][0] - 0.95) < 0.03 and abs(got["accuracy"][1] - 0.8) < 0.04 and abs(got["accuracy"][3] - 0.6) < 0.06
    linked = {(min(k, up), max(k, up)) for k, up, _ in got["tree"] if up >= 0}
    assert sum(a >= 3 and b >= 3 for a, b in linked) == 5  # the copies hang together
    free = given < 0
    assert ((got["posterior"][free] > 0.5) == y[free]).mean() > 0.93
    crowd = (votes.sum(1) > 0)[free]
    assert ((got["posterior"][free] > 0.5) == y[free]).mean() > (crowd == y[free]).mean() + 0.1
