"""Consensus by assignment, pages both ways, rule tables, segmented scans, places of bad lines, byte-true redaction, the annotation store, delivery."""

import itertools
import json
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import redact
from fieldloom.operators import collections as col
from fieldloom.operators import consensus, edits, fleet, frames, rules
from fieldloom.plans import registry, sinks, views
from fieldloom.sources import files, scratch, tables

# ---------------------------------------------------------------- consensus


def best_total(gain):
    """The largest sum over all ways of matching rows to columns one to one."""
    n, m = gain.shape
    if n > m:
        return best_total(gain.T)
    return max(sum(gain[i, c] for i, c in enumerate(p)) for p in itertools.permutations(range(m), n))


def test_assignment_is_optimal():
    rng = np.random.default_rng(1)
    for k in range(300):
        n = int(rng.integers(1, 5))
        gain = rng.random((n, int(rng.integers(n, 7))))
        if k % 3 == 0:
            gain = np.round(gain, 1) * (rng.random(gain.shape) < 0.6)  # ties and boxes apart
        got = consensus.assign(gain)
        assert len(set(got.tolist())) == n and abs(gain[np.arange(n), got].sum() - best_total(gain)) < 1e-9


BOXES = "uid long, item long, task string, annotator long, x0 double, y0 double, x1 double, y1 double"


def test_consensus_of_several_objects(spark):
    """Annotator 3 saw the first of annotator 1's two objects: half agreement, not none."""
    first, second = (0.0, 0.0, 10.0, 10.0), (50.0, 50.0, 60.0, 60.0)
    rows = [(1, 7, "t", 1, *first), (2, 7, "t", 1, *second), (3, 7, "t", 2, *second), (4, 7, "t", 2, *first), (5, 7, "t", 3, *first), (6, 8, "t", 1, *first)]
    df = spark.createDataFrame(rows, BOXES)
    got = {(r.annotator_a, r.annotator_b): (r.boxes_a, r.boxes_b, r.total, r.agreement, sorted((m.box_a, m.box_b, m.iou) for m in r.matches)) for r in consensus.box_matches(df).collect()}
    assert got == {(1, 2): (2, 2, 2.0, 1.0, [("1", "4", 1.0), ("2", "3", 1.0)]), (1, 3): (2, 1, 1.0, 0.5, [("1", "5", 1.0)]), (2, 3): (2, 1, 1.0, 0.5, [("4", "5", 1.0)])}
    score = consensus.consensus_scores(df).collect()
    assert [(r.item, round(r.score, 6), r.annotator_count, r.agreed, r.details) for r in score] == [(7, round(2 / 3, 6), 3, True, '{"1-2":10000,"1-3":5000,"2-3":5000}')]
    assert consensus.annotator_pairs(df).count() == 2 * 2 + 2 + 2
    objects = {r.uid: (r.n_others, r.n_agree, r.mean_iou) for r in consensus.consensus_objects(df).collect()}
    assert objects == {"1": (2, 2, 1.0), "4": (2, 2, 1.0), "5": (2, 2, 1.0), "2": (2, 1, 0.5), "3": (2, 1, 0.5)}


def test_box_matches_equal_brute_force(spark):
    r = random.Random(4)
    rows = []
    for item in range(12):
        for annotator in range(r.randint(0, 4)):
            for _ in range(r.randint(1, 4)):
                x, y = r.randint(0, 20), r.randint(0, 20)
                rows.append((len(rows), item, "t", annotator, float(x), float(y), float(x + r.randint(0, 15)), float(y + r.randint(1, 15))))
    got = {(m.item, m.annotator_a, m.annotator_b): m for m in consensus.box_matches(spark.createDataFrame(rows, BOXES)).collect()}
    by = {}
    for x in rows:
        by.setdefault((x[1], x[3]), []).append(x[4:])
    want = {(i, a, b): best_total(consensus._ious(np.array(by[i, a]), np.array(by[i, b]))) for i, a in by for j, b in by if i == j and a < b}
    assert got.keys() == want.keys() and all(abs(got[k].total - v) < 1e-9 for k, v in want.items())
    assert all(abs(sum(m.iou for m in x.matches) - x.total) < 1e-9 and len({m.box_a for m in x.matches}) == len(x.matches) for x in got.values())
    few = consensus.box_matches(spark.createDataFrame(rows, BOXES), consensus.Choices(min_annotations=4)).select("item").distinct().collect()
    assert {x.item for x in few} == {i for i in range(12) if sum(k[0] == i for k in by) >= 4}


# ---------------------------------------------------------------- pages


@pytest.mark.parametrize("order", [["k"], ["name", "k"]])
def test_pages_there_and_back(spark, order):
    r = random.Random(6)
    rows = spark.createDataFrame([(k, r.choice("aé\"c")) for k in range(23)], "k long, name string").repartition(3)
    pages, cursor, back = [], None, []
    while True:
        page = col.keyset_page(rows, order, 5, cursor).collect()
        pages.append([x.k for x in page])
        assert (page[0].previous_cursor is None) == (len(pages) == 1) and page[0].has_more == (page[0].next_cursor is not None)
        if page[0].next_cursor is None:
            break
        cursor = page[0].next_cursor
    assert sum(pages, []) == [x.k for x in rows.orderBy(*order).collect()] and len(pages) == 5
    cursor = page[0].previous_cursor
    while cursor:
        page = col.keyset_page(rows, order, 5, cursor).collect()
        assert page[0].has_more and col.keyset_page(rows, order, 5, page[0].next_cursor).first().k == pages[-len(back) - 1][0]
        back.append([x.k for x in page])
        cursor = page[0].previous_cursor
    assert back == pages[-2::-1]
    assert col.keyset_page(rows, order, 5, col.encode_cursor({"before": [0] if order == ["k"] else ["", 0]})).collect() == []


def test_scores_in_one_shuffle_equal_those_of_the_matches(spark, monkeypatch):
    r = random.Random(3)
    side = lambda: [x := r.uniform(0, 9), y := r.uniform(0, 9), x + r.choice([0.0, 3.0, 6.0]), y + 4.0]  # noqa: E731,F841
    rows = [(k, r.randint(1, 40) if k % 3 else 7, r.choice(["t", "u"]), f"p{r.randint(1, 30)}" if k % 50 else None, *side()) for k in range(900)]
    df = spark.createDataFrame(rows, "uid long, item long, task string, annotator string, x0 double, y0 double, x1 double, y1 double").repartition(5)
    rounded = lambda x: sorted(map(tuple, x.withColumn("score", F.round("score", 6)).collect()))
    want = rounded(consensus.consensus_scores(df, matches=consensus.box_matches(df)))
    monkeypatch.setattr(consensus, "box_matches", None)
    got = consensus.consensus_scores(df)
    assert rounded(got) == want and len(want) > 50
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    batches = [b for i in range(0, 30, 7) for b in consensus.pa.table({c: [float(k // 11) if c in ("item", "task") else float(k % 11) for k in range(i, min(i + 7, 30))] for c in ("item", "task", "annotator", *consensus.SIDES)}).to_batches()]
    monkeypatch.setattr(consensus, "PAIRS", 10)
    assert [(x["item"], x["pairs"], len(x["d"])) for b in consensus._score_rows(0.5)(iter(batches)) for x in b.to_pylist()] == [(0.0, 55, 55), (1.0, 55, 55), (2.0, 28, 28)]


def test_summary_stores_no_details(spark, sf_dir, monkeypatch):
    kept = []
    monkeypatch.setattr(consensus.scratch, "stored", lambda df: kept.append(df.columns) or df)
    assert registry.QUERIES["consensus_summary"](spark, sf_dir).count() == 1
    assert kept == [["task", "score", "agreed"]]


# ---------------------------------------------------------------- rules


def test_rule_table_equals_nested_loop(spark):
    r = random.Random(9)
    kinds, nan = ["arm", "cart", None], float("nan")
    number = lambda: r.choice([r.uniform(0, 9), float(r.randint(0, 9)), 3.0])
    events = [(k, r.randint(1, 4), r.choice([None, nan, number(), number(), number()]), r.choice([None, "error", "click", "é"]), r.randint(0, 9)) for k in range(120)]
    devices = [(1, "arm"), (2, "cart"), (3, None)]
    table = []
    for k in range(10_000):
        field = r.choice(["value", "type", "n"])
        value = r.choice([None, "click", "d", "error", "é", ""]) if field == "type" else r.choice([None, "NaN", str(number())])
        table.append((k, r.choice([True, True, None, False]), field, r.choice(rules.OPS), value, r.choice(kinds), r.choice([None, "critical"]), r.choice([None, ["tag"]])))
    ev = spark.createDataFrame(events, "uid long, device long, value double, type string, n int").repartition(4)
    dev, rule = spark.createDataFrame(devices, "uid long, type string"), spark.createDataFrame(table, rules.RULES)
    holds = lambda x, op, v: {"gt": x > v, "gte": x >= v, "lt": x < v, "lte": x <= v, "eq": x == v}[op]
    order = lambda x: (x != x, 0 if x != x else x)  # noqa: E731  NaN is above all and equals itself
    want, kind = {}, dict(devices)
    for u, d, value, text, n in events:
        for k, on, field, op, v, scope, _, _ in table:
            x = {"value": value, "type": text, "n": n}[field]
            if d in kind and on is not False and v is not None and x is not None and scope in (None, kind[d]) and (holds(x.encode(), op, v.encode()) if field == "type" else holds(order(float(x)), op, order(float(v)))):
                want[u] = want.get(u, 0) + 1
    got = rules.rule_match(ev, dev, rule)
    assert {x.uid: x.n for x in got.groupBy("uid").agg(F.count("*").alias("n")).collect()} == want
    assert got.count() == got.select("uid", "rule").distinct().count()
    sliced = rules.rule_match(ev, dev, rule, most=1700)
    assert sliced.groupBy("rule").count().exceptAll(got.groupBy("rule").count()).count() == 0 and sliced.count() == got.count()
    assert {(x.alert_severity, tuple(x.actions)) for x in got.select("alert_severity", "actions").distinct().collect()} == {(s, a) for s in ("warning", "critical") for a in (("alert",), ("tag",))}


def test_rule_totals_equal_pairs_without_making_them(spark, monkeypatch):
    r = random.Random(4)
    number = lambda: r.choice([float("nan"), -0.0, 0.0, 3.0, float(r.randint(0, 9)), r.uniform(-9, 9)])
    events = [(k, r.randint(1, 4), r.choice([None, number()]), r.choice([None, "", "error", "é"]), r.randint(0, 9), r.random() < 0.5) for k in range(300)]
    ev = spark.createDataFrame(events, "uid long, device long, value double, type string, n int, flag boolean").repartition(3)
    dev = spark.createDataFrame([(1, "arm"), (2, "cart"), (3, None)], "uid long, type string")
    value = {"value": lambda: str(number()), "n": lambda: r.choice(["0", "4.5", "-1", "NaN"]), "type": lambda: r.choice(["", "d", "error", "é"]), "flag": lambda: r.choice(["True", "F"])}
    table = [(k % 800, r.choice([True, None, False]), f, r.choice(rules.OPS), r.choice([None, value[f](), value[f]()]), r.choice(["arm", "cart", None]), None, None) for k in range(900) for f in [r.choice(list(value))]]
    rule = spark.createDataFrame(table, rules.RULES)
    want = rules.rule_match(ev, dev, rule).groupBy("rule").agg(F.count("*").alias("hit_count"), F.sum("uid").alias("uid")).collect()
    got = rules.rule_totals(ev, dev, rule, ("uid",)).collect()
    assert sorted(got) == sorted(want) and len(got) > 250
    plain = rule.filter("field <> 'flag'")
    want = rules.rule_match(ev, dev, plain).groupBy("rule").count().collect()
    monkeypatch.setattr(rules, "match_batch", None)
    assert sorted(rules.rule_totals(ev, dev, plain).collect()) == sorted(want)
    assert rules.rule_totals(ev, dev, rule.limit(0)).collect() == [] and rules.rule_totals(ev.limit(0), dev, plain).collect() == []


def test_rule_table_makes_no_pairs(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(rules, "rule_match", None)
    assert registry.QUERIES["rule_table"](spark, sf_dir).count() > 0


def test_rule_table_has_one_plan(spark):
    ev = spark.createDataFrame([(1, 1, 5.0)], "uid long, device long, value double")
    dev = spark.createDataFrame([(1, "arm")], "uid long, type string")
    size = []
    for n in (1, 3000):
        table = spark.range(n).select(F.col("id").alias("uid"), F.lit(True).alias("enabled"), F.lit("value").alias("field"), F.lit("gt").alias("op"), F.col("id").cast("string").alias("value"), F.lit(None).cast("string").alias("device_type"), F.lit(None).cast("string").alias("severity"), F.lit(None).cast("array<string>").alias("actions"))
        got = rules.rule_match(ev, dev, table)
        size.append(len(re.sub(r"\d+", "", got._jdf.queryExecution().toString())))
    assert size[0] == size[1] and got.count() == 5


@pytest.mark.parametrize(("op", "field", "value", "said"), [("near", "value", "1", "unknown operator near"), ("gt", "speed", "1", "unknown field speed"), ("gt", "value", "fast", "no number: fast"), (None, "value", "1", "unknown operator")])
def test_wrong_rules_are_errors(spark, op, field, value, said):
    ev = spark.createDataFrame([(1, 1, 5.0)], "uid long, device long, value double")
    bad = spark.createDataFrame([(1, False, field, op, value, None, None, None)], rules.RULES)
    with pytest.raises(Exception, match=said):
        rules.rule_match(ev, spark.createDataFrame([(1, "arm")], "uid long, type string"), bad).collect()
    none = rules.rule_match(ev, spark.createDataFrame([(1, "arm")], "uid long, type string"), spark.createDataFrame([], rules.RULES))
    assert none.collect() == [] and none.columns == ["rule", "alert_severity", "actions", "uid", "device", "value", "device_type"]


def test_matches_beyond_a_batch(spark, monkeypatch):
    monkeypatch.setattr(rules, "ROWS", 7)
    batch = rules.pa.RecordBatch.from_pydict({"device_type": ["a", "b", "a"], "x": [1.0, 50.0, 30.0]})
    table = rules.pa.table({"uid": list(range(40)), "field": ["x"] * 40, "op": ["gt"] * 40, "value": [str(k) for k in range(40)], "device_type": [None] * 30 + ["a"] * 10, "severity": ["w"] * 40, "actions": [["alert"]] * 40})
    index = rules.build(table, {"x"})
    parts = list(rules.match_batch(batch, index, {"x"}, "device_type"))
    assert all(len(e) <= 7 for e, _ in parts)
    assert sorted((int(e), int(p)) for es, ps in parts for e, p in zip(es, ps)) == sorted([(0, 0), *((1, k) for k in range(30)), *((2, k) for k in range(30))])


# ---------------------------------------------------------------- segments


def test_split_frames_equal_window(spark):
    """One device holds nearly all rows; ranges, not devices, decide what a task holds."""
    r = random.Random(3)
    rows = [(k, r.choice([1, 1, 1, 1, 1, 1, 1, 2, None]), r.randint(0, 5000), r.choice("aab")) for k in range(6000)]
    df = spark.createDataFrame(rows, "uid long, device long, ts long, type string").repartition(5)
    one, two = (frames.episode_frames(df, "device", ["ts", "uid"], 30, hot_rows=n) for n in (10**9, 100))
    pick = lambda x: sorted(map(tuple, x.select("uid", "device", "frame_index", "timestamp_ns").collect()))
    assert pick(one) == pick(two)
    one, two = (frames.episode_runs(df, ["device"], ["ts", "uid"], "type", hot_rows=n) for n in (10**9, 100))
    pick = lambda x: sorted(map(tuple, x.select("device", "run", "type", "n_frames", "repeated").collect()), key=repr)
    assert pick(one) == pick(two) and len(pick(one)) > 1000
    dealt = frames.segments(df.filter("device = 1"), ["device"], ["ts", "uid"]).groupBy("_p").count().collect()
    assert len(dealt) == 8 and max(x["count"] for x in dealt) < 0.3 * sum(x["count"] for x in dealt)


def test_split_runs_of_one_type_and_nulls(spark):
    df = spark.createDataFrame([(1, k, None if 300 <= k < 600 else "a") for k in range(900)], "s int, k int, e string").repartition(4)
    got = sorted((r.run, r.e or "", r.n_frames, r.repeated) for r in frames.episode_runs(df, ["s"], ["k"], "e", hot_rows=10).collect())
    assert got == [(1, "a", 300, False), (2, "", 300, False), (3, "a", 300, True)]


# ---------------------------------------------------------------- edits


def test_bad_lines_of_many_files(spark, tmp_path):
    r = random.Random(2)
    want = set()
    for f in range(40):
        lines = [r.choice(['{"a": 1}', "", "  ", '{"a": 2}']) for _ in range(r.randint(1, 60))]
        for k in r.sample(range(len(lines)), min(len(lines), f % 3)):
            lines[k] = r.choice(["[1]", "nonsense", '{"a": 1', "7"])
            want.add((f"f{f}.jsonl", k + 1, lines[k]))
        (tmp_path / f"f{f}.jsonl").write_text("\n".join(lines) + r.choice(["", "\n"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "150b"):  # several files in a task, several tasks a file
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            good, bad = tables.edit_lines(spark, str(tmp_path / "*.jsonl"), "a long")
            assert {(os.path.basename(x.file), x.line, x.text) for x in bad.collect()} == want
            assert good.count() == sum(line.strip().endswith("}") for p in tmp_path.iterdir() for line in p.read_text().split("\n"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError, match="line 1 from|line [0-9]+ from"):
        tables.edits_read(spark, str(tmp_path / "*.jsonl"), "a long")


def test_store_rewrites_touched_buckets_only(spark):
    keys, store = ["o", "i"], sinks.folder(spark)
    old = spark.range(2000).select(F.col("id").alias("o"), F.when(F.col("id") % 3 > 0, (F.col("id") % 7).cast("string")).alias("i"), F.lit("old").alias("v"))
    edits.create_store(old, store, keys, 32)
    path = lambda: {p: os.stat(p).st_mtime_ns for p in map(str, __import__("pathlib").Path(f"{store}/rows").rglob("*.parquet"))}
    files = path()
    new = spark.createDataFrame([(3, None, "delete", "x", 1), (4, "4", "upsert", "first", 1), (4, "4", "upsert", "last", 2), (9999, None, "upsert", "new", 1)], "o long, i string, action string, v string, t int")
    want = sorted(map(tuple, edits.edit_merge(old, new, keys, [F.col("t")], ["v"]).collect()), key=repr)
    n = edits.merge_store(spark, store, new, "b1", [F.col("t")], ["v"])
    assert 1 <= n <= 3 and sorted(map(tuple, edits.read_store(spark, store).select("o", "i", "v").collect()), key=repr) == want
    after = path()
    assert len(set(files) - set(after)) <= 3 and all(after[p] == t for p, t in files.items() if p in after)
    assert edits.merge_store(spark, store, new, "b1", [F.col("t")], ["v"]) == 0 and path() == after
    edits.merge_store(spark, store, new, "b2", [F.col("t")], ["v"])  # the same edits by another name change no row
    assert sorted(map(tuple, edits.read_store(spark, store).select("o", "i", "v").collect()), key=repr) == want
    gone = edits.read_store(spark, store).select("o", "i", F.lit("delete").alias("action"), "v", F.lit(9).alias("t"))
    edits.merge_store(spark, store, gone, "b3", [F.col("t")], ["v"])
    assert edits.read_store(spark, store).count() == 0


def test_delivery_goes_on_after_a_death(spark, tmp_path):
    taken, out = str(tmp_path / "taken"), sinks.folder(spark)
    os.makedirs(taken)
    df = spark.range(230).select(F.col("id").alias("uid"), F.lit("upsert").alias("action"))

    def send(chunk, rows, alive=True):
        if chunk == 7 and not alive:
            raise OSError("receiver is down")
        with open(f"{taken}/{chunk}", "a") as f:
            f.write(json.dumps([r["uid"] for r in rows]) + "\n")
        return len(rows)

    with pytest.raises(Exception, match="receiver is down"):
        edits.deliver(df, ["uid"], out, lambda c, r: send(c, r, False), 20, 3)
    first = {k: (tmp_path / "taken" / str(k)).read_text() for k in range(6)}
    log = edits.deliver(df, ["uid"], out, send, 20, 3).collect()
    assert sorted((r.chunk_index, r.n_edits, r.taken) for r in log) == [(k, 20, 20) for k in range(11)] + [(11, 10, 10)]
    assert all((tmp_path / "taken" / str(k)).read_text() == x for k, x in first.items())  # finished waves aren't sent again
    assert sorted(sum((json.loads((tmp_path / "taken" / str(k)).read_text().splitlines()[-1]) for k in range(12)), [])) == list(range(230))
    again = edits.deliver(df, ["uid"], out, send, 20, 3)
    assert again.count() == 12 and (tmp_path / "taken" / "11").read_text().count("\n") == 1
    assert edits.deliver(df.limit(0), ["uid"], sinks.folder(spark), send).collect() == []


# ---------------------------------------------------------------- redaction


def plain_redact(value, secret=False):
    """The redacted value of a parsed JSON text; objects as lists of pairs, so that repeated keys show."""
    if isinstance(value, tuple):
        return tuple((k, plain_redact(v, secret or redact._sensitive(k))) for k, v in value)
    if isinstance(value, list):
        return [plain_redact(v, secret) for v in value]
    if value is None:
        return None
    return "[redacted]" if secret else redact._by_shape(value) if isinstance(value, str) else value


def pairs(text):
    return json.loads(text, object_pairs_hook=tuple, parse_float=str, parse_int=str)


def test_clean_json_keeps_its_bytes(spark):
    clean = ['{"n": 1.0e3, "m":10000000000000000000000.5,"a":1,"a":2}', ' [ 1 ,\n2.50, -0.0 ]', '"x"', "1E5", '{"é":"ü\\u00e9\\n","k":[{},[],{"z":null}]}', "true", "", "not json", '{"k":1e400}']
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*clean, None])], "k int, j string")
    assert [r.j for r in redact.redact_json(df, "j").orderBy("k").collect()] == [*clean, None]
    part = '{"id":  1.0e3,"tok\\u0065n":{"a":[1,null,"x"],"a":true},"s":"see \\u0041KIAAAAAAAAAAAAAAAAA", "end":1.50}'
    assert redact.redact_json_text(part) == '{"id":  1.0e3,"tok\\u0065n":{"a":["[redacted]",null,"[redacted]"],"a":"[redacted]"},"s":"see [redacted]", "end":1.50}'


def test_redacted_json_equals_brute_force():
    r = random.Random(12)
    keys = ["a", "apiKey", "Tok-en", "x", "passwd", "X-Own-Api-Key", "pass word", "author", "é", 'q"', "auth", "private_key", "PrIvAtE Key Id"]
    texts = ["plain", "Bearer abc", "AKIA" + "B" * 16, "a\\n", "sk_live_" + "a" * 20, "f" * 40, "ü", "", 'he said "hi"', '"private_key_id": "x"', "keys: a_b"]

    def value(depth):
        kind = r.random()
        if depth and kind < 0.4:
            return "{" + r.choice(["", " "]) + ", ".join(f"{json.dumps(r.choice(keys), ensure_ascii=r.random() < 0.5)}{r.choice([':', ' : '])}{value(depth - 1)}" for _ in range(r.randint(0, 4))) + "}"
        if depth and kind < 0.6:
            return "[" + ",".join(value(depth - 1) for _ in range(r.randint(0, 3))) + "]"
        return r.choice(["null", "true", "1.0", "-2e5", "123456789012345678901234567890", json.dumps(r.choice(texts), ensure_ascii=r.random() < 0.5)])

    changed = 0
    for _ in range(3000):
        text = value(4)
        got = redact.redact_json_text(text)
        assert pairs(got) == plain_redact(pairs(text)) or any(x in text for x in ("1.0", "-2e5", "1234", "true"))
        kept = plain_redact(json.loads(text, object_pairs_hook=tuple))
        assert json.loads(got, object_pairs_hook=tuple) == kept
        if kept == json.loads(text, object_pairs_hook=tuple):
            assert got == text
        else:
            changed += 1
    assert changed > 500


def test_text_gates_lose_nothing(spark):
    hits = ["eyJa.b.c", "AKIA" + "A" * 16, "ASIA" + "A" * 16, "IQoJ" + "x" * 20, "1//" + "a" * 24, "pk_" + "a" * 20, "SECRET_" + "a" * 20, "token_live_" + "a" * 20, "sk-ab" + "c" * 24, "0123456789" * 4, "bEaReR abc", "x-own-aPi-Key=zz", "arn:aws-cn:s3:::b", '"PRIVATE_KEY_ID":"x"', "SecretAccessKey: " + "A" * 24, "-----BEGIN PRIVATE KEY-----x-----END PRIVATE KEY-----", "key_" + "b" * 16]
    rows = hits + [f"{a} {b}" for a, b in itertools.pairwise(hits)] + ["see secret things", "a key_ and token_", "1// 2", "b" * 39]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, t string")
    chain = F.col("t")
    for _, p in redact.PATTERNS:
        chain = F.regexp_replace(chain, p, redact.TOKEN)
    assert df.select(redact.redact_text(F.col("t")).alias("a"), chain.alias("b")).filter("a <> b").count() == 0
    want = {n: sum(r[0] > 0 for r in df.select(F.regexp_count("t", F.lit(p))).collect()) for n, p in redact.PATTERNS}
    assert {r.pattern: r.n_rows for r in redact.secret_report(df, "t").collect()} == want


# ---------------------------------------------------------------- files, messages, episodes, items


def test_inventory_equals_a_plain_walk(spark, tmp_path):
    r = random.Random(5)
    for k in range(120):
        folder = tmp_path.joinpath(*[r.choice(["a", ".b", "_c", "d e", "é=1"]) for _ in range(r.randint(0, 9))])
        folder.mkdir(parents=True, exist_ok=True)
        (folder / r.choice([f"f{k}.jpg", f".hidden{k}", f"_{k}"])).write_bytes(b"x" * r.randint(0, 50))
    (tmp_path / "empty").mkdir()
    want = {(os.path.relpath(os.path.join(d, n), tmp_path), os.path.getsize(os.path.join(d, n))) for d, _, names in os.walk(tmp_path) for n in names}
    for root in (str(tmp_path), f"file://{tmp_path}"):
        got = files.file_inventory(spark, root)
        assert {(x.relative_path, x.size_bytes) for x in got.collect()} == want and len(want) == 120
        assert all(x.path.startswith(f"file:{tmp_path}/") for x in got.collect())
    assert got.rdd.getNumPartitions() > 8  # folders are walked by several tasks


def test_messages_in_one_schema(spark, tmp_path):
    out = str(tmp_path / "m")
    spark.createDataFrame([("t", "m", 5, "x", 1)], "topic string, msgtype string, log_time_ns int, frame_id string, more int").write.parquet(out)
    got = tables.message_scan(spark, out)
    assert got.columns == [*(f.split(" ")[0] for f in tables.MESSAGE.split(", ")), "more"] and got.first().header_sec is None and dict(got.dtypes)["log_time_ns"] == "bigint"
    assert "ReadSchema: struct<topic:string>" in got.select("topic")._jdf.queryExecution().toString()
    spark.createDataFrame([("t", 1)], "topic string, log_time_ns long").write.parquet(out + "2")
    with pytest.raises(ValueError, match="msgtype missing"):
        tables.message_scan(spark, out + "2")


def test_episode_keys_against_metadata(spark):
    rows = spark.createDataFrame([(e, k, f"u{k}", [1.0, 2.0], "n") for e in range(3) for k in range(4)], "episode_index int, frame_index long, `observation.images.a` string, `observation.state` array<double>, note string")
    known = {"observation.images.a": {"dtype": "video"}, "observation.state": {"dtype": "float32"}, "note": {"dtype": "string"}}
    out = sinks.folder(spark)
    frames.episode_export(rows, out, 20, "t", features=known)
    got = tables.episode_scan(spark, out, [2])
    assert got.columns == ["episode_index", "frame_index", "timestamp_ns", "observation.images.a", "observation.state"]
    assert sorted(x.timestamp_ns for x in got.collect()) == [0, 50_000_000, 100_000_000, 150_000_000]
    assert sorted(x.timestamp_ns for x in tables.episode_scan(spark, out, [0], fps=10).collect())[1] == 100_000_000
    assert tables.episode_scan(spark, out, state_keys=["note"]).columns[-1] == "note"
    for wrong, said in (({"camera_keys": ["observation.images.z"]}, "unknown camera keys"), ({"camera_keys": ["note"]}, "unknown camera keys"), ({"state_keys": ["x"]}, "unknown state keys"), ({"camera_keys": []}, "no camera"), ({"episodes": [3]}, "out of range"), ({"episodes": []}, "no episodes")):
        with pytest.raises(ValueError, match=said):
            tables.episode_scan(spark, out, **wrong)
    bare = sinks.folder(spark)
    frames.episode_export(rows, bare, 20, "t")
    with pytest.raises(ValueError, match="has none"):
        tables.episode_scan(spark, bare, camera_keys=["observation.images.a"])


def test_two_rows_of_one_camera_are_an_error(spark):
    rows = [(1, 0, "a", 480, 640), (1, 0, "b", 480, 640), (1, 0, "a", 720, 640), (2, 0, "a", 1, 1)]
    df = spark.createDataFrame(rows, "sequence_uid long, frame_index long, camera string, height int, width int")
    with pytest.raises(Exception, match="camera names collide: a"):
        frames.feature_schema(df).collect()
    assert frames.feature_schema(df.filter("height < 700")).count() == 2


def test_siblings_of_large_and_odd_sequences(spark):
    items = spark.createDataFrame([(k, 1) for k in range(500)] + [(900, 2), (901, None), (902, 3), (903, 3)], "uid long, related_sequence_uid long")
    seq = spark.createDataFrame([(1, "one"), (3, "three")], "uid long, key string")
    got = {x.uid: (x.sequence and x.sequence.key, x.n_siblings, x.siblings) for x in col.item_siblings(items, seq, 4).collect()}
    assert len(got) == 504 and got[0] == ("one", 499, [1, 2, 3, 4]) and got[2] == ("one", 499, [0, 1, 3, 4]) and got[300] == ("one", 499, [0, 1, 2, 3])
    assert got[900] == (None, 0, []) and got[901] == (None, 0, []) and got[902] == ("three", 1, [903])


def test_old_scratch_folders_are_swept(spark, tmp_path):
    """In a folder of its own, so that no one else's are touched."""
    kept, old, other = (tmp_path / name for name in ("fieldloom-kept", "fieldloom-old", "mine"))
    for path in (kept, old, other):
        spark.range(2).write.parquet(str(path))
    assert scratch.sweep(spark, 1, str(tmp_path)) == 0
    for top in (old, other):
        for root, _, names in os.walk(top):
            for n in [root, *(os.path.join(root, x) for x in names)]:
                os.utime(n, (1, 1))
    assert scratch.sweep(spark, 1, str(tmp_path)) == 1
    assert kept.exists() and other.exists() and not old.exists()


def test_json_is_redacted_in_pieces(monkeypatch):
    monkeypatch.setattr(redact, "PIECE", 30)
    texts = ['{"token":"a"}', None, "x" * 50, "", '{"a":1}', '{"a":"b"}', "y" * 31, None]
    batch = redact.pa.RecordBatch.from_pydict({"j": texts, "k": list(range(8))})
    got = [b.column(0).to_pylist() for b in redact._pieces(batch, 0)]
    assert [x for b in got for x in b] == texts and [len(b) for b in got] == [2, 1, 3, 1, 1]
    assert list(redact._pieces(batch.slice(0, 0), 0)) == []


def test_export_files_follow_the_rows(spark):
    out = sinks.folder(spark)
    rows = spark.range(3000).selectExpr("id div 3 as episode_index", "id % 3 as frame_index", "id as v")
    frames.episode_export(rows, out, 10, "t")
    assert len(spark.read.parquet(out).inputFiles()) <= 16  # a thousand episodes
    got = tables.episode_scan(spark, out, [7, 999], ["v"])
    assert sorted(r.v for r in got.collect()) == [21, 22, 23, 2997, 2998, 2999]
    long = sinks.folder(spark)
    frames.episode_export(spark.range(200_000).selectExpr("5L as episode_index", "id as frame_index", "uuid() as v"), long, 10, "t")
    assert len(spark.read.parquet(long).inputFiles()) > 1  # a long episode is no one task's


def test_lines_are_parsed_once(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"a":1}\n \n{"a":2}\n')
    got = tables.edits_read(spark, str(tmp_path / "e.jsonl"), "a long")
    assert sorted(r.a for r in got.collect()) == [1, 2]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
