"""Stream forms against their batch forms: ingest with repeats, presence, rule tables, notes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import fleet, rules
from fieldloom.plans import registry, sinks, views
from fieldloom.streaming import jobs

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_ingest_takes_repeats_once(rocks, sf_dir, tmp_path):
    spark, src, out, check = rocks, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = registry.event_json(spark, sf_dir)
    rows.repartition(3).write.parquet(src)
    jobs.ingest(jobs.read_files(spark, src, rows.schema, 1), out, check, "3650 days").awaitTermination()
    ok, bad = jobs.tables.typed_read(rows, "event")
    sizes = lambda: (spark.read.parquet(f"{out}/events").count(), spark.read.parquet(f"{out}/quarantine").count())
    assert sizes() == (ok.count(), bad.count())
    rows.limit(200).write.mode("append").parquet(src)  # files that repeat rows, and one new row
    fresh = rows.limit(1).select(F.regexp_replace("json", '"label":"l"', '"label":"new"').alias("json"))
    fresh.write.mode("append").parquet(src)
    jobs.ingest(jobs.read_files(spark, src, rows.schema, 1), out, check, "3650 days").awaitTermination()
    again = sizes()
    assert again[0] == ok.count() + jobs.tables.typed_read(fresh, "event")[0].count()
    counts = spark.read.parquet(f"{out}/counts").agg(F.sum("created"), F.sum("rejected")).first()
    assert tuple(counts) == again


def test_ingest_state_ends_with_the_watermark(rocks, tmp_path):
    spark, src = rocks, str(tmp_path / "in")
    row = lambda k, day: (f'{{"recording":"r{k}","device":"d","label":"l","type":"t","timestamp":"2024-01-{day:02d}T00:00:00Z"}}',)
    for day in (1, 2, 9, 20):
        spark.createDataFrame([row(k, day) for k in range(50)], "json string").coalesce(1).write.mode("append").parquet(src)
    query = jobs.ingest(jobs.read_files(spark, src, "json string", 1), str(tmp_path / "out"), str(tmp_path / "check"), "3 days")
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert spark.read.parquet(str(tmp_path / "out" / "events")).count() == 200 and kept[-1] <= 100


def test_presence_equals_batch_at_each_watermark(rocks):
    spark, src, check = rocks, sinks.folder(rocks), sinks.folder(rocks)
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    steps = [[(1, 0), (2, 5), (3, 7)], [(1, 40)], [(2, 90), (4, 91)], [(5, 400)], [(1, 401), (5, 401)]]
    schema, devices = "device long, ts timestamp", spark.createDataFrame([(k, "maintenance" if k == 3 else "online") for k in range(1, 7)], "uid long, status string")
    latest, seen = {}, []
    for step in steps:
        rows = spark.createDataFrame([(d, at(s)) for d, s in step], schema)
        rows.coalesce(1).write.mode("append").parquet(src)
        seen += step
        got = []
        states = jobs.presence(jobs.read_files(spark, src, schema, 1), 60)
        states.writeStream.outputMode("update").option("checkpointLocation", check).foreachBatch(lambda df, _, got=got: got.extend(df.collect())).trigger(availableNow=True).start().awaitTermination()
        for r in got:
            if r.device not in latest or r.last_seen_us >= latest[r.device][0]:
                latest[r.device] = (r.last_seen_us, r.status)
        held = jobs.with_maintenance(spark.createDataFrame([(d, u, s) for d, (u, s) in latest.items()], "device long, last_seen_us long, status string"), devices)
        whole = spark.createDataFrame([(d, at(s)) for d, s in seen], schema)
        want = fleet.device_last_seen(whole, devices, F.lit(str(max(at(s) for _, s in seen))).cast("timestamp"), 60).filter("last_seen_at is not null")
        assert {r.device: r.status for r in held.collect()} == {r.device: r.status for r in want.collect()}


def test_streamed_notes_equal_batch(rocks, sf_dir):
    spark, src = rocks, sinks.folder(rocks)
    acts = registry.actions(spark, sf_dir).withColumn("note", F.when(F.col("tie") % 3 > 0, F.concat(F.lit("n"), "tie")))
    acts.coalesce(1).write.parquet(src)
    stream = jobs.alert_lifecycle(jobs.read_files(spark, src, acts.schema))
    stream.writeStream.outputMode("update").format("memory").queryName("notes_out").trigger(availableNow=True).option("checkpointLocation", sinks.folder(spark)).start().awaitTermination()
    pick = lambda df: sorted(map(tuple, df.select("alert", "status", "acknowledged_at", "acknowledged_by", "resolved_at", "resolution_note").collect()), key=repr)
    assert pick(spark.table("notes_out")) == pick(fleet.alert_lifecycle(acts))


def test_streamed_messages_equal_batch(spark, sf_dir):
    src, batch, dev = sinks.folder(spark), views.view(spark, sf_dir, "v_events"), views.view(spark, sf_dir, "v_devices")
    batch.coalesce(1).write.parquet(src)
    stream = jobs.rule_alerts(jobs.read_files(spark, src, batch.schema), dev, registry.RULES, "uid")
    stream.writeStream.format("memory").queryName("message_out").trigger(availableNow=True).option("checkpointLocation", sinks.folder(spark)).start().awaitTermination()
    want = fleet.alerts_of(registry.matches(spark, sf_dir), "uid")
    assert spark.table("message_out").exceptAll(want).count() == 0 and spark.table("message_out").count() == want.count()


def test_rule_table_changes_between_batches(spark, tmp_path):
    src, out, check, table = (str(tmp_path / x) for x in ("in", "out", "check", "rules"))
    schema = "uid long, device long, ts timestamp, value double"
    devices = spark.createDataFrame([(1, "arm"), (2, "cart")], "uid long, type string")
    at, read = dt.datetime(2024, 1, 1), lambda: spark.read.schema(rules.RULES).parquet(table)
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    rule = lambda *r: spark.createDataFrame([r], rules.RULES).write.mode("append").parquet(table)
    rule(1, True, "value", "gt", "5", "arm", "critical", ["alert"])
    put([(1, 1, at, 6.0), (2, 1, at, 5.0), (3, 2, at, 9.0)])
    jobs.rule_table_alerts(jobs.read_files(spark, src, schema), devices, read, out, check, "uid").awaitTermination()
    rule(2, None, "value", "lte", "1", None, None, None)
    put([(4, 2, at, 1.0), (5, 1, at, 7.0)])
    jobs.rule_table_alerts(jobs.read_files(spark, src, schema), devices, read, out, check, "uid").awaitTermination()
    got = sorted((r.rule, r.event, r.severity, r.message) for r in spark.read.parquet(f"{out}/alerts").collect())
    assert got == [(1, 1, "critical", "rule 1: event 1 of device 1"), (1, 5, "critical", "rule 1: event 5 of device 1"), (2, 4, "warning", "rule 2: event 4 of device 2")]
    assert {r.rule: r.hit_count for r in jobs.hit_counts(spark, out).collect()} == {1: 2, 2: 1}


@pytest.mark.parametrize(("batches", "want"), [(2, [3, 2]), (1, [5])])
def test_streamed_rows_keep_their_partitions(spark, tmp_path, batches, want):
    """No task of the source holds more than a partition of the rows, however many micro-batches they come in."""
    rows, seen = spark.range(50).repartition(5), []
    stream = sinks.streamed(spark, rows, batches)
    write = lambda got, k: seen.append((got.select(F.input_file_name()).distinct().count(), got.count()))
    stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [n for n, _ in seen] == want and sum(n for _, n in seen) == 50
