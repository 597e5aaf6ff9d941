"""Expected values of small cases, and what SQL can't check: errors, files, streams, shards."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import redact, urls
from fieldloom.operators import collections as col
from fieldloom.operators import edits, fleet, frames, quality
from fieldloom.plans import registry, sinks, views
from fieldloom.sources import files, tables
from fieldloom.streaming import jobs


def one(df):
    return df.collect()[0]


# ---------------------------------------------------------------- frames


def test_frame_at_out_of_range(spark, sf_dir):
    seq = registry.sequences(spark, sf_dir)
    assert frames.frame_at(seq, 10_000).count() == 0
    with pytest.raises(Exception, match="out of range"):
        frames.frame_at(seq, 10_000, strict=True).collect()
    with pytest.raises(IndexError):
        frames.frame_at(seq, -1)


def test_calibration_of_empty_sequence(spark, sf_dir):
    seq = registry.sequences(spark, sf_dir)
    none = seq.withColumn("frames", F.filter("frames", lambda f: F.lit(False)))
    assert frames.calibration(none).count() == 0
    assert {r.frame_count for r in frames.sequence_summary(none).collect()} == {0}


def test_camera_positions_keep_gaps(spark):
    rows = spark.createDataFrame([(1, ["", "b", None, "d"], [{"image_url": "x"}]), (2, [], [{"image_url": ""}, {"image_url": "y"}]), (3, ["", ""], [{"image_url": "z"}])], "k int, image_urls array<string>, images array<struct<image_url:string>>")
    got = sorted((r.k, r.camera, r.url) for r in frames.camera_urls(rows, "k").collect())
    assert got == [(1, "cam1", "b"), (1, "cam3", "d"), (2, "cam1", "y")]


def test_state_vector_takes_numbers_only(spark):
    texts = ['{"a":{"b":[1,2.5]}}', '{"a":{"b":[1,true]}}', '{"a":{"b":["2"]}}', '{"a":{"b":[]}}', '{"a":1}', '{"a":{"b":[1,null]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("raw", F.parse_json("t"))
    got = {r.k: (r.vector, r.problem) for r in frames.state_vector(df, "a.b", "k").collect()}
    assert got[0] == ([1.0, 2.5], None)
    assert all(got[k][0] is None and got[k][1] for k in range(1, 6))
    with pytest.raises(Exception, match="not all numbers"):
        frames.state_vector(df.filter("k = 1"), "a.b", "k", strict=True).collect()


def test_ego_pose_is_w_first(spark):
    df = spark.sql("select named_struct('x', 1D, 'y', 2D, 'z', 3D) device_position, named_struct('x', 4D, 'y', 5D, 'z', 6D, 'w', 7D) device_heading")
    assert one(frames.ego_pose(df)).pose == [1.0, 2.0, 3.0, 7.0, 4.0, 5.0, 6.0]


def test_message_times_and_report(spark):
    rows = [
        ("/camera/compressed", "sensor_msgs/msg/CompressedImage", 10**9, 1, 0, "", None, "jpeg"),
        ("/camera/raw", "sensor_msgs/msg/Image", 2 * 10**9, 2, 5, "f", "rgb8", None),
        ("/camera/depth/compressedDepth", "sensor_msgs/msg/CompressedImage", 3 * 10**9, 3, 0, None, None, "16UC1; compressedDepth png"),
        ("/camera/depth32", "sensor_msgs/msg/Image", 4 * 10**9, 0, 0, "", "32FC1", None),
        ("/chatter", "std_msgs/msg/String", 15 * 10**8, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "topic string, msgtype string, log_time_ns long, header_sec long, header_nanosec long, frame_id string, encoding string, format string")
    got = {r.topic: (r.timestamp_ns, r.frame_id) for r in frames.message_shape(df).collect()}
    assert got["/camera/raw"] == (2 * 10**9 + 5, "f") and got["/camera/depth32"] == (4 * 10**9, "camera.depth32") and got["/chatter"][0] == 15 * 10**8
    assert tuple(one(frames.conversion_report(df))) == (2, "/camera/depth/compressedDepth,/camera/depth32,/chatter")
    assert tuple(one(frames.conversion_report(df, ["/camera/raw"]))) == (1, "/chatter")
    with pytest.raises(Exception, match="nothing written"):
        frames.conversion_report(df, ["/none"], strict=True).collect()


def test_runs_keep_a_returning_episode(spark):
    df = spark.createDataFrame([(1, k, e) for k, e in enumerate([0, 0, 1, 1, 0])], "s int, k int, e int")
    got = sorted((r.run, r.e, r.n_frames, r.repeated) for r in frames.episode_runs(df, ["s"], ["k"], "e").collect())
    assert got == [(1, 0, 2, False), (2, 1, 2, False), (3, 0, 1, True)]


def test_export_and_scan(spark, sf_dir):
    rows = frames.episode_frames(views.view(spark, sf_dir, "v_states"), "episode_index", ["vec_id"], 10).select("episode_index", "frame_index", "vec_id")
    out = sinks.folder(spark)
    frames.episode_export(rows, out, 10, "pick")
    assert tables.episode_scan(spark, out).count() == rows.count()
    with pytest.raises(ValueError, match="out of range"):
        tables.episode_scan(spark, out, [99])
    with pytest.raises(ValueError, match="no such features"):
        tables.episode_scan(spark, out, columns=["nope"])


# ---------------------------------------------------------------- edits


def test_edit_rules(spark):
    cases = [
        ("upsert", "cuboid", "d", "i", None, None), ("delete", None, None, "i", "", None), ("move", "cuboid", "d", "i", None, "action"), (None, "cuboid", "d", "i", None, "action"),
        ("upsert", "sphere", "d", "i", None, "object_type"), ("upsert", None, "d", "i", None, "object_type"), ("upsert", "cuboid", None, "i", None, "object_data"), ("delete", "cuboid", None, "i", "s", "both targets"),
        ("delete", "cuboid", None, "", None, "no target"), ("delete", "cuboid 3d", None, "i", None, "item object_type"), ("delete", "cuboid", None, None, "s", "sequence object_type"), ("upsert", "point cloud polyline", "d", None, "s", None),
    ]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, action string, object_type string, object_data string, dataset_item_uid string, sequence_uid string, want string")
    ok, bad = edits.edit_validate(df.withColumn("object_uuid", F.lit("u")))
    assert {r.k for r in ok.collect()} == {k for k, c in enumerate(cases) if c[-1] is None}
    assert all(r.reason == r.want for r in bad.collect())


def test_merge_is_idempotent(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", None, "y"), ("c", "3", "z")], "o string, i string, v string")
    new = spark.createDataFrame([("a", "1", "delete", "q", 1), ("b", None, "upsert", "n", 2), ("d", "4", "upsert", "m", 1), ("d", "4", "upsert", "last", 2)], "o string, i string, action string, v string, t int")
    once = edits.edit_merge(old, new, ["o", "i"], [F.col("t")], ["v"])
    twice = edits.edit_merge(once, new, ["o", "i"], [F.col("t")], ["v"])
    want = [("b", None, "n"), ("c", "3", "z"), ("d", "4", "last")]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want


def test_chunks_and_shards(spark):
    df = spark.range(1234).withColumnRenamed("id", "uid")
    got = edits.edit_chunks(df, ["uid"], 500).collect()
    assert {r.uid // 500 == r.chunk_index and r.uid % 500 == r.chunk_row for r in got} == {True} and len(got) == 1234
    assert {r.chunk_index for r in edits.edit_chunks(df, ["uid"], 500, resume_after=0).collect()} == {1, 2}
    with pytest.raises(ValueError):
        edits.edit_chunks(df, ["uid"], 0)
    sharded = edits.shard_assign(df, 2, 3, ["uid"])
    assert tuple(one(edits.shard_cover_check(sharded, df))) == (1234, 0, 0, 0)
    assert tuple(one(edits.shard_cover_check(sharded.filter("shard < 5"), df)))[2] == 205
    assert {(r.rank, r.worker) for r in sharded.collect()} == {(a, b) for a in range(2) for b in range(3)}


def test_edits_read_errors(spark, tmp_path):
    p = tmp_path / "e.jsonl"
    p.write_text('{"action":"delete"}\n\n  \n{"action":"upsert"}\n')
    assert tables.edits_read(spark, str(p), "action string").count() == 2
    p.write_text('{"action":"delete"}\n[1]\n')
    with pytest.raises(Exception, match="not a JSON object"):
        tables.edits_read(spark, str(p), "action string").collect()
    q = tmp_path / "e.json"
    q.write_text('[{"action":"delete"}, {"action":"upsert"}]')
    assert tables.edits_read(spark, str(q), "action string").count() == 2


# ---------------------------------------------------------------- quality, fleet


def test_breach_and_history(spark):
    got = spark.range(1).select(quality.breached(F.lit(0.91), F.lit("gte"), F.lit(0.95)).alias("a"), quality.breached(F.lit(None).cast("double"), F.lit("gte"), F.lit(0.95)).alias("b"), quality.breached(F.lit(1.0), F.lit("lt"), F.lit(2.0)).alias("c"))
    assert tuple(one(got)) == (True, None, False)


def test_consensus_defaults(spark):
    rows = [(1, "t", a, 0.0, 0.0, 10.0, 10.0) for a in (1, 2)] + [(1, "t", 3, 100.0, 100.0, 110.0, 110.0), (2, "t", 1, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "item int, task string, annotator int, x0 double, y0 double, x1 double, y1 double")
    got = quality.consensus_scores(df).collect()
    assert [(r.item, round(r.score, 4), r.annotator_count, r.agreed) for r in got] == [(1, 0.3333, 3, False)]


def test_rules(spark, sf_dir):
    ev, dev = views.view(spark, sf_dir, "v_events"), views.view(spark, sf_dir, "v_devices")
    with pytest.raises(ValueError, match="unknown operator"):
        fleet.rule_match(ev, dev, [{"uid": 1, "field": "value", "op": "near", "value": 1}])


def test_device_maintenance_wins(spark):
    t = dt.datetime(2024, 1, 1)
    dev = spark.createDataFrame([(1, "maintenance"), (2, "offline"), (3, "online")], "uid long, status string")
    ev = spark.createDataFrame([(1, t), (2, t)], "device long, ts timestamp")
    got = {r.device: r.status for r in fleet.device_last_seen(ev, dev, F.lit("2024-01-01 00:01:00").cast("timestamp"), 300).collect()}
    assert got == {1: "maintenance", 2: "online", 3: "offline"}


def test_uploads(spark):
    p = lambda *xs: spark.createDataFrame([(x,) for x in xs], "path string")
    got = {r.path: (r.confirmed, r.remaining) for r in fleet.upload_reconcile(p("a", "b", "c"), p("a", "z"), p("a", "b")).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (True, False), "z": (True, False)}


# ---------------------------------------------------------------- listings


def test_filters_and_pages(spark, sf_dir):
    dev = views.view(spark, sf_dir, "v_devices")
    assert col.entity_filter(dev, "devices", status=None).count() == dev.count()
    with pytest.raises(ValueError):
        col.entity_filter(dev, "devices", color="red")
    named = col.entity_filter(dev, "datasets", name="OMER#0000000")
    assert named.count() > 0
    people = spark.createDataFrame([("Ann", None, None, "a"), ("bob", "x@ANN.org", None, "a"), ("c", "c", "c", "b")], "username string, email string, full_name string, role string")
    assert col.entity_filter(people, "members", search="ann", role="a").count() == 2
    with pytest.raises(LookupError):
        col.entity_get(dev, strict=True, uid=-1)
    seen, cursor = [], None
    while True:
        page = col.keyset_page(dev.select("uid"), ["uid"], 37, cursor).collect()
        seen += [r.uid for r in page]
        cursor = page[0].next_cursor
        if cursor is None:
            break
    assert seen == sorted(r.uid for r in dev.collect())
    with pytest.raises(ValueError):
        col.keyset_page(dev, ["uid"], 0)


def test_annotation_export_needs_one_scope(spark, sf_dir):
    with pytest.raises(ValueError):
        col.annotation_export(views.view(spark, sf_dir, "v_items"))


# ---------------------------------------------------------------- files, URLs, redaction


def test_media_types(spark):
    want = {"a.JPG": "image", "b.compressed.ply": "splat", "c.ply": "splat", "d.pcd": None, "e.bin": None, "f.alp.gz": "lidar", "g.mkv": "video", "h": None, "i.tar.mcap": "mcap"}
    df = spark.createDataFrame([(k,) for k in want], "key string")
    assert {r.key: r.t for r in df.select("key", files.media_type(F.col("key")).alias("t")).collect()} == want
    with pytest.raises(Exception, match="several types"):
        files.resolve_data_type(df, strict=True).collect()
    assert one(files.resolve_data_type(df.filter("key like '%ply'"))).data_type == "splat"
    with pytest.raises(Exception, match="no file is indexed"):
        files.indexable_guard(df.filter("key = 'h'"), "video", strict=True).collect()
    with pytest.raises(ValueError):
        files.indexable_guard(df, "text")


def test_inventory(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.jpg").write_bytes(b"1" * 1280)
    (tmp_path / "y.bin").write_bytes(b"22")
    got = files.file_inventory(spark, str(tmp_path))
    assert sorted((r.relative_path, r.size_bytes) for r in got.collect()) == [("a/x.jpg", 1280), ("y.bin", 2)]
    assert [r.relative_path for r in files.file_inventory(spark, str(tmp_path / "y.bin")).collect()] == ["y.bin"]
    assert {r.media_type: r.size for r in files.inventory_summary(got).collect()} == {"image": "1.2 KB", "unknown": "2.0 B", "all": "1.3 KB"}
    assert files.parse_uri("s3://b/p/q") == ("aws_s3", "b", "p/q") and files.parse_uri("gcs://b") == ("gc_storage", "b", "")
    for bad in ("s3://", "http://b/p"):
        with pytest.raises(ValueError):
            files.parse_uri(bad)
    assert one(spark.range(1).select(files.clean_csv(F.lit("jpg, png,, ")).alias("c"))).c == "jpg,png"


def test_cursor_and_urls(spark):
    cases = {"https://h/x?cursor=abc123&limit=10": "abc123", "https://h/x?page=2": "2", "https://h/x?cursor=&page=3": "3", "https://h/x": None, None: None, "https://h/x?cursor=a%3D%3D": "a=="}
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.c for r in df.select("u", tables.cursor_of(F.col("u")).alias("c")).collect()} == cases
    rows = ["https://h/a/../b", "https://h/%2E%2e/b", "https://h/a//b", "https://H:443/a", "http://h:8080/a", "https://x.amazonaws.com/k", "https://evilamazonaws.com/k", "http://x.amazonaws.com/k", "https://h:99999/", "no url"]
    got = {r.u: r for r in urls.url_audit(spark.createDataFrame([(r,) for r in rows], "u string"), "u").collect()}
    assert got[rows[0]].traversal and got[rows[1]].encoded_traversal and got[rows[2]].double_slash
    assert got[rows[3]].origin == "https://h" and got[rows[4]].origin == "http://h:8080" and got[rows[8]].origin == "" and got[rows[9]].origin == ""
    assert [got[r].allowed_host for r in rows[5:8]] == [True, False, False]


def test_redaction(spark):
    secrets = ["eyJa.b.c", "AKIA" + "A" * 16, "FwoG" + "x" * 20, "1//" + "a" * 24, "sk_live_" + "a" * 20, "sk-ab" + "c" * 24, "a" * 40, "Bearer abc.def", "X-Some-Api-Key: zzz", "arn:aws:s3:::b/k", '"private_key_id": "x"', "aws_secret_access_key=" + "A" * 24, "-----BEGIN RSA PRIVATE KEY-----\nx\n-----END RSA PRIVATE KEY-----"]
    df = spark.createDataFrame([(f"see {s} there",) for s in secrets] + [("plain $1 text",), (None,)], "t string")
    got = [r.t for r in df.select(redact.redact_text(F.col("t")).alias("t")).collect()]
    assert got[:-2] == ["see [redacted] there"] * len(secrets) and got[-2:] == ["plain $1 text", None]
    again = df.select(redact.redact_text(redact.redact_text(F.col("t"))).alias("t")).collect()
    assert [r.t for r in again] == got
    doc = {"a": {"api_key": 123, "Password": None, "token": {"x": [True, "y"]}}, "n": 5, "s": "Bearer q", "X-My-Api-Key": "k"}
    out = json.loads(one(redact.redact_json(spark.createDataFrame([(json.dumps(doc), 1)], "j string, k int"), "j")).j)
    assert out == {"a": {"api_key": "[redacted]", "Password": None, "token": {"x": ["[redacted]"] * 2}}, "n": 5, "s": "[redacted]", "X-My-Api-Key": "[redacted]"}
    report = {r.pattern: r.n_rows for r in redact.secret_report(df, "t").collect()}
    assert report["jwt"] == 1 and report["hex40"] == 1


def test_typed_read(spark):
    rows = ['{"uid":"a","name":"n","slug":"s","extra":1,"created_at":"2024-01-02T03:04:05Z"}', '{"uid":"a","name":"n"}', "nonsense", '{"uid":"b","name":"n","slug":"s","item_count":7,"created_at":"yesterday"}']
    ok, bad = tables.typed_read(spark.createDataFrame([(r,) for r in rows], "json string"), "dataset")
    got = one(ok)
    assert (got.uid, got.item_count, got.created_at) == ("a", 0, dt.datetime(2024, 1, 2, 3, 4, 5))
    assert {r.reason for r in bad.collect()} == {"missing slug", "not a JSON object of this kind", "bad time in created_at"}


# ---------------------------------------------------------------- streams


def test_stream_alerts_equal_batch(spark, sf_dir):
    batch = views.view(spark, sf_dir, "v_events")
    src = sinks.folder(spark)
    batch.repartition(4).write.parquet(src)
    dev = views.view(spark, sf_dir, "v_devices")
    stream = jobs.rule_alerts(jobs.read_files(spark, src, batch.schema, 1), dev, registry.RULES)
    q = stream.writeStream.format("memory").queryName("alerts_out").trigger(availableNow=True).option("checkpointLocation", sinks.folder(spark)).start()
    q.awaitTermination()
    want = fleet.alerts_of(registry.matches(spark, sf_dir))
    assert spark.table("alerts_out").exceptAll(want).count() == 0 and spark.table("alerts_out").count() == want.count()
    q = jobs.last_seen(jobs.read_files(spark, src, batch.schema, 1)).writeStream.outputMode("complete").format("memory").queryName("seen_out").trigger(availableNow=True).option("checkpointLocation", sinks.folder(spark)).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("seen_out").collect())) == sorted(map(tuple, jobs.last_seen(batch).collect()))


def test_stream_lifecycle_equals_batch(spark, sf_dir):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    acts = registry.actions(spark, sf_dir)
    src = sinks.folder(spark)
    acts.coalesce(1).write.parquet(src)
    stream = jobs.alert_lifecycle(jobs.read_files(spark, src, acts.schema))
    q = stream.writeStream.outputMode("update").format("memory").queryName("life_out").trigger(availableNow=True).option("checkpointLocation", sinks.folder(spark)).start()
    q.awaitTermination()
    got = sorted(map(tuple, spark.table("life_out").collect()), key=repr)
    assert got == sorted(map(tuple, fleet.alert_lifecycle(acts).collect()), key=repr)


def test_resume_loads_once(spark, sf_dir):
    got = registry.QUERIES["ingest_resume"](spark, sf_dir)
    assert got.count() == got.select("event_id").distinct().count() == views.table(spark, sf_dir, "events").count()


def test_issue_names_are_given_each_on_its_own(spark):
    issues = spark.createDataFrame([(1, 1, 10, 5), (2, 1, None, 5), (3, 1, 99, None), (4, 2, 10, 6), (5, None, 10, 5), (6, 3, 10, 5)], "uid long, tool_uid long, problem_uid long, project_uid long")
    tools = spark.createDataFrame([(1, "box", "lidar", [(10, "late"), (11, "cut")]), (2, "line", "image", [])], "uid long, name string, dataset_type string, problems array<struct<uid:long,title:string>>")
    projects = spark.createDataFrame([(5, "east")], "uid long, name string")
    got = quality.issue_enrich(issues, tools, projects).select("uid", "tool_name", "dataset_type", "problem_title", "project_name")
    want = [(1, "box", "lidar", "late", "east"), (2, "box", "lidar", None, "east"), (3, "box", "lidar", None, None), (4, "line", "image", None, None), (5, None, None, None, "east"), (6, None, None, None, "east")]
    assert sorted(map(tuple, got.collect())) == want
    assert "project_name" not in quality.issue_enrich(issues, tools).columns


def test_pages_by_text_and_mixed_keys(spark):
    rows = spark.createDataFrame([(c, k) for c in ('a"b', "a,c", "d", "é") for k in range(5)], "uid string, k long")
    for order in (["uid", "k"], ["k", "uid"]):
        got, cursor = [], None
        while True:
            page = col.keyset_page(rows, order, 7, cursor).collect()
            got += [(r.uid, r.k) for r in page]
            cursor = page[0].next_cursor
            if cursor is None:
                break
        assert got == [(r.uid, r.k) for r in rows.orderBy(*order).collect()]
    one = col.keyset_page(rows.select("uid").distinct(), ["uid"], 2).collect()
    assert col.decode_cursor(one[0].next_cursor) == ["a,c"]
    assert [r.uid for r in col.keyset_page(rows.select("uid").distinct(), ["uid"], 2, one[0].next_cursor).collect()] == ["d", "é"]


def test_first_episode_alone(spark, tmp_path):
    out = str(tmp_path / "one")
    spark.createDataFrame([(0, 0), (0, 1)], "episode_index int, frame_index int").write.partitionBy("episode_index").parquet(out)
    assert tables.episode_scan(spark, out, [0]).count() == 2
    with pytest.raises(ValueError):
        tables.episode_scan(spark, out, [1])


def test_edits_need_the_object_uuid_field(spark):
    row = ("upsert", "1", None, "cuboid", "{}", None)
    schema = "action string, dataset_item_uid string, sequence_uid string, object_type string, object_data string, object_uuid string"
    whole = spark.createDataFrame([row], schema)
    assert edits.edit_validate(whole)[0].count() == 1
    assert [r.reason for r in edits.edit_validate(whole.drop("object_uuid"))[1].collect()] == ["object_uuid"]


def test_no_enabled_rule_no_rows(spark):
    ev, dev = spark.createDataFrame([(1, 7, 2.0)], "uid long, device long, value double"), spark.createDataFrame([(7, "arm")], "uid long, type string")
    rule = {"uid": 5, "field": "value", "op": "gt", "value": 1}
    assert fleet.rule_match(ev, dev, [rule]).count() == 1
    for rules in ([], [rule | {"enabled": False}]):
        assert fleet.rule_match(ev, dev, rules).collect() == []


def test_empty_tree_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        files.file_inventory(spark, str(tmp_path / "empty"))


def test_bad_line_tells_its_place(spark, tmp_path):
    p = tmp_path / "e.jsonl"
    p.write_text('{"a": 1}\n\n{"a": 2}\nnonsense\n')
    with pytest.raises(Exception, match=r"line 4 from byte 0 of .*e\.jsonl: nonsense"):
        tables.edits_read(spark, str(p), "a long").collect()


def test_missing_refs_without_edits_of_a_kind(spark):
    e = spark.createDataFrame([("1", None), ("2", None), ("2", None), ("", None)], "dataset_item_uid string, sequence_uid string")
    known = spark.createDataFrame([(2,)], "uid long")
    assert sorted(map(tuple, edits.missing_refs(e, known, known).collect())) == [("item", 1, 2, "1"), ("sequence", 0, 0, "")]


def test_numeric_features(spark):
    rows = spark.createDataFrame([(2, 0, [1.0], [1.0]), (1, 1, [9.0], [1.0]), (1, 0, [1.0, 2.0, 3.0], [0.1, 0.2]), (1, 2, None, [0.1])], "sequence_uid long, frame_index long, s array<double>, a array<double>")
    got = {r.feature: (r.dim, r.names) for r in frames.vector_features(rows, state="s", action="a").collect()}
    assert got == {"observation.state": (3, ["state_0", "state_1", "state_2"]), "action": (2, ["action_0", "action_1"])}
    pose = frames.vector_features(rows.withColumn("p", F.array(*[F.lit(float(k)) for k in range(7)])), pose="p").first()
    assert (pose.feature, pose.dim, pose.names) == ("observation.state", 7, frames.POSE)
    with pytest.raises(ValueError, match="not both"):
        frames.vector_features(rows, state="s", pose="a")
    with pytest.raises(Exception, match="no vector"):
        frames.vector_features(rows.filter("s is null"), state="s").collect()
    assert frames.vector_features(rows.limit(0), state="s").collect() == []
    drift = frames.vector_drift(rows, "s", 3, "sequence_uid", "frame_index").collect()
    assert sorted((r.sequence_uid, r.frame_index, r.actual) for r in drift) == [(1, 1, 1), (1, 2, 0), (2, 0, 1)]


def test_chosen_cameras_exist(spark):
    features = spark.createDataFrame([("cam0", 6, 8), ("cam1", 6, 8)], "camera string, height long, width long")
    assert [r.camera for r in frames.choose_cameras(features, ["cam1"]).collect()] == ["cam1"]
    with pytest.raises(ValueError, match="cam7"):
        frames.choose_cameras(features, ["cam0", "cam7"])


def test_issue_metrics_of_nulls_and_nothing(spark):
    schema = "status string, priority string, severity string, problem_uid long, object_uid long, reporter_type string, created_at timestamp, closed_at timestamp"
    at = F.lit("2000-01-01 00:00:10").cast("timestamp")
    t = lambda k: dt.datetime(2000, 1, 1, 0, 0, k)
    rows = [("open", None, "minor", 1, 5, "customer", t(0), None), ("open", "p", "minor", 1, 5, "staff", t(4), None), ("closed", "p", "minor", 2, None, "staff", t(1), t(3))]
    got = quality.issue_metrics(spark.createDataFrame(rows, schema), at).first()
    assert (got.status_count, got.priority_count, got.object_count_by_problem) == ('{"closed":1,"open":2}', '{"null":1,"p":2}', '{"1":1,"2":0}')
    assert (got.mean_seconds_close_time_all, got.mean_seconds_close_time_customer, got.mean_unresolved_issue_age_all, got.mean_unresolved_issue_age_customer) == (2, None, 8, 10)
    none = quality.issue_metrics(spark.createDataFrame([], schema), at).first()
    assert none.status_count == "{}" and none.mean_seconds_close_time_all is None


def test_streamed_ingest_equals_batch(spark, sf_dir, tmp_path):
    src = str(tmp_path / "in")
    rows = registry.event_json(spark, sf_dir)
    rows.repartition(3).write.parquet(src)
    for k, (stream, batch) in enumerate(zip(jobs.event_ingest(jobs.read_files(spark, src, rows.schema, 1)), tables.typed_read(rows, "event"), strict=True)):
        run = stream.writeStream.format("memory").queryName(f"ingest{k}").option("checkpointLocation", str(tmp_path / f"c{k}")).trigger(availableNow=True).start()
        run.awaitTermination()
        assert spark.table(f"ingest{k}").count() == batch.count() > 0
