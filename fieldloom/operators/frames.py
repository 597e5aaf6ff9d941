"""Frames, calibration and episodes.

A sequence row has `frames`, an array of structs in order. Order is always explicit: a list position or a column.
Validation gives violation rows; strict variants raise.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import scratch

NS = 1_000_000_000


def _first(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def frames_explode(sequences: DataFrame, key: str = "sequence_uid") -> DataFrame:
    """All frames with frame_index, their place in the list; a sequence without frames gives none."""
    return sequences.select(key, F.posexplode("frames").alias("frame_index", "frame")).select(key, F.col("frame_index").cast("long").alias("frame_index"), "frame")


def frame_at(sequences: DataFrame, index: int, key: str = "sequence_uid", strict: bool = False) -> DataFrame:
    """Frame `index` of each sequence, model and camera_model standing in for each other. Out of range: no row, or an error when strict."""
    if index < 0:
        raise IndexError("frame index must not be negative")
    inside = F.size("frames") > index
    frame = F.get("frames", F.lit(index))
    if strict:
        frame = F.when(~inside, F.raise_error(F.lit(f"frame {index} is out of range"))).otherwise(frame)
    else:
        sequences = sequences.filter(inside)
    got = sequences.select(key, frame.alias("f"))
    return got.select(key, F.lit(index).cast("long").alias("frame_index"), _first(F.col("f.model"), F.col("f.camera_model")).alias("model"), _first(F.col("f.camera_model"), F.col("f.model")).alias("camera_model"), "f.xi", "f.alpha", "f.device_position", "f.device_heading", "f.images")


def calibration(sequences: DataFrame, key: str = "sequence_uid") -> DataFrame:
    """One row per camera of frame 0. Model falls through on empty text, xi and alpha on null only (0.0 stays)."""
    got = sequences.filter(F.size("frames") > 0).select(key, F.get("frames", F.lit(0)).alias("f"))
    got = got.select(key, "f", F.posexplode("f.images").alias("camera_index", "i"))
    return got.select(
        key,
        F.col("camera_index").cast("long").alias("camera_index"),
        _first(F.col("i.camera"), F.col("i.camera_id"), F.col("i.sensor_id")).alias("camera_id"),
        *[F.col(f"i.{c}").alias(c) for c in ("fx", "fy", "cx", "cy", "width", "height")],
        _first(F.col("i.model"), F.col("i.camera_model"), F.col("f.model")).alias("model"),
        F.coalesce("i.xi", "f.xi").alias("xi"),
        F.coalesce("i.alpha", "f.alpha").alias("alpha"),
    )


def sequence_summary(sequences: DataFrame) -> DataFrame:
    """uid, key, status, real frame count and whether calibration is on."""
    return sequences.select("uid", "key", "status", F.coalesce(F.size("frames"), F.lit(0)).cast("long").alias("frame_count"), "dataset_uid", F.when(F.coalesce("lidar_calibration_enabled", F.lit(False)) | F.coalesce("camera_calibration_enabled", F.lit(False)), "on").otherwise("off").alias("calibration"))


def camera_urls(frames: DataFrame, *keys: str) -> DataFrame:
    """One row per frame and camera: `cam<i>` by place in image_urls, or in images where that list is missing or empty. Empty URLs go, places keep gaps."""
    urls = F.when(F.size("image_urls") > 0, F.col("image_urls")).otherwise(F.transform("images", lambda i: i["image_url"]))
    got = frames.select(*keys, F.posexplode(urls).alias("i", "url"))
    return got.filter(F.col("url") != "").select(*keys, F.concat(F.lit("cam"), F.col("i")).alias("camera"), "url")


def state_vector(frames: DataFrame, path: str, *keys: str, raw: str = "raw", strict: bool = False) -> DataFrame:
    """The vector at a dotted path of the raw frame (VARIANT), and a problem where it is missing, empty, or not all numbers
    (true and "2" are none). A vector is given whole or not at all."""
    found = F.try_variant_get(F.col(raw), "$." + path, "array<variant>")
    kinds = F.transform("v", lambda x: F.schema_of_variant(x))
    number = lambda k: k.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$")
    got = frames.select(*keys, found.alias("v"))
    problem = F.when(F.col("v").isNull(), f"no list at {path}").when(F.size("v") == 0, f"empty list at {path}").when(~F.coalesce(F.forall(kinds, number), F.lit(False)), f"not all numbers at {path}")
    if strict:
        problem = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(problem)
    got = got.select(*keys, "v", problem.alias("problem"))
    return got.select(*keys, F.when(F.col("problem").isNull(), F.transform("v", lambda x: F.try_variant_get(x, "$", "double").cast("float"))).alias("vector"), "problem")


def ego_pose(frames: DataFrame, *keys: str, strict: bool = False) -> DataFrame:
    """[x, y, z, qw, qx, qy, qz] as float32; a missing part gives a null vector and a problem."""
    parts = [F.col(f"device_position.{c}") for c in "xyz"] + [F.col(f"device_heading.{c}") for c in "wxyz"]
    whole = F.lit(True)
    for p in parts:
        whole = whole & p.isNotNull()
    problem = F.when(~whole, F.lit("incomplete pose"))
    if strict:
        problem = F.when(~whole, F.raise_error(F.lit("incomplete pose")))
    return frames.select(*keys, F.when(whole, F.array(*[p.cast("float") for p in parts])).alias("pose"), problem.alias("problem"))


def feature_schema(frames: DataFrame, sequence: str = "sequence_uid", order_by: str = "sequence_uid") -> DataFrame:
    """Features by camera of frame 0 of the first sequence that has frames: camera, height, width. `frames` is long: one row per frame and camera; two rows of one
    camera there are an error."""
    first = frames.agg(F.min(F.struct(order_by, "frame_index")).alias("x")).select("x.*").withColumnsRenamed({order_by: "first_sequence", "frame_index": "first_frame"})
    at = (frames[order_by] == first["first_sequence"]) & (frames["frame_index"] == first["first_frame"])
    got = frames.join(F.broadcast(first), at).groupBy("camera").agg(F.min("height").cast("long").alias("height"), F.min("width").cast("long").alias("width"), F.count("*").alias("n"))
    camera = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("camera names collide: "), F.col("camera").cast("string")))).otherwise(F.col("camera"))
    return got.select(camera.cast(frames.schema["camera"].dataType).alias("camera"), "height", "width")


#: Names of an ego pose's numbers.
POSE = ["x", "y", "z", "qw", "qx", "qy", "qz"]


def _numbered(name: str, n: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.lit(f"{name}_"), i))


def vector_features(frames: DataFrame, state: str | None = None, action: str | None = None, pose: str | None = None, sequence: str = "sequence_uid") -> DataFrame:
    """The numeric features of the first frame of the first sequence: feature, dtype, dim, names. `state`, `action` and `pose` are columns with vectors; state and pose
    are the same feature, so both at once are an error, as is a first frame without a wanted vector."""
    if state and pose:
        raise ValueError("give a state or an ego pose, not both: both are observation.state")
    wanted = [(f, c, kind) for f, c, kind in (("observation.state", state, "state"), ("observation.state", pose, "pose"), ("action", action, "action")) if c]
    if not wanted:
        raise ValueError("name a state, an action or a pose")
    first = frames.agg(F.min_by(F.struct(*[F.col(c).alias(kind) for _, c, kind in wanted]), F.struct(sequence, "frame_index")).alias("x"))
    rows = []
    for feature, c, kind in wanted:
        dim = F.size(F.when(F.size(f"x.{kind}") > 0, F.col(f"x.{kind}")).otherwise(F.raise_error(F.lit(f"the first frame has no vector in {c}"))))
        names = F.array(*[F.lit(n) for n in POSE]) if kind == "pose" else _numbered(kind, dim)
        rows.append(F.struct(F.lit(feature).alias("feature"), F.lit("float32").alias("dtype"), dim.cast("long").alias("dim"), names.alias("names")))
    return first.filter("x is not null").select(F.explode(F.array(*rows)).alias("f")).select("f.*")


def choose_cameras(features: DataFrame, cameras: list[str]) -> DataFrame:
    """The features of the named cameras; a name that no feature has is an error. One row a name comes to the driver."""
    known = {r["camera"] for r in features.filter(F.col("camera").isin(cameras)).select("camera").distinct().collect()}
    if gone := sorted(set(cameras) - known):
        raise ValueError(f"no such cameras: {gone}")
    return features.filter(F.col("camera").isin(cameras))


def camera_set_diff(frames: DataFrame, cameras: DataFrame, sequence: str = "sequence_uid") -> DataFrame:
    """Per frame: cameras that are missing and extra against the schema's (a table of one row per camera)."""
    want = cameras.agg(F.array_sort(F.collect_set("camera")).alias("want"))
    have = frames.groupBy(sequence, "frame_index").agg(F.collect_set("camera").alias("have"))
    both = have.crossJoin(F.broadcast(want))  # one row on the right
    return both.select(sequence, "frame_index", F.array_join(F.array_sort(F.array_except("want", "have")), ",").alias("missing"), F.array_join(F.array_sort(F.array_except("have", "want")), ",").alias("extra"))


def schema_drift(frames: DataFrame, features: DataFrame, sequence: str = "sequence_uid", strict: bool = False) -> DataFrame:
    """Violations of the feature schema: (sequence, frame_index, kind, camera, expected, actual). Spark broadcasts the features where their size allows."""
    want = features.select("camera", F.col("height").alias("want_height"), F.col("width").alias("want_width"))
    size = lambda h, w: F.concat(F.col(h).cast("string"), F.lit("x"), F.col(w).cast("string"))
    got = frames.join(want, "camera", "left")
    kind = F.when(F.col("want_height").isNull(), "unknown camera").when((F.col("height") != F.col("want_height")) | (F.col("width") != F.col("want_width")), "resolution")
    out = got.select(sequence, "frame_index", kind.alias("kind"), "camera", size("want_height", "want_width").alias("expected"), size("height", "width").alias("actual")).filter("kind is not null")
    if strict:
        out = out.withColumn("kind", F.raise_error(F.concat(F.lit("schema drift: "), F.col("kind"))).cast("string"))
    return out


def vector_drift(frames: DataFrame, vector: str, length: int, *keys: str) -> DataFrame:
    """Frames whose vector does not have the schema's length (vector_features gives it); a null vector has none."""
    have = F.coalesce(F.size(vector), F.lit(0))
    return frames.filter(have != length).select(*keys, F.lit(f"{vector} length").alias("kind"), F.lit(length).cast("long").alias("expected"), have.cast("long").alias("actual"))


def frame_time_ns(index: Column, fps: float, given: Column | None = None) -> Column:
    """Nanoseconds, cut toward zero: of a given time in seconds, else of index / fps."""
    by_rate = index.cast("double") / F.lit(float(fps)) * F.lit(1e9)
    seconds = by_rate if given is None else F.coalesce(given.cast("double") * F.lit(1e9), by_rate)
    return seconds.cast("long")


#: A key with more rows than this is dealt to several tasks, in order.
HOT_ROWS = 1_000_000


def _is_hot(rows: DataFrame, keys: list[str], hot_rows: int) -> bool:
    """Whether a key has more rows than one task should order; one count by key."""
    most = rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return (most or 0) > hot_rows


def segments(rows: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The rows in ranges of (keys, order), one a task, stored with the number of their range in `_p`: a key with many rows lies in several ranges, each a
    segment of it. The bounds are sampled by Spark, so even one key with all rows is dealt evenly; equal rows stay together."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the bounds are sampled anew in each job, so the dealt rows are kept where every later job finds them
    return scratch.stored(rows.repartitionByRange(parts, *keys, *order_by).withColumn("_p", F.spark_partition_id()))


def _same(keys: list[str], left: DataFrame, right: DataFrame):
    """left joined with right on keys that may be null, and on the range."""
    names = {k: f"_r_{k}" for k in keys}
    right = right.select(*[F.col(k).alias(names.get(k, k)) for k in right.columns if k != "_p"], F.col("_p").alias("_rp"))
    on = F.col("_p") == F.col("_rp")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(names[k]))
    return left.join(right, on).drop("_rp", *names.values())


def split_index(rows: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """rows with `frame_index` from 0 within their keys, by a segmented prefix scan: rows are numbered within segments, and each segment begins where those before it
    end. What is carried is a row for each segment (keys plus ranges at most)."""
    dealt = segments(rows, keys, order_by)
    upto = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carry = dealt.groupBy(*keys, "_p").agg(F.count("*").alias("n")).withColumn("_base", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n")
    w = Window.partitionBy("_p", *keys).orderBy(*order_by)
    got = _same(keys, dealt, carry).withColumn("frame_index", (F.col("_base") + F.row_number().over(w) - 1).cast("long"))
    return got.select(*rows.columns, "frame_index")


def episode_frames(rows: DataFrame, episode: str, order_by: list[str], fps: float, given: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Frames numbered within their episode, with times: one shuffle by episode and one window, or, where an episode has more than hot_rows rows, a segmented
    prefix scan, so that no task holds a whole one."""
    if _is_hot(rows, [episode], hot_rows):
        got = split_index(rows, [episode], order_by)
    else:
        w = Window.partitionBy(episode).orderBy(*order_by)
        got = rows.withColumn("frame_index", (F.row_number().over(w) - 1).cast("long"))
    return got.withColumn("timestamp_ns", frame_time_ns(F.col("frame_index"), fps, F.col(given) if given else None))


def split_runs(rows: DataFrame, stream: list[str], order_by: list[str], episode: str) -> DataFrame:
    """rows with their `run` in the stream (from 1), by a segmented prefix scan: changes are counted within segments; what is carried from segment to
    segment is the changes so far and the last episode, which tells whether the next segment begins a run."""
    dealt = segments(rows, stream, order_by)
    key = F.struct(*order_by)
    w = Window.partitionBy("_p", *stream).orderBy(*order_by)
    inner = (F.row_number().over(w) > 1) & ~F.lag(episode).over(w).eqNullSafe(F.col(episode))
    marked = dealt.withColumn("_new", inner.cast("long"))
    ends = marked.groupBy(*stream, "_p").agg(F.sum("_new").alias("n"), F.min_by(F.struct(F.col(episode).alias("e")), key).alias("first"), F.max_by(F.struct(F.col(episode).alias("e")), key).alias("last"))
    by = Window.partitionBy(*stream).orderBy("_p")
    opens = F.coalesce((~F.lag("last").over(by).eqNullSafe(F.col("first"))).cast("long"), F.lit(1))
    carry = ends.withColumn("_open", F.when(F.row_number().over(by) == 1, 1).otherwise(opens))
    # the run in which a segment begins: the runs opened before it, and its own where it opens one
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = carry.select(*stream, "_p", (F.sum(F.col("n") + F.col("_open")).over(upto) - F.col("n")).alias("_base"))
    within = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return _same(stream, marked, carry).withColumn("run", (F.col("_base") + within).cast("long")).select(*rows.columns, "run")


def episode_runs(rows: DataFrame, stream: list[str], order_by: list[str], episode: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Contiguous runs of one episode in an ordered stream: run, episode, rows; `repeated` marks an episode that has another run before. The
    stream's key keeps the windows apart; a stream with more than hot_rows rows is scanned in segments."""
    if _is_hot(rows, stream, hot_rows):
        runs = split_runs(rows, stream, order_by, episode)
    else:
        w = Window.partitionBy(*stream).orderBy(*order_by)
        change = F.when(F.lag(episode).over(w).eqNullSafe(F.col(episode)) & (F.row_number().over(w) > 1), 0).otherwise(1)
        runs = rows.withColumn("new", change).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long"))
    got = runs.groupBy(*stream, "run", episode).agg(F.count("*").alias("n_frames"))
    # folded within tasks first, so that a stream of very many runs isn't in one window
    first = got.groupBy(*stream, episode).agg(F.min("run").alias("_first")).select(*[F.col(k).alias(f"_r_{k}") for k in (*stream, episode)], "_first")
    on = F.lit(True)
    for k in (*stream, episode):
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return got.join(first, on).select(*got.columns, (F.col("run") > F.col("_first")).alias("repeated"))


def episode_messages(frames: DataFrame, episode: str, cameras: dict[str, str], numeric: dict[str, str]) -> DataFrame:
    """Long form: one row per camera image and numeric feature. cameras and numeric map feature names to columns; frames have timestamp_ns."""
    rows = []
    for names, schema in ((cameras, "CompressedImage"), (numeric, "Float32MultiArray")):
        for feature, column in names.items():
            topic = "/" + feature.replace(".", "/")
            rows.append(F.struct(F.lit(topic).alias("topic"), F.lit(schema).alias("schema_name"), F.lit(topic.strip("/").replace("/", ".")).alias("frame_id"), F.col(column).cast("string").alias("value")))
    got = frames.select(episode, "timestamp_ns", F.explode(F.array(*rows)).alias("m"))
    return got.select(episode, "m.topic", "timestamp_ns", "m.schema_name", "m.frame_id", "m.value")


def episode_export(frames: DataFrame, out: str, fps: float, task: str, episode: str = "episode_index", order: str = "frame_index", features: dict | None = None) -> None:
    """Frame rows in order of episode and frame, dealt to files by ranges: a file has many short episodes or a piece of a long one, so files grow in number with the rows
    and not with the episodes, and a scan of some episodes skips what lies outside their ranges. One shuffle; a failed task leaves no _SUCCESS. With features (name -> {dtype, ...}) the dataset gets
    metadata in `_meta`, which episode_scan resolves names, rate and episodes by."""
    rows = frames.withColumn("timestamp", F.col(order) / F.lit(float(fps))).withColumn("task", F.lit(task))
    rows.repartitionByRange(episode, order).sortWithinPartitions(episode, order).write.parquet(out)
    if features is not None:
        spark = frames.sparkSession
        most = spark.read.parquet(out).agg(F.max(episode)).first()[0]
        text = json.dumps({"features": features, "fps": fps, "total_episodes": 0 if most is None else int(most) + 1})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{out}/_meta")


# ---------------------------------------------------------------- sensor messages

#: Image message types, and raw encodings with a known layout.
RAW_TYPES = ["sensor_msgs/Image", "sensor_msgs/msg/Image"]
COMPRESSED_TYPES = ["sensor_msgs/CompressedImage", "sensor_msgs/msg/CompressedImage"]
ENCODINGS = ["rgb8", "bgr8", "rgba8", "bgra8", "mono8", "mono16"]


def message_shape(messages: DataFrame) -> DataFrame:
    """Message time (header stamp unless 0/0, else log time), frame id (header's, else the topic's), and image format."""
    sec, nsec = F.coalesce("header_sec", F.lit(0)).cast("long"), F.coalesce("header_nanosec", F.lit(0)).cast("long")
    time = F.when((sec != 0) | (nsec != 0), sec * F.lit(NS) + nsec).otherwise(F.col("log_time_ns"))
    own = F.replace(F.regexp_replace("topic", "^/+|/+$", ""), F.lit("/"), F.lit("."))
    return messages.withColumns({"timestamp_ns": time, "frame_id": F.coalesce(F.nullif("frame_id", F.lit("")), own), "image_format": F.when(F.contains(F.lower("format"), F.lit("png")), "png").otherwise("jpeg")})


def _decodable() -> Column:
    compressed = F.col("msgtype").isin(COMPRESSED_TYPES) & ~F.contains(F.coalesce("format", F.lit("")), F.lit("compressedDepth"))
    raw = F.col("msgtype").isin(RAW_TYPES) & F.lower(F.coalesce("encoding", F.lit(""))).isin(ENCODINGS)
    return compressed | raw


def _unwanted(topics: list[str] | None) -> Column:
    return F.col("msgtype").isin(RAW_TYPES + COMPRESSED_TYPES) & ~F.col("topic").isin(topics) if topics is not None else F.lit(False)


def image_messages(messages: DataFrame, topics: list[str] | None = None) -> DataFrame:
    """Camera messages that can be decoded, of the wanted topics."""
    return messages.filter(_decodable() & ~_unwanted(topics))


def conversion_report(messages: DataFrame, topics: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Messages written, and the sorted topics that were skipped: those with a message that is no image or can't be decoded. Image topics outside the list are left
    out silently."""
    good, out = _decodable() & ~_unwanted(topics), _unwanted(topics)
    got = messages.agg(F.count_if(good).alias("written"), F.array_sort(F.collect_set(F.when(~good & ~out, F.col("topic")))).alias("t")).select("written", F.array_join("t", ",").alias("skipped_topics"))
    if strict:
        got = got.withColumn("written", F.when(F.col("written") == 0, F.raise_error(F.concat(F.lit("nothing written; skipped: "), F.col("skipped_topics")))).otherwise(F.col("written")))
    return got


def recording_rollup(messages: DataFrame) -> DataFrame:
    """Per recording: topics with their messages, first and last time, seconds, bytes. A first aggregation by topic keeps lists short."""
    by_topic = messages.groupBy("recording", "topic").agg(F.count("*").alias("n"), F.min("log_time_ns").alias("lo"), F.max("log_time_ns").alias("hi"), F.sum(F.octet_length("data")).alias("size"))
    got = by_topic.groupBy("recording").agg(F.count("*").alias("topic_count"), F.array_sort(F.collect_list(F.struct("topic", "n"))).alias("t"), F.min("lo").alias("started_ns"), F.max("hi").alias("ended_ns"), F.sum("size").alias("size_bytes"))
    text = F.array_join(F.transform("t", lambda x: F.concat(x["topic"], F.lit("="), x["n"].cast("string"))), ",")
    return got.select("recording", "topic_count", text.alias("topics"), "started_ns", "ended_ns", ((F.col("ended_ns") - F.col("started_ns")) / F.lit(1e9)).alias("duration_seconds"), "size_bytes")
