"""Reading entities: typed JSON rows, response envelopes, edits, episodes, messages, samples."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


def _text_schema(schema: T.StructType) -> T.StructType:
    """The schema with times as text, so that a bad time is told from a missing one."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema] + [T.StructField("_corrupt_record", T.StringType())])


def typed(df: DataFrame, entity: str, column: str = "json") -> DataFrame:
    """One row per JSON row: the entity's fields with defaults, `json`, and `reason` (null for a good row). Unknown fields are left out."""
    schema, defaults = schemas.ENTITIES[entity], schemas.DEFAULTS.get(entity, {})
    row = F.from_json(F.col(column), _text_schema(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    got = df.select(F.col(column).alias("json"), row.alias("row"))
    reason = F.when(F.col("row").isNull() | F.col("row._corrupt_record").isNotNull(), F.lit("not a JSON object of this kind"))
    for name in schemas.required(entity):
        reason = reason.when(F.col("row")[name].isNull(), F.lit(f"missing {name}"))
    cols = []
    for f in schema:
        value: Column = F.col("row")[f.name]
        if isinstance(f.dataType, T.TimestampType):
            reason = reason.when(value.isNotNull() & F.try_to_timestamp(value).isNull(), F.lit(f"bad time in {f.name}"))
            value = F.try_to_timestamp(value)
        cols.append(F.coalesce(value, F.lit(defaults[f.name]).cast(f.dataType)).alias(f.name) if f.name in defaults else value.alias(f.name))
    return got.select("json", reason.alias("reason"), *cols)


def typed_read(df: DataFrame, entity: str, column: str = "json") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine of (json, reason))."""
    both = typed(df, entity, column)
    return both.filter("reason is null").drop("json", "reason"), both.filter("reason is not null").select("json", "reason")


def cursor_of(url: Column) -> Column:
    """The `cursor` query value of a URL, else `page`, decoded; blank ones do not count."""
    get = lambda key: F.nullif(F.try_parse_url(url, F.lit("QUERY"), F.lit(key)), F.lit(""))
    return F.try_url_decode(F.coalesce(get("cursor"), get("page")))


def envelope_scan(df: DataFrame, schema: str, column: str = "json") -> DataFrame:
    """Stored response pages {results, next, previous} -> one row per result, with the page's cursors."""
    page = F.from_json(column, f"results array<{schema}>, next string, previous string")
    got = df.select(page.alias("page"))
    return got.select(F.explode("page.results").alias("r"), cursor_of(F.col("page.next")).alias("next_cursor"), cursor_of(F.col("page.previous")).alias("previous_cursor")).select("r.*", "next_cursor", "previous_cursor")


def edit_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """JSON lines -> (file, r: the parsed edit; quarantine of file, line, text). Blank lines hold no edit; a line
    that is no JSON object, or whose fields don't fit the schema, is bad. Lines are numbered from 1 in their file by a prefix sum:
    within a split rows keep their order, and the lines of the splits before it are added; only bad lines are numbered."""
    read = _lines(spark, path)
    bad = _parsed(read.filter(_some()), schema).filter("r is null").select("file", "block", "id", "value")
    splits = read.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    wrong = bad.join(splits, ["file", "block"]).select("file", (F.col("id") + F.col("shift")).alias("line"), F.col("value").alias("text"))
    return _parsed(read.filter(_some()), schema).filter("r is not null").select("file", "r"), wrong


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))


def _some() -> Column:
    """Lines that aren't blank."""
    return F.col("value").rlike(r"[^\s]")


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    """The lines with `r`, the parsed edit, null where a line is bad. Each line is parsed once: what comes after reads the generator's row, so no filter is moved below it with a copy of the parser."""
    row = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    good = lambda r: r.isNotNull() & r["_corrupt_record"].isNull()
    once = F.transform(F.array(F.when(F.ltrim("value").startswith("{"), row)), lambda r: F.when(good(r), r.dropFields("_corrupt_record")))
    return lines.select("*", F.explode(once).alias("r"))


def edits_read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Edits of a JSON array, or of JSON lines when the suffix is .jsonl: blank lines hold no edit; a bad line is an error with its text and its place, the line
    counted from the beginning of its file. Lines are looked through once before they are read, and numbered only where one is bad; edit_lines has both kinds apart."""
    if path.lower().endswith(".jsonl"):
        good, bad = edit_lines(spark, path, schema)
        if _parsed(_lines(spark, path).filter(_some()), schema).filter("r is null").count():
            first = bad.orderBy("file", "line").limit(1).collect()
            raise ValueError(f"not a JSON object in line {first[0].line} from byte 0 of {first[0].file}: {first[0].text}")
        return good.select("r.*")
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


#: Columns of a stored sensor message; the first three must be there, the others are null where they are not.
MESSAGE = "topic string, msgtype string, log_time_ns long, header_sec long, header_nanosec long, frame_id string, encoding string, format string, data binary"


def message_scan(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Decoded sensor messages of a folder in one schema (Parquet or JSON lines): wanted columns only, so the scan reads no others. A set without topic, msgtype or
    log_time_ns is an error; the payload stays as it is. Further columns come last."""
    df = spark.read.format(kind).load(path)
    wanted = [f.split(" ") for f in MESSAGE.split(", ")]
    if missing := [name for name, _ in wanted[:3] if name not in df.columns]:
        raise ValueError(f"no messages: {', '.join(missing)} missing")
    have = [(F.col(name) if name in df.columns else F.lit(None)).cast(t).alias(name) for name, t in wanted]
    return df.select(*have, *[c for c in df.columns if c not in {name for name, _ in wanted}])


#: Kinds of a camera's feature, and the numeric features that are taken where none are named.
CAMERA_KINDS = ["image", "video"]
STATES = ["observation.state", "action"]


def episode_meta(spark: SparkSession, root: str) -> dict | None:
    """What a dataset says of itself (features by name, fps, total_episodes), or None where it has no `_meta`."""
    try:
        text = spark.read.text(f"{root}/_meta", wholetext=True).first()
    except AnalysisException:
        return None
    return json.loads(text[0]) if text else None


def _chosen(named: list[str] | None, known: list[str], usual: list[str], what: str) -> list[str]:
    if named is None:
        return usual
    if unknown := [k for k in named if k not in known]:
        raise ValueError(f"unknown {what} keys {unknown}; there are {sorted(known)}")
    return list(named)


def episode_scan(spark: SparkSession, root: str, episodes: list[int] | None = None, columns: list[str] | None = None, camera_keys: list[str] | None = None, state_keys: list[str] | None = None, fps: float | None = None) -> DataFrame:
    """Frames of the wanted episodes of a dataset with a column episode_index, in its files or as its partitions; unknown columns and episodes are errors. Where the dataset has metadata (or camera_keys or
    state_keys are named), cameras and numeric features are checked against it: all cameras and the usual numeric features unless some are named, no camera is an error;
    frames then come with timestamp_ns by their own time or by the frame rate, given or the metadata's. Only those columns and episodes are read."""
    df = spark.read.parquet(root)
    missing = sorted(set(columns or []) - set(df.columns))
    if missing:
        raise ValueError(f"no such features: {', '.join(missing)}")
    meta = episode_meta(spark, root)
    if episodes is not None:
        if meta is not None:
            total = int(meta["total_episodes"])
        else:
            most = df.agg(F.max("episode_index")).first()[0]
            total = 0 if most is None else most + 1
        bad = [e for e in episodes if not 0 <= e < total]
        if bad:
            raise ValueError(f"episodes out of range 0..{total - 1}: {bad}")
        if not episodes:
            raise ValueError("no episodes selected")
        df = df.filter(F.col("episode_index").isin(episodes))
    if columns:
        return df.select("episode_index", "frame_index", *columns)
    if meta is None and camera_keys is None and state_keys is None:
        return df
    if meta is None:
        raise ValueError("cameras and states are told by metadata, and this dataset has none")
    features = meta["features"]
    cameras = _chosen(camera_keys, known := [k for k, f in features.items() if f["dtype"] in CAMERA_KINDS], known, "camera")
    if not cameras:
        raise ValueError("the dataset has no camera; name camera_keys")
    states = _chosen(state_keys, list(features), [k for k in STATES if k in features], "state")
    by_rate = F.col("frame_index").cast("double") / F.lit(float(fps if fps is not None else meta["fps"])) * F.lit(1e9)
    time = F.coalesce(F.col("timestamp").cast("double") * F.lit(1e9), by_rate) if "timestamp" in df.columns and fps is None else by_rate
    return df.select("episode_index", "frame_index", time.cast("long").alias("timestamp_ns"), *[F.col(f"`{k}`") for k in dict.fromkeys(cameras + states)])


def item_samples(items: DataFrame, **where) -> DataFrame:
    """Items as training samples; `where` gives equalities (owner, slug)."""
    for k, v in where.items():
        items = items.filter(F.col(k) == v)
    wanted = [c for c in ("uid", "key", "url", "annotations", "export_snippet", "metadata", "label", "text") if c in items.columns]
    return items.select(*wanted)
