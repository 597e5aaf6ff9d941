"""Fleet events, rules, alerts, devices; uploads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPS = {"gt": lambda a, b: a > b, "gte": lambda a, b: a >= b, "lt": lambda a, b: a < b, "lte": lambda a, b: a <= b, "eq": lambda a, b: a == b}


def fleet_enrich(events: DataFrame, recordings: DataFrame, devices: DataFrame) -> DataFrame:
    """Events with their recording's status and their device's name and type. Left joins; Spark broadcasts devices where their size allows."""
    rec = recordings.select(F.col("uid").alias("recording"), F.col("status").alias("recording_status"))
    dev = devices.select(F.col("uid").alias("device"), F.col("name").alias("device_name"), F.col("type").alias("device_type"))
    return events.join(rec, "recording", "left").join(dev, "device", "left")


def condition(rule: dict) -> Column:
    """A rule {field, op, value} as a predicate; an unknown operator is an error."""
    if rule["op"] not in OPS:
        raise ValueError(f"unknown operator {rule['op']!r}")
    return F.coalesce(OPS[rule["op"]](F.col(rule["field"]), F.lit(rule["value"])), F.lit(False))


def rule_match(events: DataFrame, devices: DataFrame, rules: list[dict]) -> DataFrame:
    """(rule, event, device) of enabled rules whose scope is the device's type and whose condition holds. Rules are compiled into one projection of the
    event, so there is no nested loop: an event's matching rules are an array, exploded. Without an enabled rule there are no rows."""
    dev = devices.select(F.col("uid").alias("device"), F.col("type").alias("device_type"))
    rows = events.join(dev, "device")
    hits = []
    for r in rules:
        ok = condition(r) & F.lit(bool(r.get("enabled", True)))
        if r.get("device_type") is not None:
            ok = ok & (F.col("device_type") == r["device_type"])
        hits.append(F.when(ok, F.struct(F.lit(r["uid"]).alias("rule"), F.lit(r.get("severity", "warning")).alias("alert_severity"), F.array(*[F.lit(a) for a in r.get("actions", ["alert"])]).alias("actions"))))
    if not hits:
        hits.append(F.lit(None).cast("struct<rule:string,alert_severity:string,actions:array<string>>"))
    return rows.withColumn("m", F.explode(F.array_compact(F.array(*hits)))).select("m.*", *events.columns, "device_type")


def alerts_of(matches: DataFrame, recording: str | None = None) -> DataFrame:
    """An open alert for each match with an alert action; with the column that names the event's recording also that and a message."""
    one = matches.filter(F.array_contains("actions", "alert"))
    more = [F.col(recording).alias("recording"), F.format_string("rule %s: event %s of device %s", *[F.col(c).cast("string") for c in ("rule", "uid", "device")]).alias("message")] if recording else []
    return one.select("rule", F.col("uid").alias("event"), "device", F.col("alert_severity").alias("severity"), F.lit("open").alias("status"), F.col("ts").alias("triggered_at"), *more)


def alert_enrich(alerts: DataFrame, rules: DataFrame, recordings: DataFrame, devices: DataFrame) -> DataFrame:
    """Alerts with the name of their rule, their recording's status and their device's name and type, each null where it is unknown."""
    named = rules.select(F.col("uid").alias("rule"), F.col("name").alias("rule_name"))
    return fleet_enrich(alerts.join(named, "rule", "left"), recordings, devices)


def rule_hits(matches: DataFrame) -> DataFrame:
    return matches.groupBy("rule").agg(F.count("*").alias("hit_count"), F.max("ts").alias("last_hit_at"))


def alert_lifecycle(actions: DataFrame) -> DataFrame:
    """An action log (alert, action, ts, tie, by) folded into states: open, acknowledged (first acknowledgement before the resolution), resolved (first). Resolving an
    open alert is allowed; repeated and backward actions do nothing. A column note gives resolution_note, the note of the resolution."""
    key = F.struct("ts", "tie")
    of = lambda a, c: F.min_by(F.when(F.col("action") == a, F.col(c)), F.when(F.col("action") == a, key))
    note = [of("resolve", "note").alias("resolution_note")] if "note" in actions.columns else []
    got = actions.groupBy("alert").agg(*note, of("acknowledge", "ts").alias("a_at"), of("acknowledge", "by").alias("a_by"), F.min(F.when(F.col("action") == "acknowledge", key)).alias("a_key"), of("resolve", "ts").alias("r_at"), F.min(F.when(F.col("action") == "resolve", key)).alias("r_key"))
    ack = F.col("a_key").isNotNull() & (F.col("r_key").isNull() | (F.col("a_key") < F.col("r_key")))
    status = F.when(F.col("r_key").isNotNull(), "resolved").when(ack, "acknowledged").otherwise("open")
    return got.select("alert", status.alias("status"), F.when(ack, F.col("a_at")).alias("acknowledged_at"), F.when(ack, F.col("a_by")).alias("acknowledged_by"), F.col("r_at").alias("resolved_at"), *["resolution_note" for _ in note])


def device_last_seen(events: DataFrame, devices: DataFrame, as_of: Column, timeout_seconds: int) -> DataFrame:
    """last_seen_at of each device; offline when never seen or longer ago than the timeout; a stored maintenance stays."""
    seen = events.groupBy("device").agg(F.max("ts").alias("last_seen_at"))
    got = devices.select(F.col("uid").alias("device"), "status").join(seen, "device", "left")
    fresh = F.unix_seconds(as_of) - F.unix_seconds("last_seen_at") <= timeout_seconds
    return got.select("device", "last_seen_at", F.when(F.col("status") == "maintenance", "maintenance").when(F.coalesce(fresh, F.lit(False)), "online").otherwise("offline").alias("status"))


# ---------------------------------------------------------------- uploads


def upload_coverage(batch: DataFrame, urls: DataFrame) -> DataFrame:
    """Files of a batch with their upload URL; a file without one is failed."""
    return batch.join(urls.select("path", "put_url"), "path", "left").withColumn("failed", F.col("put_url").isNull())


def upload_reconcile(manifest: DataFrame, local: DataFrame, pending: DataFrame) -> DataFrame:
    """Manifest paths with confirmed (known locally, or in the manifest and not pending) and remaining. Local paths outside the manifest stay confirmed."""
    flag = lambda df, name: df.select("path").distinct().withColumn(name, F.lit(True))
    got = flag(manifest, "m").join(flag(local, "l"), "path", "full_outer").join(flag(pending, "p"), "path", "left")
    done = F.col("l").isNotNull() | (F.col("m").isNotNull() & F.col("p").isNull())
    return got.select("path", done.alias("confirmed"), (F.col("m").isNotNull() & ~done).alias("remaining"))


def upload_progress(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Files and bytes in all and uploaded, failed files, and whether the upload may be finalised (none failed)."""
    got = manifest.join(results.select("path", "ok"), "path", "left")
    out = got.agg(F.count("*").alias("total_files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"), F.count_if("ok").alias("uploaded_files"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("size_bytes"))), F.lit(0)).alias("uploaded_bytes"), F.count_if(~F.col("ok")).alias("failed_files"))
    return out.withColumn("can_finalize", F.col("failed_files") == 0)
