"""Stream forms of the fleet jobs. Each has a batch form in operators.fleet with the same result."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import fleet, rules
from ..sources import tables


def event_ingest(stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JSON rows -> (events, quarantine), batch or stream. `ingest` observes how many came and how many were good."""
    got = tables.typed(stream, "event")
    got = got.observe("ingest", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason").isNull()).alias("created"))
    return got.filter("reason is null").drop("json", "reason"), got.filter("reason is not null").select("json", "reason")


def read_files(spark: SparkSession, path: str, schema, per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def ingest(stream: DataFrame, out: str, checkpoint: str, delay: str = "7 days"):
    """Start a stream of JSON rows into `out`: one foreachBatch writes the good events, the quarantine and the counts of a micro-batch together, each in a folder of
    its number, so a batch that is tried again replaces what it had written. Rows that repeat one that is there (the same JSON text) within `delay` of event time add
    nothing: their state is kept until the watermark has passed, and no longer. Events more than `delay` older than the newest one are left out and
    counted as rows dropped by the watermark in the query's progress. Returns the started query (availableNow)."""
    typed = tables.typed(stream, "event")
    good = typed.filter("reason is null").withColumns({"_key": F.sha2("json", 256), "json": F.lit(None).cast("string")})  # a good row's text ends here
    good = good.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")
    both = good.unionByName(typed.filter("reason is not null"))

    def write(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        try:
            put = lambda df, name: df.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch}")
            put(rows.filter("reason is null").drop("json", "reason"), "events")
            put(rows.filter("reason is not null").select("json", "reason"), "quarantine")
            put(rows.agg(F.count_if(F.col("reason").isNull()).alias("created"), F.count_if(F.col("reason").isNotNull()).alias("rejected")), "counts")
        finally:
            rows.unpersist()

    return both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rule_alerts(events: DataFrame, devices: DataFrame, rules: list[dict], recording: str | None = None) -> DataFrame:
    """Alerts of a stream of events: a stream-static join and a projection, no state. With the column that names the event's recording also that and a message."""
    return fleet.alerts_of(fleet.rule_match(events, devices, rules), recording)


def rule_table_alerts(events: DataFrame, devices: DataFrame, read_rules: Callable[[], DataFrame], out: str, checkpoint: str, recording: str | None = None):
    """Start a stream of events against a table of rules, read anew for each micro-batch, so a rule counts from the next batch on. Alerts and hits by
    rule go to folders of the batch's number. Returns the started query (availableNow); hit_counts has the sums so far."""

    def write(rows: DataFrame, batch: int) -> None:
        found = rules.rule_match(rows, devices, read_rules()).persist()
        try:
            fleet.alerts_of(found, recording).write.mode("overwrite").parquet(f"{out}/alerts/batch={batch}")
            fleet.rule_hits(found).write.mode("overwrite").parquet(f"{out}/hits/batch={batch}")
        finally:
            found.unpersist()

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hit_counts(spark: SparkSession, out: str) -> DataFrame:
    """hit_count and last_hit_at by rule over all batches of rule_table_alerts."""
    return spark.read.parquet(f"{out}/hits").groupBy("rule").agg(F.sum("hit_count").alias("hit_count"), F.max("last_hit_at").alias("last_hit_at"))


def last_seen(events: DataFrame) -> DataFrame:
    """last_seen_at by device, for update mode: one row of state a device."""
    return events.groupBy("device").agg(F.max("ts").alias("last_seen_at"))


def ingest_resume(spark: SparkSession, source: str, schema, out: str, checkpoint: str, per_trigger: int = 1) -> None:
    """Load the files of a folder that no earlier run with this checkpoint has loaded."""
    query = read_files(spark, source, schema, per_trigger).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


class Presence(StatefulProcessor):
    """One device: when it was last seen, and a timer that turns it offline once the watermark has passed its timeout."""

    def __init__(self, timeout_seconds: int):
        self.timeout = timeout_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "us long")

    def _row(self, device, us: int, online: bool) -> pd.DataFrame:
        return pd.DataFrame({"device": [device], "last_seen_us": [us], "status": ["online" if online else "offline"]})

    def _due(self, us: int) -> int:
        """The first millisecond at which the device has been silent for longer than the timeout, counted in whole seconds."""
        return (us // 1_000_000 + self.timeout + 1) * 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(r["us"].max()) for r in rows)
        before = self.state.get()[0] if self.state.exists() else None
        if before is None or newest > before:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.state.update((newest,))
            online = timerValues.getCurrentWatermarkInMs() < self._due(newest)
            if online:
                self.handle.registerTimer(self._due(newest))
            yield self._row(key[0], newest, online)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._row(key[0], self.state.get()[0], False)

    def close(self) -> None:
        pass


def presence(events: DataFrame, timeout_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """device, last_seen_us, status out of a stream of events (device, ts): a row whenever a device is seen later than before, and one when it goes
    offline. Time is event time: a device is offline once the watermark (the newest event of any device less `delay`) is more than the timeout after its last event, which is
    what device_last_seen says as of that moment. A row of state and a timer for each device. The caller overlays a stored maintenance
    (with_maintenance). Needs the RocksDB state store provider."""
    rows = events.select("device", "ts", F.unix_micros("ts").alias("us")).withWatermark("ts", delay)
    return rows.groupBy("device").transformWithStateInPandas(Presence(timeout_seconds), outputStructType="device long, last_seen_us long, status string", outputMode="Update", timeMode="EventTime")


def presence_table(events: DataFrame, timeout_seconds: int, out: str, checkpoint: str, delay: str = "0 seconds"):
    """Start a stream of presence states into a folder for each micro-batch; returns the started query (availableNow). current_presence has the state of each device."""
    write = lambda rows, batch: rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")
    return presence(events, timeout_seconds, delay).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_presence(spark: SparkSession, out: str) -> DataFrame:
    """device, last_seen_us, status: the last state that presence_table wrote of each device."""
    latest = F.struct("batch", "last_seen_us", (F.col("status") == "offline").alias("off"))
    got = spark.read.parquet(out).groupBy("device").agg(F.max_by(F.struct("last_seen_us", "status"), latest).alias("x"))
    return got.select("device", "x.last_seen_us", "x.status")


def with_maintenance(states: DataFrame, devices: DataFrame) -> DataFrame:
    """States of known devices; a stored maintenance stays."""
    stored = devices.select(F.col("uid").alias("device"), F.col("status").alias("_stored"))
    return states.join(stored, "device").select("device", "last_seen_us", F.when(F.col("_stored") == "maintenance", "maintenance").otherwise(F.col("status")).alias("status"))


class AlertState(StatefulProcessor):
    """One alert's state; actions of a batch are taken in order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("alert", "status string, acknowledged_at timestamp, acknowledged_by string, resolved_at timestamp, resolution_note string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, ack_at, ack_by, res_at, note = self.state.get() if self.state.exists() else ("open", None, None, None, None)
        got = pd.concat(list(rows)).sort_values(["ts", "tie"])
        with_note = "note" in got.columns
        for r in got.itertuples():
            if r.action == "acknowledge" and status == "open":
                status, ack_at, ack_by = "acknowledged", r.ts, r.by
            elif r.action == "resolve" and status != "resolved":
                status, res_at = "resolved", r.ts
                note = r.note if with_note and isinstance(r.note, str) else None
        self.state.update((status, ack_at, ack_by, res_at, note))
        out = {"alert": [key[0]], "status": [status], "acknowledged_at": [ack_at], "acknowledged_by": [ack_by], "resolved_at": [res_at]}
        yield pd.DataFrame(out | ({"resolution_note": [note]} if with_note else {}))

    def close(self) -> None:
        pass


def alert_lifecycle(actions: DataFrame, group: Column | str = "alert") -> DataFrame:
    """Current alert states out of a stream of actions, update mode; a column note gives resolution_note. Needs the RocksDB state store provider."""
    out = "alert long, status string, acknowledged_at timestamp, acknowledged_by string, resolved_at timestamp"
    out += ", resolution_note string" if "note" in actions.columns else ""
    return actions.groupBy(group).transformWithStateInPandas(AlertState(), outputStructType=out, outputMode="Update", timeMode="None")
