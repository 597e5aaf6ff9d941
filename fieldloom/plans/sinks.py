"""Writing and reading back, for queries of sinks and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import folder
from ..streaming import jobs


def write_lines(json_rows: DataFrame, path: str) -> None:
    json_rows.write.text(path)


def write_media(rows: DataFrame, path: str) -> None:
    """One .mcap object for each row's episode, so that a scan has objects to list."""
    rows.selectExpr("cast(vec_id as string) as value", "episode_index").repartition("episode_index").write.partitionBy("episode_index").option("extension", "mcap").format("csv").save(path)


def resumed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Load half of the files, add the rest, and resume: every row comes once."""
    source, out, checkpoint = folder(spark), folder(spark), folder(spark)
    rows.filter("event_id % 2 = 0").write.parquet(source)
    jobs.ingest_resume(spark, source, rows.schema, out, checkpoint, 2)
    rows.filter("event_id % 2 = 1").write.mode("append").parquet(source)
    jobs.ingest_resume(spark, source, rows.schema, out, checkpoint, 2)
    return spark.read.schema(rows.schema).parquet(out)


STATES = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streamed(spark: SparkSession, rows: DataFrame, batches: int = 2) -> DataFrame:
    """The rows as a stream of a folder's files, as many as the rows have partitions, in so many micro-batches (less where there are fewer files)."""
    source = folder(spark)
    rows.write.parquet(source)
    files = len(spark.read.schema(rows.schema).parquet(source).inputFiles())
    return jobs.read_files(spark, source, rows.schema, max(1, -(-files // batches)))


def ingested(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Counts of a streamed ingest in which every row comes twice."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATES)
    out = folder(spark)
    jobs.ingest(streamed(spark, rows.union(rows)), out, folder(spark), "3650 days").awaitTermination()
    events, bad = spark.read.parquet(f"{out}/events"), spark.read.parquet(f"{out}/quarantine")
    counts = spark.read.parquet(f"{out}/counts").agg(F.sum("created").alias("created"), F.sum("rejected").alias("rejected"))
    return counts.crossJoin(events.agg(F.count("*").alias("events"))).crossJoin(bad.select("json").distinct().agg(F.count("*").alias("bad_rows")))  # one row each


def present(spark: SparkSession, events: DataFrame, devices: DataFrame, timeout_seconds: int) -> DataFrame:
    """States of seen devices out of a stream of their events, as of the newest one. They come in one micro-batch, as events behind the watermark would be left out."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATES)
    out = folder(spark)
    jobs.presence_table(streamed(spark, events.select("device", "ts"), 1), timeout_seconds, out, folder(spark)).awaitTermination()
    return jobs.with_maintenance(jobs.current_presence(spark, out), devices)
