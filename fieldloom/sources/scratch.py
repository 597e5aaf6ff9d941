"""Folders for intermediate tables."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new path under the shared folder that the cluster names; a temporary one where none is named and the master is local, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/fieldloom-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, so that what reads it several times computes it once."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession, hours: float = 48.0, base: str | None = None) -> int:
    """Delete intermediate folders of this library in the shared folder (or in `base`) that nothing has written to for `hours`; returns how many. A query's result may be read from its folders as long as
    it is used, so they aren't deleted when it is built: call this from time to time, with more hours than the longest job takes."""
    base = base or folder(spark).rpartition("/")[0]
    at = spark._jvm.org.apache.hadoop.fs.Path(base)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    gone, before = 0, (time.time() - 3600 * hours) * 1000
    for entry in store.listStatus(at):
        if entry.getPath().getName().startswith("fieldloom-") and max([entry.getModificationTime(), *(x.getModificationTime() for x in (store.listStatus(entry.getPath()) if entry.isDirectory() else []))]) < before:
            gone += bool(store.delete(entry.getPath(), True))
    return gone
