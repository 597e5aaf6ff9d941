"""File listings: inventories, object scans, media types."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Suffixes that are indexed, by data type.
SUFFIXES = {
    "image": [".jpg", ".jpeg", ".png", ".webp", ".bmp", ".gif", ".tif", ".tiff"],
    "video": [".mp4", ".webm", ".mkv", ".mov", ".episode"],
    "lidar": [".alp", ".alp.gz"],
    "mcap": [".mcap"],
    "splat": [".ply", ".compressed.ply", ".splat", ".sog", ".spz", ".ksplat"],
}


def media_type(path: Column) -> Column:
    """Data type by suffix, case-insensitive; no type's suffixes end in another type's, so one test a type decides."""
    low = F.lower(path)
    out = F.when(F.lit(False), "")
    for kind, suffixes in SUFFIXES.items():
        out = out.when(low.rlike("(" + "|".join(re.escape(s) for s in sorted(suffixes)) + ")$"), kind)
    return out


class FolderReader(DataSourceReader):
    """Lists a tree folder by folder: the driver opens folders level by level until there are enough of them, and each of these is walked by a task."""

    LEAST, DEEPEST = 64, 6

    def __init__(self, root: str):
        self.root = root

    def _open(self):
        if re.match(r"\w+:", self.root):
            return fs.FileSystem.from_uri(self.root)
        return fs.LocalFileSystem(), self.root

    def partitions(self) -> list[InputPartition]:
        store, base = self._open()
        level, files = [base], []
        for _ in range(self.DEEPEST):
            below = []
            for folder in level:
                for info in store.get_file_info(fs.FileSelector(folder)):
                    (below if info.type == fs.FileType.Directory else files).append(info.path if info.type == fs.FileType.Directory else (info.path, info.size))
            level = below
            if not level or len(level) >= self.LEAST:
                break
        loose = [InputPartition(("files", files[k : k + 10_000])) for k in range(0, len(files), 10_000)]
        return [*loose, *(InputPartition(("folder", f)) for f in level)] or [InputPartition(("files", []))]

    def read(self, partition: InputPartition):
        kind, what = partition.value
        schema = pa.schema([("path", pa.string()), ("size_bytes", pa.int64())])
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], schema=schema)
        if kind == "files":
            yield batch(what)
            return
        store, _ = self._open()
        rest = [what]
        while rest:
            rows = []
            for info in store.get_file_info(fs.FileSelector(rest.pop())):
                if info.type == fs.FileType.Directory:
                    rest.append(info.path)
                elif info.type == fs.FileType.File:
                    rows.append((info.path, info.size))
            if rows:
                yield batch(rows)


class FolderSource(DataSource):
    """path, size_bytes of every file below `path`, hidden ones too."""

    @classmethod
    def name(cls) -> str:
        return "folder_inventory"

    def schema(self) -> str:
        return "path string, size_bytes long"

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.options["path"])


#: Stores that tasks can list by themselves; others are listed by Spark's file sources.
LISTED = ["file", "s3", "gs", "hdfs"]


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, relative_path, size_bytes of every file below root (a file maps to its own name); a tree without files is an error. Folders are listed in parallel by
    a data source, names that start with _ or a dot too. In a store that only Spark reads, Spark's file sources list, which skip such names."""
    scheme = (re.match(r"(\w+):", root) or [None, "file"])[1]
    if scheme in LISTED:
        store, at = FolderReader(root)._open()
        info = store.get_file_info(at)
        if info.type == fs.FileType.File:
            files = spark.createDataFrame([(info.path, info.size)], "path string, size_bytes long")
        elif info.type == fs.FileType.Directory:
            spark.dataSource.register(FolderSource)
            files = spark.read.format("folder_inventory").option("path", root).load()
        else:
            raise ValueError(f"no files below {root}")
        files = files.withColumn("path", F.concat(F.lit("file:" if scheme == "file" else f"{scheme}://"), F.col("path")))
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size_bytes"))
    if files.isEmpty():
        raise ValueError(f"no files below {root}")
    base = re.escape(re.sub(r"^\w+:/*", "", root).strip("/"))
    below = F.regexp_replace("path", rf"^\w+:/+{base}/", "")
    return files.select("path", F.when(below == F.col("path"), F.element_at(F.split("path", "/"), -1)).otherwise(below).alias("relative_path"), "size_bytes")


def readable(size: Column) -> Column:
    """Bytes with one decimal and a unit, base 1024; exact ties go to the even digit."""
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    out = F.lit(None).cast("string")
    for k, u in reversed(list(enumerate(units))):
        text = F.format_string(f"%.1f {u}", F.bround(size / F.lit(float(1024**k)), 1))
        out = F.when(F.abs(size) < F.lit(float(1024 ** (k + 1))), text).otherwise(out if k < len(units) - 1 else text)
    return out


def inventory_summary(files: DataFrame, path: str = "relative_path") -> DataFrame:
    """Files and bytes by media type, and in all (media_type null)."""
    one = files.select(media_type(F.col(path)).alias("media_type"), "size_bytes")
    got = one.groupBy(F.coalesce("media_type", F.lit("unknown")).alias("media_type")).agg(F.count("*").alias("n_files"), F.sum("size_bytes").alias("n_bytes"))
    total = one.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("n_bytes")).select(F.lit("all").alias("media_type"), "n_files", "n_bytes")
    return got.union(total).withColumn("size", readable(F.col("n_bytes").cast("double")))


def first_files(files: DataFrame, n: int = 20, path: str = "relative_path") -> DataFrame:
    """The first n files by path, which an inventory's summary shows: path, media type, readable size."""
    return files.orderBy(path).limit(n).select(path, F.coalesce(media_type(F.col(path)), F.lit("unknown")).alias("media_type"), readable(F.col("size_bytes").cast("double")).alias("size"))


def clean_csv(value: Column) -> Column:
    """Comma-separated values without padding and empty entries."""
    return F.array_join(F.filter(F.transform(F.split(value, ","), lambda x: F.trim(x)), lambda x: x != ""), ",")


def parse_uri(uri: str) -> tuple[str, str, str]:
    m = re.fullmatch(r"(s3|gs|gcs)://([^/]+)/?(.*)", uri)
    if not m:
        raise ValueError(f"not an s3:// or gs:// address with a bucket: {uri!r}")
    return "aws_s3" if m[1] == "s3" else "gc_storage", m[2], m[3]


def glob_regex(glob: str) -> str:
    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob) + "$"


def object_filter(files: DataFrame, key: str, included: str | None = None, ignored: str | None = None) -> DataFrame:
    """Keeps keys with an included suffix (all, without a list) that match no ignored glob."""
    split = lambda s: [x.strip() for x in (s or "").split(",") if x.strip()]
    if want := split(included):
        files = files.filter(F.lower(key).rlike("(" + "|".join(re.escape("." + w.lower().lstrip(".")) for w in want) + ")$"))
    if globs := split(ignored):
        files = files.filter(~F.col(key).rlike("|".join(map(glob_regex, globs))))
    return files


def object_scan(spark: SparkSession, uri: str, data_type: str, included: str | None = None, ignored: str | None = None) -> DataFrame:
    """Objects below an address that have the data type, without reading their content."""
    if data_type not in SUFFIXES:
        raise ValueError(f"unknown data type {data_type!r}")
    if not uri.startswith("/") and not uri.startswith("file:"):
        parse_uri(uri)
    files = object_filter(file_inventory(spark, uri), "relative_path", included, ignored)
    return files.filter(media_type(F.col("relative_path")) == data_type)


def resolve_data_type(files: DataFrame, key: str = "key", strict: bool = False) -> DataFrame:
    """The one data type of a file set; several or none give a null type and a problem, or an error when strict."""
    got = files.select(media_type(F.col(key)).alias("t")).agg(F.array_sort(F.collect_set("t")).alias("types"))
    problem = F.when(F.size("types") == 0, "no recognised files").when(F.size("types") > 1, F.concat(F.lit("several types: "), F.array_join("types", ", ")))
    if strict:
        problem = F.when(problem.isNotNull(), F.raise_error(problem)).otherwise(problem)
    return got.select(F.when(F.size("types") == 1, F.get("types", F.lit(0))).alias("data_type"), problem.alias("problem"))


def indexable_guard(files: DataFrame, data_type: str, key: str = "key", strict: bool = False) -> DataFrame:
    """Whether at least one file has a suffix of the data type."""
    if data_type not in SUFFIXES:
        raise ValueError(f"unknown data type {data_type!r}")
    got = files.agg(F.coalesce(F.bool_or(media_type(F.col(key)).eqNullSafe(F.lit(data_type))), F.lit(False)).alias("indexable"))
    if strict:
        got = got.select(F.when(~F.col("indexable"), F.raise_error(F.lit(f"no file is indexed as {data_type}"))).otherwise(F.col("indexable")).cast("boolean").alias("indexable"))
    return got.select(F.lit(data_type).alias("data_type"), "indexable")
