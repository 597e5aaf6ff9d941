"""Exact deduplication by Grace hashing.

Texts count as equal when they are the same after lower-casing A-Z. Each task first folds equal
texts that it meets (so a text in a third of all rows costs one record a buffer), then the
distinct texts are dealt out by hash: the shuffle is the first partitioning. A receiving task
fills an open-addressing table whose entries are compared by complete content; when the table
outgrows its memory, records are partitioned by further hash bits into spill files, and each file is
treated the same way, until each bucket fits. Spill files live in the task's temporary folder and go when
the bucket is done; a lost executor's task starts anew from the shuffle.

The table gives the classes, one row each; documents get theirs back by joining on the
digest alone, so no class is ever held with its members.

Defined cases: null counts as empty. A null doc_id is smaller than any other; a class of
null ids only keeps one of its rows. Of repeated rows with the largest doc_id exactly one is kept.
An empty table gives no rows. Two texts with one SHA-256 would be an error.
Only doc_id and text are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

MEMORY = 48 << 20  # bytes of distinct texts in one table
FAN_OUT = 16
FOLD = 16 << 20  # bytes of distinct texts that a sending task folds into at once
RECORD = struct.Struct("<Qqq?I")  # hash, largest id, rows, whether an id is known, bytes of text


class Table:
    """Open addressing with linear probing; entries with equal hashes are compared by complete content."""

    def __init__(self):
        self.slots, self.rows, self.bytes = [-1] * 1024, [], 0

    def add(self, h: int, text: bytes, top, n: int) -> None:
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0:
            row = self.rows[k]
            if row[0] == h and row[1] == text:
                row[2] = top if row[2] is None else row[2] if top is None else max(row[2], top)
                row[3] += n
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.rows)
        self.rows.append([h, text, top, n])
        self.bytes += len(text) + 200
        if 2 * len(self.rows) > len(self.slots):
            self.grow()

    def grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for k, row in enumerate(self.rows):
            at = row[0] & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def read_spill(path: str):
    with open(path, "rb") as f:
        while head := f.read(RECORD.size):
            h, top, n, known, size = RECORD.unpack(head)
            yield h, f.read(size), top if known else None, n


def grace(records, memory: int, depth: int = 0):
    """(hash, text, largest id, rows) records -> one entry for each distinct text."""
    table = Table()
    records = iter(records)
    for h, text, top, n in records:
        table.add(h, text, top, n)
        if table.bytes > memory and depth < 15:  # sixteen times four bits are the whole hash
            break
    else:
        yield from table.rows
        return
    with tempfile.TemporaryDirectory(prefix="spill-") as folder:
        paths = [os.path.join(folder, str(k)) for k in range(FAN_OUT)]
        files = [open(p, "wb") for p in paths]  # noqa: SIM115
        try:
            for source in (table.rows, records):
                for h, text, top, n in source:
                    f = files[(h >> (60 - 4 * depth)) % FAN_OUT]
                    f.write(RECORD.pack(h, top or 0, n, top is not None, len(text)))
                    f.write(text)
                if source is table.rows:
                    table = Table()
        finally:
            for f in files:
                f.close()
        for p in paths:
            yield from grace(read_spill(p), memory, depth + 1)
            os.remove(p)


def normal(text) -> bytes:
    """bytes.lower() changes A-Z only."""
    return text.as_buffer().to_pybytes().lower() if text.is_valid else b""


def _fold(parts, limit):
    schema = pa.schema([("part", pa.int32()), ("h", pa.int64()), ("text", pa.binary()), ("top", pa.int64()), ("n", pa.int64())])

    def send(table):
        rows = table.rows
        signed = [h - (1 << 64) if h >> 63 else h for h, *_ in rows]
        return pa.RecordBatch.from_arrays([pa.array([h % parts for h, *_ in rows], pa.int32()), pa.array(signed, pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())], schema=schema)

    def run(batches):
        table = Table()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                t = normal(text)
                table.add(int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little"), t, doc, 1)
                if table.bytes > limit:
                    yield send(table)
                    table = Table()
        if table.rows:
            yield send(table)

    return run


def _classes(memory):
    schema = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])

    def records(batches):
        for b in batches:
            for h, text, top, n in zip(*(b.column(k).to_pylist() for k in ("h", "text", "top", "n")), strict=True):
                yield h & 0xFFFFFFFFFFFFFFFF, text, top, n

    def run(batches):
        out = []
        for _, text, top, n in grace(records(batches), memory):
            out.append((hashlib.sha256(text).hexdigest(), top, n))
            if len(out) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _digests(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([hashlib.sha256(normal(t)).hexdigest() for t in b.column("text")], pa.string())], names=["doc_id", "text_sha256"])


def group_equal(docs: DataFrame, memory: int = MEMORY, fold: int = FOLD) -> DataFrame:
    """doc_id, text -> doc_id, keep_id, group_size, kept, text_sha256; a row for every row."""
    n = C.partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = rows.mapInArrow(_fold(4 * n, fold), "part int, h long, text binary, top long, n long").repartition(n, "part")
    classes = sent.mapInArrow(_classes(memory), "text_sha256 string, keep_id long, group_size long")
    members = rows.mapInArrow(_digests, "doc_id long, text_sha256 string")
    again = Window.partitionBy("doc_id", "text_sha256").orderBy(F.lit(1))
    members = members.withColumn("copy", F.row_number().over(again))
    out = members.join(classes, "text_sha256")
    return out.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def keep_rows(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns; of repeated rows one."""
    spark = docs.sparkSession
    groups = C.stored(group_equal(docs), C.shared_dir(spark))
    kept = groups.filter("kept").select(F.col("doc_id").alias("kept_doc_id"), F.col("text_sha256").alias("kept_sha256"))
    low = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tagged = docs.withColumn("kept_sha256_of", F.sha2(F.encode(low, "utf-8"), 256))
    hit = tagged["doc_id"].eqNullSafe(kept["kept_doc_id"]) & (tagged["kept_sha256_of"] == kept["kept_sha256"])
    out = tagged.join(kept, hit, "left_semi")
    if groups.filter("kept").join(groups.filter("not kept"), ["doc_id", "text_sha256"], "left_semi").count() or groups.filter("kept and doc_id is null").count():
        out = out.dropDuplicates(["doc_id", "kept_sha256_of"])  # only where rows are repeated: it moves the texts once more
    return out.select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_equal(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (
  SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
