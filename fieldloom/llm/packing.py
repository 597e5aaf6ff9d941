"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

Open bins are ordered by residual space and carry two bitmaps: the sources and the duplicate
clusters of their documents. A document goes to the successor of its length in that order; if
the bin has its source or cluster already, the search goes on to the next bin, until the
tightest compatible one is found, or a new bin is opened. Documents come in order of falling length.
A document longer than a bin is cut: whole bins are filled by it alone and the rest is packed as a piece.

Documents are dealt into groups of about GROUP_ROWS by a hash of their ids, and each group is packed by one
task from lengths and keys alone, without texts; a hot source is dealt out like any other.

Defined cases: no words (null, empty, blank): one row with piece 0 and no bin. A null source is a source of its
own. Ties go by doc_id, then piece. Repeated rows are one cluster, so they lie in different bins.
A null doc_id sorts first. An empty table gives no rows. Only doc_id, text and source are read (source may be missing).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

CAPACITY = 2048
GROUP_ROWS = 6000
BINS = 1 << 32  # bin numbers of a group


class Bins:
    """Open bins in order of residual."""

    def __init__(self, capacity: int):
        self.capacity, self.order, self.sources, self.clusters, self.residual = capacity, [], [], [], []

    def put(self, size: int, source: int, cluster: int) -> int:
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            room, k = self.order[at]
            if not (self.sources[k] & source or self.clusters[k] & cluster):
                del self.order[at]
                break
            at += 1
        else:
            k, room = len(self.residual), self.capacity
            self.sources.append(0)
            self.clusters.append(0)
            self.residual.append(0)
        self.sources[k] |= source
        self.clusters[k] |= cluster
        self.residual[k] = room - size
        if room > size:
            insort(self.order, (room - size, k))
        return k


def pack_group(rows: list[tuple], capacity: int) -> list[tuple]:
    """(doc_id, words, source, cluster) rows -> (doc_id, piece, words, bin, residual) rows."""
    bits: dict = {}
    bit = lambda kind, x: 1 << bits.setdefault(kind, {}).setdefault(x, len(bits[kind]))
    out, rest, bins = [], [], Bins(capacity)
    for doc, n, source, cluster in sorted(rows, key=lambda r: (-(r[1] % capacity), r[0] is not None, r[0] or 0, r[2] or "", r[3])):
        whole = n // capacity
        for piece in range(whole):
            bins.residual.append(0)
            bins.sources.append(-1)
            bins.clusters.append(-1)
            out.append((doc, piece, capacity, len(bins.residual) - 1))
        if n % capacity:
            rest.append((doc, whole, n % capacity, source, cluster))
        elif not n:
            out.append((doc, 0, 0, None))
    # clusters that one document alone has need no bit
    seen: dict = {}
    for r in rest:
        seen[r[4]] = seen.get(r[4], 0) + 1
    for doc, piece, n, source, cluster in rest:
        out.append((doc, piece, n, bins.put(n, bit("s", source), bit("c", cluster) if seen[cluster] > 1 else 0)))
    return [(*r, None if r[3] is None else bins.residual[r[3]]) for r in out]


def _lengths(batches):
    for b in C.chunks(batches, "text"):
        raw, off = C.utf8(b.column("text"))
        _, _, by = C.word_spans(raw, off)
        cluster = [int.from_bytes(hashlib.blake2b(t.as_buffer().to_pybytes().lower() if t.is_valid else b"", digest_size=8).digest(), "little", signed=True) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(by)), b.column("source"), pa.array(cluster, pa.int64())], names=["doc_id", "n_words", "source", "cluster"])


def _group(capacity):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int64()), ("n_words", pa.int64()), ("bin_id", pa.int64()), ("bin_residual", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        g = t.column("g")[0].as_py()
        rows = list(zip(*(t.column(k).to_pylist() for k in ("doc_id", "n_words", "source", "cluster")), strict=True))
        out = [(d, p, n, None if b is None else g * BINS + b, r) for d, p, n, b, r in pack_group(rows, capacity)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, text, source -> doc_id, piece, n_words, bin_id, bin_residual (words that the bin has left)."""
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", source.alias("source"))
    groups = max(1, -(-docs.count() // group_rows))
    sizes = rows.mapInArrow(_lengths, "doc_id long, n_words long, source string, cluster long")
    dealt = sizes.withColumn("g", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(groups)).cast("long"))
    return dealt.groupBy("g").applyInArrow(_group(capacity), "doc_id long, piece long, n_words long, bin_id long, bin_residual long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
