"""Shared helpers: Arrow text kernels in numpy, block shuffles, shared folders, connected components.

Text kernels work on chunks of about a megabyte, so the memory of a task is
bounded by a chunk (or by one document, if that is longer) and not by its input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import scratch

CHUNK_BYTES = 1 << 20
LINKS = 2_000_000  # links of a task
U64 = np.uint64
_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xD1342543DE82EF95 | 1

#: The white space that parts words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ---------------------------------------------------------------- shared folder


shared_dir = scratch.folder  # a new folder that driver and executors all see; an error where none is named and the master isn't local


def stored(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it again. Zstandard keeps it small."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- Arrow text


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about `limit` bytes, or a single longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            to = min(to, batch.num_rows, at + 4000)
            yield batch.slice(at, to - at)
            at = to


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(raw: np.ndarray, off: np.ndarray, part: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs outside `part`, never over a document's edge) and, by document, the offsets of its words."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = ~part[raw]
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = off[off < len(raw)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    edges = off[off > 0] - 1
    after[edges] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off).astype(np.int64)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverses modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        both = []
        for b in (base, inverse):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        have = _powers[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by prefix sums of a polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, inv = powers(BYTE_BASE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_CODES[raw] * p[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts])


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the `length` words from each position on (positions that have so many)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p, inv = powers(WORD_BASE, len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * p[:-1], out=total[1:])
    return mix((total[length:] - total[:n]) * inv[:n] + U64(length))


# ---------------------------------------------------------------- block shuffle


def pack(*arrays: np.ndarray) -> bytes:
    return np.array([len(a) for a in arrays], "<i8").tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, "<i8", len(kinds))
    out, at = [], 8 * len(kinds)
    for n, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(blob, kind, int(n), at))
        at += int(n) * np.dtype(kind).itemsize
    return out


def blocks(part: np.ndarray, parts: int, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Deal parallel arrays out by part number into one packed block for each part that has rows."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    arrays = tuple(a[order] for a in arrays)
    for k in np.flatnonzero(np.diff(edges)):
        lo, hi = edges[k], edges[k + 1]
        yield int(k), pack(*(a[lo:hi] for a in arrays))


def gather(batches: Iterable[pa.RecordBatch], column: str, *kinds: str) -> list[np.ndarray]:
    """The arrays of all blocks of a partition, end to end."""
    got: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for b in batches:
        for blob in b.column(b.schema.get_field_index(column)):
            if blob.is_valid:
                for g, a in zip(got, unpack(blob.as_buffer(), *kinds), strict=True):
                    g.append(a)
    return [np.concatenate(g) for g in got]


def batches_of(schema: pa.Schema, columns: list, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `rows` rows out of whole columns."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    n = len(arrays[0]) if arrays else 0
    for at in range(0, n, rows):
        yield pa.RecordBatch.from_arrays([a.slice(at, rows) for a in arrays], schema=schema)


def runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values in a sorted array, and its length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).astype(np.int64)


# ---------------------------------------------------------------- connected components


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each id of a task's links with the smallest that it reaches by them: minima are passed along until none changes."""
    got = [np.stack([b.column(k).to_numpy() for k in (0, 1)]) for b in batches]
    ids, ends = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *got], 1), return_inverse=True)
    u, v = ends.reshape(2, -1)
    low = np.arange(len(ids))
    while True:
        new = low.copy()
        least = np.minimum(low[u], low[v])
        np.minimum.at(new, low[u], least)
        np.minimum.at(new, low[v], least)
        new = new[new]
        if (new == low).all() and (low[u] == low[v]).all():
            break
        low = new
    mine = np.flatnonzero(low != np.arange(len(ids)))
    yield from batches_of(pa.schema([("u", pa.int64()), ("v", pa.int64())]), [ids[mine], ids[low[mine]]])


def components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(a, b) links of long ids -> (id, component): the smallest id that each linked id reaches.

    First each task replaces its own links, about LINKS of them, by stars about the smallest ids that these reach, so long chains are short before
    anything is shuffled; links that one task holds are done with that. Then alternating large-star and small-star rounds; each round is two aggregations and two joins on
    edges only, its result is a table in the shared folder, and nothing but a count and a checksum
    comes to the driver. Hubs: the minimum is aggregated before the shuffle, and the join that
    gives it back has one row for each id on one side, so Spark can split a hub's partition.
    """
    spark = links.sparkSession
    base = shared_dir(spark)
    pair = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    pair = stored(pair, f"{base}/pairs")
    tasks = max(1, -(-pair.count() // LINKS))
    edges, seen = stored(pair.coalesce(tasks).mapInArrow(_stars, "u long, v long").distinct(), f"{base}/0"), None
    if tasks == 1:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
    for k in range(1, most_rounds + 1):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), f"{base}/{k}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: no fixed point after {most_rounds} rounds")
    return edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component").union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
