"""Token ids in shard files with a minimal perfect hash index.

Documents are put in ascending doc_id order by a range shuffle; each task encodes its range and
writes shards. A shard image is a header, a minimal perfect hash index over the document keys
(bucket seeds by hash-and-displace; then, in slot order, a 32-bit fingerprint, offset and
length), and the raw ids, two bytes each (four for vocabularies over 65,536). A key is looked up with
two hashes and one fingerprint test. Images are rows of a table in the shared folder, so they go wherever
Spark writes; each row has the first and last key of its shard (the key-to-shard map), whose Parquet statistics let `lookup` read only the shards that may hold the keys asked for.

Encoding. Where the tokenizer file lower-cases, makes white space single spaces and splits texts by the pattern PIECES, white space parts words: encoding word by word and joining the ids
is the same as encoding the text (special tokens in a text have no white space either). So each worker process
keeps the ids of words it has met (about CACHE words, then those met once go) and gives only new words to the library. With any other file whole texts go to the library.

Defined cases: a null text counts as empty and has the end id alone. A null doc_id comes first.
Repeated doc_ids are separate documents, keyed by occurrence in the order of their texts.
An empty table gives no rows. Only doc_id and text are read, so further columns may have any name.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

END_ID = 1
SHARD_IDS = 2_000_000
CACHE = 1_200_000
U64 = C.U64
HEADER = struct.Struct("<4sIIIIQQ")  # magic, version, documents, buckets, bytes an id, ids, hash seed
MAGIC = b"FLTK"
NULL_KEY = -(1 << 63)
MOST_KEYS = 10_000  # keys of one look-up
#: The normaliser steps and the split pattern of tokenizer files under which words can be encoded one by one.
STEPS = ["NFC", "Replace", "Lowercase"]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


# ------------------------------------------------------------------ encoding


def parts_at_space(spec: dict) -> bool:
    """Whether a tokenizer file has the normaliser and pre-tokenizer that `WordCoder` knows, and no added token with white space."""
    norm = (spec.get("normalizer") or {}).get("normalizers") or []
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    space = len(norm) == 3 and (norm[1].get("pattern"), norm[1].get("content")) == ({"Regex": r"\s+"}, " ")
    split = pre[0].get("type") == "Split" and pre[0].get("pattern") == {"Regex": PIECES} and [p.get("type") for p in pre[1:]] == ["ByteLevel"]
    return [n.get("type") for n in norm] == STEPS and space and split and not any(re.search(r"\s", t["content"]) for t in spec.get("added_tokens") or [])


class WordCoder:
    """Ids of texts by way of a cache of words."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.by_words = parts_at_space(json.loads(self.tok.to_str()))
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.reset()

    def reset(self):
        self.at: dict[int, int] = {}
        self.second = np.zeros(1 << 16, np.uint64)
        self.seen = np.zeros(1 << 16, np.int32)
        self.edge = np.zeros((1 << 16) + 1, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)

    def trim(self):
        """Forget words that came in one chunk only; all of them, if that isn't enough."""
        n = len(self.at)
        keep = np.flatnonzero(self.seen[:n] > 1)
        if len(keep) > 3 * n // 4:
            self.reset()
            return
        lens = self.edge[keep + 1] - self.edge[keep]
        to = np.concatenate([[0], np.cumsum(lens)])
        self.ids = self.ids[np.repeat(self.edge[keep] - to[:-1], lens) + np.arange(to[-1])]
        new = np.full(n, -1)
        new[keep] = np.arange(len(keep))
        new = new.tolist()
        self.at = {h: new[k] for h, k in self.at.items() if new[k] >= 0}
        self.second[: len(keep)], self.seen[: len(keep)] = self.second[keep], 1
        self.edge[: len(to)] = to

    def coded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single words, end to end, and their numbers. Words of letters are one piece each, whose last id is an end-of-word id, so they
        can go to the library many at once, parted by spaces."""
        plain = [LETTERS.fullmatch(w) is not None for w in words]
        lens, ids = np.zeros(len(words), np.int64), [None, None]
        some = [w.decode() for w, p in zip(words, plain, strict=True) if p]
        lines = [" ".join(some[k : k + 24]) for k in range(0, len(some), 24)]
        flat = [i for e in self.tok.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids]
        ids[0] = np.array(flat, np.uint32)
        last = np.flatnonzero(self.ends[ids[0]])
        plain = np.array(plain, bool)
        if len(last) != len(some):
            raise ValueError("a word of letters must be one piece for the tokenizer")
        lens[plain] = np.diff(last, prepend=-1)
        rest = [e.ids for e in self.tok.encode_batch_fast([w.decode() for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False)]
        lens[~plain] = [len(r) for r in rest]
        ids[1] = np.array([i for r in rest for i in r], np.uint32)
        out, owner = np.zeros(int(lens.sum()), np.uint32), np.repeat(plain, lens)
        out[owner], out[~owner] = ids
        return out, lens

    def learn(self, first: list[int], second: np.ndarray, words: list[bytes]) -> None:
        ids, lens = self.coded(words)
        n, m = len(self.at), len(words)
        end = self.edge[n] + np.cumsum(lens)
        while n + m > len(self.second):
            self.second = np.concatenate([self.second, np.zeros_like(self.second)])
            self.seen = np.concatenate([self.seen, np.zeros_like(self.seen)])
            self.edge = np.concatenate([self.edge, np.zeros(len(self.edge), np.int64)])
        while end[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + 1024, np.uint32)])
        self.ids[self.edge[n] : end[-1]] = ids
        self.edge[n + 1 : n + m + 1] = end
        self.second[n : n + m], self.seen[n : n + m] = second, 0
        self.at.update(zip(first, range(n, n + m), strict=True))

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the documents of a chunk and the offsets by document."""
        if not self.by_words:
            return self.whole(raw, off)
        if len(self.at) > CACHE:
            self.trim()
        if b"<|" not in raw.tobytes():  # else a special token in capitals would turn into one
            raw = C.LOWER[raw]
        starts, ends, by = C.word_spans(raw, off)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        starts, ends, by = self.part_stops(raw, starts, ends, by)
        first = C.span_hashes(raw, starts, ends)
        back, key = pd.factorize(first)
        where = np.empty(len(key), np.int64)
        where[back[::-1]] = np.arange(len(back) - 1, -1, -1)  # where each comes first
        s, e = starts[where], ends[where]
        second = self.other_hash(raw, s, e)
        keys = key.tolist()
        known = self.at.get
        slot = np.array([known(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            data = raw.tobytes()
            words = [data[a:b] for a, b in zip(s[new].tolist(), e[new].tolist(), strict=True)]
            slot[new] = np.arange(len(self.at), len(self.at) + len(new))
            self.learn([keys[i] for i in new], second[new], words)
        if (self.second[slot] != second).any():  # two words with one 64-bit hash: whole texts instead
            return self.whole(raw, off)
        self.seen[slot] += 1
        slot = slot[back]
        lens = self.edge[slot + 1] - self.edge[slot]
        to = np.concatenate([[0], np.cumsum(lens)])
        take = np.repeat(self.edge[slot] - to[:-1], lens) + np.arange(to[-1])
        return self.ids[take], to[by]

    def whole(self, raw, off):
        """Whole texts by the library."""
        data = raw.tobytes()
        texts = [data[a:b].decode() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        coded = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *coded]), np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)

    @staticmethod
    def other_hash(raw, s, e):
        """Length, first and last eight bytes: a second look at words with equal hashes."""
        pad = np.concatenate([raw, np.zeros(8, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(pad, 8)
        head = np.ascontiguousarray(view[s]).view("<u8").ravel()
        tail = np.ascontiguousarray(view[np.maximum(e - 8, s)]).view("<u8").ravel()
        n = (e - s).astype(np.uint64)
        cut = U64(64) - np.minimum(n, U64(8)) * U64(8)
        short = cut > 0
        clean = np.where(short, (head << (cut & U64(63))) >> (cut & U64(63)), head)
        return C.mix(clean) ^ C.mix(np.where(short, U64(0), tail) + n)

    @staticmethod
    def part_stops(raw, starts, ends, by):
        """A comma or full stop after an ASCII letter or digit, or a Latin-1 letter, is a piece of its own for the tokenizer: taken off, more words are met again."""
        last, before = raw[ends - 1], raw[np.maximum(ends - 2, 0)]
        third = raw[np.maximum(ends - 3, 0)]
        n = ends - starts
        plain = ((before >= 97) & (before <= 122)) | ((before >= 65) & (before <= 90)) | ((before >= 48) & (before <= 57))
        latin = (n > 2) & (third == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
        stop = ((last == 46) | (last == 44)) & (n > 1) & (plain | latin)
        k = np.flatnonzero(stop)
        if not len(k):
            return starts, ends, by
        at = k + 1
        return np.insert(starts, at, ends[k] - 1), np.insert(np.where(stop, ends - 1, ends), at, ends[k]), by + np.searchsorted(at, by, "right")


_coders: dict[str, WordCoder] = {}


def coder(path: str) -> WordCoder:
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


# ------------------------------------------------------------------ minimal perfect hash


def key_hashes(keys: np.ndarray, seed: int) -> np.ndarray:
    """keys: (n, 2) of id and occurrence."""
    return C.mix(C.mix(keys[:, 0].astype(np.int64).view(np.uint64) + U64(seed)) + keys[:, 1].astype(np.uint64))


def slots_of(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    return (C.mix(h + d.astype(np.uint64) * U64(0x9E3779B97F4A7C15)) % U64(n)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(seed, bucket seeds, slot of each key, fingerprint of each key). Buckets are placed from the largest down; a
    bucket of one gets a free slot directly, stored as -1 - slot."""
    n = len(keys)
    for seed in range(100):
        h = key_hashes(keys, seed)
        if len(np.unique(h)) == n:
            break
    else:
        raise ValueError("keys must be distinct")
    r = max(1, -(-n // 4))
    bucket = ((h >> U64(17)) % U64(r)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(r + 1))
    seeds, slot, free = np.zeros(r, np.int32), np.zeros(n, np.int64), np.ones(n, bool)
    singles = []
    for b in np.argsort(-np.diff(edges), kind="stable"):
        mine = order[edges[b] : edges[b + 1]]
        if len(mine) < 2:
            singles += [(b, m) for m in mine]
            continue
        d = 1
        while True:
            tries = np.arange(d, d + 64)
            at = slots_of(h[mine][None], tries[:, None], n)
            ok = free[at].all(1) & (np.diff(np.sort(at, 1), axis=1) > 0).all(1)
            if ok.any():
                k = int(np.argmax(ok))
                break
            d += 64
        seeds[b], slot[mine] = tries[k], at[k]
        free[at[k]] = False
    for (b, m), s in zip(singles, np.flatnonzero(free), strict=True):
        seeds[b], slot[m] = -1 - s, s
    return seed, seeds, slot, (h >> U64(32)).astype(np.uint32)


def image(keys: np.ndarray, ids: np.ndarray, off: np.ndarray, width: int) -> bytes:
    """A shard: documents' ids end to end, and the index of their keys."""
    n = len(keys)
    seed, seeds, slot, finger = build_index(keys)
    fp, at, size = np.zeros(n, "<u4"), np.zeros(n, "<u8"), np.zeros(n, "<u4")
    fp[slot], at[slot], size[slot] = finger, off[:-1], np.diff(off)
    head = HEADER.pack(MAGIC, 1, n, len(seeds), width, len(ids), seed)
    return head + seeds.astype("<i4").tobytes() + fp.tobytes() + at.tobytes() + size.tobytes() + ids.astype(f"<u{width}").tobytes()


class Shard:
    """Keyed access to a shard image."""

    def __init__(self, blob: bytes):
        magic, version, self.n, r, width, n_ids, self.seed = HEADER.unpack_from(blob)
        if magic != MAGIC or version != 1:
            raise ValueError("not a shard image")
        at = HEADER.size
        parts = []
        for kind, n in (("<i4", r), ("<u4", self.n), ("<u8", self.n), ("<u4", self.n), (f"<u{width}", n_ids)):
            parts.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.seeds, self.fp, self.at, self.size, self.ids = parts

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(found, offset, length) of each key (id, occurrence)."""
        if not self.n:
            z = np.zeros(len(keys), np.int64)
            return z.astype(bool), z, z
        h = key_hashes(keys, self.seed)
        d = self.seeds[((h >> U64(17)) % U64(len(self.seeds))).astype(np.int64)]
        slot = np.where(d < 0, -1 - d, slots_of(h, np.maximum(d, 0), self.n))
        slot = np.minimum(slot, self.n - 1)
        return self.fp[slot] == (h >> U64(32)).astype(np.uint32), self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)


# ------------------------------------------------------------------ jobs

SHARDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("inside", pa.int64()), ("n_ids", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("first", pa.int64()), ("ids", pa.list_(pa.int64())), ("image", pa.binary())])


def _write(path, end_id, per_shard):
    def run(batches):
        code, part, seq, inside = coder(path), TaskContext.get().partitionId(), 0, 0
        docs, ids, lens, held, seen = [], [], [], 0, (None, 0)

        def flush():
            doc = [d for ds in docs for d, _ in ds]
            keys = np.array([(NULL_KEY if d is None else d, k) for ds in docs for d, k in ds], np.int64).reshape(-1, 2)
            off = np.concatenate([[0], np.cumsum(np.concatenate(lens))])
            row = [part, seq, inside, int(off[-1]), int(keys[0, 0]), int(keys[-1, 0]), int(keys[0, 1]), doc, image(keys, np.concatenate(ids), off, code.width)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, SHARDS, strict=True)], schema=SHARDS)

        for batch in C.chunks(batches, "text", min(C.CHUNK_BYTES, 4 * per_shard)):
            got, off = code.encode(*C.utf8(batch.column("text")))
            n = np.diff(off)
            full = np.insert(got, off[1:], end_id)
            mine = []
            for d in batch.column("doc_id").to_pylist():
                seen = (d, seen[1] + 1 if seen[0] == d else 0)
                mine.append(seen)
            docs.append(mine)
            ids.append(full)
            lens.append(n + 1)
            held += len(full)
            if held >= per_shard:
                yield flush()
                docs, ids, lens, held, seq, inside = [], [], [], 0, seq + 1, inside + held
        if docs:
            yield flush()

    return run


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, per_shard: int = SHARD_IDS) -> None:
    """Encode docs in ascending doc_id order and write shard images to `folder`."""
    n = C.partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, "doc_id")
    rows = rows.sortWithinPartitions("doc_id", "text")
    made = rows.mapInArrow(_write(tokenizer, end_id, per_shard), "part int, seq int, inside long, n_ids long, lo long, hi long, first long, ids array<long>, image binary")
    made.write.option("compression", "zstd").parquet(folder)


def _read(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for b in batches:
        for ids, blob, base in zip(b.column("ids"), b.column("image"), b.column("base").to_pylist(), strict=True):
            shard, doc, keys, seen = Shard(blob.as_buffer()), ids.as_py(), [], (None, 0)
            for d in doc:
                seen = (d, seen[1] + 1 if seen[0] == d else 0)
                keys.append((NULL_KEY if d is None else d, seen[1]))
            found, at, size = shard.find(np.array(keys, np.int64).reshape(-1, 2))
            if not found.all():
                raise ValueError("a key of the shard's own list isn't in its index")
            wide = shard.ids.astype("<u4")
            crc = [zlib.crc32(wide[a : a + n]) for a, n in zip(at.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(at + base), pa.array(size), pa.array(crc, pa.int64())], schema=schema)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in a folder of shards. Only a total for each range of the write comes to the driver."""
    shards = spark.read.parquet(folder)
    totals = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts, at = [], 0
    for part, n in totals:
        starts.append((part, at))
        at += n
    before = spark.createDataFrame(starts, "part int, before long")
    rows = shards.join(F.broadcast(before), "part").select("ids", "image", (F.col("before") + F.col("inside")).alias("base"))  # a row for each range of the write
    return rows.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """doc_id, occurrence, ids (as stored, with the end id) of at most MOST_KEYS doc_ids; those that aren't there give no rows. Shards whose range holds none of the keys
    aren't read; in a shard each key takes two hashes and a fingerprint test (32 bits: an absent key passes once in four thousand million)."""
    keys = sorted(set(keys))
    if len(keys) > MOST_KEYS:
        raise ValueError(f"at most {MOST_KEYS} keys: join with read_documents for more")
    schema = pa.schema([("doc_id", pa.int64()), ("occurrence", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches):
        for b in batches:
            for lo, hi, first, blob in zip(*(b.column(c).to_pylist() for c in ("lo", "hi", "first")), b.column("image"), strict=True):
                shard, got = Shard(blob.as_buffer()), []
                live = [(k, first if k == lo else 0) for k in keys if lo <= k <= hi]
                while live:  # the next occurrence of those that had one
                    found, at, size = shard.find(np.array(live, np.int64))
                    got += [(k, n, shard.ids[a : a + m].astype(np.int64)) for (k, n), f, a, m in zip(live, found.tolist(), at.tolist(), size.tolist(), strict=True) if f]
                    live = [(k, n + 1) for (k, n), f in zip(live, found.tolist(), strict=True) if f]
                yield pa.RecordBatch.from_arrays([pa.array([g[j] for g in got], f.type) for j, f in enumerate(schema)], schema=schema)

    some = F.lit(False)
    for k in range(0, len(keys), max(1, len(keys) // 64)):  # at most 65 or so ranges for Parquet's statistics
        part = keys[k : k + max(1, len(keys) // 64)]
        some = some | ((F.col("lo") <= part[-1]) & (F.col("hi") >= part[0]))
    return spark.read.parquet(folder).filter(some).select("lo", "hi", "first", "image").mapInArrow(run, "doc_id long, occurrence long, ids array<long>")


def query(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = f"{C.shared_dir(spark)}/shards"
    write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, tokenizer)
    return read_documents(spark, folder)
