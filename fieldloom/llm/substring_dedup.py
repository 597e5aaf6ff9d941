"""Substring deduplication by level-wise doubling of repeated windows.

The first level looks at windows of the window's length halved as often as it goes without a remainder and without falling under SHORTEST words
(at least once; 50 words have one shorter level, of 25, and 100 have two). Of a level's windows only the smallest hash within each full
window is sent to the shuffle: equal full windows have equal shorter ones inside, so they agree on that
one, and none is lost. Those that several documents share alone are extended to twice the length, the next level, where a full window goes on only
if its window of the level before is repeated; and so on up to the full length, or until no candidates survive (then there is nothing to send). What the
last level sends is pre-aggregated: of equal windows met in one task, only the smallest document's
goes on, the others are settled on the spot; so a passage in a third of all rows costs a few rows
from each task. Its keys are two 64-bit hashes (of the half and of the whole window).

Defined cases: a null text has no words. A null doc_id neither removes words elsewhere nor loses any.
Repeated rows (same doc_id and text) get equal results; the same doc_id never counts as smaller
than itself. Documents of fewer words than a window lose nothing. An empty table gives no rows.
Only doc_id and text are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

HELD = 2_000_000  # windows that a task holds before it sends them
SHORTEST = 16  # words below which a level isn't halved further


def _words(batch):
    raw, off = C.utf8(batch.column("text"))
    starts, ends, by = C.word_spans(raw, off)
    return C.span_hashes(raw, starts, ends), by


def _lowest(h: np.ndarray, span: int) -> np.ndarray:
    """The minimum of h over `span` positions from each on, by doubling."""
    n, width, m = len(h) - span + 1, 1, h
    while width * 2 <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[:n], m[span - width : span - width + n])


def _windows(words, by, window, length):
    """Hashes of the windows, the smallest hash of `length` words in each, and their documents; windows inside one document only."""
    n = len(words) - window + 1
    if n <= 0:
        z = np.zeros(0, np.uint64)
        return z, z, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _lowest(C.window_hashes(words, length), window - length + 1)
    doc = np.repeat(np.arange(len(by) - 1), np.diff(by))[:n]
    pos = np.arange(n) - by[doc]
    good = np.arange(n) + window <= by[doc + 1]
    return C.window_hashes(words, window)[good], low[good], doc[good], pos[good]


def _alive(batch, low, doc):
    """The windows whose hash of the level before came back to their document."""
    lists = batch.column("hs")
    known, lens = lists.flatten().to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy())
    if not len(low) or not len(known):
        return np.zeros(len(low), bool)
    tag = np.repeat(np.arange(len(lens)), lens).astype(np.uint64) * C.U64(0x9E3779B97F4A7C15)
    table = np.sort(known ^ tag)
    probe = low ^ (doc.astype(np.uint64) * C.U64(0x9E3779B97F4A7C15))
    return table[np.minimum(np.searchsorted(table, probe), len(table) - 1)] == probe


def _texts(batches, extended):
    """Chunks of text; of documents with candidates of the level before, if there was one."""
    for batch in batches:
        yield from C.chunks([batch.filter(batch.column("hs").is_valid())] if extended else [batch], "text")


def _level(window, length, before, parts, most):
    """A level below the last: hashes of `length` words, within full windows that the level before (of `before` words) has left."""
    schema = pa.schema([("part", pa.int32()), ("payload", pa.binary())])

    def send(held):
        m, doc, rid = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((doc, m))
        m, doc, rid = m[order], doc[order], rid[order]
        edges = C.runs(m)
        first, last = edges[:-1], edges[1:] - 1
        several = doc[first] != doc[last]  # repeated within this task: known now
        own = np.repeat(several, np.diff(edges))
        head = np.zeros(len(m), bool)
        head[first] = True
        # one row for each hash goes to its part; the others of a known repeat may go anywhere
        keep = head | ~own
        keep[1:] &= head[1:] | (doc[1:] != doc[:-1]) | (rid[1:] != rid[:-1])
        rest = own & ~head
        rest[1:] &= (doc[1:] != doc[:-1]) | (rid[1:] != rid[:-1])
        part = np.where(keep, m % C.U64(parts), rid.view(np.uint64) % C.U64(parts)).astype(np.int64)
        pick = keep | rest
        flag = np.where(rest, 2, np.where(own, 1, 0)).astype(np.int8)
        out = list(C.blocks(part[pick], parts, m[pick], doc[pick], rid[pick], flag[pick]))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], schema=schema)

    def run(batches):
        held, n = [], 0
        for batch in _texts(batches, before):
            words, by = _words(batch)
            _, low, doc, _ = _windows(words, by, window, length)
            if before and len(low):
                live = _alive(batch, _windows(words, by, window, before)[1], doc)
                low, doc = low[live], doc[live]
            if not len(low):
                continue
            new = np.ones(len(low), bool)
            new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
            low, doc = low[new], doc[new]
            held.append((low, batch.column("doc_id").to_numpy()[doc], batch.column("rid").to_numpy()[doc]))
            n += len(low)
            if n > most:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return run


def _repeated(batches):
    """Hashes of a level that several documents have, given back to each of these."""
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("h", pa.int64())])
    m, doc, rid, flag = C.gather(batches, "payload", "<u8", "<i8", "<i8", "<i1")
    away = flag == 2
    sent = (doc[away], rid[away], m[away])
    m, doc, rid, flag = m[~away], doc[~away], rid[~away], flag[~away]
    order = np.lexsort((doc, m))
    m, doc, rid, flag = m[order], doc[order], rid[order], flag[order]
    edges = C.runs(m)
    if len(m):
        several = (doc[edges[:-1]] != doc[edges[1:] - 1]) | (np.maximum.reduceat(flag, edges[:-1]) > 0)
        pick = np.repeat(several, np.diff(edges))
        sent = tuple(np.concatenate([a, b[pick]]) for a, b in zip(sent, (doc, rid, m), strict=True))
    yield from C.batches_of(schema, [sent[0], sent[1], sent[2].view(np.int64)])


def _settle(low, win, doc):
    """For windows with keys (low, win): whether an equal one is in a smaller document."""
    order = np.lexsort((doc, win, low))
    a, b, d = low[order], win[order], doc[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    least = d[np.flatnonzero(new)][group] if len(d) else d
    cut = np.zeros(len(a), bool)
    cut[order] = d > least
    return cut


SEGMENT = 32  # windows in a segment: neighbours with one hash of the level before


def _segments(low, doc, pos, rid):
    """Starts of runs of neighbouring windows with one hash of the level before, at most SEGMENT long."""
    if not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (rid[1:] != rid[:-1]) | (pos[1:] != pos[:-1] + 1)
    at = np.flatnonzero(new)
    inside = np.arange(len(low)) - np.repeat(at, np.diff(np.append(at, len(low))))
    new |= inside % SEGMENT == 0
    at = np.flatnonzero(new)
    return at, np.arange(len(low)) - np.repeat(at, np.diff(np.append(at, len(low))))


def _last(window, length, parts, most):
    schema = pa.schema([("part", pa.int32()), ("payload", pa.binary())])

    def send(held):
        win, low, doc, pos, rid = (np.concatenate(x) for x in zip(*held, strict=True))
        cut = _settle(low, win, doc)
        head = ~cut  # of its kind in the smallest document here; only these go on
        at, inside = _segments(low, doc, pos, rid)
        n = np.diff(np.append(at, len(low)))
        bit = np.left_shift(np.int64(1), inside)
        mask = np.add.reduceat(np.where(cut, bit, 0), at)
        ask = np.add.reduceat(np.where(head, bit, 0), at)  # windows whose fate others decide
        part = np.where(ask != 0, low[at] % C.U64(parts), rid[at].view(np.uint64) % C.U64(parts)).astype(np.int64)
        seg = np.repeat(np.arange(len(at)), n)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        of_seg = np.concatenate([[0], np.cumsum(np.bincount(seg[head], minlength=len(at)))])
        wins = win[head]
        ks, blobs = [], []
        for k in np.flatnonzero(np.diff(edges)):
            mine = order[edges[k] : edges[k + 1]]
            mine = mine[(mask[mine] != 0) | (ask[mine] != 0)]
            if len(mine):
                got = np.concatenate([wins[of_seg[i] : of_seg[i + 1]] for i in mine])
                ks.append(int(k))
                blobs.append(C.pack(low[at][mine], doc[at][mine], rid[at][mine], pos[at][mine].astype(np.int32), mask[mine], ask[mine], got))
        return pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(blobs, pa.binary())], schema=schema)

    def run(batches):
        held, n = [], 0
        for batch in _texts(batches, True):
            words, by = _words(batch)
            win, low, doc, pos = _windows(words, by, window, length)
            live = _alive(batch, low, doc)
            win, low, doc, pos = win[live], low[live], doc[live], pos[live]
            if len(low):
                held.append((win, low, batch.column("doc_id").to_numpy()[doc], pos, batch.column("rid").to_numpy()[doc]))
                n += len(low)
            if n > most:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return run


def _decide(batches):
    """Masks of the removable windows by segment."""
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("start", pa.int32()), ("mask", pa.int64())])
    low, doc, rid, pos, mask, ask, win = C.gather(batches, "payload", "<u8", "<i8", "<i8", "<i4", "<i8", "<i8", "<u8")
    bits = (ask[:, None] >> np.arange(SEGMENT)) & 1
    seg, bit = np.nonzero(bits)
    cut = _settle(low[seg], win, doc[seg])
    more = np.zeros(len(low), np.int64)
    np.add.at(more, seg[cut], np.left_shift(np.int64(1), bit[cut].astype(np.int64)))
    mask = mask | more
    pick = mask != 0
    yield from C.batches_of(schema, [doc[pick], rid[pick], pos[pick], mask[pick]])


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def _cut(window, with_text):
    schema = RESULT if with_text else pa.schema(list(RESULT)[:-1])

    def run(batches):
        for batch in C.chunks(batches, "text", 4 << 20):
            cols = [[], [], [], []]
            lists = batch.column("cuts")
            edges, flat = lists.offsets.to_numpy(), lists.values
            all_starts, all_masks = flat.field("start").to_numpy(), flat.field("mask").to_numpy()
            for k, text in enumerate(batch.column("text")):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                n = len(words)
                if n and edges[k + 1] > edges[k]:
                    masks = all_masks[edges[k] : edges[k + 1]]
                    seg, bit = np.nonzero((masks[:, None] >> np.arange(SEGMENT)) & 1)
                    at = all_starts[edges[k] : edges[k + 1]][seg] + bit
                    cover = np.bincount(at, minlength=n + window) - np.bincount(at + window, minlength=n + window)
                    gone = np.cumsum(cover)[:n] > 0
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept = b" ".join(words)
                cols[0].append(n)
                cols[1].append(n - len(words))
                cols[2].append(hashlib.sha256(kept).hexdigest())
                cols[3].append(kept.decode() if with_text else None)
            arrays = [batch.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(cols[3], pa.string())] * with_text, schema=schema)

    return run


def lengths(window: int) -> list[int]:
    """Words in the windows of each level; the last has the full window."""
    out = [window // 2, window]
    while out[0] % 2 == 0 and out[0] // 2 >= SHORTEST:
        out.insert(0, out[0] // 2)
    return out


def remove_repeats(docs: DataFrame, window: int = 50, with_text: bool = False, held: int = HELD) -> DataFrame:
    """doc_id, text -> doc_id, n_words, n_removed, kept_sha256 (and kept_text): every word that is covered by a window
    whose words also start in a document with a smaller doc_id goes. `window` is even: the level before the last has half of it."""
    if window < 2 or window % 2:
        raise ValueError("window must be even: a level has windows of half its length")
    n = C.partitions(docs.sparkSession)
    parts = 4 * n
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("rid"))
    known = rows.filter("doc_id is not null")
    live, before = known, None
    for length in lengths(window)[:-1]:
        sent = live.mapInArrow(_level(window, length, before, parts, held), "part int, payload binary").repartition(n, "part")
        back = sent.mapInArrow(_repeated, "doc_id long, rid long, h long")
        lists = back.groupBy("doc_id", "rid").agg(F.collect_list("h").alias("hs"))
        live, before = rows.join(lists, ["doc_id", "rid"], "left").select("doc_id", "rid", "text", "hs"), length
    sent = live.mapInArrow(_last(window, before, parts, held), "part int, payload binary").repartition(n, "part")
    cuts = sent.mapInArrow(_decide, "doc_id long, rid long, start int, mask long")
    cuts = cuts.groupBy("doc_id", "rid").agg(F.collect_list(F.struct("start", "mask")).alias("cuts"))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return rows.join(cuts, ["doc_id", "rid"], "left").select("doc_id", "text", "cuts").mapInArrow(_cut(window, with_text), out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), h AS (
  SELECT doc_id, unnest(range(1, len(ws) - 48)) AS i, unnest(list_transform(range(1, len(ws) - 48), lambda j: md5(array_to_string(ws[j:j + 49], ' ')))) AS k FROM w WHERE len(ws) >= 50
), c AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS least FROM h) q WHERE least < doc_id
), g AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS gone FROM c GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""
