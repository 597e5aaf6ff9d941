"""Benchmark decontamination by the q-gram lemma.

Texts are lower-cased (A-Z) and their white space is made single spaces. A benchmark item is cut
into passages: the whole item if it has at most WHOLE bytes, and every window of WINDOW bytes of an item longer than that, so that a part
of an item is found wherever it starts. A document holds a passage when some region of it is within the passage's edit
budget (BUDGET of its bytes, at every length). Lemma: a region within e edits of n bytes shares at least n - q + 1 - q * e of its
q-grams, on diagonals that differ by at most e. For that to be one at least, q is Q or, for short items, n / (e + 1); items are indexed by their q. So shared q-grams are counted by item in overlapping
diagonal bands; in bands that reach the bound, sums slid over the item's positions leave the passages that can hold, and banded
alignment of these with the region decides.

The benchmark is a stated query set: it is searched in blocks of at most BLOCK_BYTES of items (or one longer item). Only one block at a time is read and
broadcast; between blocks what was found is stored. A benchmark of one block takes one pass over the documents. Within a chunk of documents postings are expanded
a bounded slice at a time: counts of bands in a hashed table, which can only be too large, come first, and only what passes these is counted exactly.

Defined cases: null text and null items hold nothing; items below Q bytes must occur exactly, as whole words. Repeated rows each get their own result; ids of equal items are
all given, in order. A very long text is searched as a whole, its postings a slice at a time. An empty table gives no rows, an empty benchmark marks nothing. Extra columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

Q = 8  # most bytes in a q-gram: one 64-bit number
BUDGET = 0.1
WHOLE = 160
WINDOW = 128
BLOCK_BYTES = 16 << 20
SLICE = 1 << 21  # postings that are expanded at once
U64 = C.U64


def normal(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased A-Z, white space runs as one space, none at a text's start."""
    if not len(raw):
        return raw, off
    space = C.SPACE[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    heads = off[:-1][np.diff(off) > 0]
    keep[heads] = ~space[heads]
    text = C.LOWER[raw]
    text[space] = 32
    return text[keep], off - np.searchsorted(np.flatnonzero(~keep), off)


def grams(text: np.ndarray, q: int = Q) -> np.ndarray:
    """The q bytes from each position on as a number."""
    n = len(text) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if q == Q:
        return np.ndarray((n,), "<u8", np.ascontiguousarray(text), strides=(1,))
    padded = np.concatenate([text, np.zeros(Q - q, np.uint8)])
    return np.ndarray((n,), "<u8", padded, strides=(1,)) & U64((1 << 8 * q) - 1)


def gram_size(n: int, budget: float) -> int:
    """The q of an item of n bytes: with it, any region within the budget shares a q-gram."""
    return min([Q, *(m // (e + 1) for _, m, e in _cuts(n, budget))])


def _cuts(n: int, budget: float):
    for starts, m in ((np.zeros(1, np.int64), n if n <= WHOLE else 0), (np.arange(n - WINDOW + 1), WINDOW if n > WINDOW else 0)):
        if m:
            yield starts, m, min(int(m * budget), m - 1)


def cuts(n: int, budget: float) -> list[tuple[np.ndarray, int, int, int]]:
    """(starts, length, edits, least shared q-grams) of an item's passages, by length."""
    q = gram_size(n, budget)
    return [(starts, m, e, m - q + 1 - q * e) for starts, m, e in _cuts(n, budget)]


def passages(n: int, budget: float) -> list[tuple[int, int, int, int]]:
    """(start, length, edits, least shared q-grams) of an item's passages."""
    return [(int(a), m, e, t) for starts, m, e, t in cuts(n, budget) for a in starts]


def index(items: list[tuple[int, str]], budget: float) -> dict:
    """Indexes of the items' q-grams, one for each q, and the short items."""
    by: dict[int, tuple[list, list]] = {}
    short = []
    for i, t in items:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        text, _ = normal(raw, np.array([0, len(raw)], np.int64))
        text = np.frombuffer(text.tobytes().rstrip(), np.uint8)
        if len(text) >= Q:
            ids, texts = by.setdefault(gram_size(len(text), budget), ([], []))
            ids.append(i)
            texts.append(text)
        elif len(text):
            short.append((text.tobytes(), i))
    return {"by": [_index(q, *by[q], budget) for q in sorted(by)], "short": sorted(short, key=lambda x: (x[0], x[1] is None, x[1] or 0))}


def _index(q: int, ids: list, texts: list, budget: float) -> dict:
    """The sorted q-grams of the items with their postings."""
    code = np.concatenate([grams(t, q) for t in texts])
    item = np.concatenate([np.full(len(t) - q + 1, k) for k, t in enumerate(texts)])
    pos = np.concatenate([np.arange(len(t) - q + 1) for t in texts])
    order = np.argsort(code, kind="stable")
    code, item, pos = code[order], item[order], pos[order]
    edges = C.runs(code)
    bits = np.zeros(1 << 22, bool)
    bits[_bucket(code)] = True
    parts = [cuts(len(t), budget) for t in texts]
    width = 1 + max(e for p in parts for _, _, e, _ in p)
    least = np.array([min(t for _, _, _, t in p) for p in parts], np.int64)
    return {"q": q, "ids": ids, "texts": texts, "code": code[edges[:-1]], "edges": edges, "item": item, "pos": pos, "bits": np.packbits(bits), "cuts": parts, "width": width, "least": least}


def _bucket(code: np.ndarray) -> np.ndarray:
    return ((code * U64(0x9E3779B97F4A7C15)) >> U64(42)).astype(np.int64)


def tables(ix: dict) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each q which places of the hash table of q-grams are taken, and by which code: -1 for several."""
    bits, slots = [], []
    for one in ix["by"]:
        place = _bucket(one["code"])
        taken = np.zeros(1 << 22, np.int32)
        taken[place] = np.arange(len(place))
        taken[place[taken[place] != np.arange(len(place))]] = -1
        bits.append(np.unpackbits(one["bits"]).astype(bool))
        slots.append(taken)
    return bits, slots


def likely(have: np.ndarray, starts: np.ndarray, m: int, edits: int, least: int, q: int = Q) -> np.ndarray:
    """The starts whose passage can be within its edits, by which of the item's q-grams are shared. An edit spoils at most q grams in a row: so enough are
    shared, and `edits` stretches of q cover the others."""
    n, last = len(have), starts + m - q
    total = np.concatenate([[0], np.cumsum(have)])
    keep = total[last + 1] - total[starts] >= least
    starts, last = starts[keep], last[keep]
    if not len(starts):
        return starts
    gap = np.full(n + 1, n + q)  # the next q-gram that is not shared
    gap[:n][~have] = np.flatnonzero(~have)
    gap = np.minimum.accumulate(gap[::-1])[::-1]
    at = gap[starts]
    for _ in range(edits):
        at = gap[np.minimum(at + q, n)]
    return starts[at > last]


def within(item: np.ndarray, starts: np.ndarray, m: int, edits: int, text: np.ndarray, lo: int, hi: int, first: int, last: int) -> bool:
    """Whether text[lo:hi] has a part within `edits` of one of the passages item[start : start + m], on diagonals (place in text less place in item) that are at most
    `edits` off first..last. Alignment of all passages at once, row by row, free at the ends; those over budget leave."""
    if edits == 0:
        return any(item[a : a + m].tobytes() in text[max(lo, a + first) : min(hi, a + m + last)].tobytes() for a in starts.tolist())
    first, width = first - edits, last - first + 2 * edits + 1
    a, b = int(starts[0]) + first, int(starts[-1]) + first + m + width - 1
    region = np.full(b - a, 255, np.uint8)  # no byte of a text is 255
    x, y = max(a, lo), min(b, hi)
    if x < y:
        region[x - a : y - a] = text[x:y]
    region = np.lib.stride_tricks.sliding_window_view(region, width)
    ramp = np.arange(width, dtype=np.int16)
    row, place = np.zeros((len(starts), width), np.int16), starts - starts[0]
    for r in range(m):
        nxt = row + (region[place + r] != item[starts + r][:, None])
        np.minimum(nxt[:, :-1], row[:, 1:] + 1, out=nxt[:, :-1])
        nxt -= ramp
        row = np.minimum.accumulate(nxt, axis=1) + ramp
        if r % 8 == 7:
            keep = row.min(1) <= edits
            if not keep.all():
                row, place, starts = row[keep], place[keep], starts[keep]
                if not len(starts):
                    return False
    return bool(row.min() <= edits)


def exact(short: list[tuple[bytes, int]], text: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
    """Document -> the short items that stand in it as whole words."""
    found: dict[int, set[int]] = {}
    if not short or not len(text):
        return found
    part = text == 32
    first = ~part
    first[1:] &= part[:-1]
    first[off[:-1][off[:-1] < off[1:]]] = ~part[off[:-1][off[:-1] < off[1:]]]
    starts = np.flatnonzero(first)
    doc = np.searchsorted(off, starts, "right") - 1
    padded = np.concatenate([text, np.full(Q + 1, 32, np.uint8)])
    code = np.ndarray((len(text),), "<u8", padded, strides=(1,))[starts]
    for m in sorted({len(t) for t, _ in short}):
        names: dict[int, list[int]] = {}
        for t, i in short:
            if len(t) == m:
                names.setdefault(int.from_bytes(t, "little"), []).append(i)
        end = starts + m
        whole = (end <= off[doc + 1]) & ((end == off[doc + 1]) | (padded[end] == 32))
        low = code & U64((1 << 8 * m) - 1)
        for k in np.flatnonzero(whole & np.isin(low, np.array(list(names), np.uint64))):
            found.setdefault(int(doc[k]), set()).update(names[int(low[k])])
    return found


def search(ix: dict, bits: list[np.ndarray], slots: list[np.ndarray], raw: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
    """Document of the chunk -> the ids of the items that it holds."""
    text, off = normal(raw, off)
    out = exact(ix["short"], text, off)
    for one, taken, codes in zip(ix["by"], bits, slots, strict=True):
        for d, items in _long(one, taken, codes, text, off).items():
            out.setdefault(d, set()).update(one["ids"][i] for i in items)
    return out


def _long(ix: dict, bits: np.ndarray, slots: np.ndarray, text: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
    """Document -> the items (by number) of q bytes or more."""
    found: dict[int, set[int]] = {}
    q = ix["q"]
    code = grams(text, q)
    place = _bucket(code)
    at = np.flatnonzero(bits[place])
    k = slots[place[at]]
    more = np.flatnonzero(k < 0)  # several codes in one place
    k[more] = np.minimum(np.searchsorted(ix["code"], code[at[more]]), len(ix["code"]) - 1)
    doc = np.searchsorted(off, at, "right") - 1
    hit = (ix["code"][k] == code[at]) & (at + q <= off[doc + 1])
    at, k, doc = at[hit], k[hit], doc[hit]
    n = ix["edges"][k + 1] - ix["edges"][k]
    ends = np.cumsum(n)
    # bands of twice the width, each starting in the middle of the one before
    width = ix["width"]

    def expand(lo, hi):
        """(place, document, item, place in it, number of the band that starts with this half) for the hits lo..hi, a row for each posting."""
        m = n[lo:hi]
        post = np.repeat(ix["edges"][k[lo:hi]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        here, d, item, pos = np.repeat(at[lo:hi], m), np.repeat(doc[lo:hi], m), ix["item"][post], ix["pos"][post]
        half = (here - pos + len(text)) // width
        return here, d, item, pos, (d * len(ix["ids"]) + item) * (2 * len(text) // width + 3) + half

    counter = lambda band: ((band.astype(np.uint64) * U64(0x9E3779B97F4A7C15)) >> U64(46)).astype(np.int64)
    cuts = [0]
    while cuts[-1] < len(at):
        base = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, base + SLICE, "right"))))
    total, slices, kept = np.zeros(1 << 18, np.int64), [], []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        rows = expand(lo, hi)
        slices = [rows] if len(cuts) == 2 else []
        total += np.bincount(counter(rows[4]), minlength=1 << 18) + np.bincount(counter(rows[4] + 1), minlength=1 << 18)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        rows = slices[0] if slices else expand(lo, hi)
        need = ix["least"][rows[2]]
        ok = (total[counter(rows[4])] >= need) | (total[counter(rows[4] + 1)] >= need)
        kept.append([x[ok] for x in rows])
    if not kept:
        return found
    at, doc, item, pos, key = (np.concatenate(x) for x in zip(*kept, strict=True))
    both = np.concatenate([key, key + 1])  # the band that starts with this half, or with the one before
    names, back, count = np.unique(both, return_inverse=True, return_counts=True)
    live = (count[back] >= ix["least"][np.concatenate([item, item])]).nonzero()[0]
    if not len(live):
        return found
    live = live[np.argsort(back[live], kind="stable")]
    rows = live % len(at)
    edges = C.runs(back[live])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        mine = rows[a:b]
        d, i = int(doc[mine[0]]), int(item[mine[0]])
        if i in found.get(d, ()):
            continue
        p, diag = pos[mine], at[mine] - pos[mine]
        have = np.zeros(len(ix["texts"][i]) - q + 1, bool)
        have[p] = True
        for starts, m, edits, least in ix["cuts"][i]:
            starts = likely(have, starts, m, edits, least, q)
            if not len(starts):
                continue
            total = np.concatenate([[0], np.cumsum(have)])
            best = np.argmax(total[starts + m - q + 1] - total[starts])
            a, whole = int(starts[best]), ix["texts"][i]
            if total[a + m - q + 1] - total[a] == m - q + 1 and whole[a : a + m].tobytes() in text[off[d] : off[d + 1]].tobytes():  # no edit at all
                found.setdefault(d, set()).add(i)
                break
            here = diag[(p >= starts[0]) & (p <= starts[-1] + m - q)]
            bounds = int(off[d]), int(off[d + 1]), int(here.min()), int(here.max())
            if within(ix["texts"][i], starts[best : best + 1], m, edits, text, *bounds) or (len(starts) > 1 and within(ix["texts"][i], starts, m, edits, text, *bounds)):
                found.setdefault(d, set()).add(i)
                break
    return found


def _blocks(benchmark: DataFrame, budget: float):
    """Indexes of the benchmark's blocks, one at a time, with whether another one follows."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield k, index(sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])), budget), k < n - 1


def _found(ix, batches):
    """(chunk, ids of the items found by document)."""
    held = tables(ix.value)
    for b in C.chunks(batches, "text"):
        yield b, search(ix.value, *held, *C.utf8(b.column(b.schema.get_field_index("text"))))


def _passes(rows: DataFrame, benchmark: DataFrame, budget: float, step, schema) -> DataFrame:
    """step(index) as a pass over the rows for each block of the benchmark."""
    spark = rows.sparkSession
    base = C.shared_dir(spark)
    for k, made, more in _blocks(benchmark, budget):
        ix = spark.sparkContext.broadcast(made)
        rows = rows.mapInArrow(step(ix), schema)
        if more:
            rows = C.stored(rows, f"{base}/{k}")
            ix.destroy()
    return rows


def mark(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET) -> DataFrame:
    """doc_id, contaminated, item_ids (sorted, comma-joined) of every document."""

    def step(ix):
        def run(batches):
            for b, items in _found(ix, batches):
                hit = [had or i in items for i, had in enumerate(b.column("contaminated").to_pylist())]
                names = [had + sorted(x for x in items.get(i, ()) if x is not None) for i, had in enumerate(b.column("items").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(hit, pa.bool_()), pa.array(names, pa.list_(pa.int64()))], names=["doc_id", "text", "contaminated", "items"])

        return run

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(False).alias("contaminated"), F.array().cast("array<long>").alias("items"))
    rows = _passes(rows, benchmark, budget, step, "doc_id long, text string, contaminated boolean, items array<long>")
    return rows.select("doc_id", "contaminated", F.array_join(F.transform(F.array_sort(F.array_distinct("items")), lambda x: x.cast("string")), ",").alias("item_ids"))


def clean(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The rows of docs without a benchmark passage, all columns as they are."""

    def step(ix):
        def run(batches):
            for b, items in _found(ix, batches):
                yield b.filter(pa.array([i not in items for i in range(b.num_rows)], pa.bool_()))

        return run

    return _passes(docs, benchmark, budget, step, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
