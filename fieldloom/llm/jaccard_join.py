"""N-gram Jaccard join by parity sketches.

A document's distinct word shingles are hashed into a long bit vector in which each shingle flips
one bit. Two such vectors differ in at most |A - B| + |B - A| bits, so their Hamming distance is a
lower bound of the symmetric difference. For a similarity of t the difference is at most
d = (1 - t) / (1 + t) * (|A| + |B|).

Join. In each band of sizes (a band spans a factor of four; sizes just above a band's start also
appear in the band below) the vector is cut into k segments. Pigeonhole: linked documents differ in
at most d segments, so of the first d + 1 of the non-empty segments of either, in one global order,
they share one. A segment travels as a 51-bit key: the XOR of the 64-bit hashes of the shingles in
it, with band and segment number. The order only decides which keys are sent; any order gives the same links.
It puts keys that are common in the corpus last (at most HOT_KEYS of them are broadcast, which is the proven
bound of that list), so a passage that a third of all documents share makes no candidates among documents that
have enough text of their own.

Groups of documents under one key are never paired out. They travel on as packed lists, dealt by their smallest member: a passage of fifty words
makes dozens of keys, but the lists of these keys have nearly the same members and mostly one smallest member, so each document's sketch is sent once or twice for a passage and
not once for each key. Where lists meet, sketches (COARSE bits for a shingle, FINE ones in later rounds) are held against each other, list by list: a Hamming distance over d rejects a pair. Where the lists
of one smallest member have more than 4 * BLOCK documents together, and for keys known to have more than SPLIT documents, which are dealt to several tasks, members
travel by key instead: groups are split by size (sets that link differ by less than a third) and compared in blocks.

Verify. Only components matter. So of each place each set gives the nearest candidate alone; the nearest of these is verified with the shingle sets of the whole texts. (In
groups compared in blocks this first round takes neighbours in the list that meet under most keys.) The second round does the same between
different components, in each place. The last one takes all candidates that are left between different components, so no link between components is lost. A pair is
dealt by that of its sets that has more pairs.

Nodes are distinct shingle sets, not doc_ids. Defined cases: null, empty or blank text has an empty set and is linked with nothing.
Equal sets are linked without verification. Each row is a document of its own: repeated rows give one output row each, and rows with one doc_id
and different texts each get the component of their own text. Null doc_id rows are returned with a null component and link nothing. Only doc_id
and text are read, so further columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

HOT_KEYS = 1 << 17
HELD = 3_000_000  # keys that a task holds before it sends them
GROUP = 64  # lists up to this size are compared many at a time
SPLIT = 1 << 16  # members of a key that one task takes
BLOCK = 1024  # members in a block of a large group
TOGETHER = 4096  # documents in a bucket of lists
COARSE, FINE = 1.5, 6  # bits of a sketch for each shingle, in the first round and later
BUCKET = 512  # pairs that are verified together
BLOCK_BYTES = 64 << 20  # sketches in a block of a large group
STEP_BYTES = 64 << 20  # sketches that are compared at once
PART_SHINGLES = 4_000_000  # shingles of a shuffle partition
U64 = C.U64


# ------------------------------------------------------------------ shingles


def shingles(raw: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of all documents, and offsets by document. With fewer words the whole sequence is one."""
    low = C.LOWER[raw]
    starts, ends, by = C.word_spans(low, off)
    words = C.span_hashes(low, starts, ends)
    count = np.diff(by)
    full = np.maximum(count - width + 1, 0)
    n = np.where((count > 0) & (count < width), 1, full)
    out = np.zeros(int(n.sum()), np.uint64)
    at = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    wide = C.window_hashes(words, width)
    has = count >= width
    if has.any():
        src = np.repeat(by[:-1][has] - at[:-1][has], full[has]) + np.flatnonzero(np.repeat(has, n))
        out[np.repeat(has, n)] = wide[src]
    for m in range(1, width):
        mine = np.flatnonzero(count == m)
        if len(mine):
            out[at[mine]] = C.window_hashes(words, m)[by[mine]]
    return out, at


def distinct_sets(batch: pa.RecordBatch, width: int):
    """The sorted distinct shingle hashes of each document of a chunk."""
    raw, off = C.utf8(batch.column("text"))
    hashes, at = shingles(raw, off, width)
    return [np.unique(hashes[at[i] : at[i + 1]]) for i in range(batch.num_rows)]


def sketch(h: np.ndarray, bits: float) -> bytes:
    """Parity of the shingles on each bit; `bits` for each shingle or more, a power of two in all."""
    m = 64
    while m < bits * len(h):
        m *= 2
    return np.packbits((np.bincount(((h >> U64(9)) & U64(m - 1)).astype(np.int64), minlength=m) & 1).astype(np.uint8), bitorder="little").tobytes()


def fingerprint(h: np.ndarray) -> bytes:
    """128 bits of a set: sums of two mixes of its members."""
    if not len(h):
        return b""
    return np.array([C.mix(h).sum(), C.mix(h ^ U64(0x5851F42D4C957F2D)).sum()], np.uint64).tobytes()


# ------------------------------------------------------------------ segment keys


def segment_keys(sets: list[np.ndarray], percent: int, hot: np.ndarray, ranks: np.ndarray | None = None):
    """(document, key) of the first d + 1 non-empty segments of each set in each of its bands. Hot keys come last, by rank."""
    size = np.array([len(s) for s in sets], np.int64)
    band = np.array([(max(int(a), 1).bit_length() - 1) // 2 for a in size], np.int64)
    lo = 4**band
    rest, over = 100 - percent, 100 + percent
    doc = np.arange(len(sets))
    own = rest * (size + 100 * size // percent) // over
    below = rest * (size + lo - 1) // over
    down = (band > 0) & ((lo - 1) * 100 >= percent * size)
    doc = np.concatenate([doc[size > 0], doc[down]])
    at_band = np.concatenate([band[size > 0], band[down] - 1])
    most = np.concatenate([own[size > 0], below[down]])
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n = size[doc]
    row = np.repeat(np.arange(len(doc)), n)
    h = np.concatenate([sets[i] for i in doc])
    k = np.maximum(2 * 4**at_band, 1024).astype(np.uint64)  # powers of two
    seg = (h >> U64(20)) & (k[row] - U64(1))
    order = np.argsort((row.astype(np.uint64) << U64(40)) | seg, kind="stable")
    row, seg, h = row[order], seg[order], h[order]
    edges = C.runs((row.astype(np.uint64) << U64(40)) | seg)
    first = edges[:-1]
    fold = np.bitwise_xor.reduceat(h, first)
    row = row[first]
    key = C.mix(fold + C.mix(seg[first] + (at_band[row].astype(np.uint64) << U64(44)))) >> U64(13)
    # a set with no more than d segments could meet another such only in empty ones: these meet under a key of the band
    few = np.flatnonzero(np.bincount(row, minlength=len(doc)) <= most)
    row, key = np.concatenate([row, few]), np.concatenate([key, C.mix(at_band[few].astype(np.uint64) + U64(77)) >> U64(13)])
    most[few] += 1
    order_of = key  # 12 bits of row, one for hot, 51 of key or rank: sorted as plain numbers
    if len(hot):
        at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        order_of = np.where(hot[at] == key, U64(1 << 51) | ranks[at].astype(np.uint64), key)
        by_rank = hot[np.argsort(ranks)]
    got = [np.zeros(0, np.uint64)]
    for base in range(0, len(doc), 4096):
        mine = (row >= base) & (row < base + 4096)
        got.append(np.sort(((row[mine] - base).astype(np.uint64) << U64(52)) | order_of[mine]))
        r = (got[-1] >> U64(52)).astype(np.int64) + base
        head = np.concatenate([[0], np.flatnonzero(r[1:] != r[:-1]) + 1]) if len(r) else np.zeros(0, np.int64)
        rank = np.arange(len(r)) - np.repeat(head, np.diff(np.append(head, len(r))))
        keep = rank <= most[r]
        low = got[-1][keep] & U64((1 << 51) - 1)
        if len(hot):
            late = (got[-1][keep] & U64(1 << 51)) > 0
            low[late] = by_rank[low[late].astype(np.int64)]
        got[-1] = np.stack([doc[r[keep]].astype(np.uint64), low], 1).ravel()
    flat = np.concatenate(got).reshape(-1, 2)
    return flat[:, 0].astype(np.int64), flat[:, 1]


PROFILE = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("sketch", pa.binary()), ("hot", pa.binary())])


def _profile(width, percent, most):
    def common(held):
        key = np.sort(np.concatenate(held))
        edges = C.runs(key)
        n = np.diff(edges)
        pick = n >= 8
        if pick.any():
            blob = C.pack(key[edges[:-1][pick]], n[pick].astype("<i8"))
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in list(PROFILE)[:-1]), pa.array([blob], pa.binary())], schema=PROFILE)

    def run(batches):
        held, n = [], 0
        for batch in C.chunks(batches, "text"):
            sets = distinct_sets(batch, width)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) for s in sets], pa.binary()), pa.array([sketch(s, COARSE) for s in sets], pa.binary()), pa.nulls(len(sets), pa.binary())], schema=PROFILE)
            held.append(segment_keys(sets, percent, np.zeros(0, np.uint64))[1])
            n += len(held[-1])
            if n > most:
                yield from common(held)
                held, n = [], 0
        if held:
            yield from common(held)

    return run


def _unpack_hot(batches):
    for b in batches:
        for blob in b.column(0):
            key, n = C.unpack(blob.as_buffer(), "<u8", "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])


def _send_keys(width, percent, parts, hot, most, split):
    """Blocks of (key, doc_id) by part. `hot` are (keys, ranks, members), by key."""
    schema = pa.schema([("part", pa.int32()), ("payload", pa.binary())])

    def send(held):
        table, shares = hot.value[0], -(-hot.value[2] // split)
        key, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        salt = np.zeros(len(key), np.uint64)
        if len(table) and shares.max() > 1:
            at = np.minimum(np.searchsorted(table, key), len(table) - 1)
            share = np.where(table[at] == key, shares[at], 1).astype(np.uint64)
            salt = C.mix(ids.view(np.uint64)) % share
        out = list(C.blocks(((key + salt) % U64(parts)).astype(np.int64), parts, key, ids))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], schema=schema)

    def run(batches):
        seen, held, n = set(), [], 0
        for batch in C.chunks(batches, "text"):
            sets = distinct_sets(batch, width)
            ids, fresh, mine = batch.column("doc_id").to_numpy(zero_copy_only=False), [], []
            for i, s in enumerate(sets):
                if len(s) and (fp := fingerprint(s)) not in seen:  # equal sets in one task send their keys once
                    seen.add(fp)
                    fresh.append(s)
                    mine.append(ids[i])
            if fresh:
                doc, key = segment_keys(fresh, percent, *hot.value[:2])
                held.append((key, np.array(mine, np.int64)[doc]))
                n += len(key)
            if n > most:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return run


def _sorted(key, doc):
    """Distinct rows by key and document, and the edges of the keys."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    if len(key):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        key, doc = key[new], doc[new]
    return key, doc, C.runs(key)


def _groups(parts, split, hot):
    """Groups of two or more as blocks of (key, doc_id), dealt by the smallest doc_id of each; part -1: keys that were dealt to several tasks."""
    schema = pa.schema([("part", pa.int32()), ("payload", pa.binary())])

    def run(batches):
        key, doc, edges = _sorted(*C.gather(batches, "payload", "<u8", "<i8"))
        first, size = edges[:-1], np.diff(edges)
        part = (C.mix(doc[first].view(np.uint64)) % U64(parts)).astype(np.int64) + 1
        parted = np.isin(key[first], hot.value[0][hot.value[2] > split])
        part[parted] = 0
        keep = np.repeat((size > 1) | parted, size)
        for k, blob in C.blocks(np.repeat(part, size)[keep], parts + 1, key[keep], doc[keep]):
            yield pa.RecordBatch.from_arrays([pa.array([k - 1], pa.int32()), pa.array([blob], pa.binary())], schema=schema)

    return run


MET = pa.schema([("i", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("lists", pa.binary())])


def _members(batches):
    """(key, doc_id) of blocks."""
    for b in batches:
        for blob in b.column(0):
            key, doc = C.unpack(blob.as_buffer(), "<u8", "<i8")
            yield from C.batches_of(MET, [pa.nulls(len(key), pa.int64()), doc, key.view(np.int64), pa.nulls(len(key), pa.binary())])


def _meet(together, most):
    """Buckets of lists, of at most `together` documents or those of one smallest member: the lists (i, lists) and their documents (i, doc_id). Members with their keys,
    where the lists of one smallest member have more than `most` documents."""

    def run(batches):
        key, doc, edges = _sorted(*C.gather(batches, "payload", "<u8", "<i8"))
        if not len(key):
            return
        low = np.repeat(doc[edges[:-1]], np.diff(edges))
        order = np.argsort(low, kind="stable")
        key, doc, low = key[order], doc[order], low[order]
        heads = C.runs(low)
        ids, held, at = [], 0, 0
        for k in range(len(heads)):  # the last turn sends what is left
            lo, hi = (heads[k], heads[k + 1]) if k < len(heads) - 1 else (len(low), len(low))
            own = np.unique(doc[lo:hi])
            if held and (len(own) > most or held + len(own) > together or hi == lo):
                i, docs = int(low[at]), np.unique(np.concatenate(ids))
                yield from C.batches_of(MET, [np.full(len(docs), i), docs, pa.nulls(len(docs), pa.int64()), pa.nulls(len(docs), pa.binary())])
                yield from C.batches_of(MET, [[i], [None], [None], [C.pack(key[at:lo], doc[at:lo])]])
                ids, held, at = [], 0, lo
            if len(own) > most:
                yield from C.batches_of(MET, [pa.nulls(hi - lo, pa.int64()), doc[lo:hi], key[lo:hi].view(np.int64), pa.nulls(hi - lo, pa.binary())])
                at = hi
            else:
                ids.append(own)
                held += len(own)

    return run


def _neighbours(batches):
    """Neighbours a < b of (key, doc_id), in each task by key, with the number of keys."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
    got = [np.zeros((2, 0), np.int64)]
    for b in batches:
        got.append(np.stack([b.column(k).to_numpy() for k in ("key", "doc_id")]))
    key, doc, _ = _sorted(*np.concatenate(got, 1))
    same = np.flatnonzero(key[1:] == key[:-1])
    pairs, n = np.unique(np.stack([doc[same], doc[same + 1]], 1), axis=0, return_counts=True)
    yield from C.batches_of(schema, [pairs[:, 0], pairs[:, 1], n])


# ------------------------------------------------------------------ verification


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("s", pa.int64())])


def _folded(blobs: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By each length (in bytes) that a sketch has: the rows of words of all sketches that are at least so long, folded to it, and where each sketch's row is (-1 for shorter
    ones). A sketch takes at most twice its own length in all, so one very long text among many short ones costs what it weighs."""
    size = np.array([len(x) for x in blobs])
    out, below = {}, None
    for n in sorted(set(size.tolist()), reverse=True):
        have = np.flatnonzero(size >= n)
        m = np.zeros((len(have), n // 8), np.uint64)
        if below is not None:
            wide = below
            while wide.shape[1] > n // 8:
                wide = wide[:, : wide.shape[1] // 2] ^ wide[:, wide.shape[1] // 2 :]
            m[size[have] > n] = wide
        m[size[have] == n] = np.frombuffer(b"".join(blobs[k] for k in have[size[have] == n]), np.uint64).reshape(-1, n // 8)
        place = np.full(len(blobs), -1, np.int64)
        place[have] = np.arange(len(have))
        out[n], below = (place, m), m
    return out


def _with_sketch(width):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("text", pa.string())])

    def run(batches):
        for batch in C.chunks(batches, "text"):
            made = pa.array([sketch(s, FINE) for s in distinct_sets(batch, width)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), made, batch.column("text").cast(pa.string())], schema=schema)

    return run


def _best(x, y, s, ids):
    """For each set its pair with the least distance."""
    both, other, far = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([s, s])
    order = np.lexsort((ids[other], far, both))
    head = order[C.runs(both[order])[:-1]]
    return both[head], other[head], far[head]


def _pairs_of(ids, x, y, s) -> pa.Table:
    one, two = ids[x], ids[y]
    got, at = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)], 1), axis=0, return_index=True) if len(one) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    return pa.Table.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1]), pa.array(s[at])], schema=PAIRS)


def _compare(percent, group, nearest):
    """The sets of a bucket, and its lists: pairs in one list, of different components, whose sizes and sketches allow a link; with `nearest` one for each set."""

    def near(n, x, y, far):
        total = n[x] + n[y]
        return (far * (100 + percent) <= (100 - percent) * total) & (n[x] * 100 >= percent * n[y]) & (n[y] * 100 >= percent * n[x])

    def run(docs: pa.Table, lists: pa.Table) -> pa.Table:
        doc = docs.column("doc_id").to_numpy()
        order = np.argsort(doc, kind="stable")
        doc, raw = doc[order], docs.column("id").to_numpy()[order]
        ids, first, own = np.unique(raw, return_index=True, return_inverse=True)
        comp, n = (docs.column(k).to_numpy()[order][first] for k in ("component", "n"))
        blobs = docs.column("sketch").to_pylist()
        blobs = [blobs[k] for k in order[first]]
        size, words = np.array([len(x) for x in blobs], np.int64), _folded(blobs)
        key, member, _ = _sorted(*(np.concatenate(x) for x in zip(*(C.unpack(x.as_buffer(), "<u8", "<i8") for x in lists.column("lists").combine_chunks()), strict=True))) if len(lists) and len(doc) else (np.zeros(0, np.uint64), np.zeros(0, np.int64), None)
        lo, hi = np.searchsorted(doc, member), np.searchsorted(doc, member, "right")
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange((hi - lo).sum()) if len(member) else lo
        key, row, edges = _sorted(np.repeat(key, hi - lo), own[at])
        start, m = edges[:-1], np.diff(edges)
        xs, ys, ss = [], [], []

        def take(x, y):
            keep = comp[x] != comp[y]
            x, y = x[keep], y[keep]
            least = np.minimum(size[x], size[y])
            for w in np.unique(least):
                mine = np.flatnonzero(least == w)
                place, rows = words[int(w)]
                step = max(1, min(20_000, STEP_BYTES // int(w)))
                for k in range(0, len(mine), step):
                    p, q = x[mine[k : k + step]], y[mine[k : k + step]]
                    far = np.bitwise_count(rows[place[p]] ^ rows[place[q]]).sum(1, dtype=np.int64)
                    ok = near(n, p, q, far)
                    xs.append(p[ok])
                    ys.append(q[ok])
                    ss.append(1000 * far[ok] // np.maximum(n[p[ok]] + n[q[ok]], 1))

        some = [np.zeros((0, 2), np.int64)]
        for k in np.unique(m[(m > 1) & (m <= group)]):
            members = row[start[m == k][:, None] + np.arange(k)]
            i, j = np.triu_indices(k, 1)
            some.append(np.unique(np.stack([members[:, i].ravel(), members[:, j].ravel()], 1), axis=0))
        pairs = np.unique(np.concatenate(some), axis=0)
        take(pairs[:, 0], pairs[:, 1])
        if (m > group).any():  # long lists overlap much: each pair once
            met = np.zeros((len(ids), len(ids)), bool)
            for k in np.flatnonzero(m > group):
                members = row[start[k] : start[k] + m[k]]
                met[np.ix_(members, members)] = True
            for c in range(0, len(ids), 64):
                i, j = np.nonzero(met[c : c + 64])
                take(i[i + c < j] + c, j[i + c < j])
        x, y, s = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ys, ss))
        if nearest:
            x, y, s = _best(x, y, s, ids)
        return _pairs_of(ids, x, y, s)

    return run


def _verify(width, percent):
    """Pairs of two buckets, and the texts that they name, each once: the pairs whose sets are similar."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = {}
        for batch in C.chunks(texts.select(["id", "text"]).to_batches(), "text"):
            sets.update(zip(batch.column("id").to_pylist(), distinct_sets(batch, width), strict=True))
        out = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            x, y = sets[a], sets[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                out.append((a, b))
        return pa.Table.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], schema=schema)

    return run


def _between(percent, nearest):
    """Of any two blocks of one large group each: pairs of different components whose sketches are near enough; with `nearest` one for each set."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([(k, "ascending") for k in ("key", "kind", "i", "j")]).combine_chunks()
        names = np.stack([t.column(k).to_numpy().astype(np.int64) for k in ("key", "kind", "i", "j")])
        edges = np.concatenate([[0], np.flatnonzero((names[:, 1:] != names[:, :-1]).any(0)) + 1, [t.num_rows]])
        return pa.concat_tables([one(t.slice(a, b - a)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)])

    def one(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        blk, ids, comp, size = (t.column(k).to_numpy() for k in ("blk", "id", "component", "n"))
        blobs = t.column("sketch").to_pylist()
        sk = min(_folded(blobs).items())[1][1]  # of the shortest length, that all have
        left, right, out = np.flatnonzero(blk == i), np.flatnonzero(blk == j), [np.zeros((3, 0), np.int64)]
        wide = max(1, STEP_BYTES // (8 * sk.shape[1]))  # comparisons at once
        step = max(1, min(32, wide // max(1, len(right))))
        for at in range(0, len(left), step):
            x = left[at : at + step]
            far = np.concatenate([np.bitwise_count(sk[x][:, None] ^ sk[right[k : k + wide]][None]).sum(2, dtype=np.int64) for k in range(0, max(1, len(right)), wide)], 1)
            n = size[x][:, None] + size[right][None]
            ok = (comp[x][:, None] != comp[right][None]) & (far * (100 + percent) <= (100 - percent) * n)
            ok &= (size[x][:, None] * 100 >= percent * size[right][None]) & (size[right][None] * 100 >= percent * size[x][:, None])
            if i == j:
                ok &= ids[x][:, None] < ids[right][None]
            p, q = np.nonzero(ok)
            got = np.stack([x[p], right[q], 1000 * far[p, q] // n[p, q]])
            out.append(np.stack(_best(*got, ids)) if nearest else got)
        got = np.concatenate(out, 1)
        return _pairs_of(ids, *(_best(*got, ids) if nearest else got))

    return run


def _hot(spark: SparkSession, keys: DataFrame):
    """Broadcast of the HOT_KEYS keys with the largest `order`, as (keys, ranks, members) by key."""
    rows = keys.orderBy(F.desc("order"), "key").limit(HOT_KEYS).collect()
    key = np.array([r.key for r in rows], np.int64).view(np.uint64)
    by = np.argsort(key)
    return spark.sparkContext.broadcast((key[by], (len(rows) - 1 - np.arange(len(rows)))[by], np.array([r.n for r in rows], np.int64)[by]))


def link_components(docs: DataFrame, width: int = 5, percent: int = 75, group: int = GROUP, held: int = HELD, block: int = BLOCK, split: int = SPLIT) -> DataFrame:
    """doc_id, text -> doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), set_id (smallest doc_id with an equal set), text_hash
    (xxhash64 of the text) and stays: true for one text of each component, and for rows that are linked with nothing (no doc_id, no shingle). Ids may repeat with several
    texts, so a component is told by `stays`, not by its label."""
    spark = docs.sparkSession
    base = C.shared_dir(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    profile = C.stored(rows.mapInArrow(_profile(width, percent, held), "doc_id long, th long, n_shingles long, fp binary, sketch binary, hot binary"), f"{base}/profile")
    # a partition's keys are held by its task, so there are as many as the shingles need
    n = max(C.partitions(spark), -(-(profile.agg(F.sum("n_shingles")).first()[0] or 0) // PART_SHINGLES))
    parts = 4 * n
    common = profile.filter("hot is not null").select("hot").mapInArrow(_unpack_hot, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    hot = _hot(spark, common.filter(F.col("n") > group).withColumn("order", F.col("n")))

    # distinct sets, each with one row that has its text
    of_set = profile.filter("hot is null and doc_id is not null and n_shingles > 0")
    sets = of_set.groupBy("fp").agg(F.min("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"), F.min_by("th", "doc_id").alias("th"))
    sets = C.stored(sets.withColumn("id", F.monotonically_increasing_id()), f"{base}/sets")
    sketches = sets.select("fp", "id", "n", "doc_id", "th").join(of_set.select("fp", "doc_id", "th", "sketch"), ["fp", "doc_id", "th"]).select("id", "n", "sketch")
    sketches = C.stored(sketches.dropDuplicates(["id"]), f"{base}/sketches")
    rep = C.stored(of_set.select("doc_id", "fp").join(sets.select("fp", "id"), "fp").select("doc_id", "id").distinct(), f"{base}/rep")

    # lists of documents by key, met by smallest member
    known = rows.filter("doc_id is not null and text is not null")
    sent = known.select("doc_id", "text").mapInArrow(_send_keys(width, percent, parts, hot, held, split), "part int, payload binary").repartition(n, "part")
    found = C.stored(sent.mapInArrow(_groups(parts, split, hot), "part int, payload binary"), f"{base}/found")
    kind = "i long, doc_id long, key long, lists binary"
    met = found.filter("part >= 0").repartition(n, "part").mapInArrow(_meet(TOGETHER, 4 * block), kind)
    met = C.stored(met.union(found.filter("part < 0").select("payload").mapInArrow(_members, kind)), f"{base}/met")
    lists = met.filter("lists is not null").select("i", "lists")
    places = C.stored(met.filter("lists is null and i is not null").select("i", "doc_id").join(rep, "doc_id"), f"{base}/places")
    large = met.filter("key is not null").select("key", "doc_id")
    members = C.stored(large.join(rep, "doc_id").select("key", "id").distinct(), f"{base}/members")

    none = spark.createDataFrame([], "id long, component long")
    comp = none

    def labelled(rows):
        return rows.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def candidates(rows, sketches, nearest):
        """Pairs of different components in the buckets of lists."""
        own = labelled(rows)
        if comp is not none:
            mixed = own.groupBy("i").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("i")
            own = own.join(mixed, "i")
        own = own.join(sketches, "id").select(F.col("i").alias("at"), "doc_id", "id", "component", "n", "sketch")
        return own.groupBy("at").cogroup(lists.groupBy("i")).applyInArrow(_compare(percent, group, nearest), "a long, b long, s long")

    first = C.stored(candidates(places, sketches, True), f"{base}/first")

    # texts of all that may be verified
    ids = first.select(F.col("a").alias("id")).union(first.select(F.col("b").alias("id"))).distinct()
    ids = C.stored(ids, f"{base}/ids")
    want = sets.select("id", "n", "doc_id", "th").join(ids.union(members.select("id")).distinct(), "id").hint("merge")  # by a shuffle at every size
    cand = want.join(known, ["doc_id", "th"]).groupBy("doc_id", "th", "id", "n").agg(F.first("text").alias("text")).select("id", "n", "text")
    cand = C.stored(cand.mapInArrow(_with_sketch(width), "id long, n long, sketch binary, text string"), f"{base}/texts")
    fine = cand.select("id", "n", "sketch")

    def verified(pairs):
        """The linked ones. A pair is dealt by that of its two sets that is in more pairs, in parts if these are many; each part gets a text once."""
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("m"))
        both = pairs.select("a", "b").join(ends.select(F.col("id").alias("a"), F.col("m").alias("ma")), "a").join(ends.select(F.col("id").alias("b"), F.col("m").alias("mb")), "b")
        hub, leaf = F.expr("if(ma >= mb, a, b)"), F.expr("if(ma >= mb, b, a)")
        part = F.pmod(F.xxhash64(leaf), F.ceil(F.greatest("ma", "mb") / BUCKET))
        dealt = both.select("a", "b", F.pmod(F.xxhash64(hub, part), F.lit(max(1, pairs.count() // BUCKET))).cast("int").alias("i"))
        need = dealt.select("i", F.col("a").alias("id")).union(dealt.select("i", F.col("b").alias("id"))).distinct()
        texts = need.join(cand.select("id", "text"), "id").select(F.col("i").alias("ri"), "id", "text")
        return dealt.groupBy("i").cogroup(texts.groupBy("ri")).applyInArrow(_verify(width, percent), "a long, b long")

    tried = None

    def across(pairs):
        """Pairs of sets as pairs of their different components."""
        one, two = (comp.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
        pairs = pairs.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        return pairs.filter("a <> b").distinct()

    def settle(pairs, name):
        """Verify the pairs that are new, and take what is linked into the components."""
        nonlocal tried, comp
        new = pairs.select("a", "b").distinct()
        new = C.stored(new if tried is None else new.join(tried, ["a", "b"], "left_anti"), f"{base}/{name}-pairs")
        tried = new if tried is None else tried.union(new)
        links = C.stored(across(verified(new)), f"{base}/{name}-links")
        if _any(links):
            more = C.components(links)
            joined = more.select(F.col("id").alias("component"), F.col("component").alias("to"))
            old = comp.join(joined, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
            fresh = more.join(comp.select("id"), "id", "left_anti")
            comp = C.stored(old.union(fresh), f"{base}/{name}-components")

    def nearest(pairs):
        """For each set the pair with the nearest sketch."""
        ways = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
        best = ways.groupBy("a").agg(F.min_by("b", "s").alias("b"))
        return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def inside(nearest):
        """Pairs of different components in large groups. Linked sets have sizes of one class or of the next."""
        own = labelled(members)
        mixed = own.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
        spread = own.join(mixed.select("key"), "key").join(fine, "id")
        kind = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")
        spread = spread.select("key", "id", "component", "n", "sketch", F.explode(F.array(kind, kind + 1)).alias("kind"))
        sizes = spread.groupBy("key", "kind").agg(F.count("*").alias("m"), F.sum(F.length("sketch")).alias("bytes"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
        nb = F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
        sizes = C.stored(sizes.select("key", "kind", "m", "bytes", nb.alias("nb")), C.shared_dir(spark))
        total = sizes.agg(F.sum(F.col("m") * F.col("nb")).alias("rows"), F.sum(F.col("bytes") * F.col("nb")).alias("bytes")).first()
        buckets = max(1, (total.rows or 0) // TOGETHER, (total.bytes or 0) // (2 * BLOCK_BYTES))
        spread = spread.join(sizes.select("key", "kind", "nb"), ["key", "kind"])
        spread = spread.withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
        spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        spread = spread.select("key", "kind", "id", "component", "n", "sketch", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"))
        return spread.groupBy(F.pmod(F.xxhash64("key", "kind", "i", "j"), F.lit(buckets))).applyInArrow(_between(percent, nearest), "a long, b long, s long")

    # three rounds: the nearest, the nearest of another component, all of other components
    crowded = _any(members)
    start = nearest(first)
    if crowded:
        beside = large.mapInArrow(_neighbours, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        one, two = (rep.select(F.col("doc_id").alias(c), F.col("id").alias(f"r{c}")) for c in "ab")
        beside = beside.join(one, "a").join(two, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"), (-F.col("n")).alias("s"))
        start = start.union(nearest(beside))
    settle(start, "1")
    for name, closest in (("2", True), ("3", False)):
        left = candidates(places.join(ids, "id", "left_semi"), fine, closest)
        left = C.stored(left.union(inside(closest)) if crowded else left, f"{base}/left{name}")
        if not _any(left):
            break
        settle(left, name)

    # the smallest doc_id of each component
    label = labelled(sets.select("fp", "id", F.col("doc_id").alias("set_id"), F.col("th").alias("set_th")))
    least = label.groupBy("component").agg(F.min(F.struct("set_id", "id")).alias("lead"))
    label = label.join(least, "component").select("fp", "set_id", "set_th", F.col("lead.set_id").alias("component_id"), (F.col("lead.id") == F.col("id")).alias("leads"))
    out = profile.filter("hot is null").select("doc_id", "n_shingles", "fp", "th").join(label, "fp", "left")
    own = lambda c: F.when(F.col("doc_id").isNotNull(), F.coalesce(c, "doc_id")).alias(c)
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    stays = alone | (F.col("leads") & (F.col("doc_id") == F.col("set_id")) & (F.col("th") == F.col("set_th")))
    return out.select("doc_id", "n_shingles", own("component_id"), own("set_id"), F.col("th").alias("text_hash"), F.coalesce(stays, F.lit(True)).alias("stays"))


def _any(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda j: array_to_string(ws[j:j + 4], ' ')) END) AS g FROM w WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS id, doc_id AS reached FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON r.reached = e.a
), m AS (
  SELECT id, min(reached) AS component_id FROM r GROUP BY id
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN m ON m.id = w.doc_id
"""
