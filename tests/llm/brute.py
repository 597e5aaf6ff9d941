"""Plain versions of the operators for small inputs."""

import hashlib


def lower(text):
    return (text or "").encode().lower()


def shingle_set(text, width=5):
    w = lower(text).split()
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def components(rows, percent=75):
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    ids = sorted(sets)
    for a in ids:
        for b in {y for x in sets[a] for y in where[x] if y > a}:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}


def repeats(rows, window=50):
    least = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, d), d)
    out = {}
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out
