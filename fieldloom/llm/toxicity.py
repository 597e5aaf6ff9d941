"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posterior labels.

1. A bounded sample of rows (SAMPLE: toxic, clean and unlabelled ones with the smallest hashes of their ids) is kept as a table.
   Its texts are read whole, in tasks; only counts of hashed word pieces (whole words, and their first 4 to 8 bytes) come to the driver.
2. Voters say toxic (1), clean (-1) or nothing (0): lexicons of pieces that stand out in toxic rows, by kind of piece and strength (a row never
   counts as evidence for the lexicon that votes on it), and patterns: insults in four languages, address in the second person, threats,
   shouting, runs of signs, masked words.
3. The label model is a tree over the voters under the hidden class. Each voter has its table of votes by class (its accuracy) and by the voter it
   correlates with most (Chow-Liu: the spanning tree with most conditional mutual information), so that voters which repeat each other
   don't count twice. The given label is one more witness with an accuracy of its own for each class. Tables, tree and posteriors are fitted by EM.
4. A logistic regression on the piece counts learns the posteriors, weighted to the true shares of the sampled classes. Its margins are calibrated
   out of fold. Tasks get one table of weights, so a text costs its hashed words and a sum, however long it is.

Only rows with crc32(doc_id as text) mod 3 other than 1 are sampled; a score sees the text alone.

Defined cases. Null or empty text: the score of a text without words. Null doc_id: not held out, never sampled. Rows that repeat an id: one of them (the smallest
text) is sampled, all are scored. Labels that repeat an id: toxic if any of them is; null is no label. Without sampled rows of
both classes the score is the share of toxic rows among those labelled, 0 without any. Ties in sampling: by id. Very long texts are
scored whole, in chunks of words that share one sum. Empty table: no rows. Extra columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SAMPLE = (4000, 6000, 2000)  # toxic, clean, unlabelled
KEEP = 4096  # pieces that the classifier knows
LEAST_Z = 2.0  # how far a kept piece's log odds are from none, in standard errors
PREFIXES = (0, 4, 5, 6, 7, 8)  # bytes of a word; 0 is the whole word
BITS = 18
SIZE = len(PREFIXES) << BITS
THRESHOLD = 0.7
U64 = C.U64

#: Letters and bytes of other scripts make words.
PART = np.ones(256, bool)
PART[65:91] = PART[97:123] = PART[128:] = False

INSULTS = "idiot|moron|stupid|dumb|loser|trash|garbage|scum|clown|pathetic|worthless|disgusting|ugly|filthy|freak|fool|jerk|creep|coward|liar|pig|rat|vermin|parasite|imbecile|retard|bastard|bitch|asshole|shit|fuck\\w*|crap|damn|whore|slut"
FOREIGN = "idiota|estúpid[oa]|imbécil|basura|asqueros[oa]|patétic[oa]|mierda|idiote|stupide|imbécile|ordure|dégoûtante?|pathétique|merde|connard|salope|dumm|dummkopf|idiotin?|abschaum|müll|widerlich|erbärmlich|scheiße|arschloch"
#: Patterns over the lower-cased text; each is a voter that says toxic where it is found and nothing else.
PATTERNS = {
    "insult": rf"\b(?:{INSULTS})s?\b",
    "insults": rf"\b(?:{INSULTS})s?\b.*\b(?:{INSULTS})s?\b",
    "foreign": rf"\b(?:{FOREIGN})\b",
    "second_person": rf"\b(?:you|your|du|ihr|tu|vous|tú|eres)\b(?:\s+\w+){{0,3}}\s+(?:{INSULTS}|{FOREIGN})\b",
    "threat": r"\b(?:kill|hurt|beat|shoot|destroy|hang)\s+(?:you|them|him|her|yourself)\b|\bshut up\b|\bgo (?:away|die|to hell)\b",
    "hate": r"\bi hate\b|\bhate (?:you|them|all)\b|\bdeserves? to (?:die|suffer)\b",
    "signs": r"!{2,}|\?{3,}",
    "masked": r"\b[a-z]+\*{2,}[a-z]*\b",
}


def pieces(raw: np.ndarray, off: np.ndarray):
    """For each kind of piece: the piece's place in the table and its document; and the words of each document."""
    low = C.LOWER[raw]
    starts, ends, at = C.word_spans(low, off, PART)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(at))

    def each():
        for k, size in enumerate(PREFIXES):
            mine = slice(None) if size == 0 else np.flatnonzero(ends - starts >= size)
            s, e = starts[mine], ends[mine]
            h = C.span_hashes(low, s, e if size == 0 else s + size)
            yield (h >> U64(64 - BITS)).view(np.int64) + (k << BITS), doc[mine]

    return each(), np.diff(at)


# ---------------------------------------------------------------- sample


def sample(docs: DataFrame, labels: DataFrame, most: tuple[int, int, int] = SAMPLE) -> tuple[DataFrame, dict]:
    """(doc_id, y, text and pattern counts of at most sum(most) rows, as a stored table; rows that each class stands for)."""
    spark = docs.sparkSession
    mark = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("y"))
    ids = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id")).filter("crc32(cast(doc_id as string)) % 3 <> 1").distinct()
    ids = C.stored(ids.join(mark, "doc_id", "left").withColumn("y", F.coalesce("y", F.lit(-1))), C.shared_dir(spark))
    stand = {r.y: r.n for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}  # three rows at most
    chosen = None
    for y, n in zip((1, 0, -1), most, strict=True):
        part = ids.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.union(part)
    lower = F.lower("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # ids of at most sum(most) rows
    rows = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    upper = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    found = [lower.rlike(f"(?s){p}").alias(k) for k, p in PATTERNS.items()] + [(upper * 10 > F.length("text") * 3).alias("shouting")]
    return C.stored(rows.select("doc_id", "y", "text", *found), C.shared_dir(spark)), stand


def piece_counts(rows: DataFrame) -> DataFrame:
    """piece, toxic, clean: sampled rows of either class that have a piece."""
    schema = pa.schema([("piece", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches):
        total = np.zeros((2, SIZE), np.int32)
        for b in C.chunks(batches, "text"):
            y = b.column("y").to_numpy()
            each, _ = pieces(*C.utf8(b.column("text")))
            for piece, doc in each:
                one = np.unique(doc * SIZE + piece)
                for k in (1, 0):
                    total[1 - k] += np.bincount(one[y[one // SIZE] == k] % SIZE, minlength=SIZE).astype(np.int32)
        hit = np.flatnonzero(total.any(0))
        yield from C.batches_of(schema, [hit, total[0][hit].astype(np.int64), total[1][hit].astype(np.int64)])

    return rows.filter("y >= 0").select("y", "text").mapInArrow(run, "piece long, toxic long, clean long").groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose(counts: DataFrame, n_toxic: int, n_clean: int, keep: int = KEEP) -> dict[str, np.ndarray]:
    """The pieces whose share differs most surely between the classes."""
    z = F.abs(F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))) / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    got = counts.withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "piece").limit(keep).collect()  # keep rows
    return {"piece": np.array([r.piece for r in got], np.int64), "toxic": np.array([r.toxic for r in got], float), "clean": np.array([r.clean for r in got], float)}


def vectors(rows: DataFrame, chosen: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts of the chosen pieces in each sampled row, as three parallel arrays, with the rows' labels, words and pattern votes."""
    place = np.full(SIZE, -1, np.int32)
    place[chosen["piece"]] = np.arange(len(chosen["piece"]))
    shared = rows.sparkSession.sparkContext.broadcast(place)
    names = [*PATTERNS, "shouting"]
    schema = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("words", pa.int64()), ("at", pa.binary()), ("n", pa.binary()), *((k, pa.bool_()) for k in names)])

    def run(batches):
        place = shared.value
        for b in C.chunks(batches, "text"):
            each, words = pieces(*C.utf8(b.column("text")))
            keys = []
            for piece, doc in each:
                at = place[piece]
                mine = at >= 0
                keys.append(doc[mine] * SIZE + at[mine])
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            edges = np.searchsorted(key, np.arange(b.num_rows + 1) * SIZE)
            ats = [(key[lo:hi] % SIZE).astype("<u2").tobytes() for lo, hi in zip(edges, edges[1:], strict=False)]
            ns = [n[lo:hi].astype("<u4").tobytes() for lo, hi in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(words), pa.array(ats), pa.array(ns), *(b.column(k) for k in names)], schema=schema)

    got = rows.mapInArrow(run, "doc_id long, y int, words long, at binary, n binary, " + ", ".join(f"{k} boolean" for k in names)).toArrow().sort_by("doc_id")
    ats = [np.frombuffer(x, "<u2") for x in got.column("at").to_pylist()]
    none = [np.zeros(0, np.int64)]
    return {
        "y": got.column("y").to_numpy(),
        "words": got.column("words").to_numpy().astype(float),
        "row": np.repeat(np.arange(len(ats)), [len(a) for a in ats]),
        "at": np.concatenate([*none, *ats]).astype(np.int64),
        "n": np.concatenate([*none, *(np.frombuffer(x, "<u4") for x in got.column("n").to_pylist())]).astype(float),
        "patterns": np.stack([got.column(k).to_numpy(zero_copy_only=False).astype(bool) for k in names], 1),
    }


# ---------------------------------------------------------------- voters and label model


def votes(v: dict[str, np.ndarray], chosen: dict[str, np.ndarray], n_toxic: int, n_clean: int) -> np.ndarray:
    """Rows by voters, -1, 0 or 1. A labelled row's own part in a piece's counts is taken out before the piece votes on it."""
    y = v["y"][v["row"]]
    pos, neg = chosen["toxic"][v["at"]] - (y == 1), chosen["clean"][v["at"]] - (y == 0)
    z = (np.log((pos + 0.5) / (n_toxic + 1.0)) - np.log((neg + 0.5) / (n_clean + 1.0))) / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    kind = chosen["piece"][v["at"]] >> BITS
    out, rows = [], len(v["y"])
    for k in range(len(PREFIXES)):
        for least, share in ((5.0, 1 / 400), (2.5, 1 / 100)):
            hits = np.bincount(v["row"], v["n"] * ((kind == k) & (z >= least)), minlength=rows)
            out.append(np.where(hits == 0, -1, np.where(hits >= 1 + share * v["words"], 1, 0)))
    return np.concatenate([np.stack(out, 1), v["patterns"].astype(int)], 1)


def pair_information(t: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Mutual information of each two voters given the class; t: rows by voters in 0..2, w: rows by classes."""
    n = t.shape[1]
    out = np.zeros((n, n))
    for i in range(n):
        for j in range(i):
            for c in (0, 1):
                joint = np.bincount(3 * t[:, i] + t[:, j], w[:, c], 9).reshape(3, 3) + 1e-3
                share = joint / joint.sum()
                alone = share.sum(1, keepdims=True) * share.sum(0, keepdims=True)
                out[i, j] += w[:, c].sum() / w.sum() * (share * np.log(share / alone)).sum()
    return out + out.T


def spanning_tree(weight: np.ndarray) -> list[tuple[int, int]]:
    """(voter, parent) in an order in which parents come first; the root's parent is -1."""
    n = len(weight)
    order, best, parent = [], weight[0].copy(), np.zeros(n, int)
    left = set(range(1, n))
    order.append((0, -1))
    while left:
        k = max(sorted(left), key=lambda x: best[x])
        left.remove(k)
        order.append((k, int(parent[k])))
        better = weight[k] > best
        best, parent = np.where(better, weight[k], best), np.where(better, k, parent)
    return order


def label_model(vote: np.ndarray, given: np.ndarray, weight: np.ndarray, rounds: int = 4, steps: int = 6) -> dict:
    """EM over the tree model. given: 1, 0 or -1 (no label). Returns the posterior of toxic for each row, the voters' accuracies where they vote, the
    tree with the information of each edge, and the accuracy of the given label in each class."""
    t = vote + 1
    has = given >= 0
    p = np.where(has, np.where(given == 1, 0.97, 0.03), np.clip(0.5 + vote.mean(1) / 2, 0.02, 0.98))
    mine = np.where(has, weight, 0.0)  # the first tables rest on labelled rows alone
    trust = np.array([0.97, 0.97])
    tree: list[tuple[int, int]] = []
    for round_ in range(rounds):
        info = pair_information(t, (mine if round_ == 0 else weight)[:, None] * np.stack([1 - p, p], 1))
        tree = spanning_tree(info)
        for _ in range(steps):
            w = (mine if round_ == 0 else weight)[:, None] * np.stack([1 - p, p], 1)
            prior = (w.sum(0) + 1) / (w.sum() + 2)
            score = np.tile(np.log(prior), (len(t), 1))
            for k, up in tree:
                for c in (0, 1):
                    if up < 0:
                        table = np.bincount(t[:, k], w[:, c], 3) + 0.5
                        score[:, c] += np.log(table / table.sum())[t[:, k]]
                    else:
                        table = np.bincount(3 * t[:, up] + t[:, k], w[:, c], 9).reshape(3, 3) + 0.5
                        score[:, c] += np.log(table / table.sum(1, keepdims=True))[t[:, up], t[:, k]]
            for c in (0, 1):
                agrees = given == c
                score[:, c] += np.where(has, np.log(np.where(agrees, trust[c], 1 - trust[c])), 0.0)
            p = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
            soft = weight * has
            for c, q in ((0, 1 - p), (1, p)):
                trust[c] = np.clip(((soft * q)[given == c].sum() + 9.7) / ((soft * q).sum() + 10), 0.6, 0.995)
    right = (vote == 1) * p[:, None] + (vote == -1) * (1 - p)[:, None]
    spoke = (weight[:, None] * (vote != 0)).sum(0)
    info = pair_information(t, weight[:, None] * np.stack([1 - p, p], 1))
    return {"posterior": p, "accuracy": (weight[:, None] * right).sum(0) / np.maximum(spoke, 1e-9), "tree": [(k, up, float(info[k, up]) if up >= 0 else 0.0) for k, up in tree], "trust": trust}


# ---------------------------------------------------------------- classifier


def logistic(row, at, n, extra, target, weight, size: int, steps: int = 200, decay: float = 2.0) -> np.ndarray:
    """Weights of a logistic regression by Adam over all rows: `size` pieces, then the columns of extra (the last is constant)."""
    rows, wide = len(target), size + extra.shape[1]
    scale = np.ones(wide)
    scale[:size] = np.sqrt(np.maximum(1.0, np.bincount(at, n * n, size) / np.maximum(np.bincount(at, minlength=size), 1)))
    x = n / scale[at]
    theta, m, s = np.zeros(wide), np.zeros(wide), np.zeros(wide)
    total = weight.sum()
    for k in range(1, steps + 1):
        margin = np.bincount(row, x * theta[at], minlength=rows) + extra @ theta[size:]
        g = weight * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - target)
        grad = np.concatenate([np.bincount(at, x * g[row], minlength=size), extra.T @ g])
        grad[:-1] += decay * theta[:-1]
        grad /= total
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
        theta -= 0.1 * (1 - k / (steps + 1)) * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-8)
    return theta / scale


def columns(words: np.ndarray) -> np.ndarray:
    """What a score takes besides pieces: words in hundreds, and a constant."""
    return np.stack([words / 100.0, np.ones(len(words))], 1)


def calibrate(margin: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities (Newton, a little ridge)."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        grad = np.array([(g * margin).sum() + 1e-3 * (a - 1), g.sum()])
        hess = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum()]])
        step = np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    return float(max(a, 1e-3)), float(b)


def fit(docs: DataFrame, labels: DataFrame, most: tuple[int, int, int] = SAMPLE, keep: int = KEEP) -> dict:
    """{weights by piece, words, constant}; with `report`: what the label model found."""
    rows, stand = sample(docs, labels, most)
    n = {y: min(k, stand.get(y, 0)) for y, k in zip((1, 0, -1), most, strict=True)}
    if not n[1] or not n[0]:
        share = stand.get(1, 0) / max(stand.get(1, 0) + stand.get(0, 0), 1)
        return {"share": share}
    chosen = choose(piece_counts(rows), n[1], n[0], keep)
    v = vectors(rows, chosen)
    weight = np.array([stand[y] / n[y] for y in v["y"].tolist()])
    weight /= weight.mean()
    found = label_model(votes(v, chosen, n[1], n[0]), v["y"], weight)
    size, target, extra = len(chosen["piece"]), found["posterior"], columns(v["words"])
    fold = np.arange(len(target)) % 3
    margin = np.zeros(len(target))
    for k in range(3):
        use = fold[v["row"]] != k
        theta = logistic(v["row"][use], v["at"][use], v["n"][use], extra, target, weight * (fold != k), size)
        margin = np.where(fold == k, np.bincount(v["row"], v["n"] * theta[v["at"]], minlength=len(target)) + extra @ theta[size:], margin)
    slope, offset = calibrate(margin, target, weight)
    theta = logistic(v["row"], v["at"], v["n"], extra, target, weight, size) * slope
    table = np.zeros(SIZE, np.float32)
    table[chosen["piece"]] = theta[:size]
    return {"table": table, "words": float(theta[size]), "constant": float(theta[size + 1] + offset), "report": found}


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def rate(model: dict, texts: pa.Array) -> np.ndarray:
    """The score of each text."""
    if "share" in model:
        return np.full(len(texts), float(model["share"]))
    each, words = pieces(*C.utf8(texts))
    margin = model["words"] * words / 100.0 + model["constant"]
    for piece, doc in each:
        margin += np.bincount(doc, model["table"][piece].astype(float), minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def score(docs: DataFrame, labels: DataFrame, most: tuple[int, int, int] = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    model = {k: x for k, x in fit(docs, labels, most).items() if k != "report"}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in C.chunks(batches, "text"):
            got = rate(shared.value, b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(got), pa.array((got >= THRESHOLD).astype(np.int32))], schema=OUT)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.expr("crc32(cast(doc_id as string)) % 3 = 1"), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
