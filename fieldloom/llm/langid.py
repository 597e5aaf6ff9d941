"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's vector is the mean of the embeddings of its byte 3- and 5-grams (A-Z lower-cased, other
ASCII signs as spaces, edges padded), hashed into BUCKETS rows; a linear softmax on it gives the
languages. Both are trained by stochastic gradient descent in numpy, in one task (the driver gets the model alone), from a
bounded sample: the labelled training documents with the smallest hashes of their ids, SAMPLE of them and SAMPLE_BYTES of text at most, whole texts and short spans of them.
A fifth of the sample is held back to calibrate: the temperature of the softmax, and
the two bounds of rejection (probability; share of 3-grams known from training), which refuse at
most one in five hundred of these. Tasks get the product of embedding and softmax, so a text
costs two hashed counts and one matrix product.

Training takes rows with text, lang and doc_id, where crc32(doc_id as text) mod 4 is not 2. Prediction sees the text alone.

Defined cases: null text, or text without a letter: `und`, score 0, rejected. Without any training
row every text is `und`. Ties go to the language that sorts first. A null doc_id is not held out and not trained on.
Rows that repeat an id are all judged, and one of them may be trained on. A very long text is counted as a whole. An empty table gives no rows. Extra columns may have any name.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SAMPLE = 3000
SAMPLE_BYTES = 64 << 20
BUCKETS = 1 << 12
DIM = 16
GRAMS = (3, 5)  # the first is the one that `known` is about
EPOCHS = 6
U64 = C.U64

#: A-Z lower-cased; ASCII that is no letter becomes a space; other bytes stay.
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def features(raw: np.ndarray, off: np.ndarray):
    """For each n in GRAMS: hash bucket and plain code of the n-gram at every position of the padded texts, and the positions that run over a text's end."""
    n = len(off) - 1
    edges = off + np.arange(n + 1)  # a space before each text, and one at the end
    text = np.full(len(raw) + n + 8, 32, np.uint8)
    spot = np.ones(len(raw) + n + 8, bool)
    spot[edges] = False
    spot[len(raw) + n :] = False
    text[spot] = FOLD[raw]
    wide = np.ndarray((len(raw) + n,), "<u8", text.tobytes(), strides=(1,))
    for size in GRAMS:
        code = wide & U64((1 << (8 * size)) - 1)
        over = (edges[1:, None] - np.arange(1, size - 1)).ravel()
        over = over[over >= np.repeat(edges[:-1], size - 2)]
        yield ((code * U64(0x9E3779B97F4A7C15 + 2 * size)) >> U64(52)).view(np.int64), code, over


def counts(raw: np.ndarray, off: np.ndarray, known: np.ndarray | None = None):
    """Mean bucket counts of each text, and the share of its 3-grams that `known` has."""
    n = len(off) - 1
    edges = off + np.arange(n + 1)
    base = np.repeat(np.arange(n) * BUCKETS, np.diff(off) + 1)
    total, share = np.zeros(n * BUCKETS, np.int64), np.ones(n)
    for size, (bucket, code, over) in zip(GRAMS, features(raw, off), strict=True):
        key = bucket + base
        key[over] = n * BUCKETS
        total += np.bincount(key, minlength=n * BUCKETS + 1)[:-1]
        if size == 3 and known is not None:
            hit = known[code.view(np.int64)]
            hit[over] = False
            several = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
            gone = np.bincount(np.searchsorted(edges, over, "right") - 1, minlength=n)
            share = np.diff(several[edges]) / np.maximum(np.diff(edges) - gone, 1)
    total = total.reshape(n, BUCKETS).astype(np.float32)
    return total / np.maximum(total.sum(1, keepdims=True), 1), share


def encode(texts: list[str]):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 1) -> dict | None:
    """(text, lang) rows -> a model as plain arrays."""
    if not rows:
        return None
    langs = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    texts, labels, held = [], [], []
    known = np.zeros(1 << 24, bool)
    for k, (text, lang) in enumerate(rows):
        mine, words = [text], text.split()
        for size in (2, 5, 12, 40):
            at = int(rng.integers(0, max(1, len(words) - size)))
            mine.append(" ".join(words[at : at + size]))
        texts += mine
        labels += [langs.index(lang)] * len(mine)
        held += [k % 5 == 4] * len(mine)
    labels, held = np.array(labels), np.array(held)
    if held.all() or not held.any():
        held[:] = False
    xs = []
    for at in range(0, len(texts), 50):
        raw, off = encode(texts[at : at + 50])
        x, _ = counts(raw, off)
        for row in x:
            hit = np.flatnonzero(row)
            xs.append((hit.astype(np.int16), row[hit]))  # BUCKETS fit in
    for at in np.flatnonzero(~held):
        _, code, over = next(features(*encode([texts[at]])))
        known[np.delete(code.view(np.int64), over)] = True
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    mine, step = np.flatnonzero(~held), 0
    for epoch in range(EPOCHS):
        for i in rng.permutation(mine):
            hit, w = xs[i]
            rate = 8.0 * (1 - step / (EPOCHS * len(mine)))
            step += 1
            v = w @ emb[hit]
            g = softmax((v @ out + bias)[None])[0]
            g[labels[i]] -= 1
            back = out @ g
            out -= (0.5 * rate) * np.outer(v, g)
            bias -= 0.002 * rate * g
            emb[hit] -= rate * w[:, None] * back
    table = emb @ out
    cal = np.flatnonzero(held) if held.any() else mine
    z = np.stack([xs[i][1] @ table[xs[i][0]] + bias for i in cal])
    best = min(np.geomspace(0.05, 5, 60), key=lambda t: -np.log(softmax(z / t)[np.arange(len(cal)), labels[cal]] + 1e-12).mean())
    full = cal[cal % 5 == 0]
    raw, off = encode([texts[i] for i in full[:400]])
    _, share = counts(raw, off, known)
    top = softmax(z[cal % 5 == 0] / best).max(1)
    least = float(min(0.5, np.quantile(top, 0.002)))
    return {"langs": langs, "table": table.astype(np.float32), "bias": bias, "temperature": float(best), "known": np.packbits(known), "least_p": least, "least_known": float(min(0.25, 0.5 * np.quantile(share, 0.002)))}


def predict(model: dict | None, known: np.ndarray | None, texts: pa.Array):
    """(lang, score, rejected) for each text of a chunk."""
    n = len(texts)
    raw, off = C.utf8(texts)
    plain = ((raw >= 65) & (raw <= 90)) | ((raw >= 97) & (raw <= 122))
    has = np.diff(np.concatenate([[0], np.cumsum(plain)])[off]) > 0
    for i in np.flatnonzero(~has):
        has[i] = any(map(str.isalpha, texts[i].as_py() or ""))
    if model is None:
        return ["und"] * n, np.zeros(n), np.ones(n, bool)
    x, share = counts(raw, off, known)
    p = softmax((x @ model["table"] + model["bias"]) / model["temperature"])
    best = p.argmax(1)
    score = np.where(has, np.clip(p[np.arange(n), best], 0, 1), 0.0)
    rejected = ~has | (score < model["least_p"]) | (share < model["least_known"])
    return [model["langs"][k] if h else "und" for k, h in zip(best, has, strict=True)], score, rejected


def fit(docs: DataFrame, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> dict | None:
    """Train on the labelled documents with the smallest id hashes: at most `sample` of them, and no more than `most_bytes` of text (but one text at least). Of rows that repeat an id
    the one with the smallest (text, lang) is taken."""
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("text is not null and lang is not null and crc32(id) % 4 <> 2").withColumn("h", F.xxhash64("id"))
    last = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return None
    size = rows.filter(F.col("h") <= last).groupBy("h").agg(F.max(F.octet_length("text")).alias("n")).orderBy("h").limit(sample).collect()
    fit_in = np.flatnonzero(np.cumsum([r.n for r in size]) <= most_bytes)
    last = size[int(fit_in[-1]) if len(fit_in) else 0].h
    one = rows.filter(F.col("h") <= last).groupBy("h", "id").agg(F.min(F.struct("text", "lang")).alias("x"))
    made = one.select("h", "id", "x.text", "x.lang").repartition(1).mapInArrow(_trained, "model binary").collect()  # at most `sample` rows and `most_bytes` in the task
    return pickle.loads(made[0].model) if made else None


def _trained(batches):
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    if rows:
        model = train([(text, lang) for _, _, text, lang in sorted(rows, key=lambda r: r[:2])])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def _model(shared):
    model = shared.value
    return model, None if model is None else np.unpackbits(model["known"]).astype(bool)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, lang -> doc_id, held_out, lang_pred, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, sample))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        model, known = _model(shared)
        for b in C.chunks(batches, "text"):
            lang, score, rejected = predict(model, known, b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs that are not rejected, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, sample))

    def run(batches):
        model, known = _model(shared)
        for b in C.chunks(batches, "text"):
            rejected = predict(model, known, b.column(b.schema.get_field_index("text")))[2]
            yield b.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
