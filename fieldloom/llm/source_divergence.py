"""Source divergence audit: how far the vocabulary of each source is from its language and from the other sources.

Terms are counted once, by (lang, source): tasks fold the terms of many documents exactly (Arrow dictionaries, no hashes) and
pass on a row for each group and term. After one shuffle by (lang, term) a term's rows lie together, so
the terms that a language keeps and their totals need no second one.

Count-cell ranking (part `term`): a term's value depends only on its count in the group and in the language, so terms are
grouped by these two counts. The value is worked out for each cell; cells of equal value are merged; the values with the largest
cumulative multiplicity up to TOP are taken, 50 at most for each group. Only the cells of these values are expanded to
terms again, in UTF-8 order. Both limits are pushed below the shuffle (a limit by rank within each task).

Part `pair`: the distance of two sources is a sum over all kept terms. Terms are dealt to chunks and sources to blocks, and each
task holds a dense matrix of one chunk by two blocks: neither a large vocabulary nor a language of very many sources meets in one task.
What a term adds beyond a term that neither source has is summed there; the rest is a product, V times the distance of the two zero
counts. The result itself has a row for each ordered pair of sources of a language; nothing larger is made.

Whole numbers throughout: decimals of 38 digits where a product may exceed 64 bits.

Defined cases. Null text, lang or source: empty. Rows that repeat doc_id or text each count as a document. A group without terms, or
a language that keeps none (V = 0): pairs with value 0, ranked by item, no terms. A language with one source has no pairs. A very long text is counted as a whole, in memory of a small multiple of its
length. Ties: by the item's UTF-8 bytes. Empty table: no rows.
Only text, lang and source are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

LEAST_DOCS = 30
TOP = 50
SMOOTH = 5
SCALE = 1_000_000_000
CHUNK = 1024  # terms of a matrix
BLOCK = 128  # sources of a side of a matrix
FOLD_ROWS = 400_000  # rows that a task keeps before it folds them

#: Bytes that part terms: ASCII that is no letter.
PART = np.ones(256, bool)
PART[65:91] = PART[97:123] = PART[128:] = False

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms(raw: np.ndarray, off: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of the texts, A-Z lower-cased, as a dictionary array, and the text of each."""
    starts, ends, at = C.word_spans(raw, off, PART)
    inside = ~PART[raw]
    data = C.LOWER[raw[inside]]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    return pc.dictionary_encode(words), np.repeat(np.arange(len(off) - 1), np.diff(at))


def _chunk(batch: pa.RecordBatch) -> pa.Table:
    """A row for each group and term of a chunk of documents, and one with an empty term for each group."""
    langs, sources = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
    n_sources = len(sources.dictionary)
    group = langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy()
    word, doc = terms(*C.utf8(batch.column("text")))
    size = len(word.dictionary) + 1  # the last is the empty term
    pairs, times = np.unique(doc * size + word.indices.to_numpy(), return_counts=True)
    here = np.unique(group)
    keys, back = np.unique(np.concatenate([group[pairs // size] * size + pairs % size, here * size + size - 1]), return_inverse=True)
    n = np.bincount(back[: len(pairs)], times, len(keys)).astype(np.int64)
    docs = np.bincount(back[: len(pairs)], minlength=len(keys))
    g, names = keys // size, pa.concat_arrays([word.dictionary, pa.array([""])])
    return pa.Table.from_arrays([langs.dictionary.take(pa.array(g // n_sources)), sources.dictionary.take(pa.array(g % n_sources)), names.take(pa.array(keys % size)), pa.array(n), pa.array(docs)], schema=COUNTS)


def _fold(tables: list[pa.Table]) -> pa.Table:
    got = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return got.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(COUNTS.names)


def _count(batches):
    """Counts of a task, folded whenever FOLD_ROWS rows have come together; what doesn't fold to half of that goes on."""
    held, rows = [], 0
    for b in C.chunks(batches, "text", 4 * C.CHUNK_BYTES):
        held.append(_chunk(b))
        rows += len(held[-1])
        if rows > FOLD_ROWS:
            held = [_fold(held)]
            rows = len(held[0])
            if rows > FOLD_ROWS // 2:
                yield from held[0].to_batches(50_000)
                held, rows = [], 0
    if held:
        yield from _fold(held).to_batches(50_000)


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, total (in the language), lead (true in one row of each term of a language); only kept terms, and a row with an empty term for each group."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    by = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")
    whole = by.select("lang", "source", "term", "n", F.sum("n").over(w).alias("total"), F.sum("docs").over(w).alias("docs"), (F.min("source").over(w) == F.col("source")).alias("lead"))
    return whole.filter((F.col("docs") >= least) | (F.col("term") == "")).drop("docs")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)); null where no term is kept."""
    wide = lambda c: c.cast("decimal(20,0)")
    over = wide(count) + F.lit(SMOOTH).cast("decimal(20,0)")
    under = wide(total) + wide(kept) * F.lit(SMOOTH).cast("decimal(2,0)")
    got = F.call_function("div", (over * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)"), F.nullif(under, F.lit(0).cast("decimal(20,0)")).cast("decimal(38,0)"))
    return F.when(kept > 0, got.cast("long") + 1)


def group_stats(kept: DataFrame) -> DataFrame:
    """lang, source, n_group, n_lang, v (kept terms of the language), zero (p of a term that the group doesn't have), n_sources."""
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    terms_of = kept.filter("term <> ''").groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("lead").alias("v"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    got = groups.join(sources.join(terms_of, "lang", "left").select("lang", "n_sources", zero("n_lang"), zero("v")), "lang")
    return got.withColumn("zero", share(F.lit(0), F.col("n_group"), F.col("v")))


def top_terms(kept: DataFrame, stats: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank of the `top` terms of each group: cells by counts, values by multiplicity, terms of the chosen cells."""
    counts = ["lang", "source", "n", "total"]
    rows = kept.filter("term <> '' and n > 0")
    cells = rows.groupBy(*counts).agg(F.count("*").alias("m")).join(stats.select("lang", "source", "n_group", "n_lang", "v"), ["lang", "source"])
    value = share(F.col("n"), F.col("n_group"), F.col("v")) - share(F.col("total"), F.col("n_lang"), F.col("v"))
    cells = C.stored(cells.select(*counts, "m", value.alias("value")).filter("value > 0"), C.shared_dir(kept.sparkSession))
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = merged.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top)  # a value has a term at least
    chosen = first.withColumn("before", F.sum("m").over(w) - F.col("m")).filter(F.col("before") < top).select("lang", "source", "value")
    wanted = cells.join(chosen, ["lang", "source", "value"]).select(*counts, "value")
    found = rows.select(*counts, F.col("term").alias("item")).join(wanted, counts)
    last = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top).select("lang", "source", "item", "value", "rank")


EXTRA = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("extra", pa.int64())])


def _distances(table: pa.Table) -> pa.Table:
    """Of a chunk of terms and one or two blocks of sources: what the chunk's terms add to each pair beyond the distance of the zero counts."""
    source = table.column("source").combine_chunks().dictionary_encode()
    term = table.column("term").combine_chunks().dictionary_encode()
    s, names = source.indices.to_numpy(), source.dictionary.to_pylist()
    has = table.column("term").is_valid().to_numpy()
    zero, side = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    zero[s], side[s] = table.column("zero").to_numpy(), table.column("block").to_numpy()
    p = np.tile(zero, (len(term.dictionary), 1))
    p[term.indices.fill_null(0).to_numpy()[has], s[has]] = table.column("p").fill_null(0).to_numpy()[has]
    order = np.array(sorted(range(len(names)), key=lambda k: names[k].encode()), np.int64)
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    a, b, extra = [], [], []
    for at, g in enumerate(order):
        others = order[at + 1 :]
        if i != j:  # only pairs across the two blocks; those within one are another task's
            others = others[side[others] != side[g]]
        if len(others):
            got = np.abs(p[:, others] - p[:, g : g + 1]).sum(0) - len(p) * np.abs(zero[others] - zero[g])
            a += [names[g]] * len(others)
            b += [names[k] for k in others]
            extra.append(got)
    lang = table.column("lang")[0].as_py()
    return pa.Table.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(np.concatenate(extra) if extra else np.zeros(0, np.int64))], schema=EXTRA)


def source_pairs(kept: DataFrame, stats: DataFrame, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """lang, source, item, value, rank for each ordered pair of sources of a language."""
    n_blocks, n_chunks = F.ceil(F.col("n_sources") / block), F.greatest(F.ceil(F.col("v") / chunk), F.lit(1))
    dealt = stats.filter("v > 0").select("lang", "source", "n_group", "v", "zero", n_blocks.alias("blocks"), n_chunks.alias("chunks"), F.pmod(F.xxhash64("source"), n_blocks).alias("block"))
    own = ["lang", "source", "zero", "block", "blocks"]
    marks = dealt.select(*own, F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    rows = kept.filter("term <> ''").select("lang", "source", "term", "n").join(dealt, ["lang", "source"])
    rows = rows.select(*own, "term", share(F.col("n"), F.col("n_group"), F.col("v")).alias("p"), F.pmod(F.xxhash64("term"), F.col("chunks")).alias("chunk"))
    both = rows.unionByName(marks).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    both = both.select("lang", "source", "zero", "block", "term", "p", "chunk", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    extra = both.groupBy("lang", "chunk", "i", "j").applyInArrow(_distances, "lang string, a string, b string, extra long").groupBy("lang", "a", "b").agg(F.sum("extra").alias("extra"))
    side = lambda item, zero: stats.select("lang", F.col("source").alias(item), F.col("zero").alias(zero), *(["v"] if item == "source" else []))
    pairs = side("source", "z").join(side("item", "y"), "lang").filter("source <> item")
    pairs = pairs.withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")}).join(extra, ["lang", "a", "b"], "left")
    value = F.coalesce(F.col("v") * F.abs(F.col("z") - F.col("y")), F.lit(0)) + F.coalesce("extra", F.lit(0))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.select("lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(w))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank."""
    spark = docs.sparkSession
    kept = C.stored(kept_terms(docs, least), C.shared_dir(spark))
    stats = C.stored(group_stats(kept), C.shared_dir(spark))
    part = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return part(source_pairs(kept, stats, chunk, block), "pair").unionByName(part(top_terms(kept, stats, top), "term"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS nl FROM k GROUP BY lang),
g AS (SELECT q.lang, q.source, coalesce(v, 0) AS v, coalesce(nl, 0) AS nl, coalesce(ng, 0)::HUGEINT AS ng FROM (SELECT DISTINCT lang, source FROM d) q LEFT JOIN l ON q.lang = l.lang LEFT JOIN (SELECT lang, source, sum(n) AS ng FROM c GROUP BY ALL) s ON q.lang = s.lang AND q.source = s.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (ng + 5 * v))::BIGINT AS p, (1 + (1000000000::HUGEINT * (total + 5)) // (nl + 5 * v))::BIGINT AS q
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM y)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50"""
