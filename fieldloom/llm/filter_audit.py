"""Filter interaction audit: what five filters remove in each of the 120 orders, alone and together.

One scan gives each document five bits, failed or not, and two marks from the labels. Counts by part
and bits are a 2x2x2x2x2 contingency tensor for each part and measure (documents, good ones, toxic
ones). Every figure of every order and step is then one contraction of that tensor: along each axis
a selector takes pass, fail or all. All 600 selections are one einsum in whole numbers.

Documents meet in two shuffles of small rows (no texts): by doc_id with their labels, and by (text
digest, doc_id) with the smallest doc_id of each text, which is folded within tasks first. So a group of
copies, however large, is never in one task. The tensors have 32 cells a part, whatever the input.

Defined cases. Text: null counts as empty; an empty text has no word, so it fails A only (and E, where a smaller
doc_id is empty too); long texts are one row like any other. lang: null counts as an empty string, so both are one part. doc_id:
a null one has no smaller and is no smaller one; rows that repeat id and text are not smaller than each other. Labels:
of repeated rows of an id any 1 counts; null is no mark; ids without a label have none. Equal texts are told by SHA-256. Empty
table: no rows. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ("n", "good", "toxic")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
CELLS = 1 << len(FILTERS)


def failed(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest and the conditions A to D of each document as bits 0 to 3, all in the scan."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    # Spark's split gives '' for an empty text, and no empty words inside a trimmed one
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    rows = rows.withColumn("w", F.split(trimmed, r"[\x20\x09-\x0D]+"))
    none = F.col("w")[0] == ""
    count = lambda words: F.when(none, 0).otherwise(F.size(words)).cast("long")
    n, several = count("w"), count(F.array_distinct("w"))
    upper = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    conditions = [n < 200, 100 * several < 50 * n, 100 * upper.cast("long") > 3 * F.length("text").cast("long"), F.col("text").rlike(r"[#$%&*|]")]
    bits = sum((c.cast("int") * (1 << k) for k, c in enumerate(conditions)), F.lit(0))
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), bits.alias("bits"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits (0 to 31), n, good, toxic."""
    rows = C.stored(failed(docs), C.shared_dir(docs.sparkSession))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null").withColumn("first", F.lit(True))
    mark = labels.filter("quality = 1 or toxic = 1").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    got = rows.join(first, ["digest", "doc_id"], "left").join(mark, "doc_id", "left")
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return got.groupBy("part", (F.col("bits") + F.when(copy, 16).otherwise(0)).alias("bits")).agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def selectors() -> dict[str, np.ndarray]:
    """For each figure the selector of each order, step and axis: 600 x 5 x 2."""
    out: dict[str, list] = {k: [] for k in ("kept", "removed", "failing", "alone")}
    for order in ORDERS:
        for step, name in enumerate(order):
            before, upto = order[:step], order[: step + 1]
            out["kept"].append([PASS if f in upto else ALL for f in FILTERS])
            out["removed"].append([FAIL if f == name else PASS if f in before else ALL for f in FILTERS])
            out["failing"].append([FAIL if f == name else ALL for f in FILTERS])
            out["alone"].append([FAIL if f == name else PASS for f in FILTERS])
    return {k: np.array(v, np.int64) for k, v in out.items()}


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Sums of a (measures, 2, 2, 2, 2, 2) tensor under each row of selectors: (measures, rows)."""
    return np.einsum("mabcde,ra,rb,rc,rd,re->mr", tensor, *np.moveaxis(chosen, 1, 0), optimize="greedy")


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
OUT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((f, pa.int64()) for f in FIGURES)])


def figures(tensor: np.ndarray, choose: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The seven figures of a part for each of the 600 rows; tensor: measures by cell, bit k of a cell is filter k."""
    cube = tensor.reshape(len(MEASURES), *[2] * len(FILTERS)).transpose(0, *range(len(FILTERS), 0, -1))
    removed = contract(cube, choose["removed"])
    axis = np.array([FILTERS.index(f) for order in ORDERS for f in order])
    shapley = np.zeros(len(FILTERS), np.int64)
    np.add.at(shapley, axis, removed[0])
    return {
        "kept": contract(cube, choose["kept"])[0],
        "removed": removed[0],
        "redundant": contract(cube, choose["failing"])[0] - removed[0],
        "unique_fails": contract(cube, choose["alone"])[0],
        "good_lost": removed[1],
        "toxic_lost": removed[2],
        "shapley": shapley[axis],
    }


def _parts(batches):
    choose = selectors()
    names = [order for order in ORDERS for _ in order]
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
    for b in batches:
        for part, cell in zip(b.column("part").to_pylist(), b.column("cells").to_pylist(), strict=True):
            tensor = np.zeros((len(MEASURES), CELLS), np.int64)
            for c in cell:
                tensor[:, c["bits"]] = [c[m] for m in MEASURES]
            got = figures(tensor, choose)
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(names)), pa.array(names), pa.array(steps), *(pa.array(got[f]) for f in FIGURES)], schema=OUT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step -> kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. A part has 32 cells at most."""
    by = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("bits", *MEASURES)).alias("cells"))
    return by.mapInArrow(_parts, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'int' if f.type == pa.int32() else 'long'}" for f in OUT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text))::INT
  + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS m FROM w),
l AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, m),
x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(k, bit)),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM x a JOIN x b ON a.k <> b.k JOIN x c ON c.k NOT IN (a.k, b.k) JOIN x d ON d.k NOT IN (a.k, b.k, c.k) JOIN x e ON e.k NOT IN (a.k, b.k, c.k, d.k)),
s AS (SELECT filter_order, step, (SELECT bit FROM x WHERE k = filter_order[step]) AS own, coalesce((SELECT sum(bit) FROM x WHERE contains(filter_order[1:step - 1], k)), 0)::BIGINT AS before FROM o, range(1, 6) r(step)),
g AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE m & (before | own) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE m & before = 0 AND m & own <> 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE m & before <> 0 AND m & own <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE m = own), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (WHERE m & before = 0 AND m & own <> 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE m & before = 0 AND m & own <> 0), 0)::BIGINT AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM g"""
