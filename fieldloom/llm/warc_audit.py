"""Merkle fixity audit of WARC replicas.

A record is a page in WARC form; its slot is its page_id. Slots are the leaves of trees with a fan-out of
16: a node covers an ordered range of slots, and so of the archive file's bytes; it holds a digest
over its children's slots, lengths and digests, and its own length. Three levels up, at 4096 slots, is a
file's root. The audit compares the roots of two replicas and descends, level by level, only
below nodes that differ, carrying each node's start offset (its parent's start plus
its elder siblings' lengths), down to the records.

Trees are tables in the shared folder, a level each, so an audit after a lost executor starts from these. A level's rows are written in order of slots, and a step of the descent asks only for the
ranges of slots below differing nodes (RANGES of them at most, each from its first to its last differing node), which reach the scan: what lies outside is skipped by the statistics of its files, so damage in one place costs
one place's bytes.

Several records in one slot (repeated page_id) are one leaf: its digest is over their number and the sums of
four parts of their digests, aggregated before the shuffle, so a slot with a third of all rows costs one row a task.

Defined cases: null page_id is a slot of its own (NULL_SLOT). Null url or html counts as empty. An empty
replica has every record of the other as missing or extra; two empty ones give no rows. Very long records are hashed as a whole. Extra columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

FAN_BITS = 4
LEVELS = 3
RANGES = 64  # of slots that a step of the descent reads
NULL_SLOT = -(1 << 60)


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, html -> slot, record: each page as a WARC record."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NULL_SLOT)).alias("slot"), F.concat(head, html, F.lit("\r\n\r\n")).alias("record"))


def leaves(archive: DataFrame) -> DataFrame:
    """slot, record -> slot, n_records, n_bytes, digest."""
    one = archive.select("slot", F.octet_length("record").cast("long").alias("n"), F.sha2(F.col("record").cast("binary"), 256).alias("d"))
    parts = [F.sum(F.conv(F.substring("d", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).alias(f"p{k}") for k in range(4)]
    got = one.groupBy("slot").agg(F.count("*").alias("n_records"), F.sum("n").alias("n_bytes"), *parts)
    return got.select("slot", "n_records", "n_bytes", F.sha2(F.concat_ws(":", F.col("n_records").cast("string"), *[F.col(f"p{k}").cast("string") for k in range(4)]).cast("binary"), 256).alias("digest"))


def parents(nodes: DataFrame) -> DataFrame:
    """One level up: at most 16 children a node, so their list is bounded."""
    kids = F.array_sort(F.collect_list(F.struct("slot", "n_bytes", "digest")))
    text = F.array_join(F.transform("kids", lambda k: F.concat_ws(",", k.slot.cast("string"), k.n_bytes.cast("string"), k.digest)), ";")
    up = nodes.groupBy(F.shiftright("slot", FAN_BITS).alias("up")).agg(kids.alias("kids"), F.sum("n_records").alias("n_records"), F.sum("n_bytes").alias("n_bytes"))
    return up.select(F.col("up").alias("slot"), "n_records", "n_bytes", F.sha2(text.cast("binary"), 256).alias("digest"))


def build_tree(archive: DataFrame, folder: str) -> list[DataFrame]:
    """The levels of a replica's tree, leaves first, each a table in `folder`, in order of slots."""
    ordered = lambda nodes: nodes.repartitionByRange("slot").sortWithinPartitions("slot")
    levels = [C.stored(ordered(leaves(archive)), f"{folder}/0")]
    for k in range(1, LEVELS + 1):
        levels.append(C.stored(ordered(parents(levels[-1])), f"{folder}/{k}"))
    return levels


def below_any(nodes: DataFrame) -> Column:
    """A condition on the slots one level down that all children of the nodes meet, as at most RANGES ranges; the null slot's nodes are negative and lie apart."""
    own = nodes.select("slot").filter("slot >= 0")
    lo, hi, apart = nodes.agg(F.min(F.when(F.col("slot") >= 0, F.col("slot"))), F.max("slot"), F.count_if(F.col("slot") < 0)).first()
    hit = F.col("slot") < 0 if apart else F.lit(False)
    if lo is None:
        return hit
    step = F.call_function("div", F.col("slot") - F.lit(lo), F.lit(-(-(hi - lo + 1) // RANGES)))
    for r in own.groupBy(step.alias("k")).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).collect():  # at most RANGES rows
        hit = hit | F.col("slot").between(r.lo << FAN_BITS, ((r.hi + 1) << FAN_BITS) - 1)
    return hit


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    a = a.select("slot", F.col("n_bytes").alias("bytes_a"), F.col("n_records").alias("records_a"), F.col("digest").alias("digest_a"))
    b = b.select("slot", F.col("n_bytes").alias("bytes_b"), F.col("n_records").alias("records_b"), F.col("digest").alias("digest_b"))
    return a.join(b, "slot", "full_outer").filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """Slots that differ between two trees: file, slot, kind (changed, missing or extra in b), their bytes in either, and where the slot starts in a's and b's file."""
    base = C.shared_dir(a[0].sparkSession)
    bad = _differing(a[-1], b[-1]).select("slot", F.lit(0).cast("long").alias("start_a"), F.lit(0).cast("long").alias("start_b"))
    for level in range(LEVELS - 1, -1, -1):
        bad = C.stored(bad, f"{base}/{level}")
        up, inside = bad.select(F.col("slot").alias("up"), "start_a", "start_b"), below_any(bad)

        def below(nodes, side, up=up, inside=inside):
            kids = nodes.filter(inside).withColumn("up", F.shiftright("slot", FAN_BITS)).join(up.select("up"), "up", "left_semi")
            return kids.select("up", "slot", "n_bytes", "n_records", "digest", F.lit(side).alias("side"))

        # both replicas' children of a differing node: at most 32 rows, so its siblings' lengths are added up in place
        both = below(a[level], "a").union(below(b[level], "b"))
        kids = both.groupBy("up", "slot").agg(*[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{n}_{s}") for s in "ab" for c, n in (("n_bytes", "bytes"), ("n_records", "records"), ("digest", "digest"))])
        kids = kids.groupBy("up").agg(F.array_sort(F.collect_list(F.struct("slot", "bytes_a", "bytes_b", "records_a", "records_b", "digest_a", "digest_b"))).alias("kids"))
        before = lambda i, c: F.aggregate(F.slice("kids", 1, i), F.lit(0).cast("long"), lambda s, k: s + F.coalesce(k[c], F.lit(0)))
        placed = kids.select("up", F.explode(F.transform("kids", lambda k, i: F.struct(k.alias("k"), before(i, "bytes_a").alias("a"), before(i, "bytes_b").alias("b")))).alias("x"))
        placed = placed.filter(~F.col("x.k.digest_a").eqNullSafe(F.col("x.k.digest_b"))).join(up, "up")
        bad = placed.select("x.k.*", (F.col("start_a") + F.col("x.a")).alias("start_a"), (F.col("start_b") + F.col("x.b")).alias("start_b"))
    kind = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return bad.select(F.shiftright("slot", FAN_BITS * LEVELS).alias("file"), "slot", kind.alias("kind"), "start_a", "start_b", F.coalesce("bytes_a", F.lit(0)).cast("long").alias("bytes_a"), F.coalesce("bytes_b", F.lit(0)).cast("long").alias("bytes_b"))


def damaged(archive: DataFrame) -> DataFrame:
    """A replica with known damage: some records lost, some cut short, some with a changed byte, some twice."""
    r = F.col("record")
    n = F.length(r)
    bent = F.when(F.pmod("slot", F.lit(157)) == 3, F.substring(r, 1, 60)).when(F.pmod("slot", F.lit(101)) == 7, F.concat(r.substr(F.lit(1), n - 5), F.lit("#"), r.substr(n - 3, F.lit(4)))).otherwise(r)
    kept = archive.filter(F.pmod("slot", F.lit(211)) != 13)
    return kept.select("slot", F.explode(F.when(F.pmod("slot", F.lit(307)) == 5, F.array(bent, bent)).otherwise(F.array(bent))).alias("record"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = C.shared_dir(spark)
    archive = records(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return audit(build_tree(archive, f"{base}/a"), build_tree(damaged(archive), f"{base}/b"))


ORACLE = r"""
WITH r AS (
  SELECT page_id AS slot, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(html) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
), s AS (
  SELECT slot, strlen(record) AS bytes_a,
    CASE WHEN slot % 211 = 13 THEN 0 ELSE (CASE WHEN slot % 157 = 3 THEN strlen(substring(record, 1, 60))
      WHEN slot % 101 = 7 THEN strlen(substring(record, 1, length(record) - 5)) + 1 + strlen(substring(record, length(record) - 3, 4)) ELSE strlen(record) END)
      * (CASE WHEN slot % 307 = 5 THEN 2 ELSE 1 END) END AS bytes_b,
    slot % 211 = 13 AS gone, slot % 211 = 13 OR slot % 157 = 3 OR slot % 101 = 7 OR slot % 307 = 5 AS bad
  FROM r
), o AS (
  SELECT *, slot // 4096 AS file,
    coalesce(sum(bytes_a) OVER (PARTITION BY slot // 4096 ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_a,
    coalesce(sum(bytes_b) OVER (PARTITION BY slot // 4096 ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_b
  FROM s
)
SELECT file, slot, CASE WHEN gone THEN 'missing' ELSE 'changed' END AS kind, CAST(start_a AS BIGINT) AS start_a, CAST(start_b AS BIGINT) AS start_b,
  CAST(bytes_a AS BIGINT) AS bytes_a, CAST(bytes_b AS BIGINT) AS bytes_b
FROM o WHERE bad
"""
