"""Annotation edits: validation, merge, chunks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import scratch

#: What an edit may say.
ACTIONS = ["upsert", "delete"]
ITEM_TYPES = ["cuboid"]
SEQUENCE_TYPES = ["cuboid 3d", "point cloud polyline"]


def edit_problem(has_object_uuid: Column | None = None) -> Column:
    """The first rule that an edit breaks, or null. An empty uid counts as missing; object_uuid may be null where the field is there."""
    item, seq = F.nullif("dataset_item_uid", F.lit("")), F.nullif("sequence_uid", F.lit(""))
    kind = F.nullif("object_type", F.lit(""))
    upsert = F.col("action") == "upsert"
    return (
        F.when(~F.coalesce(F.col("action").isin(ACTIONS), F.lit(False)), "action")
        .when(F.lit(False) if has_object_uuid is None else ~has_object_uuid, "object_uuid")
        .when(upsert & ~F.coalesce(F.col("object_type").isin(ITEM_TYPES + SEQUENCE_TYPES), F.lit(False)), "object_type")
        .when(upsert & F.col("object_data").isNull(), "object_data")
        .when(item.isNotNull() & seq.isNotNull(), "both targets")
        .when(item.isNull() & seq.isNull(), "no target")
        .when(item.isNotNull() & kind.isNotNull() & ~kind.isin(ITEM_TYPES), "item object_type")
        .when(seq.isNotNull() & kind.isNotNull() & ~kind.isin(SEQUENCE_TYPES), "sequence object_type")
    )


def edit_validate(edits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted edits, rejected edits with reason). Without a column object_uuid every edit lacks that field."""
    got = edits.withColumn("reason", edit_problem(F.lit("object_uuid" in edits.columns)))
    return got.filter("reason is null").drop("reason"), got.filter("reason is not null")


def object_name_counts(edits: DataFrame) -> DataFrame:
    """Edits by object name; none or empty counts as Object. Most first, then by name."""
    name = F.coalesce(F.nullif("object_name", F.lit("")), F.lit("Object"))
    return edits.groupBy(name.alias("object_name")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "object_name")


def missing_refs(edits: DataFrame, items: DataFrame, sequences: DataFrame) -> DataFrame:
    """Uids that edits need and a dataset does not have: kind, missing, needed, a sorted sample of ten."""
    targets = F.array(F.struct(F.lit("item").alias("kind"), F.col("dataset_item_uid").alias("uid")), F.struct(F.lit("sequence").alias("kind"), F.col("sequence_uid").alias("uid")))
    need = edits.select(F.explode(targets).alias("t")).select("t.kind", "t.uid", F.lit(1).alias("needed")).filter("uid <> ''")
    uids = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("uid").cast("string").alias("uid"), F.lit(0).alias("needed"))
    each = need.union(uids(items, "item")).union(uids(sequences, "sequence")).groupBy("kind", "uid").agg(F.max("needed").alias("needed"), F.min("needed").alias("gone")).filter("needed = 1")
    each = each.withColumn("gone", F.col("gone") == 1)
    first = Window.partitionBy("kind", "gone").orderBy("uid")
    few = each.filter("gone").withColumn("r", F.row_number().over(first)).filter("r <= 10").groupBy("kind").agg(F.array_join(F.array_sort(F.collect_list("uid")), ",").alias("sample"))
    total = each.groupBy("kind").agg(F.count_if("gone").alias("missing"), F.count("*").alias("needed"))
    kinds = edits.sparkSession.createDataFrame([("item",), ("sequence",)], "kind string")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return kinds.join(total, "kind", "left").join(few, "kind", "left").select("kind", zero("missing"), zero("needed"), F.coalesce("sample", F.lit("")).alias("sample"))


def latest_edit(edits: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The last edit of each key. max_by keeps one row a key and task, so little is shuffled; rows of any type can't be hashed in place, so Spark sorts by
    key before and after the shuffle."""
    rest = [c for c in edits.columns if c not in keys]
    got = edits.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("x"))
    return got.select(*keys, *[F.col("x")[c].alias(c) for c in rest])


def edit_merge(annotations: DataFrame, edits: DataFrame, keys: list[str], order_by: list[Column], values: list[str]) -> DataFrame:
    """Annotations after the edits: the last edit of a key wins, delete removes. Running it again changes nothing. Null keys meet each other. Any other action than delete
    puts the row, so edits go through edit_validate first where they may be wrong."""
    last = latest_edit(edits, keys, order_by).select(*[F.col(k).alias(f"e_{k}") for k in keys], F.col("action").alias("e_action"), *[F.col(v).alias(f"e_{v}") for v in values])
    on = None
    for k in keys:
        hit = F.col(k).eqNullSafe(F.col(f"e_{k}"))
        on = hit if on is None else on & hit
    got = annotations.join(last, on, "full_outer").filter(~F.col("e_action").eqNullSafe(F.lit("delete")))
    edited = F.col("e_action").isNotNull()
    return got.select(*[F.when(edited, F.col(f"e_{k}")).otherwise(F.col(k)).alias(k) for k in keys], *[F.when(edited, F.col(f"e_{v}")).otherwise(F.col(v)).alias(v) for v in values])


# ---------------------------------------------------------------- a store of annotations


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def create_store(annotations: DataFrame, store: str, keys: list[str], buckets: int = 1024) -> None:
    """Annotations as a table in key buckets, which merge_store changes bucket by bucket. A bucket has a marker row (`_live` false), so that one whose
    annotations are all deleted is written too."""
    rows = annotations.withColumns({"_live": F.lit(True), "_bucket": _bucket(keys, buckets)})
    rows.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{store}/rows")
    annotations.sparkSession.createDataFrame([(buckets, list(keys))], "buckets int, keys array<string>").coalesce(1).write.parquet(f"{store}/about")


def read_store(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/rows").filter("_live").drop("_live", "_bucket")


def merge_store(spark: SparkSession, store: str, edits: DataFrame, batch: str, order_by: list[Column], values: list[str]) -> int:
    """Apply a batch of edits to a store: edits are dealt to the buckets of their keys and only these are read and written again; the other
    files stay. Returns the number of buckets written. A batch has a name: once its marker is there, it is done and another call does nothing. A call that died before can be
    repeated: the new buckets are staged first, each bucket is replaced whole, and an edit applied twice changes nothing."""
    if _exists(spark, f"{store}/commits/{batch}/_SUCCESS"):
        return 0
    about = spark.read.parquet(f"{store}/about").first()
    keys, n = list(about["keys"]), about["buckets"]
    dealt = scratch.stored(edits.withColumn("_bucket", _bucket(keys, n)))
    touched = [r[0] for r in dealt.select("_bucket").distinct().collect()]  # at most the store's buckets
    if touched:
        old = spark.read.parquet(f"{store}/rows")
        columns = [c for c in old.columns if c not in ("_live", "_bucket")]
        own = old.filter(F.col("_bucket").isin(touched) & F.col("_live")).select(*columns)
        merged = edit_merge(own, dealt.drop("_bucket"), keys, order_by, values).select(*columns).withColumns({"_live": F.lit(True), "_bucket": _bucket(keys, n)})
        marks = spark.createDataFrame([(b,) for b in touched], "_bucket int").select(*[F.lit(None).cast(old.schema[c].dataType).alias(c) for c in columns], F.lit(False).alias("_live"), "_bucket")
        staged = scratch.stored(merged.select(*columns, "_live", "_bucket").union(marks))
        staged.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(f"{store}/rows")
    spark.createDataFrame([(len(touched),)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{store}/commits/{batch}")
    return len(touched)


# ---------------------------------------------------------------- order and chunks


def global_index(df: DataFrame, order_by: list[str], name: str = "index") -> DataFrame:
    """A dense index from 0 in a given order, without a single-task window: range partitions, their counts, and offsets (a row for each partition
    comes to the driver)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order_by).withColumn("_p", F.spark_partition_id())
    # the split points are sampled anew in each job, so the dealt rows are kept where every later job finds them
    path = scratch.folder(df.sparkSession)
    ranged.write.parquet(path)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(path)
    offsets, at = [], 0
    for r in sorted(ranged.groupBy("_p").count().collect()):
        offsets.append((r["_p"], at))
        at += r["count"]
    base = df.sparkSession.createDataFrame(offsets, "_p int, _base long")
    w = Window.partitionBy("_p").orderBy(*order_by)
    got = ranged.withColumn("_r", F.row_number().over(w)).join(F.broadcast(base), "_p")
    return got.select(*df.columns, (F.col("_base") + F.col("_r") - 1).cast("long").alias(name))


def edit_chunks(edits: DataFrame, order_by: list[str], chunk_size: int = 500, resume_after: int = -1) -> DataFrame:
    """Edits in order with chunk_index and place in it; chunks up to `resume_after` are done already."""
    if chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    got = global_index(edits, order_by, "_i")
    got = got.withColumns({"chunk_index": F.floor(F.col("_i") / chunk_size).cast("long"), "chunk_row": F.col("_i") % chunk_size}).drop("_i")
    return got.filter(F.col("chunk_index") > resume_after)


def deliver(edits: DataFrame, order_by: list[str], out: str, send, chunk_size: int = 500, wave: int = 1000) -> DataFrame:
    """Hand the chunks of an edit set to `send(chunk_index, rows)` in tasks, `wave` chunks a job, and log what was handed over. The first call numbers the edits and keeps
    them in `out`; a later call with the same `out` goes on with the chunks that the log lacks. Chunks go out in order of waves; those of a wave that died are sent again, so a receiver
    sees an edit at least once (edits may be repeated: the last one of a key wins). `send` gets a list of dicts and returns how many it took. Returns the log: chunk_index, n_edits, taken."""
    spark = edits.sparkSession
    if not _exists(spark, f"{out}/edits/_SUCCESS"):
        numbered = edit_chunks(edits, order_by, chunk_size)
        numbered.repartitionByRange("chunk_index").sortWithinPartitions("chunk_index", "chunk_row").write.mode("overwrite").parquet(f"{out}/edits")
    rows, log = spark.read.parquet(f"{out}/edits"), "chunk_index long, n_edits long, taken long"

    def run(table):
        table = table.sort_by("chunk_row")
        chunk = table.column("chunk_index")[0].as_py()
        taken = send(chunk, table.drop_columns(["chunk_index", "chunk_row"]).to_pylist())
        return pa.table({"chunk_index": [chunk], "n_edits": [table.num_rows], "taken": [taken]})

    most = rows.agg(F.max("chunk_index")).first()[0]
    for first in range(0, 0 if most is None else most + 1, wave):
        at = f"{out}/log/wave={first // wave}"
        if _exists(spark, f"{at}/_SUCCESS"):
            continue
        mine = rows.filter(F.col("chunk_index").between(first, first + wave - 1))
        mine.groupBy("chunk_index").applyInArrow(run, log).write.mode("overwrite").parquet(at)
    if most is None:
        return spark.createDataFrame([], log)
    return spark.read.schema(log).option("recursiveFileLookup", True).parquet(f"{out}/log")


def shard_assign(df: DataFrame, world: int, workers: int, order_by: list[str] | None = None, uid: str = "uid") -> DataFrame:
    """shard, rank and worker of each row: global index mod world * workers, or, without an order, a hash of the uid (no shuffle)."""
    n = world * workers
    if n <= 0:
        raise ValueError("world and workers must be positive")
    got = global_index(df, order_by, "_i").withColumn("shard", (F.col("_i") % n).cast("long")).drop("_i") if order_by else df.withColumn("shard", F.pmod(F.xxhash64(uid), F.lit(n)).cast("long"))
    return got.withColumns({"rank": F.floor(F.col("shard") / workers).cast("long"), "worker": (F.col("shard") % workers).cast("long")})


def shard_cover_check(sharded: DataFrame, full: DataFrame, uid: str = "uid") -> DataFrame:
    """Whether shards are disjoint and complete: rows, uids in several shards, uids missing and foreign."""
    got = sharded.groupBy(uid).agg(F.count_distinct("shard").alias("shards"), F.count("*").alias("rows")).withColumn("here", F.lit(True))
    both = got.join(full.select(uid, F.lit(True).alias("there")).distinct(), uid, "full_outer")
    return both.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"), F.count_if(F.col("shards") > 1).alias("n_shared"), F.count_if(F.col("here").isNull()).alias("n_missing"), F.count_if(F.col("there").isNull()).alias("n_foreign"))
