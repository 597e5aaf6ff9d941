"""Listings, pages, slices, samples."""

from __future__ import annotations

import base64
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filters of each listing. `~` marks a case-insensitive substring.
FILTERS = {
    "datasets": ["data_type", "~name", "status", "visibility"], "tasks": ["project", "status"], "auto_label_jobs": ["project"], "devices": ["status", "type"], "recordings": ["device", "status"],
    "events": ["recording", "device", "type", "severity"], "rules": ["enabled"], "alerts": ["status", "severity", "device", "rule"], "issues_by_sequence": ["sequence_uid", "dataset_item_uid", "project_uid"],
    "issues_by_dataset": ["dataset", "sequence_uid"], "issue_tools": ["dataset_type"], "storage_configs": ["organization"], "members": ["~search", "role"], "items": ["owner", "slug"], "sequences": ["owner", "slug"],
    "slices": ["owner"], "slice_items": ["owner", "slug"], "agent_executions": ["agent"], "consensus_scores": ["project"], "quality_targets": ["project"], "teams": ["organization"], "team_members": ["organization", "team"],
    "invitations": ["organization"],
}


def entity_filter(df: DataFrame, entity: str, **filters) -> DataFrame:
    """All given filters (None is none) of a listing; unknown ones are errors. Filters are plain predicates, so they reach the scan."""
    known = {f.lstrip("~"): f[0] == "~" for f in FILTERS.get(entity, [])}
    for name, value in filters.items():
        if name not in known:
            raise ValueError(f"{entity} has no filter {name!r}")
        if value is None:
            continue
        columns = ["username", "email", "full_name"] if name == "search" else [name]
        if known[name]:
            hit = F.lit(False)
            for c in columns:
                hit = hit | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(value.lower())), F.lit(False))
            df = df.filter(hit)
        else:
            df = df.filter(F.col(name) == value)
    return df


def entity_get(df: DataFrame, strict: bool = False, **key) -> DataFrame:
    """The row with a uid, or an owner and slug. None: no row, or LookupError when strict."""
    for k, v in key.items():
        df = df.filter(F.col(k) == v)
    got = df.limit(1)
    if strict and not got.take(1):
        raise LookupError(f"not found: {key}")
    return got


def encode_cursor(key: list | dict) -> str:
    return base64.urlsafe_b64encode(json.dumps(key, default=str).encode()).decode()


def decode_cursor(cursor: str) -> list | dict:
    return json.loads(base64.urlsafe_b64decode(cursor))


def _beyond(order_by: list[str], key: list, forward: bool) -> Column:
    """Whether a row's key lies after (or before) a key, compared column by column."""
    far, same = F.lit(False), F.lit(True)
    for c, v in zip(order_by, key, strict=True):
        step = F.col(c) > F.lit(v) if forward else F.col(c) < F.lit(v)
        far = far | (same & step)
        same = same & (F.col(c) == F.lit(v))
    return far


def keyset_page(df: DataFrame, order_by: list[str], limit: int, cursor: str | None = None) -> DataFrame:
    """A page of at most `limit` rows in order, each with has_more, next_cursor and previous_cursor of the page (null where nothing lies that way). A cursor is
    the key of a page's edge: `[key]` asks for what follows it, `{"before": [key]}` for what comes right before it, read as a key range in reverse order and turned
    round; so walking back gives the pages that walking forward gave. Each page reads limit + 1 rows and, the other way, one. The keys must be unique and
    not null. An empty page has no cursors."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    key = decode_cursor(cursor) if cursor else None
    forward = not isinstance(key, dict)
    key = key if forward else key["before"]
    hit = F.lit(True) if key is None else _beyond(order_by, key, forward)
    rows = df.filter(hit).orderBy(*[F.asc(c) if forward else F.desc(c) for c in order_by]).limit(limit + 1)
    held = F.array_sort(F.collect_list(F.struct(*order_by, F.struct(*df.columns).alias("_r"))))
    page = rows.agg(held.alias("all"))
    more = F.size("all") > limit
    page = page.select(more.alias("more"), F.slice("all", F.when(more & F.lit(not forward), 2).otherwise(1), limit).alias("rs"))
    other = df.filter(~hit).limit(1).agg((F.count("*") > 0).alias("other"))  # a row on the far side of the cursor
    page = page.crossJoin(other)  # one row each
    bare = lambda x: F.substr(x, F.lit(2), F.length(x) - 2)  # noqa: E731  a JSON array without its brackets
    text = lambda r: F.concat(F.lit("["), F.concat_ws(",", *[bare(F.to_json(F.array(r[c]))) for c in order_by]), F.lit("]"))
    safe = lambda x: F.translate(F.base64(F.encode(x, "utf-8")), "+/", "-_")
    after, before = ("more", "other") if forward else ("other", "more")
    following = F.when(F.col(after), safe(text(F.element_at("rs", -1))))
    preceding = F.when(F.col(before), safe(F.concat(F.lit('{"before":'), text(F.element_at("rs", 1)), F.lit("}"))))
    page = page.filter(F.size("rs") > 0).select("rs", F.col(after).alias("has_more"), following.alias("next_cursor"), preceding.alias("previous_cursor"))
    return page.select(F.explode("rs").alias("x"), "has_more", "next_cursor", "previous_cursor").select("x._r.*", "has_more", "next_cursor", "previous_cursor")


def latest_n(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order_by]).limit(n)


def rows_json(df: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows as JSON text under the API's field names."""
    return df.select(F.to_json(F.struct(*[F.col(c).alias(k) for k, c in keys.items()])).alias("json"))


def status_overview(organizations: DataFrame, members: DataFrame, lists: dict[str, DataFrame], exports: DataFrame, devices: DataFrame, newest: int = 5) -> DataFrame:
    """(section, name, value) rows: members by organization, whether each list has more than the newest rows shown, pending exports, devices online and not."""
    by = members.groupBy("organization").agg(F.count("*").alias("n"))
    out = organizations.join(by, "organization", "left").select(F.lit("members").alias("section"), F.col("name"), F.coalesce("n", F.lit(0)).cast("long").alias("value"))
    for kind, df in lists.items():
        some = df.limit(newest + 1).agg(F.count("*").alias("n"))
        out = out.union(some.select(F.lit(kind), F.lit("shown"), F.least("n", F.lit(newest)).cast("long"))).union(some.select(F.lit(kind), F.lit("has_more"), (F.col("n") > newest).cast("long")))
    out = out.union(exports.agg(F.count_if(F.col("status").isin("pending", "processing")).alias("v")).select(F.lit("exports"), F.lit("pending"), "v"))
    fleet = devices.agg(F.count_if(F.col("status") == "online").alias("on"), F.count("*").alias("n"))
    return out.union(fleet.select(F.lit("fleet"), F.lit("online"), "on")).union(fleet.select(F.lit("fleet"), F.lit("offline"), F.col("n") - F.col("on")))


def status_lists(lists: dict[str, tuple[DataFrame, str]], n: int = 5) -> DataFrame:
    """The newest n rows of each list: section, place from 1, uid. A list comes with the column of its time; ties go to the larger uid."""
    out = None
    for section, (df, at) in lists.items():
        newest = df.select("uid", F.col(at).alias("at")).orderBy(F.desc("at"), F.desc("uid")).limit(n)
        few = newest.agg(F.reverse(F.array_sort(F.collect_list(F.struct("at", "uid")))).alias("rs"))  # n rows at most
        rows = few.select(F.lit(section).alias("section"), F.posexplode("rs").alias("i", "r")).select("section", (F.col("i") + 1).cast("long").alias("place"), F.col("r.uid").cast("string").alias("uid"))
        out = rows if out is None else out.union(rows)
    return out


def org_rollup(organizations: DataFrame, **parts: DataFrame) -> DataFrame:
    """organization, name and a count of each part (members, teams, ...), which has a column organization."""
    out = organizations.select("organization", "name")
    for name, df in parts.items():
        out = out.join(df.groupBy("organization").agg(F.count("*").alias(f"{name}_count")), "organization", "left")
    return out.select("organization", "name", *[F.coalesce(f"{n}_count", F.lit(0)).cast("long").alias(f"{n}_count") for n in parts])


def random_selection(items: DataFrame, n: int, seed: str, uid: str = "uid") -> DataFrame:
    """n items, always the same: those with the smallest md5 of uid and seed."""
    return items.orderBy(F.md5(F.concat(F.col(uid).cast("string"), F.lit(seed)).cast("binary")), uid).limit(n)


def slice_compose(items: DataFrame, sub_slices: list[dict], n: int | None = None, seed: str = "", uid: str = "uid") -> DataFrame:
    """Items of any sub-slice {dataset, query}, query `field=value` or none, once each; then a random selection. One pass: the sub-slices are one predicate."""
    hit: Column = F.lit(False)
    for s in sub_slices:
        one = F.col("dataset") == s["dataset"]
        if s.get("query"):
            field, _, value = s["query"].partition("=")
            one = one & (F.col(field.strip()).cast("string") == value.strip())
        hit = hit | F.coalesce(one, F.lit(False))
    got = items.filter(hit).dropDuplicates([uid])
    return got if n is None else random_selection(got, n, seed, uid)


def related_items(items: DataFrame, uid: str = "uid", sequence: str = "related_sequence_uid") -> DataFrame:
    """Each item with its sequence's size and the smallest and largest of its siblings; a sequence's items are aggregated, not paired."""
    by = items.groupBy(sequence).agg(F.count("*").alias("n_items"), F.min(uid).alias("first_uid"), F.max(uid).alias("last_uid"))
    return items.select(uid, sequence).join(by, sequence, "left").select(uid, sequence, (F.col("n_items") - 1).alias("n_siblings"), "first_uid", "last_uid")


def item_siblings(items: DataFrame, sequences: DataFrame, most: int = 20, uid: str = "uid", sequence: str = "related_sequence_uid") -> DataFrame:
    """Each item with its sequence as a struct (null where there is none of that uid), the number of its siblings, and the `most` smallest sibling uids in order. The list is
    the only limit: of each sequence most + 1 uids are taken, within tasks first, so a sequence of any size makes no pairs."""
    w = Window.partitionBy(sequence).orderBy(uid)
    few = items.filter(F.col(sequence).isNotNull()).select(sequence, uid).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= most + 1)
    few = few.groupBy(sequence).agg(F.array_sort(F.collect_list(uid)).alias("few"))
    size = items.groupBy(sequence).agg(F.count("*").alias("n"))
    seq = sequences.select(F.struct(*sequences.columns).alias("sequence"), F.col("uid").alias(sequence))
    got = items.select(uid, sequence).join(size, sequence, "left").join(few, sequence, "left").join(seq, sequence, "left")
    others = F.slice(F.filter("few", lambda x: x != F.col(uid)), 1, most)
    return got.select(uid, sequence, "sequence", F.coalesce(F.col("n") - 1, F.lit(0)).alias("n_siblings"), F.coalesce(others, F.array().cast(f"array<{dict(items.dtypes)[uid]}>")).alias("siblings"))


def annotation_export(items: DataFrame, project: str | None = None, dataset: str | None = None, tasks: DataFrame | None = None) -> DataFrame:
    """Annotated items of one project or one dataset."""
    if (project is None) == (dataset is None):
        raise ValueError("give a project or a dataset")
    got = items.filter("annotations is not null")
    if dataset is not None:
        got = got.filter(F.col("dataset") == dataset)
    else:
        got = got.join(tasks.filter(F.col("project") == project).select("dataset").distinct(), "dataset", "left_semi")
    return got.select("uid", "dataset", "key", "annotations")


def sample_transform(df: DataFrame, fn, schema: str) -> DataFrame:
    """A user's function from a sample (dict) to a sample, batch by batch."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([fn(r) for r in b.to_pylist()], schema=out)

    return df.mapInArrow(run, schema)
