"""Fleet rules as data: a table of rules matched against events by a threshold index.

A rule is (uid, enabled, field, op, value, device_type, severity, actions); a null device_type is every device, a null enabled is true. Rules are sorted by
value for each (scope, field, direction), so the rules that an event meets are one range of each list, found by binary search: what an event costs grows with
the logarithm of the rules and with its own matches. Lists come as arrays to each task, at most SLICE rules at a time; a larger table takes one pass over
the events for each slice. The plan is the same for ten rules and for a million.

rule_match gives pairs, and where rules and events both grow their number grows with the product. rule_totals gives hits by rule without the pairs: values and thresholds in
one order, dealt by ranges, with sums up to each place; its work grows with events and rules.

Comparisons are Spark's: numbers as doubles with NaN above all, text by UTF-8 bytes; a null value of the event or the rule meets nothing. A rule's value is
text; it is a number where the event's field is one. Unknown operators, fields that the events lack and values that are no number are errors, also in disabled rules.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources import scratch
from . import edits

RULES = "uid long, enabled boolean, field string, op string, value string, device_type string, severity string, actions array<string>"
#: The comparisons that a rule may ask for.
OPS = ["gt", "gte", "lt", "lte", "eq"]
SLICE = 200_000
ROWS = 50_000  # matches of an output batch


@dataclass
class Index:
    """Rules of a slice: by (device_type, field, op) the sorted values and the rules' places; and the rules' own columns."""

    lists: dict
    uid: pa.Array
    severity: pa.Array
    actions: pa.Array


def build(rules: pa.Table, numeric: set[str]) -> Index:
    """The index of a slice of enabled rules."""
    groups: dict[tuple, list[int]] = {}
    for k, key in enumerate(zip(*(rules.column(c).to_pylist() for c in ("device_type", "field", "op")), strict=True)):
        groups.setdefault(key, []).append(k)
    value, lists = rules.column("value").to_pylist(), {}
    for key, places in groups.items():
        if key[1] in numeric:
            own = np.array([float(value[k]) for k in places])
            order = np.argsort(own, kind="stable")
            lists[key] = (own[order], np.array(places)[order])
        else:
            pairs = sorted((value[k].encode(), k) for k in places)
            lists[key] = (np.array([v for v, _ in pairs], object), np.array([k for _, k in pairs]))
    whole = lambda c: rules.column(c).combine_chunks()
    return Index(lists, whole("uid"), whole("severity"), whole("actions"))


def ranges(values: np.ndarray, op: str, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (excluded) place of the sorted values v for which `x op v` holds."""
    left, right = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
    zero, end = np.zeros(len(x), np.int64), np.full(len(x), len(values))
    return {"gt": (zero, left), "gte": (zero, right), "lt": (right, end), "lte": (left, end), "eq": (left, right)}[op]


def _column(batch: pa.RecordBatch, name: str, numeric: bool) -> tuple[np.ndarray, np.ndarray]:
    """Values of a field and the rows that have one."""
    col = batch.column(batch.schema.get_field_index(name))
    rows = np.flatnonzero(col.is_valid().to_numpy(zero_copy_only=False))
    col = col.drop_null()
    if numeric:
        return col.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False), rows
    return np.array([str(v).encode() for v in col.to_pylist()], object), rows


def match_batch(batch: pa.RecordBatch, index: Index, numeric: set[str], device: str):
    """(event rows, rules) of a batch's matches, at most ROWS at a time."""
    fields = {}
    kinds = batch.column(batch.schema.get_field_index(device)).to_pylist()
    of_kind = {kind: np.array([k == kind for k in kinds]) for kind in {key[0] for key in index.lists} - {None}}
    for (kind, field, op), (values, places) in index.lists.items():
        if field not in fields:
            fields[field] = _column(batch, field, field in numeric)
        x, rows = fields[field]
        if kind is not None:
            mine = of_kind[kind][rows]
            x, rows = x[mine], rows[mine]
        if not len(rows):
            continue
        first, last = ranges(values, op, x)
        while len(rows):
            size = np.maximum(last - first, 0)
            upto = np.cumsum(size)
            n = max(1, int(np.searchsorted(upto, ROWS, "right")))
            take = np.minimum(size[:n], ROWS)  # an event with more matches than a batch holds goes on in the next
            if take.sum():
                event = np.repeat(rows[:n], take)
                start = np.repeat(first[:n] - np.concatenate([[0], np.cumsum(take)[:-1]]), take)
                yield event, places[start + np.arange(take.sum())]
            first[:n] += take
            rest = np.flatnonzero(first < last)
            rows, first, last = rows[rest], first[rest], last[rest]


def checked(rules: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The rules with defaults; wrong ones raise when they are read."""
    known = F.create_map(*[F.lit(x) for pair in fields.items() for x in pair])
    problem = F.when(~F.coalesce(F.col("op").isin(OPS), F.lit(False)), F.concat(F.lit("unknown operator "), F.coalesce("op", F.lit("null"))))
    problem = problem.when(F.col("field").isNull() | F.get(F.map_keys(F.map_filter(known, lambda k, _: k == F.col("field"))), F.lit(0)).isNull(), F.concat(F.lit("unknown field "), F.coalesce("field", F.lit("null"))))
    problem = problem.when((F.try_element_at(known, F.col("field")) == "number") & F.col("value").isNotNull() & F.expr("try_cast(value as double)").isNull(), F.concat(F.lit("no number: "), F.col("value")))
    problem = F.when(problem.isNotNull(), F.raise_error(F.concat(F.lit("rule "), F.col("uid").cast("string"), F.lit(": "), problem)))
    got = rules.withColumn("_bad", problem.cast("string")).filter("_bad is null")
    return got.select("uid", F.coalesce("enabled", F.lit(True)).alias("enabled"), "field", "op", "value", "device_type", F.coalesce("severity", F.lit("warning")).alias("severity"), F.coalesce("actions", F.array(F.lit("alert"))).alias("actions"))


def _kinds(events: DataFrame) -> dict[str, str]:
    """What a field is compared as: number or text."""
    return {f.name: "number" if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or f.dataType.typeName().startswith("decimal") else "text" for f in events.schema}


def rule_match(events: DataFrame, devices: DataFrame, rules: DataFrame, most: int = SLICE) -> DataFrame:
    """(rule, alert_severity, actions, the event's columns, device_type): each enabled rule with each event that it holds for. Events of unknown devices meet nothing."""
    spark = events.sparkSession
    fields = _kinds(events)
    numeric = {k for k, v in fields.items() if v == "number"}
    good = checked(rules, fields).filter("enabled and value is not null")
    rows = events.join(devices.select(F.col("uid").alias("device"), F.col("type").alias("device_type")), "device").select(*events.columns, "device_type")
    found = rows.select(F.lit(None).cast("long").alias("rule"), F.lit("").alias("alert_severity"), F.array(F.lit("")).alias("actions"), *rows.columns)
    schema = to_arrow_schema(found.schema)
    n, out = good.count(), None
    slices = -(-n // most)
    good = edits.global_index(good, ["uid", "field", "op", "value"], "_at") if slices > 1 else good
    for k in range(slices):
        part = good.filter((F.col("_at") >= k * most) & (F.col("_at") < (k + 1) * most)).drop("_at") if slices > 1 else good
        shared = spark.sparkContext.broadcast(build(part.toArrow(), numeric))  # at most `most` rules

        def run(batches, shared=shared):
            index = shared.value
            for b in batches:
                for event, place in match_batch(b, index, numeric, "device_type"):
                    place = pa.array(place)
                    mine = [index.uid.take(place), index.severity.take(place), index.actions.take(place), *(c.take(pa.array(event)) for c in b.columns)]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(mine, schema, strict=True)], schema=schema)

        one = rows.mapInArrow(run, found.schema)
        out = one if out is None else out.union(one)
    return found.filter(F.lit(False)) if out is None else out


PLACE = ["field", "scope", "x", "t"]  # of a value or a threshold: numbers in x, text in t; a null scope is every device


def rule_totals(events: DataFrame, devices: DataFrame, rules: DataFrame, sums: tuple[str, ...] = ()) -> DataFrame:
    """rule, hit_count, and the sums of the named whole-number columns (nulls add nothing) over the events that each enabled rule holds for; a rule without one has no row. The same as
    rule_match, grouped by rule, but no pair is made: a rule's events are those below, above or at its threshold, so sums up to each place of the ordered values give
    them. Values and thresholds are folded by (field, scope, value), dealt by ranges, summed within each range and carried on by a row for each range and scope. Fields that
    are neither numbers nor strings go through rule_match."""
    fields = _kinds(events)
    good = checked(rules, fields).filter("enabled and value is not null").select("uid", "field", "op", "value", "device_type")
    used = sorted(r.field for r in good.select("field").distinct().collect())  # a row for each column of the events at most
    odd = [k for k in used if fields[k] == "text" and events.schema[k].dataType.typeName() != "string"]
    out = ["hit_count", *sums]
    if odd:
        one = rule_match(events, devices, rules.filter(F.col("field").isin(odd)))
        whole = one.groupBy("rule").agg(F.count("*").alias("hit_count"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in sums])
        used = [k for k in used if k not in odd]
        if not used:
            return whole
        rest = rule_totals(events, devices, rules.filter(~F.coalesce(F.col("field").isin(odd), F.lit(False))), sums)
        return rest.union(whole).groupBy("rule").agg(*[F.sum(c).alias(c) for c in out])
    own = [f"_{k}" for k in range(len(out))]  # their names until the end
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    at = [F.struct(F.lit(k).alias("field"), F.col(k).cast("double").alias("x") if fields[k] == "number" else number.alias("x"), F.col(k).alias("t") if fields[k] == "text" else text.alias("t")) for k in used]
    at = F.array(*at) if at else F.expr("cast(array() as array<struct<field: string, x: double, t: string>>)")
    exact = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)")
    rows = events.join(devices.select(F.col("uid").alias("device"), F.col("type").alias("device_type")), "device")
    rows = rows.select("device_type", F.explode(at).alias("v"), F.lit(1).cast("decimal(38,0)").alias("_0"), *[exact(c).alias(k) for k, c in zip(own[1:], sums, strict=True)]).filter("v.x is not null or v.t is not null")
    scopes = F.when(F.col("device_type").isNull(), F.array(text)).otherwise(F.array(text, F.col("device_type")))
    rows = rows.select("v.field", F.explode(scopes).alias("scope"), "v.x", "v.t", *own, F.lit(False).alias("asked"))
    numeric = F.col("field").isin([k for k in used if fields[k] == "number"])
    place = [F.col("field"), F.col("device_type").alias("scope"), F.when(numeric, F.expr("try_cast(value as double)")).alias("x"), F.when(~numeric, F.col("value")).alias("t")]
    good = good.select(F.col("uid").alias("rule"), "op", *place)
    asks = good.select(*PLACE, *[F.lit(0).cast("decimal(38,0)").alias(c) for c in own], F.lit(True).alias("asked"))
    total = lambda c: F.sum(c).cast("decimal(38,0)")
    places = rows.union(asks).groupBy(*PLACE).agg(*[total(c).alias(c) for c in own], F.max("asked").alias("asked"))
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = scratch.stored(places.repartitionByRange(parts, *PLACE).withColumn("_p", F.spark_partition_id()))  # ranges are sampled anew in each job
    inside = Window.partitionBy("_p", "field", "scope").orderBy("x", "t").rowsBetween(Window.unboundedPreceding, 0)
    upto = places.select("*", *[F.sum(c).over(inside).cast("decimal(38,0)").alias(f"upto_{c}") for c in own]).filter("asked")
    scope = Window.partitionBy("field", "scope")
    before = scope.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ranges_of = places.groupBy("_p", "field", "scope").agg(*[total(c).alias(c) for c in own])
    ranges_of = ranges_of.select(F.col("_p").alias("_q"), F.col("field").alias("_field"), F.col("scope").alias("_scope"), *[F.coalesce(F.sum(c).over(before).cast("decimal(38,0)"), F.lit(0)).alias(f"before_{c}") for c in own], *[F.sum(c).over(scope).cast("decimal(38,0)").alias(f"all_{c}") for c in own])
    got = upto.join(ranges_of, (F.col("_p") == F.col("_q")) & (F.col("field") == F.col("_field")) & F.col("scope").eqNullSafe(F.col("_scope")))
    got = got.select(*[F.col(c).alias(f"at_{c}") for c in PLACE], *[F.struct((F.col(f"before_{c}") + F.col(f"upto_{c}")).alias("upto"), F.col(c).alias("own"), F.col(f"all_{c}").alias("whole")).alias(c) for c in own])
    same = (F.col("field") == F.col("at_field")) & F.col("scope").eqNullSafe(F.col("at_scope")) & F.col("x").eqNullSafe(F.col("at_x")) & F.col("t").eqNullSafe(F.col("at_t"))
    op = F.col("op")

    def held(c: str):
        s = F.col(c)
        return F.when(op == "gt", s["whole"] - s["upto"]).when(op == "gte", s["whole"] - s["upto"] + s["own"]).when(op == "lt", s["upto"] - s["own"]).when(op == "lte", s["upto"]).otherwise(s["own"])

    found = good.join(got, same).select("rule", *[held(c).alias(c) for c in own]).filter("_0 > 0")
    return found.groupBy("rule").agg(*[F.sum(k).cast("long").alias(c) for k, c in zip(own, out, strict=True)])
