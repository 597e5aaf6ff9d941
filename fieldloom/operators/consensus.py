"""Agreement of annotators: pairs of their boxes, best assignment of one's boxes to another's, scores by item and task.

A box is an axis-aligned rectangle (uid, item, task, annotator, x0, y0, x1, y1). Choices of ours, as the service keeps the arithmetic to itself: two annotators'
boxes are matched one to one so that the sum of IoU is largest; their agreement is that sum over the larger number of boxes, so a box without a partner
counts as 0; an item's score is the mean agreement over its pairs of annotators.

What meets in one row is one annotator's boxes on one item and task: a person's work on one picture. An item's pairs grow with the square of its annotators,
which is the feature; Spark splits a hot item's join partition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import scratch


@dataclass(frozen=True)
class Choices:
    iou_threshold: float = 0.5
    min_agreement_ratio: float = 0.5
    min_annotations: int = 2
    histogram_buckets: int = 2


OURS = Choices()
SIDES = ("x0", "y0", "x1", "y1")


def iou(a: str, b: str) -> Column:
    """Intersection over union of two axis-aligned boxes (x0, y0, x1, y1) of struct columns."""
    c = lambda s, f: F.col(f"{s}.{f}")
    w = F.greatest(F.least(c(a, "x1"), c(b, "x1")) - F.greatest(c(a, "x0"), c(b, "x0")), F.lit(0.0))
    h = F.greatest(F.least(c(a, "y1"), c(b, "y1")) - F.greatest(c(a, "y0"), c(b, "y0")), F.lit(0.0))
    area = lambda s: (c(s, "x1") - c(s, "x0")) * (c(s, "y1") - c(s, "y0"))
    return F.try_divide(w * h, area(a) + area(b) - w * h)


def _enough(boxes: DataFrame, cfg: Choices) -> DataFrame:
    """Boxes of items and tasks with at least min_annotations annotators; a pair has two anyway. Boxes without a column uid are told by their sides."""
    if "uid" not in boxes.columns:
        boxes = boxes.withColumn("uid", F.concat_ws(",", *[F.col(c).cast("string") for c in SIDES]))
    if cfg.min_annotations <= 2:
        return boxes
    many = boxes.groupBy("item", "task").agg(F.count_distinct("annotator").alias("n")).filter(F.col("n") >= cfg.min_annotations)
    return boxes.join(many.select("item", "task"), ["item", "task"], "left_semi")


def annotator_pairs(boxes: DataFrame, cfg: Choices = OURS) -> DataFrame:
    """Pairs of boxes of different annotators (a < b) on one item and task, with their IoU (null for two boxes without area)."""
    rows = _enough(boxes, cfg)
    side = lambda s: rows.select("item", "task", F.struct("annotator", "uid", *SIDES).alias(s))
    both = side("a").join(side("b"), ["item", "task"]).filter("a.annotator < b.annotator")
    return both.select("item", "task", F.col("a.annotator").alias("annotator_a"), F.col("b.annotator").alias("annotator_b"), F.col("a.uid").alias("box_a"), F.col("b.uid").alias("box_b"), iou("a", "b").alias("iou"))


# ---------------------------------------------------------------- assignment


def assign(gain: np.ndarray) -> np.ndarray:
    """The column of each row in an assignment with the largest sum of gains (rows <= columns). Rows are added one by one; each takes the shortest
    augmenting path under the prices of the columns, so the assignment stays optimal."""
    n, m = gain.shape
    cost = gain.max(initial=0.0) - gain
    row_price, column_price = np.zeros(n), np.zeros(m)
    row_of = np.full(m, -1)
    for new in range(n):
        best, before, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        row, column, so_far = new, -1, 0.0
        while True:
            slack = so_far + cost[row] - row_price[row] - column_price
            closer = ~done & (slack < best)
            best[closer], before[closer] = slack[closer], column
            column = int(np.where(done, np.inf, best).argmin())
            so_far = best[column]
            done[column] = True
            if row_of[column] < 0:
                break
            row = row_of[column]
        reached = np.flatnonzero(done & (row_of >= 0))
        row_price[new] += so_far
        row_price[row_of[reached]] += so_far - best[reached]
        column_price[reached] -= so_far - best[reached]
        while column >= 0:  # turn the path round
            up = before[column]
            row_of[column] = new if up < 0 else row_of[up]
            column = up
    out = np.full(n, -1)
    taken = np.flatnonzero(row_of >= 0)
    out[row_of[taken]] = taken
    return out


def _ious(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of each of a with each of b (rows of x0, y0, x1, y1); 0 where both have no area."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    both = np.prod(np.maximum(high - low, 0.0), 2)
    area = lambda x: np.prod(x[:, 2:] - x[:, :2], 1)
    union = area(a)[:, None] + area(b)[None] - both
    return np.divide(both, union, out=np.zeros_like(both), where=union != 0)


def best_match(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in a and in b of the matched boxes and their IoU; pairs that don't overlap are no match."""
    gain = _ious(a, b)
    if len(a) <= len(b):
        left, right = np.arange(len(a)), assign(gain)
    else:
        right, left = np.arange(len(b)), assign(gain.T)
    got = gain[left, right]
    return left[got > 0], right[got > 0], got[got > 0]


MATCH = pa.list_(pa.struct([("box_a", pa.string()), ("box_b", pa.string()), ("iou", pa.float64())]))


def _match_rows(batches):
    for b in batches:
        out, total = [], []
        flat = {}
        for side in ("a", "b"):
            boxes = b.column(side)
            off = boxes.offsets.to_numpy()
            inner = boxes.values
            flat[side] = (off - off[0], np.stack([inner.field(c).to_numpy(zero_copy_only=False) for c in SIDES], 1)[off[0] : off[-1]], inner.field("uid").slice(off[0], off[-1] - off[0]))
        (oa, xa, ua), (ob, xb, ub) = flat["a"], flat["b"]
        for k in range(b.num_rows):
            left, right, got = best_match(xa[oa[k] : oa[k + 1]], xb[ob[k] : ob[k + 1]])
            out.append([{"box_a": ua[int(oa[k] + i)].as_py(), "box_b": ub[int(ob[k] + j)].as_py(), "iou": float(g)} for i, j, g in zip(left, right, got, strict=True)])
            total.append(float(got.sum()))
        kept = [b.column(c) for c in ("item", "task", "annotator_a", "annotator_b", "boxes_a", "boxes_b")]
        fields = [b.schema.field(c) for c in ("item", "task", "annotator_a", "annotator_b", "boxes_a", "boxes_b")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(total, pa.float64()), pa.array(out, MATCH)], schema=pa.schema([*fields, ("total", pa.float64()), ("matches", MATCH)]))


def box_matches(boxes: DataFrame, cfg: Choices = OURS) -> DataFrame:
    """By item, task and pair of annotators (a < b): the numbers of their boxes, the total IoU of the best assignment, its matches and the agreement.
    Pairs of one box each stay within Spark's expressions; the others go through the assignment in Arrow batches."""
    one = _enough(boxes, cfg).groupBy("item", "task", "annotator").agg(F.array_sort(F.collect_list(F.struct(F.col("uid").cast("string").alias("uid"), *[F.col(c).cast("double").alias(c) for c in SIDES]))).alias("boxes"))
    one = scratch.stored(one)  # both sides of the join, and two ways out of it
    side = lambda s: one.select("item", "task", F.col("annotator").alias(f"annotator_{s}"), F.col("boxes").alias(s), F.size("boxes").cast("long").alias(f"boxes_{s}"))
    both = side("a").join(side("b"), ["item", "task"]).filter("annotator_a < annotator_b")
    names = ["item", "task", "annotator_a", "annotator_b", "boxes_a", "boxes_b"]
    single = F.greatest("boxes_a", "boxes_b") == 1
    first = both.filter(single).withColumns({"p": F.get("a", F.lit(0)), "q": F.get("b", F.lit(0))})
    first = first.withColumn("total", F.coalesce(iou("p", "q"), F.lit(0.0)))
    match = F.filter(F.array(F.struct(F.col("p.uid").alias("box_a"), F.col("q.uid").alias("box_b"), F.col("total").alias("iou"))), lambda m: m["iou"] > 0)
    first = first.select(*names, "total", match.alias("matches"))
    kinds = dict(both.dtypes)
    rest = both.filter(~single).mapInArrow(_match_rows, ", ".join(f"{c} {kinds[c]}" for c in names) + ", total double, matches array<struct<box_a:string,box_b:string,iou:double>>")
    return first.union(rest).withColumn("agreement", F.col("total") / F.greatest("boxes_a", "boxes_b"))


# ---------------------------------------------------------------- scores


def _agreement(x: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Agreement of pairs of people; a person's boxes are the rows at[k] to at[k + 1] of x."""
    size = np.diff(at)
    a, b = x[at[left]], x[at[right]]
    w, h = (np.maximum(np.minimum(a[:, k + 2], b[:, k + 2]) - np.maximum(a[:, k], b[:, k]), 0.0) for k in (0, 1))
    area = lambda y: (y[:, 2] - y[:, 0]) * (y[:, 3] - y[:, 1])
    union = area(a) + area(b) - w * h
    got = np.nan_to_num(np.divide(w * h, union, out=np.zeros(len(left)), where=union != 0))
    for k in np.flatnonzero((size[left] > 1) | (size[right] > 1)):
        i, j = left[k], right[k]
        got[k] = best_match(x[at[i] : at[i + 1]], x[at[j] : at[j + 1]])[2].sum() / max(size[i], size[j])
    return got


def _starts(columns: list[pa.Array]) -> np.ndarray:
    """Rows that differ from the one before in some column, the first one included."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= pc.not_equal(c.slice(1), c.slice(0, max(0, len(c) - 1))).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


PAIRS = 500_000  # pairs of people that are compared at a time


def _scored(rows: pa.Table, threshold: float):
    """Scores of whole items out of rows in order of item, task and annotator."""
    column = lambda c: pa.concat_arrays(rows.column(c).chunks)
    item, task, name = column("item"), column("task"), column("annotator")
    x = np.stack([column(c).to_numpy(zero_copy_only=False) for c in SIDES], 1)
    own = _starts([item, task, name])
    at = np.append(own, len(x))
    first = np.searchsorted(own, _starts([item, task]))  # people before each item's
    n = np.diff(np.append(first, len(own)))
    first, n = first[n > 1], n[n > 1]
    pairs = n * (n - 1) // 2
    upto, k, corners = np.cumsum(pairs), 0, {}
    while k < len(n):
        to = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PAIRS, "right")))
        for c in set(n[k:to].tolist()) - corners.keys():
            corners[c] = np.triu_indices(c, 1)
        left, right = (np.concatenate([corners[c][side] + f for c, f in zip(n[k:to].tolist(), first[k:to], strict=True)]) for side in (0, 1))
        got = np.concatenate([_agreement(x, at, left[i : i + PAIRS], right[i : i + PAIRS]) for i in range(0, len(left), PAIRS)])
        edge = np.concatenate([[0], np.cumsum(pairs[k:to])])
        score = np.add.reduceat(got, edge[:-1]) / pairs[k:to]
        agree = np.add.reduceat((got >= threshold).astype(np.int64), edge[:-1])
        of = lambda p: name.take(pa.array(own[p]))
        each = pa.StructArray.from_arrays([of(left), of(right), pa.array(np.floor(got * 10000 + 0.5).astype(np.int64))], ["annotator_a", "annotator_b", "v"])
        row = pa.array(own[first[k:to]])
        yield pa.RecordBatch.from_arrays([item.take(row), task.take(row), pa.array(score), pa.array(pairs[k:to].astype(np.int64)), pa.array(agree), pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), each)], names=["item", "task", "score", "pairs", "agree", "d"])
        k = to


def _score_rows(threshold: float):
    def run(batches):
        held = []  # rows of an item that may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            keys = [pa.concat_arrays([*([held[-1].column(c).slice(held[-1].num_rows - 1)] if held else []), b.column(c)]) for c in ("item", "task")]
            new = _starts(keys)[1:] - 1 if held else _starts(keys)[1:]
            if len(new):
                yield from _scored(pa.Table.from_batches([*held, b.slice(0, new[-1])]), threshold)
                held, b = [], b.slice(new[-1])
            held.append(b)
        if held:
            yield from _scored(pa.Table.from_batches(held), threshold)

    return run


def _pair_scores(boxes: DataFrame, cfg: Choices) -> DataFrame:
    """item, task, score, pairs, agree and the agreements of the pairs, in one shuffle of the boxes: an item's rows stand together in one order, and what a task holds at a time
    is items of a batch. An item's boxes are no more than its list of pairs in the result or the matrix of gains of two people."""
    rows = _enough(boxes, cfg).filter("item is not null and task is not null and annotator is not null")
    rows = rows.select("item", "task", "annotator", "uid", *SIDES).repartition("item", "task")
    rows = rows.sortWithinPartitions("item", "task", "annotator", F.col("uid").cast("string")).select("item", "task", "annotator", *[F.col(c).cast("double").alias(c) for c in SIDES])
    kinds = dict(rows.dtypes)
    person = kinds["annotator"]
    return rows.mapInArrow(_score_rows(cfg.iou_threshold), f"item {kinds['item']}, task {kinds['task']}, score double, pairs long, agree long, d array<struct<annotator_a:{person},annotator_b:{person},v:long>>")


def consensus_scores(boxes: DataFrame, cfg: Choices = OURS, matches: DataFrame | None = None) -> DataFrame:
    """By item and task: mean agreement of the pairs of annotators, annotators, whether enough pairs agree, and details: the agreement of each pair
    `a-b` in ten-thousandths, as JSON text. `matches` takes box_matches that are there already."""
    if matches is None:
        got = _pair_scores(boxes, cfg)
    else:
        each = F.struct("annotator_a", "annotator_b", F.floor(F.col("agreement") * 10000 + 0.5).cast("long").alias("v"))
        got = matches.groupBy("item", "task").agg(F.avg("agreement").alias("score"), F.count("*").alias("pairs"), F.count_if(F.col("agreement") >= cfg.iou_threshold).alias("agree"), F.array_sort(F.collect_list(each)).alias("d"))
    people = (F.lit(1) + F.sqrt(F.lit(1) + 8 * F.col("pairs"))) / 2  # n annotators have n (n - 1) / 2 pairs
    details = F.to_json(F.map_from_entries(F.transform("d", lambda x: F.struct(F.concat_ws("-", x["annotator_a"].cast("string"), x["annotator_b"].cast("string")), x["v"]))))
    return got.select("item", "task", "score", F.round(people).cast("long").alias("annotator_count"), (F.col("agree") / F.col("pairs") >= cfg.min_agreement_ratio).alias("agreed"), details.alias("details"))


def consensus_objects(boxes: DataFrame, cfg: Choices = OURS, matches: DataFrame | None = None) -> DataFrame:
    """By box: item, task, annotator, uid, how many other annotators worked there, how many of them have a matching box at the threshold, and the mean IoU
    over all of them (0 where one has no match)."""
    pairs = box_matches(boxes, cfg) if matches is None else matches
    rows = pairs.select("item", "task", F.explode("matches").alias("m"))
    ends = rows.select("item", "task", F.explode(F.array(F.struct(F.col("m.box_a").alias("uid"), F.col("m.iou").alias("iou")), F.struct(F.col("m.box_b").alias("uid"), F.col("m.iou").alias("iou")))).alias("e"))
    met = ends.groupBy("item", "task", "e.uid").agg(F.sum("e.iou").alias("s"), F.count_if(F.col("e.iou") >= cfg.iou_threshold).alias("n_agree"))
    people = boxes.groupBy("item", "task").agg((F.count_distinct("annotator") - 1).alias("n_others")).filter("n_others > 0")
    own = _enough(boxes, cfg)
    own = own.select("item", "task", "annotator", F.col("uid").cast("string").alias("uid")).join(people, ["item", "task"]).join(met, ["item", "task", "uid"], "left")
    return own.select("item", "task", "annotator", "uid", "n_others", F.coalesce("n_agree", F.lit(0)).cast("long").alias("n_agree"), (F.coalesce("s", F.lit(0.0)) / F.col("n_others")).alias("mean_iou"))


def consensus_summary(scores: DataFrame, cfg: Choices = OURS) -> DataFrame:
    """One row: mean, median, least, most, items, items with consensus, histogram and means by task as JSON text. The scores are stored once, without their details."""
    scores = scratch.stored(scores.select("task", "score", "agreed"))  # three aggregates read it
    n = cfg.histogram_buckets
    edge = lambda k: f"{k / n:.1f}"
    bucket = F.least(F.floor(F.col("score") * n), F.lit(n - 1))
    label = F.element_at(F.array(*[F.lit(f"{edge(k)}-{edge(k + 1)}") for k in range(n)]), (bucket + 1).cast("int"))
    total = scores.agg(F.avg("score").alias("mean_score"), F.median("score").alias("median_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.count("*").alias("total_items"), F.count_if("agreed").alias("items_with_consensus"))
    as_json = lambda rows, k, v: rows.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v))))).alias("j"))
    hist = as_json(scores.groupBy(label.alias("k")).agg(F.count("*").alias("v")), "k", "v").withColumnRenamed("j", "score_distribution")
    tasks = as_json(scores.groupBy(F.col("task").alias("k")).agg(F.format_string("%.4f", F.avg("score")).alias("v")), "k", "v").withColumnRenamed("j", "by_task_name")
    return total.crossJoin(hist).crossJoin(tasks)  # one row each
