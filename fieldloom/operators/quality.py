"""Quality targets, issues, dataset health, jobs. Arithmetic that the service keeps to itself is a choice of ours, stated here and
collected in Choices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .consensus import annotator_pairs, consensus_scores, consensus_summary, iou  # noqa: F401  also by their earlier place


@dataclass(frozen=True)
class Choices:
    customer: str = "customer"
    created: str = "created"


OURS = Choices()


def breached(value: Column, op: Column, threshold: Column) -> Column:
    """Not (value op threshold); null for a null value or an unknown operator."""
    holds = F.when(op == "gt", value > threshold).when(op == "gte", value >= threshold).when(op == "lt", value < threshold).when(op == "lte", value <= threshold)
    return ~holds


def quality_evaluate(targets: DataFrame, metrics: DataFrame) -> DataFrame:
    """Active targets against current metrics (metric, current_value); a null metric is not evaluated."""
    got = targets.filter("is_active").join(metrics, "metric", "left")
    return got.select("uid", "metric", "operator", "threshold", "current_value", breached(F.col("current_value"), F.col("operator"), F.col("threshold")).alias("is_breached"), "severity")


def quality_history(evals: DataFrame) -> DataFrame:
    """Evaluations (uid, ts, tie, current_value, is_breached) folded by target."""
    last = lambda c: F.max_by(c, F.struct("ts", "tie"))
    return evals.filter("is_breached is not null").groupBy("uid").agg(last("current_value").alias("last_value"), F.max("ts").alias("last_evaluated_at"), last("is_breached").alias("is_breached"), F.count_if("is_breached").alias("breach_count"), F.max(F.when(F.col("is_breached"), F.col("ts"))).alias("last_breached_at"))


def issue_enrich(issues: DataFrame, tools: DataFrame, projects: DataFrame | None = None) -> DataFrame:
    """Issues with the names of their tool, problem and project, each null on its own; tools have `problems`, an array of (uid, title), projects uid and name.
    Without projects there is no project_name."""
    named = tools.select(F.col("uid").alias("tool_uid"), F.col("name").alias("tool_name"), "dataset_type")
    listed = tools.select(F.col("uid").alias("tool_uid"), F.explode("problems").alias("p")).select("tool_uid", F.col("p.uid").alias("problem_uid"), F.col("p.title").alias("problem_title"))
    got = issues.join(named, "tool_uid", "left").join(listed, ["tool_uid", "problem_uid"], "left")
    return got if projects is None else got.join(projects.select(F.col("uid").alias("project_uid"), F.col("name").alias("project_name")), "project_uid", "left")


def issue_metrics(issues: DataFrame, as_of: Column, sequence_uid=None, cfg: Choices = OURS) -> DataFrame:
    """One row: counts by status, priority and severity (JSON), mean seconds to close and mean age of open issues (all and customers'), objects by problem.
    One pass over the issues: grouping sets count values within tasks, and what is left of each value is folded by name. A null value counts as `null`."""
    if sequence_uid is not None:
        issues = issues.filter(F.col("sequence_uid") == sequence_uid)
    customer = F.col("reporter_type") == cfg.customer
    took = F.when(F.col("closed_at").isNotNull(), F.unix_seconds("closed_at") - F.unix_seconds("created_at"))
    age = F.when(F.col("closed_at").isNull(), F.unix_seconds(as_of) - F.unix_seconds("created_at"))
    counted = ["status", "priority", "severity", "problem_uid"]
    means = {"mean_seconds_close_time_all": took, "mean_seconds_close_time_customer": F.when(customer, took), "mean_unresolved_issue_age_all": age, "mean_unresolved_issue_age_customer": F.when(customer, age)}
    rows = issues.select(*[F.col(c).cast("string").alias(c) for c in counted], F.col("object_uid").alias("o"), *[x.alias(f"t{i}") for i, x in enumerate(means.values())])
    sets = [["status"], ["priority"], ["severity"], ["problem_uid", "o"], []]
    got = rows.groupingSets(sets, *counted, "o").agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"), *[F.avg(f"t{i}").cast("long").alias(f"t{i}") for i in range(len(means))])
    # bits of g from the left: status, priority, severity, problem_uid, o; 1 where the column is not in the set
    kind = F.when(F.col("g") == 0b01111, "status_count").when(F.col("g") == 0b10111, "priority_count").when(F.col("g") == 0b11011, "severity_count").when(F.col("g") == 0b11100, "object_count_by_problem")
    value = F.when(F.col("g") == 0b11100, F.col("o").isNotNull().cast("long")).otherwise(F.col("n"))
    whole = F.col("g") == 0b11111
    folded = got.groupBy(kind.alias("kind"), F.when(~whole, F.coalesce(*counted, F.lit("null"))).alias("k")).agg(F.sum(value).alias("v"), *[F.max(F.when(whole, F.col(f"t{i}"))).alias(f"t{i}") for i in range(len(means))])
    text = lambda name: F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == name, F.struct("k", "v")))))).alias(name)
    return folded.agg(*[F.max(f"t{i}").alias(c) for i, c in enumerate(means)], *[text(c) for c in ("status_count", "priority_count", "severity_count", "object_count_by_problem")])


def dataset_sequences(sequences: DataFrame) -> DataFrame:
    """The sequences of the datasets' health: frame count and calibration flags (null counts as none). A row each, as a dataset may have any number of them."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    return sequences.select(F.col("dataset_uid").alias("dataset"), "uid", "key", "status", F.greatest(F.coalesce(F.size("frames"), F.lit(0)), F.lit(0)).cast("long").alias("frame_count"), flag("lidar_calibration_enabled").alias("has_lidar_calibration"), flag("camera_calibration_enabled").alias("has_camera_calibration"))


def dataset_health(datasets: DataFrame, items: DataFrame, sequences: DataFrame, cfg: Choices = OURS) -> DataFrame:
    """By dataset: items, sequences, frames, latest update, issues, ingest_ok. Sequences have dataset, status, declared and actual frames, updated_at."""
    n_items = items.groupBy("dataset").agg(F.count("*").alias("item_count"))
    seq = sequences.groupBy("dataset").agg(F.count("*").alias("sequence_count"), F.sum("actual").alias("total_frames"), F.max("updated_at").alias("last_updated_at"), F.count_if(F.col("declared") != F.col("actual")).alias("wrong"), F.count_if(F.col("actual") == 0).alias("empty"))
    got = datasets.join(n_items, "dataset", "left").join(seq, "dataset", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    issues = F.array_compact(F.array(F.when(~F.col("status").eqNullSafe(F.lit(cfg.created)), F.concat(F.lit("status "), F.col("status"))), F.when(zero("wrong") > 0, F.concat(zero("wrong").cast("string"), F.lit(" sequences with a wrong frame count"))), F.when(zero("empty") > 0, F.concat(zero("empty").cast("string"), F.lit(" empty sequences")))))
    return got.select("dataset", zero("item_count").alias("item_count"), zero("sequence_count").alias("sequence_count"), zero("total_frames").alias("total_frames"), "last_updated_at", F.array_join(issues, "; ").alias("issues"), (F.size(issues) == 0).alias("ingest_ok"))


def autolabel_progress(job_items: DataFrame) -> DataFrame:
    """By job: total, processed, successful, failed, skipped, percent processed."""
    got = job_items.groupBy("job").agg(F.count("*").alias("total_items"), *[F.count_if(F.col("status") == s).alias(f"{s}_items") for s in ("successful", "failed", "skipped")])
    done = F.col("successful_items") + F.col("failed_items") + F.col("skipped_items")
    return got.select("job", "total_items", done.alias("processed_items"), "successful_items", "failed_items", "skipped_items", F.try_divide(F.lit(100.0) * done, F.col("total_items")).alias("progress_pct"))


def detections_filter(preds: DataFrame, threshold: float, labels: list[str]) -> DataFrame:
    """Predictions at or above the threshold with one of the labels (an empty list takes all)."""
    got = preds.filter(F.col("confidence") >= threshold)
    return got.filter(F.col("label").isin(labels)) if labels else got


def execution_stats(executions: DataFrame) -> DataFrame:
    """By agent: executions in all and by status, as JSON text."""
    by = executions.groupBy("agent", "status").agg(F.count("*").alias("n"))
    got = by.groupBy("agent").agg(F.sum("n").alias("total"), F.collect_list(F.struct(F.col("status").alias("k"), F.col("n").alias("v"))).alias("s"))
    entries = F.array_sort(F.concat("s", F.array(F.struct(F.lit("total").alias("k"), F.col("total").alias("v")))))
    return got.select("agent", F.to_json(F.map_from_entries(entries)).alias("stats"))
