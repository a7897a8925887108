"""Batch, task, project and test status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docfleet.plans.ordered import ordered_parts, range_split, split_running_sum

TERMINAL = ("SUCCESS", "FAILURE")


def batch_summary(items: DataFrame) -> DataFrame:
    """items(batch_id, status) -> total, completed, failed."""
    return items.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("completed"),
        F.count_if(F.col("status") == "failure").alias("failed"),
    )


def batch_results(items: DataFrame, **parts) -> DataFrame:
    """items(batch_id, idx, status, error) -> (batch_id, part, results): JSON lines in item order,
    in parts of bounded length."""
    line = F.to_json(F.struct(F.col("idx").alias("index"), "status", "error"))
    return ordered_parts(items, ["batch_id"], "idx", line, "\n", out="results", **parts)


def batch_progress(items: DataFrame, order: Sequence[str] = ("idx",)) -> DataFrame:
    """Percentage done after each item, cut to a whole number: int(position / total * 100).

    The division comes first, in double arithmetic: item 29 of 100 gives 28.
    """
    by = [F.col(c) for c in order]
    split = range_split(items, ["batch_id"], by)
    placed = split_running_sum(split, ["batch_id"], by, F.lit(1).cast("bigint"), "position")
    totals = split.groupBy("batch_id").agg(F.count(F.lit(1)).alias("total"))
    share = F.col("position").cast("double") / F.col("total") * 100
    return (
        placed.join(totals, "batch_id")
        .withColumn("progress", F.floor(share).cast("bigint"))
        .drop("_piece")
    )


def latest_state(events: DataFrame) -> DataFrame:
    """events(task_id, seq, ts, state, progress, ...) -> the newest event of every task."""
    row = F.struct(*[F.col(c) for c in events.columns if c != "task_id"])
    return events.groupBy("task_id").agg(F.max_by(row, F.struct("ts", "seq")).alias("e")).select("task_id", "e.*")


def task_status(ids: DataFrame, events: DataFrame) -> DataFrame:
    """Status of each asked id: unknown ones and those in state PENDING are ``pending``; a result
    only on SUCCESS, an error only on FAILURE, otherwise progress (0 if not reported)."""
    found = ids.join(latest_state(events), "task_id", "left")
    state = F.col("state")
    waiting = state.isNull() | (state == "PENDING")
    return found.select(
        *ids.columns,
        F.when(waiting, "pending").otherwise(state).alias("status"),
        F.when(state == "SUCCESS", F.col("result")).alias("result"),
        F.when(state == "FAILURE", F.col("error")).alias("error"),
        F.when(~waiting & ~state.isin(*TERMINAL), F.coalesce("progress", F.lit(0.0))).alias("progress"),
    )


def effective_status(tasks: DataFrame) -> DataFrame:
    """tasks(state, result_status, has_data) with the real outcome and what a download would say.

    A task reports its failure inside a result, so state SUCCESS may hold a failed conversion.
    """
    done = F.col("state") == "SUCCESS"
    ok = F.col("result_status").eqNullSafe("success")
    return tasks.withColumn(
        "effective",
        F.when(done & ~ok, "failure").when(done, "success").when(F.col("state") == "FAILURE", "failure").otherwise(F.lower("state")),
    ).withColumn(
        "download",
        F.when(~done, "Result not found")
        .when(F.col("result_status").isNull(), "Result is empty")
        .when(~ok, "Conversion failed")
        .when(~F.col("has_data"), "No converted file data")
        .otherwise("ok"),
    )


QUEUE_STATES = {"pending": ("pending",), "running": ("running",), "completed": ("completed",)}
PROJECT_STATES = {
    "completed": ("completed",),
    "failed": ("failed",),
    "in_progress": ("developing", "testing"),
    "waiting_approval": ("waiting_approval",),
}


def state_counts(
    rows: DataFrame, by: Sequence[str] = (), states: Mapping[str, Sequence[str]] = QUEUE_STATES, column: str = "state"
) -> DataFrame:
    """Rows in all and per group of states; states in no group count in the total only."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(column).isin(list(values))).alias(name) for name, values in states.items()],
    )


def project_counts(projects: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return state_counts(projects, by, PROJECT_STATES, "status")


def feature_progress(features: DataFrame) -> DataFrame:
    """features(project_id, passes) -> total, completed, remaining, progress in percent."""
    done = F.coalesce("passes", F.lit(False))
    return (
        features.groupBy("project_id")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(done).alias("completed"))
        .withColumn("remaining", F.col("total") - F.col("completed"))
        .withColumn("progress", F.col("completed") / F.col("total") * 100)
    )


def update_progress(projects: DataFrame, features: DataFrame) -> DataFrame:
    """projects(project_id, progress) with new progress; a project without features keeps its old."""
    new = feature_progress(features).select("project_id", F.col("progress").alias("_new"))
    return (
        projects.join(new, "project_id", "left")
        .withColumn("progress", F.coalesce("_new", "progress"))
        .drop("_new")
    )


def test_summary(results: DataFrame, by: Sequence[str] = ("project_id",)) -> DataFrame:
    """results(by..., passed) -> total, passed, failed, all_passed."""
    ok = F.coalesce("passed", F.lit(False))
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("passed"),
        F.count_if(~ok).alias("failed"),
        F.bool_and(ok).alias("all_passed"),
    )


def test_errors(results: DataFrame, by: Sequence[str] = ("project_id",)) -> DataFrame:
    """The failed results as rows (by..., pos, name, error); order by pos within a group."""
    return results.filter(~F.coalesce("passed", F.lit(False))).select(*by, "pos", "name", "error")


def next_pending(requirements: DataFrame) -> DataFrame:
    """Pending requirement with the highest priority number per project, earliest first."""
    row = F.struct(*[F.col(c) for c in requirements.columns if c != "project_id"])
    return (
        requirements.filter(F.col("status") == "pending")
        .groupBy("project_id")
        .agg(F.min_by(row, F.struct(-F.col("priority"), F.col("seq"))).alias("r"))
        .select("project_id", "r.*")
    )


def next_feature(features: DataFrame) -> DataFrame:
    """Unfinished feature with the lowest priority number per project (5 if none), first in list."""
    row = F.struct(*[F.col(c) for c in features.columns if c != "project_id"])
    return (
        features.filter(~F.coalesce("passes", F.lit(False)))
        .groupBy("project_id")
        .agg(F.min_by(row, F.struct(F.coalesce("priority", F.lit(5)), F.col("pos"))).alias("f"))
        .select("project_id", "f.*")
    )


def stuck_tasks(events: DataFrame, now: Column, soft_seconds: int = 3000, hard_seconds: int = 3600) -> DataFrame:
    """Tasks that started after their last end and have run past the soft or the hard limit."""
    ended = F.max(F.when(F.col("state").isin(*TERMINAL), F.struct("ts", "seq")))
    started = F.max(F.when(F.col("state") == "STARTED", F.struct("ts", "seq")))
    return running_too_long(
        events.groupBy("task_id").agg(started.alias("started"), ended.alias("ended")), now, soft_seconds, hard_seconds
    )


def running_too_long(tasks: DataFrame, now: Column, soft_seconds: int = 3000, hard_seconds: int = 3600) -> DataFrame:
    """tasks(task_id, started, ended), both struct(ts, seq) -> those over a limit."""
    seconds = (F.unix_micros(now) - F.unix_micros("started.ts")) / F.lit(1e6)
    open_ = F.col("started").isNotNull() & (F.col("ended").isNull() | (F.col("started") > F.col("ended")))
    return tasks.filter(open_ & (seconds > soft_seconds)).select(
        "task_id", seconds.alias("seconds"), F.when(seconds > hard_seconds, "hard").otherwise("soft").alias("limit")
    )
