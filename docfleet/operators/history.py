"""Project history: progress, status, versions, references and states as of a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from docfleet.functions import constants as K
from docfleet.plans.ordered import number_rows, range_split, split_last, split_running_sum
from docfleet.plans.runtime import stored

# ---------------------------------------------------------------- references and snapshots


def dangling_references(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Referenced paths that do not exist. References are made distinct first, so a path that is
    referenced everywhere is one row in the join."""
    return refs.select("path").distinct().join(files.select("path").distinct(), "path", "left_anti")


def orphan_files(files: DataFrame, refs: DataFrame) -> DataFrame:
    """Files nothing refers to."""
    return files.select("path").join(refs.select("path").distinct(), "path", "left_anti")


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two snapshots (path, hash), one row per path each -> (path, change) of what differs. A file
    without a hash is there all the same; it is modified where only one of the snapshots has one."""
    old = before.select("path", F.col("hash").alias("old"), F.lit(True).alias("_was"))
    new = after.select("path", F.col("hash").alias("new"), F.lit(True).alias("_is"))
    change = (
        F.when(F.col("_was").isNull(), "added")
        .when(F.col("_is").isNull(), "removed")
        .when(~F.col("old").eqNullSafe(F.col("new")), "modified")
    )
    return old.join(new, "path", "full").select("path", change.alias("change")).filter(F.col("change").isNotNull())


def state_as_of(points: DataFrame, history: DataFrame, values: Sequence[str]) -> DataFrame:
    """points(project_id, at) and history(project_id, ts, seq, values...) -> the points with the
    values of the last entry at or before them (null if there is none).

    Both sides become one ordered stream per project, so the cost is one sort and not a range
    join; the stream is split by range, so one busy project is spread over many tasks.
    """
    value = F.struct(*[F.col(c) for c in values])
    kind = history.select(value.alias("v")).schema["v"].dataType
    entries = history.select("project_id", F.col("ts").alias("at"), F.lit(0).alias("_side"), F.col("seq"), value.alias("_v"))
    asked = points.select(
        "project_id", "at", F.lit(1).alias("_side"), F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast(kind).alias("_v")
    )
    order = [F.col("at"), F.col("_side"), F.col("seq")]
    split = range_split(entries.union(asked), ["project_id"], order)
    filled = split_last(split, ["project_id"], order, F.struct("at", "_side", "seq"), "_v", "_state")
    return filled.filter(F.col("_side") == 1).select("project_id", "at", "_state.*")


def content_versions(snapshots: DataFrame) -> DataFrame:
    """snapshots(path, ts, hash) -> the same with ``version``, which rises when the hash changes."""
    order = [F.col("ts"), F.col("hash")]
    split = range_split(snapshots, ["path"], order)
    before = split_last(split, ["path"], order, F.struct("ts", "hash"), "hash", "_before", before_only=True)
    changed = F.when(F.col("_before").eqNullSafe(F.col("hash")), 0).otherwise(1).cast("bigint")
    return split_running_sum(before, ["path"], order, changed, "version").drop("_before", "_piece")


# ---------------------------------------------------------------- decisions and issues


def effective_decisions(decisions: DataFrame) -> DataFrame:
    """Accepted decisions that no accepted decision supersedes, directly or through a chain.

    What a rejected or proposed decision would supersede stays in force, unless an accepted one stands
    further up the chain. Decisions that supersede each other in a circle replace each other.
    """
    return decisions.filter(F.col("status") == "accepted").join(replaced_decisions(decisions), "decision_id", "left_anti")


def replaced_decisions(decisions: DataFrame) -> DataFrame:
    """(decision_id) of all that stand below an accepted decision in a chain of supersessions.

    Links are doubled in every round, so a chain of any length takes log2 rounds of joins, where a
    recursion would take as many as the chain has links. A round that finds nothing new ends it, on a
    circle too.
    """
    links = decisions.filter(F.col("supersedes").isNotNull()).select(F.col("decision_id").alias("a"), F.col("supersedes").alias("b")).distinct()
    links = stored(links, "links")
    accepted = decisions.filter(F.col("status") == "accepted").select(F.col("decision_id").alias("a"))
    found = stored(links.join(accepted.distinct(), "a").select(F.col("b").alias("decision_id")).distinct(), "replaced")
    size = found.count()
    while size:
        further = found.join(links.withColumnRenamed("a", "decision_id"), "decision_id").select(F.col("b").alias("decision_id"))
        found = stored(found.union(further).distinct(), "replaced")
        before, size = size, found.count()
        if size == before:
            break
        onward = links.select(F.col("a").alias("b"), F.col("b").alias("c"))
        links = stored(links.join(onward, "b").select("a", F.col("c").alias("b")).distinct(), "links")
    return found


def decision_log(decisions: DataFrame, phase: str | None = None, category: str | None = None, pending: bool = False) -> DataFrame:
    """Decisions of a phase and category; ``pending`` are those still proposed."""
    out = decisions
    if phase is not None:
        out = out.filter(F.col("phase") == phase)
    if category is not None:
        out = out.filter(F.col("category") == category)
    return out.filter(F.col("status") == "proposed") if pending else out


def issue_list(issues: DataFrame, status: str | None = None) -> DataFrame:
    return issues if status is None else issues.filter(F.col("status") == status)


def resolve_issues(issues: DataFrame, updates: DataFrame) -> DataFrame:
    """updates(issue_id, resolved_at, resolution) -> issues with these applied; of several for one
    issue the newest counts."""
    newest = updates.groupBy("issue_id").agg(F.max(F.struct("resolved_at", "resolution")).alias("u"))
    new = newest.select(
        "issue_id", F.struct("u.resolved_at", "u.resolution", F.lit("resolved").alias("status")).alias("_new")
    )
    out = issues.join(new, "issue_id", "left")
    for field in ("status", "resolved_at", "resolution"):
        value = F.col(f"_new.{field}")
        out = out.withColumn(field, F.coalesce(value, field) if field in issues.columns else value)
    return out.drop("_new")


def open_issues(issues: DataFrame) -> DataFrame:
    """Unresolved issues, most severe first, then oldest. The order is a total one, so the range
    partitioning of the sort is even although there are four severities only."""
    rank = F.array_position(F.array(*[F.lit(s) for s in K.SEVERITIES]), F.col("severity")).cast("bigint")
    return (
        issues.filter(F.col("status").isin(list(K.UNRESOLVED)))
        .withColumn("rank", rank)
        .orderBy("rank", "created_at", "issue_id")
    )


def assign_ids(
    rows: DataFrame, prefix: str, order: Sequence[Column], keys: Sequence[str] = ("phase",), stored_rows: DataFrame | None = None
) -> DataFrame:
    """Add ``label`` = prefix-phase-number, numbered within each phase from 001, or after the largest
    number among the labels of ``stored_rows`` (keys..., label)."""
    numbered = number_rows(rows, list(keys), order, "_n")
    if stored_rows is not None:
        number = F.substring_index("label", "-", -1).try_cast("bigint")
        last = stored_rows.groupBy(*keys).agg(F.max(number).alias("_last"))
        numbered = numbered.join(last, list(keys), "left").withColumn("_n", F.col("_n") + F.coalesce("_last", F.lit(0))).drop("_last")
    digits = F.when(F.length(F.col("_n").cast("string")) < 3, F.lpad(F.col("_n").cast("string"), 3, "0")).otherwise(
        F.col("_n").cast("string")
    )
    return numbered.withColumn("label", F.concat(F.lit(prefix + "-"), F.col("phase"), F.lit("-"), digits)).drop("_n")


# ---------------------------------------------------------------- history


def recent_history(history: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` entries per project; the limit is applied before the shuffle as well."""
    newest = Window.partitionBy("project_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return history.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)


def append_history(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New entries with ``sequence`` = entries of the project so far + 1, 2, ... in time order."""
    have = existing.groupBy("project_id").agg(F.count(F.lit(1)).alias("_have"))
    numbered = number_rows(new, ["project_id"], [F.col("ts"), F.col("event_id")], "_n")
    return (
        numbered.join(have, "project_id", "left")
        .withColumn("sequence", F.col("_n") + F.coalesce("_have", F.lit(0)))
        .drop("_n", "_have")
    )


def projects_by_activity(history: DataFrame) -> DataFrame:
    """Projects, newest activity first; the first one is the active one."""
    last = history.groupBy("project_id").agg(F.max("ts").alias("last_activity"))
    # one row, so it can be broadcast; of several with the latest time the smallest id, whatever its type
    newest_first = F.struct((-F.unix_micros(F.col("last_activity").cast("timestamp"))).alias("t"), "project_id")
    first = (
        last.filter(F.col("last_activity").isNotNull())
        .agg(F.min_by("project_id", newest_first).alias("project_id"))
        .withColumn("active", F.lit(True))
    )
    return (
        last.join(F.broadcast(first), "project_id", "left")
        .withColumn("active", F.coalesce("active", F.lit(False)))
        .orderBy(F.col("last_activity").desc(), "project_id")
    )


def phase_progress(manifests: DataFrame) -> DataFrame:
    """manifests(project_id, phases array) -> completed and total phases and the percentage."""
    done = F.size(F.filter("phases", lambda p: p["status"] == "completed"))
    total = F.size("phases")
    return manifests.select(
        "project_id",
        done.cast("bigint").alias("completed"),
        total.cast("bigint").alias("total"),
        F.when(total > 0, done / total * 100).otherwise(F.lit(0.0)).alias("progress"),
    )


def set_phase_status(phases: DataFrame, updates: DataFrame) -> DataFrame:
    """phases(project_id, phase, status, completed_at) with updates(project_id, phase, status, at) put onto
    them, and their project's progress: completed_phases, total_phases, progress.

    The newest update of a phase counts. A phase that becomes completed gets the time of that update; any
    other keeps the time it had. Updates of unknown phases have no effect.
    """
    key = ["project_id", "phase"]
    newest = updates.groupBy(*key).agg(F.max_by(F.struct(F.col("status").alias("new"), "at"), F.struct("at", "status")).alias("_u"))
    new = F.col("_u.new")
    out = phases.join(newest, key, "left").select(
        *[F.col(c) for c in phases.columns if c not in ("status", "completed_at")],
        F.coalesce(new, F.col("status")).alias("status"),
        F.when(new == "completed", F.col("_u.at")).otherwise(F.col("completed_at")).alias("completed_at"),
    )
    totals = out.groupBy("project_id").agg(
        F.count_if(F.col("status") == "completed").alias("completed_phases"), F.count(F.lit(1)).alias("total_phases")
    )
    return out.join(totals, "project_id").withColumn("progress", F.col("completed_phases") / F.col("total_phases") * 100)


def current_status(history: DataFrame, issues: DataFrame, decisions: DataFrame, phases: DataFrame) -> DataFrame:
    """One row per project of any input: phase, progress, last activity, open issues, pending
    decisions and the next phase. Every input is aggregated to a row per project before the joins."""
    last = history.groupBy("project_id").agg(
        F.max("ts").alias("last_activity"), F.max_by("phase", F.struct("ts", "event_id")).alias("phase")
    )
    unresolved = issues.groupBy("project_id").agg(
        F.count_if(F.col("status").isin(list(K.UNRESOLVED))).alias("open_issues")
    )
    pending = decisions.groupBy("project_id").agg(F.count_if(F.col("status") == "proposed").alias("pending_decisions"))
    done = F.count_if(F.col("status") == "completed")
    total = F.count(F.lit(1))
    by_phase = phases.groupBy("project_id").agg(
        (done / total * 100).alias("progress"),
        F.when(done == total, "completed").when(done == 0, "initialized").otherwise("in-progress").alias("status"),
        F.min(F.when(F.col("status") == "pending", F.col("phase"))).alias("next_milestone"),
    )
    out = reduce(lambda a, b: a.join(b, "project_id", "full"), (last, unresolved, pending, by_phase))
    return out.fillna(0, ["open_issues", "pending_decisions"])


def phase_history(history: DataFrame) -> DataFrame:
    """Per project and phase: start, end, hours, and how many different artifacts and decisions.

    The sets themselves are rows: see :func:`phase_items`.
    """
    key = ["project_id", "phase"]
    span = history.groupBy(*key).agg(F.min("ts").alias("started"), F.max("ts").alias("completed"))
    items = phase_items(history)
    counts = items.groupBy(*key).agg(
        F.count_if(F.col("kind") == "artifact").alias("artifacts"),
        F.count_if(F.col("kind") == "decision").alias("decisions"),
    )
    hours = (F.unix_micros("completed") - F.unix_micros("started")) / F.lit(3.6e9)
    return span.withColumn("duration_hours", hours).join(counts, key, "left").fillna(0, ["artifacts", "decisions"])


def phase_items(history: DataFrame) -> DataFrame:
    """Distinct (project_id, phase, kind, item) artifacts and decisions of every phase."""
    both = F.array(
        F.struct(F.lit("artifact").alias("kind"), F.col("artifact").alias("item")),
        F.struct(F.lit("decision").alias("kind"), F.col("decision_id").cast("string").alias("item")),
    )
    return (
        history.select("project_id", "phase", F.explode(both).alias("x"))
        .select("project_id", "phase", "x.*")
        .filter(F.col("item").isNotNull())
        .distinct()
    )


def metric_totals(reports: DataFrame, key: str = "project_id") -> DataFrame:
    """reports(key, metrics struct, quality struct) -> sums of the metrics, and of the checks
    whether all hold."""
    return reports.groupBy(key).agg(
        *[F.sum(F.col(f"metrics.{m}")).alias(m) for m in K.PHASE_METRICS],
        *[F.bool_and(F.col(f"quality.{c}")).alias(c) for c in K.PHASE_CHECKS],
    )


def context_hash(entries: DataFrame, digests: DataFrame) -> DataFrame:
    """entries(entry_id, files_affected array) -> (entry_id, context_hash, without_hash), one row per
    entry: SHA-256 over the sorted hashes of the entry's files (of the empty text if none has one), and
    its files that have no hash.
    A file referenced by very many entries is a skewed key of a plain join, which adaptive execution splits. The lists are as long
    as the entry's own array."""
    wanted = entries.select("entry_id", F.explode_outer(F.array_distinct("files_affected")).alias("path"))
    found = wanted.join(digests.select("path", "hash"), "path", "left")
    return found.groupBy("entry_id").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list("hash")), ""), 256).alias("context_hash"),
        F.sort_array(F.collect_set(F.when(F.col("hash").isNull(), F.col("path")))).alias("without_hash"),
    )


def rebuild_manifest(history: DataFrame) -> DataFrame:
    """Current phase and status of every project from its history alone."""
    at = F.struct("ts", "event_id")
    return history.groupBy("project_id").agg(
        F.min("ts").alias("created_at"),
        F.max("ts").alias("last_updated"),
        F.max_by("phase", at).alias("current_phase"),
        F.max_by("type", at).alias("last_type"),
        F.count(F.lit(1)).alias("entries"),
    )


def artifact_index(history: DataFrame) -> DataFrame:
    """history with files_affected arrays -> per file: first and last entry, entries, and the
    phases that touched it (their number is bounded by the phase catalogue)."""
    touched = history.select("event_id", "ts", "phase", F.explode(F.array_distinct("files_affected")).alias("path"))
    per_phase = touched.groupBy("path", "phase").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("entries")
    )
    return per_phase.groupBy("path").agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.sum("entries").alias("entries"),
        F.sort_array(F.collect_list("phase")).alias("phases"),
    )


def handoff_history(handoffs: DataFrame) -> DataFrame:
    return handoffs.orderBy("project_id", "ts", "event_id")


def latest_handoff(handoffs: DataFrame, from_phase: str | None = None) -> DataFrame:
    """Newest handoff per project, from any phase or from one."""
    chosen = handoffs if from_phase is None else handoffs.filter(F.col("from_phase") == from_phase)
    row = F.struct(*[F.col(c) for c in handoffs.columns if c != "project_id"])
    return (
        chosen.groupBy("project_id").agg(F.max_by(row, F.struct("ts", "event_id")).alias("h")).select("project_id", "h.*")
    )
