"""Duplicate, temporary, empty and stale files; the clean-up plan; health and phase checks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docfleet.functions import constants as K
from docfleet.functions.scalars import age_hours, archive_path, base_name, strip, valid_artifact_name
from docfleet.plans.runtime import stored

PLACEHOLDERS = ("todo", "tbd", "tba", "n/a", "placeholder", "coming soon", "to be written", "待补充")


# ---------------------------------------------------------------- exact duplicates


def file_digests(files: DataFrame) -> DataFrame:
    """SHA-256 of every non-empty file: path, size, mtime, hash.

    Stored once, because contents are the bulk of the data: they are hashed where they are read
    and never shuffled, and everything after works on this narrow table.
    """
    hashed = files.filter(F.col("size") > 0).select("path", "size", "mtime", F.sha2(F.col("content"), 256).alias("hash"))
    return stored(hashed, "digests")


def _copies(digests: DataFrame) -> DataFrame:
    newest_first = F.struct(-F.unix_micros(F.col("mtime").cast("timestamp")), F.col("path"))
    groups = (
        digests.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min_by("path", newest_first).alias("keeper"))
        .filter(F.col("copies") > 1)
    )
    return digests.join(groups, "hash")


def duplicate_groups(digests: DataFrame) -> DataFrame:
    """(hash, path, copies) for every path whose content occurs more than once."""
    return _copies(digests).select("hash", "path", "copies")


def duplicate_keeper(digests: DataFrame) -> DataFrame:
    """(hash, path, keeper, kept): the newest copy stays, of equally new ones the first path."""
    return _copies(digests).select("hash", "path", "keeper", (F.col("path") == F.col("keeper")).alias("kept"))


# ---------------------------------------------------------------- temporary and empty files


def temp_pattern(path: Column, suffixes: Sequence[str] = K.TEMP_SUFFIXES) -> Column:
    """The first temporary-file pattern a path matches, else null."""
    out = F.lit(None).cast("string")
    for suffix in reversed(suffixes):
        out = F.when(F.endswith(path, F.lit(suffix)), "*" + suffix).otherwise(out)
    return out


def temp_listing(files: DataFrame, now: Column) -> DataFrame:
    """Every temporary file with its age."""
    return files.filter(temp_pattern(F.col("path")).isNotNull()).select(
        "path", "mtime", age_hours(F.col("mtime"), now).alias("age_hours")
    )


def expired_temp(
    files: DataFrame, now: Column, keep: int = K.KEEP_RECENT_TEMP, max_age_hours: float = K.TEMP_MAX_AGE_HOURS, by: Sequence[str] = ()
) -> DataFrame:
    """Temporary files to delete: older than the limit and not among the newest of their pattern (of
    each group ``by``).

    The newest few per pattern are found with a row-number limit, which every task applies
    before the shuffle. Without ``by`` there are at most patterns x keep of them, so they are broadcast.
    """
    temp = files.select(*by, "path", "mtime", temp_pattern(F.col("path")).alias("pattern")).filter(
        F.col("pattern").isNotNull()
    )
    newest = Window.partitionBy(*by, "pattern").orderBy(F.col("mtime").desc(), "path")
    kept = temp.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= keep).select(*by, "path")
    old = temp.filter(age_hours(F.col("mtime"), now) > max_age_hours)
    return old.join(kept if by else F.broadcast(kept), [*by, "path"], "left_anti").select(*by, "pattern", "path", "mtime")


def zero_size(files: DataFrame) -> DataFrame:
    return files.filter((F.col("size") == 0) & (base_name(F.col("path")) != K.EMPTY_FILE_EXEMPT)).select("path")


def placeholders(files: DataFrame, texts: Sequence[str] = PLACEHOLDERS) -> DataFrame:
    """Files whose whole content is a placeholder, ignoring case, spacing and marks around it."""
    return files.filter(is_placeholder(F.col("content"), texts)).select("path")


def is_placeholder(content: Column, texts: Sequence[str] = PLACEHOLDERS) -> Column:
    """The pattern is anchored, so a real text is given up at its first letters."""
    marks = F.lit(K.BLANK_CHARS + "-#*<>[]().:!…")
    words = "|".join(re.escape(t).replace("\\ ", f"[{K.BLANKS}]+") for t in texts)
    return F.btrim(F.lower(content), marks).rlike(rf"^(?:{words})\z")


def large_logs(files: DataFrame, min_bytes: int = K.LARGE_LOG_BYTES, suffixes: Sequence[str] = (".log",)) -> DataFrame:
    named = F.lit(False)
    for suffix in suffixes:
        named = named | F.endswith("path", F.lit(suffix))
    return files.filter(named & (F.col("size") > min_bytes)).select("path", "size")


def expired_results(results: DataFrame, now: Column, ttl_hours: int = K.RESULT_TTL_HOURS) -> DataFrame:
    """Results older than the limit; what stays is the opposite filter."""
    return results.filter(age_hours(F.col("created_at"), now) > ttl_hours)


def live_results(results: DataFrame, now: Column, ttl_hours: int = K.RESULT_TTL_HOURS) -> DataFrame:
    return results.filter(~(age_hours(F.col("created_at"), now) > ttl_hours))


# ---------------------------------------------------------------- plan and report


def action_plan(files: DataFrame, digests: DataFrame, now: Column, apply: bool = False, root: str = "99-archive") -> DataFrame:
    """(action, file, moved_to, kept, status): what a clean-up would do, from one snapshot.

    This is a plan only; nothing is moved. ``apply`` marks the rows as wanted.
    """
    none = F.lit(None).cast("string")
    temp = expired_temp(files, now).select(
        F.lit("delete_temp").alias("action"), F.col("path").alias("file"), none.alias("moved_to"), none.alias("kept")
    )
    zero = zero_size(files).select(
        F.lit("move_zero"), "path", archive_path(F.col("path"), "tombstones", root), none
    )
    dup = duplicate_keeper(digests).filter(~F.col("kept")).select(
        F.lit("move_dup"), "path", archive_path(F.col("path"), "duplicates", root), "keeper"
    )
    return temp.union(zero).union(dup).withColumn("status", F.lit("wanted" if apply else "dry-run"))


def scan_summary(files: DataFrame, digests: DataFrame, apply: bool = False) -> DataFrame:
    """One row of counts. The inputs are aggregated apart and added up."""
    counted = files.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(temp_pattern(F.col("path")).isNotNull()).alias("temp_count"),
        F.count_if((F.col("size") == 0) & (base_name(F.col("path")) != K.EMPTY_FILE_EXEMPT)).alias("zero_count"),
        F.lit(0).cast("bigint").alias("duplicate_groups"),
        F.lit(0).cast("bigint").alias("duplicate_files"),
    )
    groups = digests.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    none = F.lit(0).cast("bigint")
    dups = groups.agg(none.alias("scanned"), none.alias("temp_count"), none.alias("zero_count"), F.count(F.lit(1)), F.coalesce(F.sum("n"), none))
    return (
        counted.union(dups)
        .agg(*[F.sum(c).alias(c) for c in counted.columns])
        .withColumn("apply_mode", F.lit(apply))
    )


def scan_report(files: DataFrame, now: Column, apply: bool = False, root: str = "99-archive") -> DataFrame:
    """The whole report as rows (section, path, detail); ``detail`` is JSON.

    Long lists are rows, never arrays, so the report of any number of files stays distributed.
    """
    digests = file_digests(files)
    row = lambda section, path, *fields: [
        F.lit(section).alias("section"),
        path.alias("path"),
        F.to_json(F.struct(*fields)).alias("detail"),
    ]
    none = F.lit(None).cast("string")
    summary = scan_summary(files, digests, apply)
    plan = action_plan(files, digests, now, apply, root)
    sections = [
        summary.select(*row("summary", none, *summary.columns)),
        temp_listing(files, now).select(*row("temp_file", F.col("path"), "mtime", "age_hours")),
        zero_size(files).select(F.lit("zero_size"), "path", none),
        duplicate_groups(digests).select(*row("duplicate", F.col("path"), "hash", "copies")),
        plan.select(*row("action", F.col("file"), "action", "moved_to", "kept", "status")),
    ]
    report = sections[0]
    for section in sections[1:]:
        report = report.union(section)
    return report


# ---------------------------------------------------------------- health


HEALTH_CHECKS = (
    "state_parses", "references_exist", "no_orphans", "no_empty_files", "no_placeholders", "temp_cleaned", "names_valid", "decisions_recorded",
)


def health_checks(
    state_docs: DataFrame, refs: DataFrame, files: DataFrame, decisions: DataFrame, phases: DataFrame, now: Column, by: str = "project_id"
) -> DataFrame:
    """One row per project and check, and one per check over all projects (``scope`` total): violations and
    whether the check passed.

    state_docs(by, broken), refs(by, path), files(by, path, size, mtime, content), decisions(by, phase) and
    phases(by, phase) are looked at each on its own; a project is whatever any of them names. Each
    violation becomes a narrow row, these are counted per project and check, and one pass of grouping
    sets gives the projects and the total, which is the sum of the projects.
    """
    pair = [by, "path"]
    paths, wanted = files.select(*pair).distinct(), refs.select(*pair).distinct()
    needed = phases.select(by, "phase").distinct()
    found = {
        "state_parses": state_docs.filter("broken"),
        "references_exist": wanted.join(paths, pair, "left_anti"),
        "no_orphans": paths.join(wanted, pair, "left_anti"),
        "no_empty_files": files.filter((F.col("size") == 0) & (base_name(F.col("path")) != K.EMPTY_FILE_EXEMPT)),
        "no_placeholders": files.filter(is_placeholder(F.col("content"))),
        "temp_cleaned": expired_temp(files, now, by=[by]),
        "names_valid": files.filter(~valid_artifact_name(base_name(F.col("path")))),
        "decisions_recorded": needed.join(decisions.select(by, "phase").distinct(), [by, "phase"], "left_anti"),
    }
    violations, projects = None, None
    for check, rows in found.items():
        one = rows.select(by, F.lit(check).alias("check"))
        violations = one if violations is None else violations.union(one)
    for table in (state_docs, refs, files, decisions, phases):
        own = table.select(by).distinct()
        projects = own if projects is None else projects.union(own)
    zero = projects.distinct().select(by, F.explode(F.array(*map(F.lit, HEALTH_CHECKS))).alias("check"), F.lit(0).cast("bigint").alias("n"))
    counted = violations.groupBy(by, "check").agg(F.count(F.lit(1)).alias("n")).union(zero)
    return (
        counted.groupingSets([[F.col(by), F.col("check")], [F.col("check")]], F.col(by), F.col("check"))
        .agg(F.sum("n").alias("violations"), F.when(F.grouping(by) == 1, "total").otherwise("project").alias("scope"))
        .select("scope", by, "check", "violations", (F.col("violations") == 0).alias("passed"))
    )


def health_report(checks: DataFrame, by: str = "project_id") -> DataFrame:
    """From :func:`health_checks`, per project and for the total: violations, failed checks, score and band."""
    summed = checks.groupBy("scope", by).agg(F.sum("violations").alias("violations"), F.count_if(~F.col("passed")).alias("failed_checks"))
    scored = summed.withColumn("score", health_score(F.col("violations")))
    return scored.withColumn("band", health_band(F.col("score")))


def health_score(violations: Column) -> Column:
    return F.greatest(F.lit(0), F.lit(100) - violations * 5)


def health_band(score: Column) -> Column:
    return (
        F.when(score >= 90, "excellent").when(score >= 70, "good").when(score >= 50, "fair").otherwise("poor")
    )


def archive_completed(phases: DataFrame, root: str = "99-archive") -> DataFrame:
    """Completed phases and the folder each is archived to."""
    return phases.filter(F.col("status") == "completed").select(
        "project_id",
        "phase",
        F.concat(F.lit(f"{root}/"), F.col("project_id").cast("string"), F.lit("/"), F.col("phase")).alias("target"),
    )


REQUIRED_HANDOFF_FIELDS = (
    "from_phase",
    "to_phase",
    "executive_summary",
    "key_deliverables",
    "critical_decisions",
    "constraints_next_phase",
)


def handoff_gaps(handoffs: DataFrame) -> DataFrame:
    """Per handoff an array of what is wrong with it.

    Text fields and arrays must be filled, the summary may have two sentences at most, and every
    open issue (struct issue, suggested_action) needs a suggested action.
    """
    types = dict(handoffs.dtypes)
    gaps = []
    for field in REQUIRED_HANDOFF_FIELDS:
        value = F.col(field)
        empty = F.size(value) <= 0 if types[field].startswith("array") else strip(value) == ""
        gaps.append(F.when(value.isNull() | empty, f"missing {field}"))
    gaps.append(
        F.when(F.regexp_count("executive_summary", F.lit(r"[.!?。！？]+")) > 2, "executive_summary longer than two sentences")
    )
    no_action = lambda i: F.coalesce(strip(i["suggested_action"]) == "", F.lit(True))
    gaps.append(
        F.when(F.exists(F.coalesce("open_issues", F.array().cast(types["open_issues"])), no_action), "open issue without suggested action")
    )
    return handoffs.withColumn("gaps", F.array_compact(F.array(*gaps)))


def phase_gate(
    phases: DataFrame,
    artifacts: DataFrame,
    issues: DataFrame,
    decisions: DataFrame,
    required: Sequence[str] = ("handoff-out.json", "report.json"),
) -> DataFrame:
    """phases(project_id, phase) with ``gaps`` and ``may_complete``.

    Every input is first brought down to one row per phase. A phase may complete when it has each
    required output, valid artifact names only, no temporary file, a recorded decision, and no
    unresolved critical issue.
    """
    key = ["project_id", "phase"]
    name = base_name(F.col("path"))
    is_required = F.lit(False)
    for r in required:
        is_required = is_required | F.endswith(name, F.lit(r))
    is_temp = temp_pattern(F.col("path")).isNotNull()
    per_phase = artifacts.groupBy(*key).agg(
        *[F.max(F.endswith(name, F.lit(r))).alias(f"_has{i}") for i, r in enumerate(required)],
        F.count_if(~is_required & ~is_temp & ~valid_artifact_name(name)).alias("_badly_named"),
        F.count_if(is_temp).alias("_temp"),
    )
    decided = decisions.groupBy(*key).agg(F.count(F.lit(1)).alias("_decisions"))
    critical = (
        issues.filter((F.col("severity") == "critical") & F.col("status").isin(list(K.UNRESOLVED)))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_critical"))
    )
    joined = (
        phases.select(*key)
        .distinct()
        .join(per_phase, key, "left")
        .join(decided, key, "left")
        .join(critical, key, "left")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    gaps = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(F.col(f"_has{i}"), F.lit(False)), f"missing {r}")
                for i, r in enumerate(required)
            ],
            F.when(zero("_badly_named") > 0, "invalid artifact names"),
            F.when(zero("_temp") > 0, "temporary files left"),
            F.when(zero("_decisions") == 0, "no decision recorded"),
            F.when(zero("_critical") > 0, "critical issue unresolved"),
        )
    )
    return joined.select(*key, gaps.alias("gaps")).withColumn("may_complete", F.size("gaps") == 0)
