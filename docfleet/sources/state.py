"""Requirement files and project-state JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from docfleet.functions.scalars import base_name

DEFAULT_NAME = "Unnamed Project"

def _record(*fields, **typed) -> T.StructType:
    """A struct of string fields, and of typed ones whose names have hyphens for underscores."""
    out = [T.StructField(name, T.StringType()) for name in fields]
    return T.StructType(out + [T.StructField(name.replace("_", "-"), kind) for name, kind in typed.items()])


_TEXTS, _COUNT, _FLAG = T.ArrayType(T.StringType()), T.LongType(), T.BooleanType()

PHASE = _record("id", "name", "display-name", "status", "description", "completed-at")
MANIFEST = _record(
    "project-id", "name", "description", "status", "current-phase", "created-at", "last-updated", "priority",
    phases=T.ArrayType(PHASE), tags=_TEXTS, assigned_agents=_TEXTS,
    total_phases=_COUNT, completed_phases=_COUNT, progress_percentage=T.DoubleType(),
    key_metrics=_record(files_created=_COUNT, files_modified=_COUNT, decisions_recorded=_COUNT, issues_resolved=_COUNT, issues_open=_COUNT),
    configuration=_record("backup-interval", "health-check-interval", auto_cleanup=_FLAG),
)
DECISION = _record(
    "id", "timestamp", "phase", "category", "title", "description", "context", "status", "supersedes",
    related=_TEXTS, options=_TEXTS, consequences=_record(positive=_TEXTS, negative=_TEXTS),
)
DECISION_LOG = _record("project-id", decisions=T.ArrayType(DECISION))
ISSUE = _record("id", "created-at", "resolved-at", "phase", "severity", "category", "title", "description", "status", "resolution", related=_TEXTS)
ISSUE_TRACKER = _record("project-id", issues=T.ArrayType(ISSUE))
HANDOFF = _record(
    "from-phase", "to-phase", "timestamp", "executive-summary", "estimated-effort-next-phase", "confidence-level", "agent-notes",
    key_deliverables=_TEXTS, critical_decisions=_TEXTS, constraints_next_phase=_TEXTS, reference_materials=_TEXTS,
    open_issues=T.ArrayType(_record("issue", "suggested-action")),
)
PHASE_REPORT = _record(
    "phase-id", "phase-name", "display-name", "status", "started-at", "completed-at", "agent", "summary",
    duration_hours=T.DoubleType(),
    artifacts=T.ArrayType(_record("path", "type", "description")),
    decisions=T.ArrayType(_record("id", "description", "rationale", alternatives_considered=_TEXTS)),
    issues_encountered=T.ArrayType(_record("id", "severity", "description", "resolution")),
    metrics=_record(
        files_created=_COUNT, files_modified=_COUNT, lines_of_documentation=_COUNT, lines_of_code=_COUNT, tests_written=_COUNT,
        tests_passing=_COUNT, decisions_made=_COUNT, issues_resolved=_COUNT, issues_discovered=_COUNT,
    ),
    quality_checks=_record(documentation_complete=_FLAG, code_reviewed=_FLAG, tests_passing=_FLAG, standards_followed=_FLAG),
    next_phase_recommendations=_TEXTS,
)
HISTORY_ENTRY = T.StructType(
    [
        T.StructField("sequence", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("agent", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("files-affected", T.ArrayType(T.StringType())),
        T.StructField("context-hash", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("decisions", T.ArrayType(T.StringType())),
    ]
)
HISTORY = T.StructType(
    [
        T.StructField("project-id", T.StringType()),
        T.StructField("entries", T.ArrayType(HISTORY_ENTRY)),
    ]
)


#: Kind of state file -> its schema.
STATE_SCHEMAS = {
    "manifest": MANIFEST, "history": HISTORY, "decisions": DECISION_LOG, "issues": ISSUE_TRACKER, "handoff": HANDOFF, "phase-report": PHASE_REPORT,
}


def read_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Whole text files under a folder: path, content."""
    return (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    )


def read_requirements(texts: DataFrame) -> DataFrame:
    """texts(path, content) -> (path, pos, name, description, priority).

    The content is a JSON list, one JSON object, or plain text (also a bare JSON scalar), which
    becomes one requirement named after the file. A missing name gets the default, a missing
    description the name, and a priority that is no whole number 1; fractions are cut off only
    when they come as JSON numbers.
    """
    parsed = texts.withColumn("_v", F.try_parse_json("content")).withColumn(
        "_kind", F.substring(F.schema_of_variant("_v"), 1, 5)
    )
    is_json = F.coalesce(F.col("_kind").isin("ARRAY", "OBJEC"), F.lit(False))
    items = (
        parsed.filter(is_json)
        .withColumn(
            "_items",
            F.when(F.col("_kind") == "ARRAY", F.col("_v")).otherwise(
                F.try_parse_json(F.concat(F.lit("["), F.col("content"), F.lit("]")))
            ),
        )
        .select("path", F.posexplode(F.col("_items").cast("array<variant>")).alias("pos", "r"))
    )
    field = lambda name, kind: F.try_variant_get("r", f"$.{name}", kind)
    present = lambda name: F.try_variant_get("r", f"$.{name}", "variant").isNotNull()
    name = F.when(present("name"), field("name", "string"))
    kind = F.schema_of_variant(F.try_variant_get("r", "$.priority", "variant"))
    text = field("priority", "string")
    number = (
        F.when(kind == "STRING", F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*\z"), F.trim(text).try_cast("bigint")))
        .when(kind == "BOOLEAN", field("priority", "boolean").cast("bigint"))
        .when(kind.isin("BIGINT", "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), field("priority", "double").cast("bigint"))
    )
    from_json = items.select(
        "path",
        F.col("pos").cast("bigint").alias("pos"),
        F.when(present("name"), name).otherwise(DEFAULT_NAME).alias("name"),
        F.when(present("description"), field("description", "string"))
        .otherwise(F.when(present("name"), name).otherwise(""))
        .alias("description"),
        F.coalesce(number, F.lit(1)).cast("bigint").alias("priority"),
    )
    stem = F.regexp_replace(base_name(F.col("path")), r"(?<=.)\.[^.]*\z", "")
    plain = parsed.filter(~is_json).select(
        "path",
        F.lit(0).cast("bigint").alias("pos"),
        stem.alias("name"),
        F.col("content").alias("description"),
        F.lit(1).cast("bigint").alias("priority"),
    )
    return from_json.unionByName(plain)


def read_state_json(texts: DataFrame, schema: T.StructType | str) -> DataFrame:
    """texts(..., doc) -> the same rows with ``state`` (null if broken) and ``broken``.

    ``schema`` is one of ``STATE_SCHEMAS`` by name, or any other.
    """
    if isinstance(schema, str):
        schema = STATE_SCHEMAS[schema]
    bad = "_corrupt"
    wide = T.StructType(schema.fields + [T.StructField(bad, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parsed = texts.withColumn("_state", F.from_json("doc", wide, options))
    broken = F.col("_state").isNull() | F.col(f"_state.{bad}").isNotNull()
    good = F.struct(*[F.col(f"_state.`{f.name}`").alias(f.name) for f in schema.fields])
    return (
        parsed.withColumn("broken", broken).withColumn("state", F.when(~broken, good)).drop("_state")
    )


def broken_state(texts: DataFrame, schema: T.StructType | str) -> DataFrame:
    return read_state_json(texts, schema).filter("broken").drop("state", "broken")
