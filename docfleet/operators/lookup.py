"""Stored-file lookups, conversion catalogue checks and feature updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docfleet.functions import constants as K


def stored_extension(path: Column) -> Column:
    """Extension with its dot and in its own case; empty if the file name has none."""
    return F.regexp_extract(path, r"\.[^./]*\z", 0)


def first_variants(files: DataFrame, extensions: Sequence[str] = K.LOOKUP_EXTENSIONS) -> DataFrame:
    """files(file_id, path, size, ...) -> per id the file whose extension comes first in the list.

    A stored id may exist under several extensions; others than those listed are never found. Where the
    files have a time (``mtime``), the hit has it as ``created_at``.
    """
    order = F.array_position(F.array(*[F.lit(e) for e in extensions]), stored_extension(F.col("path")))
    hit = F.struct("path", "size", *([F.col("mtime").alias("created_at")] if "mtime" in files.columns else []))
    return (
        files.withColumn("_order", order)
        .filter(F.col("_order") > 0)
        .groupBy("file_id")
        .agg(F.min_by(hit, F.struct("_order", "path")).alias("hit"))
        .select("file_id", "hit.*")
    )


def resolve_files(requests: DataFrame, files: DataFrame, extensions: Sequence[str] = K.LOOKUP_EXTENSIONS) -> DataFrame:
    """requests(request_id, file_id) with path and size, or an error where nothing is found."""
    return requests.join(first_variants(files, extensions), "file_id", "left").withColumn(
        "error", F.when(F.col("path").isNull(), K.MSG_NO_FILE)
    )


def merge_inputs(requests: DataFrame, files: DataFrame) -> DataFrame:
    """requests(merge_id, file_ids array) -> found files in request order; missing ids are skipped."""
    wanted = requests.select("merge_id", F.posexplode("file_ids").alias("pos", "file_id"))
    return wanted.join(first_variants(files), "file_id").select(
        "merge_id", F.col("pos").cast("bigint").alias("pos"), "file_id", "path"
    )


def require_files(requests: DataFrame, files: DataFrame) -> DataFrame:
    """As resolve_files, for operations that accept a PDF (or a file without extension) only."""
    return requests.join(first_variants(files, ("", ".pdf")), "file_id", "left").withColumn(
        "error", F.when(F.col("path").isNull(), K.MSG_NO_PDF)
    )


def delete_files(files: DataFrame, ids: DataFrame, extensions: Sequence[str] = K.LOOKUP_EXTENSIONS) -> dict[str, DataFrame]:
    """Every variant of the given ids: what is kept, what is deleted, and ids that match nothing."""
    wanted = ids.select("file_id").distinct()
    known = stored_extension(F.col("path")).isin(list(extensions))
    doomed = files.filter(known).select("file_id").distinct()
    hit = wanted.withColumn("_hit", F.lit(True))
    marked = files.join(hit, "file_id", "left").withColumn("_gone", F.coalesce("_hit", F.lit(False)) & known)
    return {
        "kept": marked.filter(~F.col("_gone")).select(files.columns),
        "deleted": marked.filter("_gone").select(files.columns),
        "missing": wanted.join(doomed, "file_id", "left_anti").withColumn("error", F.lit(K.MSG_NO_FILE)),
    }


# ---------------------------------------------------------------- conversion catalogue


def _targets(ext: Column) -> Column:
    """Array of the (target, label) structs offered for an extension, from the fixed catalogue."""
    offered = F.array(
        *[F.struct(F.lit(a).alias("source"), F.lit(b).alias("target"), F.lit(c).alias("label")) for a, b, c in K.OFFERED_CONVERSIONS]
    )
    return F.filter(offered, lambda c: c["source"] == ext)


def available_conversions(files: DataFrame) -> DataFrame:
    """files(file_id, ext) -> one row per conversion offered, in catalogue order."""
    return files.select("file_id", "ext", F.posexplode(_targets(F.col("ext"))).alias("pos", "c")).select(
        "file_id", "ext", F.col("pos").cast("bigint").alias("pos"), "c.target", "c.label"
    )


def default_target(ext: Column) -> Column:
    """First target offered, else pdf."""
    return F.coalesce(F.get(_targets(ext), F.lit(0))["target"], F.lit(K.DEFAULT_TARGET))


def check_supported(requests: DataFrame, supported: Sequence[str] = K.SINGLE_CONVERSIONS) -> DataFrame:
    """requests(conversion_type, ...) with ``error`` where nothing handles the type."""
    kind = F.col("conversion_type")
    return requests.withColumn("error", F.when(~kind.isin(list(supported)), F.concat(F.lit(K.MSG_UNSUPPORTED), kind)))


# ---------------------------------------------------------------- features


def apply_test_results(features: DataFrame, results: DataFrame) -> DataFrame:
    """results(project_id, pos, name, status, error) put onto features by description.

    The first result of a name wins; features without a result keep what they had.
    """
    first = (
        results.groupBy("project_id", F.col("name").alias("description"))
        .agg(F.min_by(F.struct("status", "error"), "pos").alias("_r"))
    )
    old = lambda c: F.col(c) if c in features.columns else F.lit(None).cast("string")
    hit = F.col("_r").isNotNull()
    return (
        features.join(first, ["project_id", "description"], "left")
        .withColumn("test_status", F.when(hit, F.col("_r.status")).otherwise(old("test_status")))
        .withColumn("test_error", F.when(hit, F.col("_r.error")).otherwise(old("test_error")))
        .drop("_r")
    )


def mark_feature(features: DataFrame, updates: DataFrame) -> DataFrame:
    """updates(project_id, description, passes): sets ``passes`` on the first feature with that
    description only; of several updates for one description all must pass. The join back is on the
    row's own key, so it is even."""
    updates = updates.groupBy("project_id", "description").agg(F.bool_and("passes").alias("passes"))
    first = features.groupBy("project_id", "description").agg(F.min("pos").alias("pos"))
    new = first.join(updates.withColumnRenamed("passes", "_new"), ["project_id", "description"]).select(
        "project_id", "pos", "_new", F.lit(True).alias("_hit")
    )
    return (
        features.join(new, ["project_id", "pos"], "left")
        .withColumn("passes", F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("passes")))
        .drop("_new", "_hit")
    )
