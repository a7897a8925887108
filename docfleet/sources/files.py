"""File inventory, ingest manifest, result tables and reports."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docfleet.functions import constants as K
from docfleet.functions.scalars import base_name, file_extension
from docfleet.operators.documents import is_falsy
from docfleet.plans.runtime import stored
from docfleet.sources.tree import FileTree, open_root


def scan_files(
    spark: SparkSession, root: str, exclude_dirs: Iterable[str] = K.EXCLUDED_DIRS, skip: Iterable[str] = (), under: str = "", **options: int
) -> DataFrame:
    """Recursive inventory: path (relative to root), size, mtime, of paths that start with ``under``.

    The listing (see :mod:`docfleet.sources.tree`) is one job and is stored, so all that is made of it
    sees the same snapshot. Folders with an excluded name are not entered. Names are compared one path
    component at a time, so an excluded name that contains a slash never matches. ``root`` must be a
    folder that the executors reach. No session setting is needed.
    """
    spark.dataSource.register(FileTree)
    found = spark.read.format(FileTree.name()).options(root=root, exclude=json.dumps(sorted(exclude_dirs)), under=under, **options).load()
    return stored(found.filter(~F.col("path").isin(list(skip))), "listing")


def hash_files(files: DataFrame, root: str, copies_only: bool = True) -> DataFrame:
    """SHA-256 of the files of an inventory: path, size, mtime, hash.

    ``copies_only`` reads only files whose size occurs more than once, since no other file can
    have a copy. Files are read in blocks, never whole, and the sizes table is joined before any
    file is opened.
    """
    wanted = files.filter(F.col("size") > 0)
    if copies_only:
        sizes = wanted.groupBy("size").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        wanted = wanted.join(sizes.select("size"), "size", "left_semi")
    kept = wanted.columns

    def hash_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, base = open_root(root.rstrip("/"))
        for batch in batches:
            digests = []
            for path in batch["path"]:
                digest = hashlib.sha256()
                with opened.open_input_stream(f"{base}/{path}") as stream:
                    while block := stream.read(1 << 20):
                        digest.update(block)
                digests.append(digest.hexdigest())
            yield batch.assign(hash=digests)

    schema = ", ".join(f"{name} {kind}" for name, kind in files.select(kept).dtypes) + ", hash string"
    # by path, so that large files of one folder are not read by one task
    return stored(wanted.repartition("path").mapInPandas(hash_batch, schema), "digests")


def write_files(files: DataFrame, root: str) -> int:
    """Write files(path, content binary) below ``root``, one file per row, and count them.

    Paths must differ; a null content is a file without bytes. Tasks write the files themselves: Spark's
    writers make a folder, a checksum and a move in the driver for each. A file gets its name when it is
    whole, so a task that runs again replaces it; what a task that ended early leaves begins with a dot.
    """
    root = root.rstrip("/")
    system, base = open_root(root)
    system.create_dir(base)

    def write_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, base = open_root(root)
        made = set()
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
                folder, _, name = f"{base}/{path}".rpartition("/")
                if folder not in made:
                    opened.create_dir(folder)
                    made.add(folder)
                draft = f"{folder}/.{uuid.uuid4().hex}"
                with opened.open_output_stream(draft) as stream:
                    stream.write(content or b"")
                opened.move(draft, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"files": [batch.num_rows]})

    return files.select("path", "content").mapInArrow(write_batch, "files bigint").agg(F.sum("files")).first()[0] or 0


def ingest_manifest(files: DataFrame, uploaded_at: Column | None = None) -> DataFrame:
    """files(path, size, mtime) -> one manifest row per file.

    The id is a hash of the path, so a rerun gives the same ids.
    """
    name = base_name(F.col("path"))
    ext = file_extension(name)
    guessed = F.coalesce(
        F.try_element_at(
            F.create_map(*[F.lit(x) for kv in _MEDIA_BY_EXTENSION.items() for x in kv]), ext
        ),
        F.lit(K.DEFAULT_CONTENT_TYPE),
    )
    return files.select(
        F.sha2("path", 256).alias("file_id"),
        name.alias("filename"),
        ext.alias("ext"),
        F.col("size").cast("bigint").alias("size"),
        guessed.alias("content_type"),
        (uploaded_at if uploaded_at is not None else F.col("mtime")).alias("upload_time"),
    )


_MEDIA_BY_EXTENSION = {ext: K.CONTENT_TYPES[ext] for ext in ("pdf", "docx", "xlsx", "pptx", "html", "csv", "png", "svg", "ico")} | {
    "md": K.CONTENT_TYPES["markdown"],
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
}


def append_manifest(manifest: DataFrame, path: str) -> None:
    """Append manifest rows as parquet, one folder per upload day."""
    manifest.withColumn("upload_date", F.to_date("upload_time")).write.mode("append").partitionBy(
        "upload_date"
    ).parquet(path)


def csv_lines(cells: DataFrame, quote: bool = False) -> DataFrame:
    """cells(doc_id, rw, col, value, is_num) -> (doc_id, rw, line), header kept.

    Every empty, zero or false cell is left blank and nothing is quoted, unless ``quote`` asks
    for RFC 4180 quoting.
    """
    value = F.when(is_falsy(F.col("value"), F.col("is_num")), "").otherwise(F.col("value"))
    if quote:
        doubled = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        value = F.when(value.rlike('[",\r\n]'), doubled).otherwise(value)
    return (
        cells.groupBy("doc_id", "rw")
        .agg(F.sort_array(F.collect_list(F.struct("col", value.alias("v")))).alias("c"))
        .select("doc_id", "rw", F.array_join(F.transform("c", lambda x: x["v"]), ",").alias("line"))
    )


def export_csv(cells: DataFrame, path: str, quote: bool = False) -> None:
    """Write the lines as text, one folder per document, sorted by row within each file."""
    lines = csv_lines(cells, quote)
    # rows of one document are spread by row range, so a large sheet becomes several files
    lines.repartitionByRange("doc_id", "rw").sortWithinPartitions("doc_id", "rw").select("doc_id", "line").write.partitionBy(
        "doc_id"
    ).text(path)


def write_report(report: DataFrame, path: str) -> None:
    """Write report rows (section, path, entry...) as JSON lines, one folder per section."""
    report.write.partitionBy("section").json(path)


def write_results(results: DataFrame, path: str) -> None:
    """Append result rows, one folder per day and status, so expired days drop as folders."""
    results.withColumn("result_date", F.to_date("created_at")).write.mode("append").partitionBy(
        "result_date", "status"
    ).parquet(path)


def read_results(spark: SparkSession, path: str, now: Column, ttl_hours: int = K.RESULT_TTL_HOURS) -> DataFrame:
    """Results that have not expired; whole days that have are pruned before reading."""
    oldest = now.cast("timestamp") - F.make_dt_interval(hours=F.lit(ttl_hours))
    rows = spark.read.parquet(path)
    return rows.filter((F.col("result_date") >= F.to_date(oldest)) & (F.col("created_at") >= oldest))
