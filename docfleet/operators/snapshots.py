"""Snapshots of file trees as trees of folder digests, compared without opening equal folders.

A folder's digest is made of the hashes of (path, content hash) of all files below it, combined by
exclusive or and counted, so it needs no order and no list: each task adds up its own files, and two
folders agree if they hold the same files (but for a chance of about 2^-128).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docfleet.plans.runtime import stored

FEW_FOLDERS = 1_000
FOLDERS = "folder string, files bigint, x1 bigint, x2 bigint, own_files bigint, own_x1 bigint, own_x2 bigint, parent string, depth int"
FILES = "folder string, path string, hash string"


def folder_of(path: Column) -> Column:
    """The folder a file or folder lies in; of one at the top it is ''."""
    return F.regexp_replace(path, r"/?[^/]*\z", "")


def _ancestors(folder: Column) -> Column:
    """The folder itself and all above it, the root '' included."""
    names = F.split(folder, "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(names)), lambda n: F.array_join(F.slice(names, F.lit(1), n), "/"))
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), above))


def folder_digests(snapshot: DataFrame) -> DataFrame:
    """snapshot(path, hash) -> (folder, depth, parent, and the digests of all files below and of its own files)."""
    file = snapshot.select(folder_of(F.col("path")).alias("_at"), *[F.xxhash64(F.lit(k), "path", F.col("hash").isNull(), "hash").alias(f"h{k}") for k in (1, 2)])
    below = file.select(F.explode(_ancestors(F.col("_at"))).alias("folder"), "_at", "h1", "h2")
    own = F.col("folder") == F.col("_at")
    sums = below.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"),
        F.count_if(own).alias("own_files"), F.bit_xor(F.when(own, F.col("h1"))).alias("own_x1"), F.bit_xor(F.when(own, F.col("h2"))).alias("own_x2"),
    )
    depth = F.when(F.col("folder") == "", 0).otherwise(F.size(F.split("folder", "/", -1)))
    return sums.withColumn("depth", depth).withColumn("parent", F.when(F.col("folder") != "", folder_of(F.col("folder"))))


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Store a snapshot (path, hash) with its folder digests: by depth and parent, and the files by folder."""
    digests = folder_digests(snapshot)
    digests.repartitionByRange("depth", "parent", "folder").sortWithinPartitions("depth", "parent", "folder").write.partitionBy("depth").parquet(f"{path}/folders")
    files = snapshot.select(folder_of(F.col("path")).alias("folder"), "path", "hash")
    files.repartitionByRange("folder", "path").sortWithinPartitions("folder", "path").write.parquet(f"{path}/files")


def _within(table: DataFrame, column: str, folders: DataFrame) -> DataFrame:
    """The rows of a stored table in ``folders``; few of them are pushed down to the scan, which skips all other row groups."""
    few = folders.take(FEW_FOLDERS + 1)
    if len(few) <= FEW_FOLDERS:
        return table.filter(F.col(column).isin([r[0] for r in few]))
    return table.join(folders.select(F.col(folders.columns[0]).alias(column)), column, "left_semi")


def changed_folders(spark: SparkSession, before: str, after: str) -> DataFrame:
    """(folder, own) of all folders that differ between two stored snapshots; ``own``: by files of their own.

    Goes down from the root, one level after the other, and looks at the children of folders that differ only.
    """
    old, new = (spark.read.schema(FOLDERS).parquet(f"{p}/folders") for p in (before, after))
    digest = ("files", "x1", "x2", "own_files", "own_x1", "own_x2")

    def differ(*names: str) -> Column:
        # a folder that only one snapshot has holds no files in the other
        value = lambda side, c: F.coalesce(f"{side}_{c}", F.lit(0)) if c.endswith("files") else F.col(f"{side}_{c}")
        return reduce(or_, [~value("a", c).eqNullSafe(value("b", c)) for c in names])

    open_ = spark.createDataFrame([(None,)], "folder string")
    out, depth = None, 0
    while True:
        at = [t.filter(F.col("depth") == depth) for t in (old, new)]
        pair = [_within(t, "parent", open_) for t in at] if depth else at
        left, right = (t.select("folder", *[F.col(c).alias(f"{side}_{c}") for c in digest]) for t, side in zip(pair, "ab"))
        level = left.join(right, "folder", "full").filter(differ(*digest[:3])).select("folder", differ(*digest[3:]).alias("own"))
        level = stored(level, "level")
        out = level if out is None else out.union(level)
        if level.isEmpty():
            return out
        open_, depth = level.select("folder"), depth + 1


def stored_snapshot_diff(spark: SparkSession, before: str, after: str) -> DataFrame:
    """As :func:`snapshot_diff`, of two snapshots stored by :func:`write_snapshot`; only folders whose own files differ are opened."""
    from docfleet.operators.history import snapshot_diff

    folders = stored(changed_folders(spark, before, after).filter("own").select("folder"), "folders")
    old, new = (_within(spark.read.schema(FILES).parquet(f"{p}/files"), "folder", folders) for p in (before, after))
    return snapshot_diff(old, new)
