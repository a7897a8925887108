"""Session and scratch-table helpers shared by the operators."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "docfleet", cpus: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the library is written for."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.python.filterPushdown.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LEFT: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Where that is unset (tests, local runs) it lies under the warehouse, which executors share as
    well. What is left of it when the driver's Python ends is removed then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    path = f"{base.rstrip('/')}/docfleet/{label}-{uuid.uuid4().hex}"
    _LEFT[path] = spark
    return path


class Folder:
    """A folder in whatever file system Spark reads, for small files written by the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        """Names in the folder, sorted; none if there is no such folder."""
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Write a whole file under a name that is not taken; readers see all of it or nothing."""
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        stream = self._fs.create(self._at(draft))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(self._at(draft), self._at(name)):
            self.delete(draft)
            raise FileExistsError(f"{self.path}/{name}")

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)


@atexit.register
def _clean() -> None:
    for path, spark in _LEFT.items():
        try:
            Folder(spark, path).delete()
        except Exception:  # the session has ended; what it wrote to a local disk can still go
            if path.startswith(("/", "file:")):
                shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """What a query inside shuffles is removed when it ends, and not when the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def spread_out(df: DataFrame) -> DataFrame:
    """A table with fewer splits than there are cores, dealt over all of them; a larger one as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    # an adaptive plan would run its shuffles to tell
    with setting(df.sparkSession, "spark.sql.adaptive.enabled", "false"):
        splits = df.select("*").rdd.getNumPartitions()
    return df.repartition(cores) if splits < cores else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes values that a recomputation could change (partition ids of a
    sampled range split), so a lost executor cannot make two readers disagree.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove what ``stored`` wrote and nothing reads any more."""
    for df in tables:
        Folder(_LEFT.pop(df.stored_at), df.stored_at).delete()
