"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_LEFT: dict[str, SparkSession] = {}
_TABLES: dict[str, SparkSession] = {}


class Work:
    """A folder of intermediate tables for one run of an operator.

    It lies under ``spark.checkpoint.dir``; where that is unset (tests, local runs) under the
    warehouse, which executors share as well. Tables written here cut the lineage: a lost executor
    costs its running tasks and nothing that was written before. What is no longer read is dropped
    at once, the rest when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
        self.spark, self.label = spark, label
        self.base = f"{base.rstrip('/')}/docfleet-llm/{label}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        _LEFT[path] = self.spark
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(f"{self.base}/{name}")

    def bucketed(self, df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
        """Write a bucketed table: later reads have all rows of a bucket in one task without a shuffle."""
        table = f"docfleet_{self.label}_{name}_{uuid.uuid4().hex[:12]}"
        _TABLES[table] = self.spark
        df.repartition(buckets, column).write.bucketBy(buckets, column).option("compression", "zstd").saveAsTable(table)
        out = self.spark.table(table)
        out.table_name = table
        return out

    def drop_table(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        _TABLES.pop(table, None)


def _delete(path: str) -> None:
    spark = _LEFT.pop(path, None)
    if spark is not None:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _clean() -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        for path in list(_LEFT):
            _delete(path)
        for table, spark in list(_TABLES.items()):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
