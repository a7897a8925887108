"""Which lists name which conversion types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docfleet.functions import constants as K
from docfleet.functions.scalars import conversion_key


def conversion_lists(spark: SparkSession) -> DataFrame:
    """(list, conversion_type) of the five fixed lists."""
    lists = {
        "declared": K.DECLARED_CONVERSIONS,
        "single": K.SINGLE_CONVERSIONS,
        "batch": K.BATCH_CONVERSIONS,
        "advertised": K.ADVERTISED_CONVERSIONS,
    }
    rows = [(name, kind) for name, kinds in lists.items() for kind in kinds]
    named = spark.createDataFrame(rows, "list string, conversion_type string")
    offered = spark.createDataFrame([(a, b) for a, b, _ in K.OFFERED_CONVERSIONS], "a string, b string")
    return named.union(offered.select(F.lit("offered"), conversion_key(F.col("a"), F.col("b"))).distinct())


def catalogue_coverage(requests: DataFrame) -> DataFrame:
    """requests(conversion_type) -> per type the number of requests and which lists know it.

    Types that nobody asked for are shown with 0. Requests are counted before anything is joined,
    so the join sees one row per type.
    """
    asked = requests.groupBy("conversion_type").agg(F.count(F.lit(1)).alias("requests"))
    known = (
        conversion_lists(requests.sparkSession)
        .groupBy("conversion_type")
        .agg(
            *[
                F.bool_or(F.col("list") == name).alias(name)
                for name in ("declared", "single", "batch", "advertised", "offered")
            ]
        )
    )
    return asked.join(known, "conversion_type", "full").fillna(0, ["requests"]).fillna(
        False, ["declared", "single", "batch", "advertised", "offered"]
    )
