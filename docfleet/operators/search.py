"""Plain-text search over an index of trigrams, written once and looked up many times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docfleet.functions.scalars import let

POSTING_PARTS = 32
FILE_PARTS = 64


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters; none of a shorter text."""
    def runs(c: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(c) - 3)
        made = F.transform(starts, lambda i: F.concat(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2)))
        return F.when(F.size(c) >= 3, made).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(let(F.split(text, ""), runs))


def _part(value: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(parts)).cast("int")


def write_search_index(files: DataFrame, path: str) -> None:
    """Write the index of files(path, content): the files by a number of theirs, and which trigrams each holds.

    Postings lie in folders by trigram, sorted, so a look-up reads the row groups of its own
    trigrams; contents lie in folders by file number, of which a search reads those with candidates.
    """
    numbered = files.select(F.xxhash64("path").alias("file_no"), "path", "content").withColumn("part", _part(F.col("file_no"), FILE_PARTS))
    numbered.repartition("part").sortWithinPartitions("part", "file_no").write.partitionBy("part").parquet(f"{path}/files")
    postings = numbered.select("file_no", F.explode(trigrams(F.col("content"))).alias("gram")).withColumn("part", _part(F.col("gram"), POSTING_PARTS))
    # by a range of (part, gram), so a trigram that nearly all files hold is spread over tasks
    postings.repartitionByRange("part", "gram", "file_no").sortWithinPartitions("part", "gram", "file_no").write.partitionBy("part").parquet(f"{path}/postings")


def search_index(spark: SparkSession, path: str, pattern: str, under: str = ".") -> DataFrame:
    """All paths, in path order, whose content holds ``pattern`` as plain text, as :func:`search_content` gives them.

    Files that hold all trigrams of the pattern are candidates, and their contents are looked at. A
    pattern of fewer than three characters has no trigram; for it all contents are.
    """
    files = spark.read.schema("file_no bigint, path string, content string, part int").parquet(f"{path}/files")
    if under != ".":
        files = files.filter(F.contains("path", F.lit(under)))
    one = spark.createDataFrame([(pattern,)], "p string")
    wanted = one.select(F.explode(trigrams(F.col("p"))).alias("g")).select("g", _part(F.col("g"), POSTING_PARTS).alias("part")).collect()
    if wanted:
        postings = spark.read.schema("file_no bigint, gram string, part int").parquet(f"{path}/postings")
        own = postings.filter(F.col("part").isin(sorted({r["part"] for r in wanted})) & F.col("gram").isin([r["g"] for r in wanted]))
        candidates = own.groupBy("file_no").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(wanted))
        candidates = candidates.select("file_no", _part(F.col("file_no"), FILE_PARTS).alias("part"))
        files = files.join(candidates, ["part", "file_no"], "left_semi")
    return files.filter(F.contains("content", F.lit(pattern))).select("path").orderBy("path")
