"""Grace hash deduplication of whole texts.

Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Each task first
folds the copies among its own rows in an open-addressing table, so a text that holds a third of all
rows leaves as one record per task. The records are partitioned by a hash of the text to spill files
(a bucketed table in the shared folder). A bucket above ``bucket_bytes`` is folded and partitioned
again with another hash, until every bucket fits an open-addressing table that compares complete
contents, or holds copies of one text only: these stream through a table with that one content. No text is compared by its hash alone.

Defined results: of equal texts the row with the largest doc_id stays, null ids last. Rows that
repeat both that doc_id and the text are interchangeable: one of them stays. Other columns pass
through and may have any name that does not start with an underscore. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from docfleet.llm.words import tidy
from docfleet.llm.work import Work

BUCKET_BYTES = 16 << 20
FOLD_BYTES = 16 << 20
RECORD = "_sha string, _text binary, _n bigint, _top bigint, _tops bigint"


def normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


class ContentTable:
    """Open addressing with linear probing; a slot is taken over only by an identical content."""

    def __init__(self, slots: int = 1 << 10):
        self.slots: list[int] = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.counts: list[list] = []  # rows, largest id, rows that have it
        self.bytes = 0

    def _place(self, h: int, content: bytes | None) -> int:
        """The slot of this content, or the free slot where it belongs."""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if content is not None and self.hashes[entry] == h and self.contents[entry] == content:
                break
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        for entry, h in enumerate(self.hashes):
            self.slots[self._place(h, None)] = entry

    def add(self, content: bytes, n: int, top: int | None, tops: int) -> None:
        h = xxhash.xxh3_64_intdigest(content)
        at = self._place(h, content)
        entry = self.slots[at]
        if entry < 0:
            self.slots[at] = len(self.contents)
            self.hashes.append(h)
            self.contents.append(content)
            self.counts.append([n, top, tops])
            self.bytes += len(content) + 200
            if 3 * len(self.contents) > 2 * len(self.slots):
                self._grow()
            return
        count = self.counts[entry]
        count[0] += n
        if top == count[1]:
            count[2] += tops
        elif count[1] is None or (top is not None and top > count[1]):
            count[1], count[2] = top, tops

    def batch(self, start: int = 0, end: int | None = None) -> pa.RecordBatch:
        counts, contents = list(zip(*self.counts[start:end])) or [(), (), ()], self.contents[start:end]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([hashlib.sha256(c).hexdigest() for c in contents], pa.string()),
                pa.array(contents, pa.binary()),
                *(pa.array(c, pa.int64()) for c in counts),
            ],
            ["_sha", "_text", "_n", "_top", "_tops"],
        )


def _flush(table: ContentTable) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(table.contents), 1000):
        yield table.batch(at, at + 1000)


def _fold_rows(most: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                table.add(normal(text.as_py()), 1, doc_id, 1)
                if table.bytes > most:
                    yield from _flush(table)
                    table = ContentTable()
        yield from _flush(table)

    return fold


def _fold_records(most: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for text, *count in zip(batch.column("_text"), *(batch.column(c).to_pylist() for c in ("_n", "_top", "_tops"))):
                table.add(text.as_py(), *count)
                if table.bytes > most:
                    yield from _flush(table)
                    table = ContentTable()
        yield from _flush(table)

    return fold


def _whole_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of one bucket; its records stream through a table that holds each content once."""
    table = ContentTable()
    for batch in batches:
        for text, *count in zip(batch.column("_text"), *(batch.column(c).to_pylist() for c in ("_n", "_top", "_tops"))):
            table.add(text.as_py(), *count)
    several = [(hashlib.sha256(content).hexdigest(), *count) for content, count in zip(table.contents, table.counts) if count[0] > 1]
    columns = list(zip(*several)) or [(), (), (), ()]
    yield pa.RecordBatch.from_pydict({
        "_sha": pa.array(columns[0], pa.string()),
        **{name: pa.array(column, pa.int64()) for name, column in zip(("_n", "_top", "_tops"), columns[1:])},
    })


@F.pandas_udf(StringType())
def text_sha(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: hashlib.sha256(normal(t if isinstance(t, str) else None)).hexdigest())


def copy_groups(docs: DataFrame, work: Work, bucket_bytes: int = BUCKET_BYTES, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """Contents that several rows have: _sha, _n (rows), _top (largest doc_id), _tops (rows with that id).

    The tables of spill files are gone when this returns; only the narrow result is kept.
    """
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("b")).first()["b"] or 0
    records = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(_fold_rows(fold_bytes)), RECORD)
    found, level, tables = [], 0, []
    while True:
        buckets = max(1, min(100_000, -(-size // bucket_bytes)))
        spill = work.bucketed(
            records.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(level), "_sha"), F.lit(buckets)).cast("int")),
            f"spill{level}", "_bucket", buckets,
        )
        tables.append(spill.table_name)
        # copies of one text stay together under every hash, so a bucket with a single hash is not partitioned again
        mark = F.xxhash64("_sha")
        sizes = spill.groupBy("_bucket").agg(F.sum(F.octet_length("_text") + 64).alias("_b"), (F.min(mark) < F.max(mark)).alias("_several"))
        large = work.save(sizes.filter((F.col("_b") > 2 * bucket_bytes) & F.col("_several")), f"large{level}")
        more = large.agg(F.sum("_b").alias("b")).first()["b"]
        small = spill if not more else spill.join(large.select("_bucket"), "_bucket", "left_anti")
        fits = small.groupBy("_bucket").applyInArrow(_whole_bucket, "_sha string, _n bigint, _top bigint, _tops bigint")
        found.append(work.save(fits, f"groups{level}"))
        if not more:
            break
        records = spill.join(large.select("_bucket"), "_bucket", "left_semi").drop("_bucket").mapInArrow(tidy(_fold_records(fold_bytes)), RECORD)
        size, level = more, level + 1
    for table in tables:
        work.drop_table(table)
    groups = found[0]
    for other in found[1:]:
        groups = groups.unionByName(other)
    return groups


def mark_copies(docs: DataFrame, work: Work | None = None, bucket_bytes: int = BUCKET_BYTES, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """The rows with text_sha256, keep_id, group_size and kept added."""
    work = work or Work(docs.sparkSession, "exact_dedup")
    groups = copy_groups(docs, work, bucket_bytes, fold_bytes)
    marked = (
        docs.drop("text_sha256", "keep_id", "group_size", "kept")
        .withColumn("text_sha256", text_sha("text"))
        .join(groups.withColumnRenamed("_sha", "text_sha256"), "text_sha256", "left")
        .withColumn("keep_id", F.when(F.col("_n").isNull(), F.col("doc_id")).otherwise(F.col("_top")).cast("bigint"))
        .withColumn("group_size", F.coalesce("_n", F.lit(1)).cast("bigint"))
        .withColumn("kept", F.col("keep_id").eqNullSafe(F.col("doc_id")))
    )
    if not groups.filter("_tops > 1").isEmpty():
        # the id that stays is itself repeated: one of these rows, which are alike, stays
        alike = Window.partitionBy("text_sha256", "kept", F.when(~F.col("kept"), F.col("doc_id"))).orderBy(F.lit(1))
        marked = marked.withColumn("kept", F.col("kept") & (F.row_number().over(alike) == 1))
    return marked.drop("_n", "_top", "_tops")


def drop_copies(docs: DataFrame, work: Work | None = None) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return mark_copies(docs, work).filter("kept").select(docs.columns)
