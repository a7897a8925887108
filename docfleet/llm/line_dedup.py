"""Line dedup: lines that many documents share stay in one of them only.

Native: DataFrame expressions only.

* Explode and hash. A line's key is the line without ``BLANK`` at both ends and with A-Z lower-cased.
  Keys of at least ``min_chars`` code points are exploded as 128-bit hashes with their position, never
  as texts, and the narrow table is stored because it is read twice.
* Count. Distinct documents and the largest doc_id per hash, counted by (hash, document) first, so a
  line that a third of all documents hold is spread over their ids and meets as partial counts only.
* Drop. The hashes at or above ``min_documents`` are joined back to the narrow lines. The hot side of
  that join is an ordinary shuffle of narrow rows, which adaptive execution splits.
* Reassemble. A document's dropped positions become the stretches between them, so putting it together
  again takes time in proportion to its lines, and texts are shuffled once, by row.

Defined results: a null or empty text is one empty line and comes back as an empty text. Rows with one
doc_id are one document for the count; each of them gets its own result, and repeated rows equal ones.
A null doc_id is one document too, below all others. Other columns pass through and may have any name
but ``n_lines``, ``n_dropped`` or one that starts with an underscore; these are replaced. An empty
table gives an empty result. A line is told from others by 128 hash bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docfleet.functions.scalars import let
from docfleet.llm.work import Work

MIN_CHARS = 20
MIN_DOCUMENTS = 3
BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(value: Column, *more: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k), *more, value) for k in (11, 13)]


def _rows(docs: DataFrame) -> DataFrame:
    """The documents with 128 bits that name the row; equal rows share them and lose the same lines."""
    text = F.col("text").cast("string")
    one, two = _hash(text, F.col("doc_id"))
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")], one.alias("_r1"), two.alias("_r2"))


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, work: Work | None = None) -> tuple[DataFrame, DataFrame]:
    """The narrow lines (_r1, _r2, _doc, _pos, _h1, _h2) and, per hash in ``min_documents`` or more, _keep."""
    work = work or Work(docs.sparkSession, "line_dedup")
    keys = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _UPPER, _LOWER)
    trimmed = F.transform(F.split(keys, "\n", -1), lambda line: F.btrim(line, F.lit(BLANK)))
    long = lambda c: F.length(c) >= min_chars
    entries = F.transform(trimmed, lambda line, at: F.when(long(line), F.struct(at.cast("int").alias("p"), _hash(line)[0].alias("a"), _hash(line)[1].alias("b"))))
    rows = _rows(docs.select("doc_id", "text")).select("_r1", "_r2", F.col("doc_id").alias("_doc"), F.explode(F.array_compact(entries)).alias("_e"))
    lines = work.save(
        rows.select("_r1", "_r2", "_doc", F.col("_e.p").alias("_pos"), F.col("_e.a").alias("_h1"), F.col("_e.b").alias("_h2")), "lines"
    )
    per_document = lines.select("_h1", "_h2", "_doc").distinct()
    shared = (
        per_document.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"), F.max("_doc").alias("_keep"))
        .filter(F.col("_n") >= min_documents).select("_h1", "_h2", "_keep")
    )
    return lines, work.save(shared, "shared")


def without(lines: Column, dropped: Column) -> Column:
    """The lines whose positions are not in the sorted array ``dropped``, joined by a line break."""
    def stretches(lines: Column) -> Column:
        after = F.concat(F.array(F.lit(-1)), dropped)
        before = F.concat(dropped, F.array(F.size(lines)))
        kept = F.zip_with(after, before, lambda a, b: F.slice(lines, a + 2, b - a - 1))
        return F.array_join(F.flatten(kept), "\n")

    return let(lines, stretches)


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, work: Work | None = None) -> DataFrame:
    """The rows of ``docs`` with the text that is left, n_lines (before) and n_dropped."""
    work = work or Work(docs.sparkSession, "line_dedup")
    lines, shared = shared_lines(docs, min_chars, min_documents, work)
    gone = lines.join(shared, ["_h1", "_h2"]).filter(~F.col("_doc").eqNullSafe(F.col("_keep")))
    dropped = gone.groupBy("_r1", "_r2").agg(F.sort_array(F.collect_set("_pos")).alias("_dropped"))
    joined = _rows(docs).join(dropped, ["_r1", "_r2"], "left")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = F.when(F.col("_dropped").isNull(), text).otherwise(without(lines_of(text), F.col("_dropped")))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *[kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in columns],
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
