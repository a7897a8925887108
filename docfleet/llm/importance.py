"""Target-distribution importance resampling by hashed n-grams.

Features of a text are its runs of 1 to 3 words; a feature's bucket is the CRC-32 of its bytes modulo
``BUCKETS``. How often a bucket occurs in the raw and in the target texts gives its gain, a document's
weight is the sum of its features' gains, and Gumbel noise from its id turns "highest scores" into a
draw without replacement in proportion to the weights.

* CRC matrices. A block of texts is lower-cased and cut into words as one byte array. Distinct features
  of the block are found by whole-number keys, grouped by their length in bytes, and laid out as one
  matrix of bytes per length; all CRCs of a matrix advance together, column by column, and the buckets
  are scattered back to every occurrence. Groups of fewer than ``MATRIX_ROWS`` features, where a matrix
  would have more columns than rows to gain from, go through zlib.
* One pass over the texts. It stores per document the sorted buckets as gaps, about a byte a feature;
  corpus counts and weights are made from these. Only the ``buckets`` sums of counts reach the driver.
* The draw is numbered over a range-partitioned table, so no task sorts all documents.

A text longer than ``BLOCK_BYTES`` is cut between words, and each piece sees the two words that follow
it, so memory is bounded by the block unless one word is longer.

Defined results: a null or empty text has no features and weight 0; rows that repeat a doc_id are
scored each on its own and share their noise; a null doc_id counts as the empty string in the noise and
stands first among ties; rows alike in all of score, doc_id, weight and n_features take their ranks in
any order. Without target texts every gain still exists (all target counts are 0). Other columns take
no part in scores, pass through ``resample``, and may have any name that does not start with an
underscore. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from docfleet.llm.words import chunks, tidy
from docfleet.llm.work import Work
from docfleet.plans.ordered import number_rows

BUCKETS = 10_000
WORDS_IN_FEATURE = 3
PERCENT, MIN_WORDS, SEED = 5, 20, 42
BLOCK_BYTES = 2 << 20
MATRIX_ROWS = 16
MATRIX_BYTES = 1 << 20
COUNTED = "doc_id bigint, _text_hash bigint, n_words bigint, n_features bigint, _gaps binary"


def _crc_table() -> np.ndarray:
    """Steps of CRC-32 (polynomial EDB88320, least bit first) for each byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


def crc_matrix(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every column of a matrix whose rows are first bytes, second bytes and so on."""
    crc = np.full(matrix.shape[1], 0xFFFFFFFF, np.uint32)
    for byte in matrix:
        crc = _TABLE[(crc ^ byte) & 0xFF] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the slices of ``data``, by matrices of equal length."""
    out = np.empty(len(start), np.uint32)
    order = np.argsort(length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, first[1:])):
        if len(rows) < MATRIX_ROWS:
            out[rows] = [zlib.crc32(data[a : a + size]) for a in start[rows].tolist()]
            continue
        windows = np.lib.stride_tricks.sliding_window_view(data, size)
        step = max(MATRIX_ROWS, MATRIX_BYTES // size)
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            out[own] = crc_matrix(np.ascontiguousarray(windows[start[own]].T))
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For whole-number keys: each one's number among the distinct ones, and one place of each of these."""
    number = pc.dictionary_encode(pa.array(keys)).indices.to_numpy()
    place = np.empty(int(number.max(initial=-1)) + 1, np.int64)
    place[number] = np.arange(len(keys))
    return number, place


def _words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words, each followed by a space, as one byte array; where each starts there, and in ``data``.

    ``edges``: the documents' starts in ``data`` and its end; no word goes over an edge.
    """
    data = _FOLD[data]
    inside = _IN_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    begins = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    size = ends - begins
    start = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = data[inside]
    return joined, np.append(start, len(joined)), begins


def block_buckets(data: np.ndarray, edges: np.ndarray, limits: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per document, and document and bucket of every feature.

    Only words and features that start before ``limits`` of their document count.
    """
    joined, start, begins = _words(data, edges)
    docs = len(edges) - 1
    doc = np.searchsorted(edges[1:], begins, "right")
    own = begins < limits[doc]
    n_words = np.bincount(doc[own], minlength=docs)
    if not len(begins):
        return n_words, np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = np.cumsum(np.bincount(doc, minlength=docs))[doc]  # the end of the word's document
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(start), pa.py_buffer(joined)])
    word = pc.dictionary_encode(words).indices.to_numpy().astype(np.int64)
    vocabulary = int(word.max()) + 1
    found_docs, found, keys = [], [], word
    for k in range(1, WORDS_IN_FEATURE + 1):
        at = np.flatnonzero(own & (np.arange(len(begins)) + k <= last))
        if not len(at):
            break
        number, place = _distinct(keys[at])
        first = at[place]
        crc = crcs(joined, start[first], start[first + k] - 1 - start[first])
        found.append((crc % np.uint32(buckets)).astype(np.int64)[number])
        found_docs.append(doc[at])
        if k < WORDS_IN_FEATURE:
            # runs of k words have numbers below the words there are, so keys stay far below 2^63
            longer = np.zeros(len(begins), np.int64)
            longer[at] = number
            longer[: len(begins) - k] = longer[: len(begins) - k] * vocabulary + word[k:]
            keys = longer
    return n_words, np.concatenate(found_docs), np.concatenate(found)


def _pieces(data: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """A long text cut between words: each piece with the words that its last features need, and where these begin."""
    inside = _IN_WORD[_FOLD[data]]
    begins = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    at = 0
    while at < len(begins):
        end = max(at + 1, int(np.searchsorted(begins, begins[at] + BLOCK_BYTES)))
        after = end + WORDS_IN_FEATURE - 1
        stop = len(data) if after >= len(begins) else begins[after]
        limit = len(data) if end >= len(begins) else begins[end]
        yield data[begins[at] : stop], int(limit - begins[at])
        at = end


def _block(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and text and bucket of every feature."""
    raw = pc.fill_null(column.cast(pa.large_binary()), b"")
    edges = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    if len(raw) > 1 or len(data) <= BLOCK_BYTES:
        return block_buckets(data, edges, np.full(len(raw), len(data)), buckets)
    parts = [block_buckets(piece, np.array([0, len(piece)]), np.array([limit]), buckets) for piece, limit in _pieces(data)]
    if not parts:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return sum(x[0] for x in parts), np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts])


def _count(buckets: int):
    def count(batches):
        for chunk in chunks(batches, most=BLOCK_BYTES):
            n_words, docs, found = _block(chunk.column("text"), buckets)
            keys = np.sort(docs * buckets + found)
            n = np.bincount(docs, minlength=chunk.num_rows)
            edges = np.concatenate([[0], np.cumsum(n)])
            gaps = np.diff(keys % buckets, prepend=0)
            gaps[edges[:-1][n > 0]] = (keys % buckets)[edges[:-1][n > 0]]
            stored = pa.Array.from_buffers(pa.binary(), chunk.num_rows, [None, pa.py_buffer((edges * 2).astype(np.int32)), pa.py_buffer(gaps.astype("<u2"))])
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("_text_hash"), pa.array(n_words, pa.int64()), pa.array(n, pa.int64()), stored],
                ["doc_id", "_text_hash", "n_words", "n_features", "_gaps"],
            )

    return count


def _stored(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all documents, and where each document's begin."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    gaps = np.frombuffer(column.buffers()[2] or b"", "<u2")[edges[0] // 2 : edges[-1] // 2].astype(np.int64)
    edges = (edges - edges[0]) // 2
    sums = np.concatenate([[0], np.cumsum(gaps)])
    return sums[1:] - np.repeat(sums[edges[:-1]], np.diff(edges)), edges


def _total(buckets: int):
    def total(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in chunks(batches, "_gaps"):
            sums += np.bincount(_stored(batch.column("_gaps"))[0], minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], ["bucket", "n"])

    return total


def _weigh(gains: np.ndarray):
    def weigh(batches):
        for batch in chunks(batches, "_gaps"):
            found, edges = _stored(batch.column("_gaps"))
            sums = np.concatenate([[0], np.cumsum(gains[found])])
            weight = pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "_text_hash", "n_words", "n_features")], weight], ["doc_id", "_text_hash", "n_words", "n_features", "weight"])

    return weigh


# ---------------------------------------------------------------- Spark


def _counted(texts: DataFrame, buckets: int) -> DataFrame:
    text = F.col("text").cast("string")
    narrow = texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("_text_hash"), text.alias("text"))
    return narrow.mapInArrow(tidy(_count(buckets)), COUNTED)


def bucket_counts(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs; what comes to the driver are ``buckets`` numbers."""
    parts = counted.select("_gaps").mapInArrow(tidy(_total(buckets)), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share of the target over its smoothed share of the raw texts."""
    buckets = float(len(raw))
    up = (target + 1.0) * (float(raw.sum()) + buckets)
    return np.floor(1000 * np.log(up / ((raw + 1.0) * (float(target.sum()) + buckets)))).astype(np.int64)


def score_documents(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED, work: Work | None = None) -> DataFrame:
    """doc_id, _text_hash, n_words, n_features, weight and score of every document; ``target`` has a column text."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("1 to 65536 buckets")
    work = work or Work(docs.sparkSession, "importance")
    counted = work.save(_counted(docs, buckets), "counted")
    wanted = work.save(_counted(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), buckets), "target")
    gains = gains_of(bucket_counts(counted, buckets), bucket_counts(wanted, buckets))
    weighed = counted.mapInArrow(tidy(_weigh(gains)), "doc_id bigint, _text_hash bigint, n_words bigint, n_features bigint, weight bigint")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", (F.col("weight") + noise).cast("bigint"))


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, work: Work | None = None) -> DataFrame:
    """``scored`` with the rank of the documents drawn: floor(percent * N / 100) of the N with ``min_words`` words or more."""
    work = work or Work(scored.sparkSession, "importance")
    scored = work.save(scored, "scored")
    eligible = F.col("n_words") >= min_words
    wanted = scored.filter(eligible).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("weight"), F.col("n_features")]
    ranked = number_rows(scored.filter(eligible), [], order, out="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranked.unionByName(scored.filter(~eligible).withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED, work: Work | None = None) -> DataFrame:
    """The rows of ``docs`` that are drawn; rows with equal doc_id and text are drawn together."""
    work = work or Work(docs.sparkSession, "importance")
    drawn = draw(score_documents(docs, target, buckets, seed, work), percent, min_words, work).filter(F.col("rank").isNotNull())
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_hash"))
    return docs.join(drawn.select(F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash")), same, "left_semi")
