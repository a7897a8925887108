"""Repeated passages by window look-up, which stands in for greedy relative Lempel-Ziv parsing.

Every document is factored against all that comes earlier (smaller doc_id, or the same document
further up). A factor is a run of words that an earlier place has word for word; those of at least
``window`` words are duplicate spans. The index of earlier places is cut into reference blocks:

* A window of 20 words is filed under its anchor, the smallest hash among its 5-word grams. Equal
  windows have the same anchor, so they meet in the block that owns it, and only there. Consecutive
  windows mostly share their anchor and travel as one row of short fingerprints.
* Within a task windows are first looked up among its own documents; only the first place of a window
  leaves the task. A passage that a third of all documents share is one row per chunk in its block.
* A block of more than ``hold`` windows (its 5-word gram is frequent, but what surrounds it differs) is not
  held by the task that meets it. Its windows are stored and dealt again one by one, by anchor and
  fingerprint, sorted, and compared with the first place of each in passing.
* Hits whose next window continues the same earlier place are joined to one factor. No longest match is
  searched: every window is looked up on its own, so there are no boundaries to check, and a passage
  that greedy parsing would cut in two parts, each too short, is still found.

Windows are judged on the input, not on what is left. Two windows agree when their 64-bit anchors and
48-bit fingerprints do. Defined results: null and empty texts have no words; rows that share a doc_id
are documents of the same rank, neither is earlier than the other; a null doc_id comes before all
others. Other columns pass through and may have any name that does not start with an underscore.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from docfleet.llm.words import WordHash, chunks, grams, hashed, words_of
from docfleet.llm.work import Work

WINDOW = 20
GRAM = 5
PRINT_BYTES = 6
FIRST = -(2**63)  # stands for a null doc_id
HOLD = 1_000_000  # windows of one anchor that a task holds
RUN = 1_024  # windows of one row

RUNS = "_anchor bigint, _id bigint, _tag bigint, _at int, _prints binary, _src bigint, _srcat int"
FACTORS = "_id bigint, _tag bigint, _at int, _n int, _src bigint, _srcat int"
MET = f"{FACTORS}, _anchor bigint, _prints binary"
WINDOWS = "_anchor bigint, _print bigint, _id bigint, _tag bigint, _at int"


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs that begin where ``breaks`` is true."""
    start = np.flatnonzero(breaks)
    return start, np.diff(np.concatenate([start, [len(breaks)]]))


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_RUN_SCHEMA = pa.schema([
    ("_anchor", pa.int64()), ("_id", pa.int64()), ("_tag", pa.int64()), ("_at", pa.int32()), ("_prints", pa.binary()),
    ("_src", pa.int64()), ("_srcat", pa.int32()),
])
_FACTOR_SCHEMA = pa.schema([
    ("_id", pa.int64()), ("_tag", pa.int64()), ("_at", pa.int32()), ("_n", pa.int32()), ("_src", pa.int64()), ("_srcat", pa.int32()),
])
_MET_SCHEMA = pa.schema([*_FACTOR_SCHEMA, ("_anchor", pa.int64()), ("_prints", pa.binary())])
_WINDOW_SCHEMA = pa.schema([("_anchor", pa.int64()), ("_print", pa.int64()), ("_id", pa.int64()), ("_tag", pa.int64()), ("_at", pa.int32())])


def _local(window: int):
    """Runs of windows that are first in their chunk (with _prints), and factors found inside it (with _src)."""

    def parse(batches):
        cache = WordHash()
        for part in chunks(batches):
            ids = part.column("_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, tags = ids[order], part.column("_tag").to_numpy()[order]
            docs = [words_of(t) for t in part.column("text").take(pa.array(order)).to_pylist()]
            flat, starts = hashed(docs, cache)
            size = np.diff(starts)
            if not (size >= window).any():
                continue
            anchor = _smallest(grams(flat, GRAM), window - GRAM + 1)
            prints = grams(flat, window)
            doc = np.repeat(np.arange(len(docs)), size)[: len(prints)]
            at = np.arange(len(prints)) - starts[doc]
            inside = at + window <= size[doc]
            anchor, prints, doc, at = anchor[inside], prints[inside], doc[inside], at[inside]
            # the first place of each window; rows are in order of (doc_id, position)
            by = np.argsort(prints, kind="stable")
            start, n = _runs(np.concatenate([[True], prints[by][1:] != prints[by][:-1]]))
            source = np.empty(len(prints), np.int64)
            source[by] = np.repeat(by[start], n)
            earlier = (ids[doc] > ids[doc[source]]) | ((doc == doc[source]) & (at > at[source]))

            k = np.flatnonzero(earlier)
            if len(k):
                s = source[k]
                new = np.concatenate([[True], (np.diff(k) != 1) | (np.diff(s) != 1) | (np.diff(doc[k]) != 0) | (np.diff(doc[s]) != 0)])
                start, n = _runs(new)
                k, s = k[start], s[start]
                yield _rows(
                    _RUN_SCHEMA, _anchor=np.zeros(len(k), np.int64), _id=ids[doc[k]], _tag=tags[doc[k]], _at=at[k],
                    _prints=[int(x).to_bytes(4, "little") for x in n], _src=ids[doc[s]], _srcat=at[s],
                )
            k = np.flatnonzero(~earlier)
            new = np.concatenate([[True], (np.diff(k) != 1) | (np.diff(doc[k]) != 0) | (anchor[k][1:] != anchor[k][:-1]) | (at[k][1:] % RUN == 0)])
            start, n = _runs(new)
            packed = np.ascontiguousarray(prints[k]).view(np.uint8).reshape(-1, 8)[:, :PRINT_BYTES].tobytes()
            ends = (np.cumsum(n) * PRINT_BYTES).tolist()
            k = k[start]
            for a in range(0, len(k), 20_000):
                b = min(a + 20_000, len(k))
                own = k[a:b]
                cut = [packed[x:y] for x, y in zip(([0] + ends)[a:b], ends[a:b])]
                yield _rows(
                    _RUN_SCHEMA, _anchor=anchor[own].view(np.int64), _id=ids[doc[own]], _tag=tags[doc[own]], _at=at[own],
                    _prints=cut, _src=pa.nulls(b - a, pa.int64()), _srcat=pa.nulls(b - a, pa.int32()),
                )

    return parse


def _unpacked(prints: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Windows of each row, and the fingerprints of all rows one after the other."""
    n = pc.binary_length(prints).to_numpy(zero_copy_only=False).astype(np.int64) // PRINT_BYTES
    raw = np.zeros((int(n.sum()), 8), np.uint8)
    raw[:, :PRINT_BYTES] = np.frombuffer(b"".join(prints.to_pylist()), np.uint8).reshape(-1, PRINT_BYTES)
    return n, raw.view(np.uint64).ravel()


def _met(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Factors in the form of MET."""
    none = [pa.nulls(rows.num_rows, pa.int64()), pa.nulls(rows.num_rows, pa.binary())]
    return pa.RecordBatch.from_arrays([*rows.columns, *none], schema=_MET_SCHEMA)


def _put_off(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Runs of an anchor that no task can hold, in the form of MET."""
    return _rows(
        _MET_SCHEMA, _id=rows.column("_id"), _tag=rows.column("_tag"), _at=rows.column("_at"), _n=np.zeros(rows.num_rows, np.int32),
        _src=rows.column("_src"), _srcat=rows.column("_srcat"), _anchor=rows.column("_anchor"), _prints=rows.column("_prints"),
    )


def _block(batches, hold: int):
    """Factors found in the reference blocks; rows are sorted by anchor, so one anchor's rows are together."""

    def solve(table: pa.Table):
        n, prints = _unpacked(table.column("_prints"))
        row = np.repeat(np.arange(len(n)), n)
        anchor, ids, tags, first = (table.column(c).to_numpy() for c in ("_anchor", "_id", "_tag", "_at"))
        at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        # only windows that another row has, too
        key = grams_key(anchor[row].view(np.uint64), prints)
        doc, tag = ids[row], tags[row]
        by = np.lexsort((at, tag, doc, key))
        new = np.concatenate([[True], key[by][1:] != key[by][:-1]])
        start, m = _runs(new)
        source = np.repeat(by[start], m)
        start, m = _runs(new | np.concatenate([[True], (doc[by][1:] != doc[by][:-1]) | (tag[by][1:] != tag[by][:-1])]))
        own = np.repeat(by[start], m)
        above = doc[by] > doc[source]
        earlier = above | (at[by] > at[own])
        k, s = by[earlier], np.where(above, source, own)[earlier]
        if not len(k):
            return
        order = np.argsort(k)
        k, s = k[order], s[order]
        new = np.concatenate([[True], (np.diff(k) != 1) | (np.diff(s) != 1) | (np.diff(row[k]) != 0) | (np.diff(row[s]) != 0)])
        start, m = _runs(new)
        k, s = k[start], s[start]
        yield _met(_rows(
            _FACTOR_SCHEMA, _id=doc[k], _tag=tags[row[k]], _at=at[k], _n=m, _src=doc[s], _srcat=at[s],
        ))

    # rows of the last anchor, how many windows it had so far, and whether its rows are put off
    held: list[pa.RecordBatch] = []
    last, count, off = None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("_anchor").to_numpy()
        total = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("_prints")).to_numpy().astype(np.int64) // PRINT_BYTES)])
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        # the first and the last anchor may have more rows in other batches; those between are solved together as far as they fit
        a = 0
        while a < len(cuts) - 1:
            if a in (0, len(cuts) - 2):
                b = a + 1
            else:
                b = int(np.searchsorted(total[cuts], total[cuts[a]] + hold, "right")) - 1
                b = min(max(b, a + 1), len(cuts) - 2)
            part, n = batch.slice(int(cuts[a]), int(cuts[b] - cuts[a])), int(total[cuts[b]] - total[cuts[a]])
            if last != key[cuts[a]]:
                if held:
                    yield from solve(pa.Table.from_batches(held))
                held, last, count, off = [], key[cuts[a]], 0, False
            count += n
            if b > a + 1:
                yield from solve(pa.Table.from_batches([part]))
                last, count = None, 0
            elif count > hold:
                yield from map(_put_off, [*held, part])
                held, off = [], True
            else:
                held.append(part)
            a = b
    if held:
        yield from solve(pa.Table.from_batches(held))


def _windows(batches):
    """One row per window of the runs that were put off."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            n, prints = _unpacked(part.column("_prints"))
            row = np.repeat(np.arange(len(n)), n)
            anchor, ids, tags, first = (part.column(c).to_numpy() for c in ("_anchor", "_id", "_tag", "_at"))
            yield _rows(
                _WINDOW_SCHEMA, _anchor=anchor[row], _print=prints.view(np.int64), _id=ids[row], _tag=tags[row],
                _at=first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n),
            )


def _first_places(batches):
    """Windows that have an earlier place; rows are sorted by window, then id, tag and position."""
    carry = None  # the last row, and the first rows of its window and of its document's part of it
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, prints, ids, tags, at = (batch.column(c).to_numpy() for c in _WINDOW_SCHEMA.names)
        if carry is not None:
            (anchor, prints, ids, tags, at) = (np.concatenate([[r[c] for r in carry], x]) for c, x in enumerate((anchor, prints, ids, tags, at)))
        window = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (prints[1:] != prints[:-1])])
        own = window | np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
        start, n = _runs(window)
        first = np.repeat(start, n)
        start, n = _runs(own)
        first_own = np.repeat(start, n)
        again = ids > ids[first]
        source = np.where(again, first, first_own)
        again |= at > at[first_own]
        if carry is not None:
            again[: len(carry)] = False
        k = np.flatnonzero(again)
        if len(k):
            yield _rows(_FACTOR_SCHEMA, _id=ids[k], _tag=tags[k], _at=at[k], _n=np.ones(len(k), np.int32), _src=ids[source[k]], _srcat=at[source[k]])
        carry = [tuple(int(c[i]) for c in (anchor, prints, ids, tags, at)) for i in (first[-1], first_own[-1])]


def _joined(batches):
    """Windows that continue each other as one factor; rows are sorted by document and position."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, tags, at, _, src, srcat = (batch.column(c).to_numpy() for c in _FACTOR_SCHEMA.names)
        new = (np.diff(ids) != 0) | (np.diff(tags) != 0) | (np.diff(at) != 1) | (np.diff(src) != 0) | (np.diff(srcat) != 1)
        k, n = _runs(np.concatenate([[True], new]))
        yield _rows(_FACTOR_SCHEMA, _id=ids[k], _tag=tags[k], _at=at[k], _n=n, _src=src[k], _srcat=srcat[k])


def grams_key(anchor: np.ndarray, prints: np.ndarray) -> np.ndarray:
    return anchor * np.uint64(0x9E3779B97F4A7C15) ^ prints


def _keys() -> list[Column]:
    """Rank of a document, and a hash of its text that tells documents of one rank apart."""
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST)).alias("_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_tag")]


def factors(docs: DataFrame, window: int = WINDOW, work: Work | None = None, hold: int = HOLD) -> DataFrame:
    """Runs of windows that an earlier place has: _id, _tag (of the text), _at, _n (windows), _src, _srcat."""
    work = work or Work(docs.sparkSession, "substring_dedup")
    keyed = docs.select(*_keys(), F.col("text").cast("string").alias("text"))
    parsed = keyed.mapInArrow(_local(window), RUNS)
    # factors found on the spot pass through the blocks' tasks untouched: their anchor is 0 and _src is set
    split = parsed.withColumn("_block", F.when(F.col("_src").isNull(), F.col("_anchor")).otherwise(F.xxhash64("_id", "_at")))

    def block(batches):
        def filed():
            for batch in batches:
                yield batch

        held_out: list[pa.RecordBatch] = []

        def indexed():
            for batch in filed():
                found = batch.column("_src").is_valid()
                done = batch.filter(found)
                if done.num_rows:
                    n = [int.from_bytes(x, "little") for x in done.column("_prints").to_pylist()]
                    held_out.append(_met(_rows(
                        _FACTOR_SCHEMA, _id=done.column("_id"), _tag=done.column("_tag"), _at=done.column("_at"), _n=n,
                        _src=done.column("_src"), _srcat=done.column("_srcat"),
                    )))
                yield batch.filter(pc.invert(found))

        for out in _block(indexed(), hold):
            yield from held_out
            held_out.clear()
            yield out
        yield from held_out

    met = split.repartition(F.col("_block")).sortWithinPartitions("_block").drop("_block")
    found = work.save(met.mapInArrow(block, MET), "factors")
    late = found.filter("_prints IS NOT NULL")
    found = found.filter("_prints IS NULL").drop("_anchor", "_prints")
    if late.isEmpty():
        return found
    dealt = late.select("_anchor", "_prints", "_id", "_tag", "_at").mapInArrow(_windows, WINDOWS).repartition("_anchor", "_print")
    again = dealt.sortWithinPartitions("_anchor", "_print", "_id", "_tag", "_at").mapInArrow(_first_places, FACTORS)
    runs = again.repartition("_id", "_tag").sortWithinPartitions("_id", "_tag", "_at").mapInArrow(_joined, FACTORS)
    return found.unionByName(work.save(runs, "late"))


def _cut(window: int):
    def cut(batches):
        for part in chunks(batches):
            out = {"_words": [], "_removed": [], "_kept": []}
            for text, spans in zip(part.column("text").to_pylist(), part.column("_spans").to_pylist()):
                words = words_of(text)
                if spans:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for s in spans:
                        gone[s["_at"]] += 1
                        gone[s["_at"] + s["_n"] + window - 1] -= 1
                    keep = np.cumsum(gone[:-1]) == 0
                    left = [w for w, k in zip(words, keep.tolist()) if k]
                else:
                    left = words
                out["_words"].append(len(words))
                out["_removed"].append(len(words) - len(left))
                out["_kept"].append(b" ".join(left).decode("utf-8", "surrogatepass"))
            rest = [n for n in part.schema.names if n not in ("_spans", "text")]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in rest), pa.array(out["_words"], pa.int64()), pa.array(out["_removed"], pa.int64()), pa.array(out["_kept"], pa.string())],
                [*rest, "_words", "_removed", "_kept"],
            )

    return cut


def remove_repeats(docs: DataFrame, window: int = WINDOW, work: Work | None = None, hold: int = HOLD) -> DataFrame:
    """The rows with text replaced by the kept words joined by one space, and n_words and n_removed added."""
    work = work or Work(docs.sparkSession, "substring_dedup")
    found = factors(docs, window, work, hold)
    # a set, since rows that are alike have the same spans
    spans = found.groupBy("_id", "_tag").agg(F.collect_set(F.struct("_at", "_n")).alias("_spans"))
    rest = [c for c in docs.columns if c not in ("text", "n_words", "n_removed")]
    joined = docs.select(*rest, F.col("text").cast("string").alias("text"), *_keys()).join(spans, ["_id", "_tag"], "left").drop("_id", "_tag")
    types = dict(joined.select(rest).dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in rest), "_words bigint, _removed bigint, _kept string"])
    cut = joined.mapInArrow(_cut(window), schema)
    return cut.select(*rest, F.col("_kept").alias("text"), F.col("_words").alias("n_words"), F.col("_removed").alias("n_removed"))
