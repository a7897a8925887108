"""Similarity join on word shingles: rare-first prefix filtering with length, positional and suffix filters.

A document is the set of its distinct shingles of ``k`` words (A-Z lower-cased); one with fewer words
is one shingle, its whole sequence; one without words is empty and linked with nothing. Two documents
link when 100 * intersection >= percent * union.

1. The shingles of all documents are counted, by sorted runs that are added up per range of hashes. What
   is kept is a table of ``CELLS`` cells with the class (a power of two) of the most frequent shingle in
   each. It gives the order "rare first"; ties are ordered by hash. A shingle that occurs once never makes
   another one look frequent, and one whose cell has only such is in one document and meets nothing.
   The prefix filter is exact under any order that all documents share, so the classes decide the
   speed only.
2. Documents with equal sets are folded to one class. A class emits its prefix, the rarest
   n - ceil(t*n) + 1 shingles, without those of one document.
3. Prefixes meet by shingle. In a shingle's group every member is compared with one member only, the
   pivot, and a member of several groups with the smallest of its pivots, so near copies cost their
   number and not its square. Pairs pass the length filter, the
   positional filter and the suffix filter (parity bits, then counts per hash range, bound from below
   how much the sets differ); what is left is verified once per pair on the whole sets.
4. Groups that these links leave in several components are compared with their own pivot, with ``PIVOTS``
   more from outside the first component and three times as many of any, where labels differ. Members that are still apart are compared with each other, pairs of a component left out, and pass
   all filters before a pair is written. Groups above ``TILE`` members are cut into tiles of pairs of
   blocks. No link between different components is lost, and links within one change nothing.
5. Components of the links name each document by the smallest doc_id it can reach.

Shingles are told apart by 64-bit hashes. Defined results: rows with the same doc_id are one document
for linking; a row without doc_id links with nothing. Other columns pass through and may have any
name that does not start with an underscore. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType

from docfleet.llm.components import smallest_reachable
from docfleet.llm.words import WordHash, chunks, grams, hashed, tidy, words_of
from docfleet.llm.work import Work

K = 5
PERCENT = 80
#: Shingles are counted by their first 40 bits; a cell is told by the first 24.
KEY_BITS, CELLS = 40, 1 << 24
RUN_KEYS = 1 << 20
RANGE_ROWS_PER_DOC = 512
#: Further pivots of a group from outside its first component, and three times as many of any component,
#: before its members are compared with each other.
PIVOTS = 3
BLOCK = 1 << 12
TILE = 2048


def shingle_sets(texts: list, k: int, cache: WordHash) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    docs = [words_of(t, lower=True) for t in texts]
    flat, starts = hashed(docs, cache)
    of_run = grams(flat, k)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= k:
            yield np.unique(of_run[a : b - k + 1])
        elif b > a:
            yield grams(flat[a:b], b - a)[:1]
        else:
            yield np.zeros(0, np.uint64)


def fixed_table(df: DataFrame, fill, dtype: str, size: int, wide: str, merge) -> np.ndarray:
    """A table of ``size`` numbers that ``fill`` makes from the batches of a task, merged over all tasks.

    Tasks send the blocks that have anything in them; these are merged block by block, in two steps,
    and only the finished table, of the same size at any input, comes to the driver.
    """

    def make(batches):
        total = fill(batches)
        for block in range(-(-size // BLOCK)):
            own = total[block * BLOCK : (block + 1) * BLOCK]
            if own.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "n": [own.astype(dtype).tobytes()]})

    def merged(kind: str):
        def one(table: pa.Table) -> pa.Table:
            total = None
            for x in table.column("n").to_pylist():
                part = np.frombuffer(x, kind).astype(wide)
                total = part if total is None else merge(total, part)
            return pa.table({"block": pa.array(table.column("block").to_pylist()[:1], pa.int32()), "n": [total.tobytes()]})

        return one

    parts = df.mapInArrow(tidy(make), "block int, n binary").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    halfway = parts.groupBy("block", "part").applyInArrow(merged(dtype), "block int, n binary")
    total = np.zeros(size, wide)
    for row in halfway.groupBy("block").applyInArrow(merged(wide), "block int, n binary").collect():
        total[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["n"], wide)
    return total


def _key_runs(k: int, bits: int):
    """Per range of keys: the sorted keys of a stretch of documents as packed gaps, and how often each occurs."""

    def packed(keys: np.ndarray) -> pa.RecordBatch:
        keys, counts = np.unique(keys, return_counts=True)
        edges = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS - bits))
        ranges, gaps, times = [], [], []
        for r in np.flatnonzero(np.diff(edges)).tolist():
            own = keys[edges[r] : edges[r + 1]] & np.uint64((1 << KEY_BITS - bits) - 1)
            ranges.append(r)
            # bytes of one weight side by side: the upper ones are nearly all zero
            planes = np.diff(own, prepend=np.uint64(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
            gaps.append(pa.compress(planes.tobytes(), "zstd", asbytes=True))
            times.append(pa.compress(counts[edges[r] : edges[r + 1]].astype("<u4").tobytes(), "zstd", asbytes=True))
        sizes = np.diff(edges)[ranges]
        return pa.RecordBatch.from_pydict({"range": pa.array(ranges, pa.int32()), "size": pa.array(sizes, pa.int64()), "gaps": pa.array(gaps, pa.binary()), "times": pa.array(times, pa.binary())})

    def runs(batches):
        cache, held, n = WordHash(), [], 0
        for part in chunks(batches):
            sets = np.concatenate([*shingle_sets(part.column("text").to_pylist(), k, cache)]) >> np.uint64(64 - KEY_BITS)
            held.append(sets)
            n += len(sets)
            if n >= RUN_KEYS:
                yield packed(np.concatenate(held))
                held, n = [], 0
        if n:
            yield packed(np.concatenate(held))

    return runs


def _classes(bits: int):
    """Cells of one range of keys: the largest class of a shingle in the cell, 0 if none is in two documents."""

    def classes(key, runs):
        keys, counts = [], []
        for size, gaps, times in zip(*(runs.column(c).to_pylist() for c in ("size", "gaps", "times"))):
            planes = np.frombuffer(pa.decompress(gaps, 4 * size, "zstd", asbytes=True), np.uint8).reshape(4, -1)
            keys.append(np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint64))
            counts.append(np.frombuffer(pa.decompress(times, 4 * size, "zstd", asbytes=True), "<u4"))
        keys, counts = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        total = np.add.reduceat(counts[order], first)
        several = total > 1
        cells = np.zeros(CELLS >> bits, np.uint8)
        at = (keys[first][several] >> np.uint64(KEY_BITS - CELLS.bit_length() + 1)).astype(np.int64)
        np.maximum.at(cells, at, np.ceil(np.log2(total[several])).astype(np.uint8))
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([pa.compress(cells.tobytes(), "zstd", asbytes=True)], pa.binary())})

    return classes


def shingle_classes(docs: DataFrame, k: int = K) -> np.ndarray:
    """For each cell of shingle hashes, how frequent its most frequent shingle is.

    Every shingle is counted: stretches of documents give sorted runs of keys, the runs of a range of
    keys meet in one task and are added up. A cell's class is 0 if each of its shingles is in one
    document, else the count as a power of two, rounded up. The driver gets ``CELLS`` bytes.
    """
    bits = max(8, min(CELLS.bit_length() - 1, (docs.count() * RANGE_ROWS_PER_DOC // RUN_KEYS).bit_length()))
    runs = docs.select("text").mapInArrow(tidy(_key_runs(k, bits)), "range int, size bigint, gaps binary, times binary")
    found = runs.groupBy("range").applyInArrow(_classes(bits), "range int, cells binary")
    width = CELLS >> bits
    out = np.zeros(CELLS, np.uint8)
    for row in found.collect():  # CELLS bytes at most, packed
        out[row["range"] * width : (row["range"] + 1) * width] = np.frombuffer(pa.decompress(bytes(row["cells"]), width, "zstd", asbytes=True), np.uint8)
    return out


def some_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose _id is in ``ids``, and a few others.

    The ids set bits in a table of fixed size, so texts are not shuffled to find the few that are
    wanted. Rows that pass by chance find no partner in the joins that follow.
    """

    def fill(batches):
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            p = batch.column(0).to_numpy()
            np.bitwise_or.at(bits, p >> 3, (128 >> (p & 7)).astype(np.uint8))
        return bits

    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    table = fixed_table(ids.select(place("_id").alias("p")), fill, "u1", FILTER_BITS // 8, "u1", np.bitwise_or)
    bits = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(BooleanType())
    def passes(at: pd.Series) -> pd.Series:
        p = at.to_numpy()
        return pd.Series(bits.value[p >> 3] & (128 >> (p & 7)).astype(np.uint8) != 0)

    return docs.filter(passes(place("_id")))


RANGES = 256
FILTER_BITS = 1 << 27
SET_ROW = "_id bigint, _text bigint, _n int, _key binary, _parity bigint, _ranges binary, _first int, _prefix binary"


def _set_rows(classes, k: int, percent: int):
    shift = np.uint64(64 - CELLS.bit_length() + 1)

    def rows(batches):
        cache, rank = WordHash(), classes.value
        for part in chunks(batches):
            n, key, parity, ranges, first, prefix = [], [], [], [], [], []
            for s in shingle_sets(part.column("text").to_pylist(), k, cache):
                size = len(s)
                n.append(size)
                key.append(xxhash.xxh3_128_digest(s.tobytes()) if size else None)
                spread = np.bincount(s >> np.uint64(56), minlength=RANGES)
                ranges.append(np.minimum(spread, 255).astype(np.uint8).tobytes())
                bits = spread.reshape(64, -1).sum(axis=1) & 1
                parity.append(int(np.packbits(bits.astype(np.uint8)).view(">i8")[0]))
                length = size - -(-percent * size // 100) + 1 if size else 0
                rarity = rank[(s >> shift).astype(np.int64)]
                order = np.argsort(rarity, kind="stable")[:length]
                # shingles of one document come first and meet nothing
                alone = int((rarity[order] == 0).sum())
                first.append(alone)
                prefix.append(s[order[alone:]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("_text"), pa.array(n, pa.int32()), pa.array(key, pa.binary()), pa.array(parity, pa.int64()), pa.array(ranges, pa.binary()), pa.array(first, pa.int32()), pa.array(prefix, pa.binary())],
                ["_id", "_text", "_n", "_key", "_parity", "_ranges", "_first", "_prefix"],
            )

    return rows


def _may_link(a: dict, b: dict, percent: int) -> np.ndarray:
    """Length, positional and suffix filter; ``a`` and ``b`` hold arrays n, pos and parity."""
    na, nb = a["n"].astype(np.int64), b["n"].astype(np.int64)
    need = -(-percent * (na + nb) // (100 + percent))  # smallest intersection that links
    # a pair that links passes at its first common shingle, where nothing before it is shared
    ok = np.minimum(na - a["pos"], nb - b["pos"]) >= need
    ok &= 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
    differ = np.bitwise_count((a["parity"] ^ b["parity"]).view(np.uint64)).astype(np.int64)  # at most the size of the symmetric difference
    return ok & (na + nb - differ >= 2 * need)


def _may_link_natively(percent: int):
    """The same for columns _n, _pos, _parity and _pn, _ppos, _pparity."""
    both = F.col("_n") + F.col("_pn")
    need = F.ceil(both * percent / F.lit(100.0 + percent) - F.lit(1e-9))
    left, right = F.col("_n") - F.col("_pos"), F.col("_pn") - F.col("_ppos")
    alike = F.least("_n", "_pn") * 100 >= F.greatest("_n", "_pn") * percent
    return (F.least(left, right) >= need) & alike & (both - F.bit_count(F.col("_parity").bitwiseXOR(F.col("_pparity"))) >= 2 * need)


_GROUP = ["_token", "_id", "_n", "_pos", "_parity"]


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Tables that end where a group ends, from rows sorted by ``by``."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(by)
        if held and key[0].as_py() != held[-1].column(by)[-1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        values = key.to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(values, values[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _columns(table: pa.Table) -> dict:
    return {c: table.column(c).to_numpy() for c in table.column_names}  # bytes as objects


def _with_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of groups of two and more, each with the pivot of its group, its first row.

    Of a group only the pivot is held, so a group of any size streams through.
    """
    held: dict | None = None  # the last row's pivot
    alone = False  # whether that pivot is the only row of its group so far
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _columns(pa.Table.from_batches([batch]))
        goes_on = held is not None and x["_token"][0] == held["_token"][0]
        if goes_on and alone:
            x = {c: np.concatenate([held[c], x[c]]) for c in _GROUP}
            goes_on = False
        token, rows = x["_token"], len(x["_token"])
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        n = np.diff(np.concatenate([first, [rows]]))
        pivot = {c: np.repeat(x[c][first], n) for c in _GROUP}
        size = np.repeat(n, n)
        if goes_on:
            for c in _GROUP:
                pivot[c][: n[0]] = held[c]
            size[: n[0]] += 1
        held = {c: pivot[c][-1:].copy() for c in _GROUP}
        alone = size[-1] == 1
        keep = size > 1
        if keep.any():
            out = {c: x[c][keep] for c in _GROUP} | {f"_p{c[1:]}": pivot[c][keep] for c in _GROUP[1:]}
            yield pa.RecordBatch.from_pydict(out)


def _tile_pairs(percent: int):
    def pairs(batches):
        """Pairs of one tile that pass the filters and are not of one component."""
        for table in _groups(batches, "_tile"):
            x = _columns(table)
            _, first, n = np.unique(x["_tile"], return_index=True, return_counts=True)
            for at, m in zip(first.tolist(), n.tolist()):
                own = {c: v[at : at + m] for c, v in x.items()}
                order = np.argsort(own["_n"], kind="stable")
                own = {c: v[order] for c, v in own.items()}
                shape = np.frombuffer(b"".join(own["_ranges"]), np.uint8).reshape(m, RANGES).astype(np.int16)
                most = own["_n"].astype(np.int64) * 100 // percent
                ends = np.searchsorted(own["_n"], most, side="right")
                left, right = [], []
                for i in range(m):
                    j = np.arange(i + 1, ends[i])
                    if not len(j):
                        continue
                    j = j[own["_label"][j] != own["_label"][i]]
                    a = {c: own[f"_{c}"][i : i + 1] for c in ("n", "pos", "parity")}
                    b = {c: own[f"_{c}"][j] for c in ("n", "pos", "parity")}
                    # a pair of two members of one block belongs to the block's own tile
                    mine = (own["_same"][i] == 1) | (own["_block"][j] != own["_block"][i])
                    j = j[_may_link(a, b, percent) & mine]
                    if len(j):
                        both = int(own["_n"][i]) + own["_n"][j].astype(np.int64)
                        differ = np.abs(shape[j] - shape[i]).sum(axis=1)
                        j = j[both - differ >= 2 * -(-percent * both // (100 + percent))]
                    left.append(np.full(len(j), own["_id"][i]))
                    right.append(own["_id"][j])
                if left:
                    a, b = np.concatenate(left), np.concatenate(right)
                    yield pa.RecordBatch.from_pydict({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return pairs


def _shuffled(df: DataFrame, by: str) -> DataFrame:
    return df.repartition(F.col(by)).sortWithinPartitions(by, "_id")


def _close(pairs: DataFrame, shapes: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass the suffix filter: sets differ at least by what their counts per hash range differ."""

    @F.pandas_udf(BooleanType())
    def passes(na: pd.Series, ra: pd.Series, nb: pd.Series, rb: pd.Series) -> pd.Series:
        if not len(na):
            return pd.Series([], dtype=bool)
        rows = lambda r: np.frombuffer(b"".join(r), np.uint8).reshape(-1, RANGES).astype(np.int16)
        both = na.to_numpy(np.int64) + nb.to_numpy(np.int64)
        differ = np.abs(rows(ra) - rows(rb)).sum(axis=1)
        return pd.Series(both - differ >= 2 * -(-percent * both // (100 + percent)))

    right = shapes.select(F.col("_id").alias("b"), F.col("_n").alias("_nb"), F.col("_ranges").alias("_rb"))
    left = shapes.select(F.col("_id").alias("a"), F.col("_n").alias("_na"), F.col("_ranges").alias("_ra"))
    return pairs.join(right, "b").join(left, "a").filter(passes("_na", "_ra", "_nb", "_rb")).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets link; natively, one pair per row."""
    right = sets.select(F.col("_id").alias("b"), F.col("_set").alias("_sb"))
    left = sets.select(F.col("_id").alias("a"), F.col("_set").alias("_sa"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("_sa", "_sb"))
    linked = 100 * shared >= percent * (F.size("_sa") + F.size("_sb") - shared)
    return both.filter(linked).select("a", "b").distinct()


def link_documents(docs: DataFrame, k: int = K, percent: int = PERCENT, work: Work | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, class_id, component_id."""
    spark = docs.sparkSession
    work = work or Work(spark, "jaccard_join")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_text"))
    classes = spark.sparkContext.broadcast(shingle_classes(narrow, k))
    sets = work.save(narrow.mapInArrow(tidy(_set_rows(classes, k, percent)), SET_ROW), "sets")
    classes.destroy()

    folded = (
        sets.filter("_n > 0 AND _id IS NOT NULL").groupBy("_key")
        .agg(F.min("_id").alias("_class"), F.count(F.lit(1)).alias("_rows"))
    )
    named = work.save(
        sets.select("_id", "_text", "_n", "_key").join(folded.filter("_rows > 1").drop("_rows"), "_key", "left")
        .select("_id", "_text", "_n", F.when((F.col("_n") > 0) & F.col("_id").isNotNull(), F.coalesce("_class", "_id")).alias("_class")),
        "named",
    )
    # a class is shown by its smallest id
    chosen = (
        sets.filter("_n > 0 AND _id IS NOT NULL").join(folded.filter("_rows > 1").drop("_rows"), "_key", "left")
        .filter("_class IS NULL OR _class = _id")
    )

    def postings(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            prefixes = [np.frombuffer(p, np.uint64) for p in batch.column("_prefix").to_pylist()]
            n = np.array([len(p) for p in prefixes])
            repeat = lambda c: np.repeat(batch.column(c).to_numpy(), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + repeat("_first")
            whole = pa.RecordBatch.from_pydict({
                "_token": np.concatenate(prefixes).view(np.int64), "_id": repeat("_id"), "_n": repeat("_n"),
                "_pos": at.astype(np.int32), "_parity": repeat("_parity"),
            })
            for start in range(0, whole.num_rows, 50_000):
                yield whole.slice(start, 50_000)

    rows = "_token bigint, _id bigint, _n int, _pos int, _parity bigint"
    shapes = work.save(chosen.select("_id", "_n", "_ranges"), "shapes")
    posted = _shuffled(chosen.select("_id", "_n", "_parity", "_first", "_prefix").mapInArrow(postings, rows), "_token")
    met = work.save(
        posted.mapInArrow(_with_pivots, f"{rows}, _pid bigint, _pn int, _ppos int, _pparity bigint"), "met"
    )
    work.drop("sets")

    def pivot_pairs(batches):
        for batch in batches:
            x = _columns(pa.Table.from_batches([batch]))
            ok = _may_link(
                {"n": x["_n"], "pos": x["_pos"], "parity": x["_parity"]},
                {"n": x["_pn"], "pos": x["_ppos"], "parity": x["_pparity"]}, percent,
            ) & (x["_id"] != x["_pid"])
            yield pa.RecordBatch.from_pydict({"m": x["_id"][ok], "p": x["_pid"][ok]})

    # each member is tried with the smallest of its pivots first; the others matter only where that leaves it apart
    tried = met.mapInArrow(pivot_pairs, "m bigint, p bigint").groupBy("m").agg(F.min("p").alias("p"))
    tried = tried.select(F.least("m", "p").alias("a"), F.greatest("m", "p").alias("b")).distinct()
    first = work.save(_close(tried, shapes, percent), "pairs1")
    # whole sets of the documents in a pair, and of no others

    def whole_sets(batches):
        cache = WordHash()
        for part in chunks(batches):
            found = [s.view(np.int64) for s in shingle_sets(part.column("text").to_pylist(), k, cache)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            values = pa.array(np.concatenate(found), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.ListArray.from_arrays(pa.array(offsets), values)], ["_id", "_set"]
            )

    def sets_for(pairs: DataFrame, name: str) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct()
        return work.save(some_of(narrow.filter("_id IS NOT NULL"), wanted).select("_id", "text").mapInArrow(whole_sets, "_id bigint, _set array<bigint>"), name)

    sets1 = sets_for(first, "sets1")
    links = work.save(_verified(first, sets1, percent), "links1")
    work.drop("sets1")
    labels = smallest_reachable(links, work, "labels1")

    def labelled(members: DataFrame) -> DataFrame:
        """Members of the groups that still have several labels, with their own and their group's smallest label."""
        own = (
            members.select("_token", "_id", "_n", "_pos", "_parity")
            .join(labels.select(F.col("id").alias("_id"), "label"), "_id", "left")
            .withColumn("_label", F.coalesce("label", "_id")).drop("label")
        )
        several = own.groupBy("_token").agg(F.min("_label").alias("_l0"), F.max("_label").alias("_l1"), F.count(F.lit(1)).alias("_members"))
        return own.join(several.filter("_l0 <> _l1").drop("_l1"), "_token")

    def relabelled(more: DataFrame, name: str) -> DataFrame:
        known = labels.filter("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b"))
        return smallest_reachable(known.unionByName(more), work, name)

    apart = work.save(labelled(met), "apart0")
    work.drop("met")
    # the group's own pivot, any members, and some outside its first component are the next pivots of all not joined with them
    seen = F.struct(*[F.col(c).alias(f"_p{c[1:]}") for c in ("_id", "_n", "_pos", "_parity", "_label")])
    outside = F.col("_label") != F.col("_l0")
    by_chance = lambda k: F.struct(F.xxhash64(F.lit(k), "_id"), F.col("_id"))
    drawn = [F.min_by(seen, F.when(outside, by_chance(k)) if k <= PIVOTS else by_chance(k)) for k in range(1, 4 * PIVOTS + 1)]
    chosen = apart.groupBy("_token").agg(F.array_distinct(F.array(F.min_by(seen, "_id"), *drawn)).alias("_p"))
    pivots = chosen.select("_token", F.explode("_p").alias("_p")).select("_token", "_p.*")
    tried = apart.join(pivots, "_token").filter((F.col("_label") != F.col("_plabel")) & _may_link_natively(percent))
    pairs = tried.select(F.least("_id", "_pid").alias("a"), F.greatest("_id", "_pid").alias("b")).distinct()
    close = work.save(_close(pairs, shapes, percent), "pairs_more")
    found = work.save(_verified(close, sets_for(close, "sets_more"), percent), "links_more")
    work.drop("sets_more")
    if not found.isEmpty():
        labels = relabelled(found, "labels_more")
        apart = work.save(labelled(apart), "apart1")
        work.drop("apart0")

    tiles = (
        apart.withColumn("_blocks", F.ceil(F.col("_members") / TILE).cast("int"))
        .withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int"))
        .join(shapes.select("_id", "_ranges"), "_id")
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_same", (F.col("_block") == F.col("_other")).cast("int"))
        .withColumn("_tile", F.xxhash64("_token", F.least("_block", "_other"), F.greatest("_block", "_other")))
        .select("_tile", "_id", "_n", "_pos", "_parity", "_label", "_block", "_same", "_ranges")
    )
    second = work.save(_shuffled(tiles, "_tile").mapInArrow(_tile_pairs(percent), "a bigint, b bigint").distinct(), "pairs2")
    work.drop("shapes")
    links2 = work.save(_verified(second, sets_for(second, "sets2"), percent), "links2")
    work.drop("sets2")
    final = relabelled(links2, "labels2")
    # a class takes the smallest id of its component; its members follow it
    follow = named.join(final.select(F.col("id").alias("_class"), "label"), "_class", "left")
    return follow.select(
        F.col("_id").alias("doc_id"), F.col("_n").cast("bigint").alias("n_shingles"), F.col("_class").alias("class_id"),
        F.col("_text").alias("text_hash"),
        F.coalesce("label", "_class", "_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = K, percent: int = PERCENT, work: Work | None = None) -> DataFrame:
    """The row with the smallest doc_id of each component, with the columns of ``docs``."""
    linked = link_documents(docs, k, percent, work)
    gone = linked.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone"), "text_hash").distinct()
    same = (F.col("doc_id") == F.col("_gone")) & (F.xxhash64(F.col("text").cast("string")) == F.col("text_hash"))
    return docs.join(gone, same, "left_anti")
