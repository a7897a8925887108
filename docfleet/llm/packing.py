"""Best-fit packing into sequences of fixed length, as a tree of residuals.

Each task tokenises its documents, cuts those longer than a sequence into pieces and packs the pieces
best-fit, largest first, in lots of bounded size. Bins that are nearly full are emitted. The others go
up a tree as items: a node takes the underfull bins of several lots and packs these best-fit again.
Every round asks for less to emit a bin, so a round that finds nothing to merge ends as well, and a
node never takes more than ``NODE_ITEMS`` items. Nothing is dropped: a bin that cannot be filled is
emitted underfull.

A document is the ids of its text followed by ``end_id``. Defined results: a null text is empty, and
an empty one is a piece of one token. Rows with the same doc_id are packed each on its own. Other
columns take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docfleet.llm.words import chunks, tidy
from docfleet.llm.work import Work

LENGTH = 2048
LOT_ITEMS = 65_536
NODE_ITEMS = 65_536
FAN_IN = 8
BLOCK_BYTES = 8 << 20
TOGETHER = 10_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, _bin bigint, offset bigint, _fill int"


# ---------------------------------------------------------------- tokens


def _bytes(*values: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


_BLANK, _CLOSING = _bytes(0x20, *range(0x09, 0x0E)), _bytes(*b'.,;:!?)"')
_ALNUM = _bytes(*b"abcdefghijklmnopqrstuvwxyz0123456789")
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A") : ord("Z") + 1] += 32


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + lengths[i] - 1, one stretch after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _parts(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, A-Z lower-cased, and where the words of all texts begin and end.

    Closing marks at the end of a word, after a letter or digit, are a word of their own: the
    pre-tokeniser parts them too, and lower-cases all but its special tokens, whose words stay as they are.
    """
    inside, cut = ~_BLANK[data], np.zeros(len(data) + 1, bool)
    cut[edges] = True
    begins = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    low = _LOW[data]
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    for at in np.unique(np.searchsorted(begins, special, "right") - 1).tolist():
        low[begins[at] : ends[at]] = data[begins[at] : ends[at]]
    if len(begins):
        last = np.maximum.accumulate(np.where(_CLOSING[low], np.int32(-1), np.arange(len(low), dtype=np.int32)))[ends - 1]
        before = low[np.maximum(last - 1, 0)]
        letter = _ALNUM[low[last]] | ((before == 0xC3) & (low[last] >= 0x80) & (low[last] != 0x97) & (low[last] != 0xB7))
        split = last[(last >= begins) & (last < ends - 1) & letter] + 1
        begins, ends = np.sort(np.concatenate([begins, split])), np.sort(np.concatenate([ends, split]))
    return low, begins, ends


class WordIds:
    """Ids of texts, from ids of their distinct words.

    The pre-tokeniser never joins across ASCII white space, so the ids of a text are those of its
    words in order. A block of texts is cut into words as one byte array, each distinct word of the block is
    looked up once, and the ids are gathered by word number. Unknown plain words go through the
    tokeniser together, any other word on its own. Words are remembered in two generations: when the
    younger one is full it becomes the older one, and a word that is met again moves back.
    """

    plain = regex.compile(r"[\x21-\x7e\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]+")  # lower-cased letter by letter
    most = 200_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _alone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of each of many words that stay as long as they are when lower-cased."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in words])
        of = np.searchsorted(ends, np.array([at for at, _ in found.offsets], np.int64), "right")
        ids, edges = np.array(found.ids, "<u4"), np.searchsorted(of, np.arange(len(words) + 1))
        return [ids[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        out, new, joint = [], [], []
        for at, word in enumerate(words):
            ids = self.young.get(word)
            if ids is None:
                ids = self.old.get(word)
                new.append(at)
            out.append(ids)
        for at in new:
            if out[at] is None:
                word = words[at].decode("utf-8", "surrogatepass")
                simple = word.isprintable() if word.isascii() else self.plain.fullmatch(word) and unicodedata.is_normalized("NFC", word)
                if "<|" in word or not simple:
                    out[at] = self._alone(word)
                else:
                    joint.append((at, word))
        for a in range(0, len(joint), TOGETHER):
            own = joint[a : a + TOGETHER]
            for (at, _), ids in zip(own, self._together([w for _, w in own])):
                out[at] = ids
        for at in new:
            if len(self.young) >= self.most:
                self.old, self.young = self.young, {}
            self.young[words[at]] = out[at]
        return out

    def __call__(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with ``end_id`` after each, and where each text's begin (and the end)."""
        raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
        edges = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
        data, begins, ends = _parts(data, edges - edges[0])
        inside = ~_BLANK[data]
        starts = np.concatenate([[0], np.cumsum(ends - begins)])
        joined = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(starts), pa.py_buffer(data[inside])])
        coded = pc.dictionary_encode(joined)
        word = coded.indices.to_numpy()
        ids = self._ids(coded.dictionary.to_pylist())
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        n = sizes[word]
        so_far = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(begins, edges - edges[0])]
        bounds = so_far + np.arange(len(edges))
        out = np.full(int(bounds[-1]), end_id, "<u4")
        places = np.ones(len(out), bool)
        places[bounds[1:] - 1] = False
        out[places] = flat[_ragged((np.cumsum(sizes) - sizes)[word], n)]
        return out, bounds


# ---------------------------------------------------------------- best fit


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, largest items first, each into the fullest bin that takes it."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set where a bin with r free places is open
    count = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            own = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, own, count = capacity, count, count + 1
        bins[item], offsets[item] = own, capacity - room
        if room > size:
            by_room[room - size].append(own)
            rooms |= 1 << (room - size)
    return bins, offsets


def _lots(path: str, length: int, end_id: int):
    def rows(batches):
        ids_of = WordIds(path)
        prefix, lot = TaskContext.get().partitionId() << 33, 0
        held: list[tuple] = []

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal lot
            sizes = np.array([x[3] for x in held], np.int64)
            bins, offsets = best_fit(sizes, length)
            fill = np.bincount(bins, sizes).astype(np.int32)[bins]
            columns = [pa.array(c, t) for c, t in zip(zip(*held), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(prefix + (lot << 17) + bins), pa.array(offsets), pa.array(fill)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "_bin", "offset", "_fill"],
            )
            held.clear()
            lot += 1

        for block in chunks(batches, most=BLOCK_BYTES):
            ids, bounds = ids_of(block.column("text"), end_id)
            for doc_id, first, last in zip(block.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                for piece, at in enumerate(range(first, last, length)):
                    own = ids[at : min(at + length, last)]
                    held.append((doc_id, piece, at - first, len(own), zlib.crc32(own)))
                    if len(held) == LOT_ITEMS:
                        yield from packed()
        if held:
            yield from packed()

    return rows


def _node(length: int, round_: int):
    def node(items: pa.Table) -> pa.Table:
        items = items.sort_by("_item")
        bins, offsets = best_fit(items.column("_fill").to_numpy().astype(np.int64), length)
        # a bin is named after its first item
        names = items.column("_item").to_numpy()
        first = np.full(int(bins.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, bins, names)
        fill = np.bincount(bins, items.column("_fill").to_numpy()).astype(np.int32)
        return pa.table({"_item": items.column("_item"), "_bin": first[bins], "_shift": offsets, "_fill": fill[bins]})

    return node


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = 0, work: Work | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    work = work or Work(docs.sparkSession, "packing")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = work.save(source.mapInArrow(tidy(_lots(tokenizer_path, length, end_id)), PIECES), "pieces")

    slack = length // 128
    bins = pieces.filter("offset = 0").select(F.col("_bin").alias("_item"), "_fill")
    open_ = work.save(bins.filter(F.col("_fill") < length - slack), "open0")
    moves, round_ = None, 0
    count = open_.count()
    # a lot is a leaf of the tree; bin numbers start with the task and its lot
    nodes = -(-count // NODE_ITEMS) if count else 0
    lots = open_.select(F.shiftright("_item", 17)).distinct().count()
    nodes = max(nodes, -(-lots // FAN_IN))
    while count > 1:
        round_ += 1
        spread = open_.withColumn("_node", F.pmod(F.xxhash64("_item"), F.lit(nodes)))
        merged = work.save(
            spread.groupBy("_node").applyInArrow(_node(length, round_), "_item bigint, _bin bigint, _shift bigint, _fill int"), f"round{round_}"
        )
        step = merged.select("_item", "_bin", "_shift")
        if moves is None:
            moves = step
        else:
            up = step.select(F.col("_item").alias("_bin"), F.col("_bin").alias("_to"), F.col("_shift").alias("_more"))
            moves = moves.join(up, "_bin", "left").select(
                "_item", F.coalesce("_to", "_bin").alias("_bin"), (F.col("_shift") + F.coalesce("_more", F.lit(0))).alias("_shift")
            )
        moves = work.save(moves, f"moves{round_}")
        if nodes == 1:
            break
        slack = min(2 * slack, length)
        open_ = work.save(
            merged.filter((F.col("_item") == F.col("_bin")) & (F.col("_fill") < length - slack)).select("_item", "_fill"), f"open{round_}"
        )
        count = open_.count()
        nodes = max(-(-nodes // FAN_IN), -(-count // NODE_ITEMS))
    if moves is not None:
        pieces = (
            pieces.join(moves, pieces["_bin"] == moves["_item"], "left")
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce(moves["_bin"], pieces["_bin"]).alias("_bin"),
                    (F.col("offset") + F.coalesce("_shift", F.lit(0))).alias("offset"))
        )
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("_bin").alias("sequence_id"), "offset")
