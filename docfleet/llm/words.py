"""Words of whole texts as arrays of 64-bit hashes, for use inside tasks.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which is what ``bytes.split()`` gives.
Sequences of words are told apart by 64-bit hashes: two different sequences agree with a chance of
about 2**-64.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 8 << 20
_M = np.uint64(0x9E3779B97F4A7C15)
_A = np.uint64(0xBF58476D1CE4E5B9)


class WordHash(dict):
    """Hashes of the words seen so far; emptied when it holds ``most`` words."""

    most = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """``lower`` changes A-Z only."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def hashed(docs: list[list[bytes]], cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the documents, one after the other, and each document's start (and the end)."""
    starts = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(d) for d in docs], out=starts[1:])
    flat = np.fromiter(map(cache.__getitem__, chain.from_iterable(docs)), np.uint64, int(starts[-1]))
    return flat, starts


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; a run is made of two halves, so the work grows with log k."""
    if k == 1:
        return mix(h)
    if len(h) < k:
        return np.zeros(0, np.uint64)
    half = grams(h, k // 2)
    rest = half if k % 2 == 0 else grams(h, k - k // 2)
    n = len(h) - k + 1
    return mix(half[:n] * _M + rest[k // 2 : k // 2 + n])


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about ``most`` bytes (a longer text alone), for bounded memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def tidy(task: Callable) -> Callable:
    """``task`` that gives its memory back when it ends: Spark keeps the Python worker for later stages."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not the GNU C library
                pass

    return run
