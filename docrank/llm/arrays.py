"""Text columns as flat byte arrays, for vectorised work inside Arrow tasks.

Spark hands a task its rows as Arrow batches. These helpers view a string
column as one ``uint8`` array with document borders, find words in it and
hash words, shingles and fixed-length byte strings with 64-bit hashes, a
bounded number of bytes at a time. Nulls count as empty texts.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Ship this module's code with the functions that use it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 2 << 20
HASH_BYTES = 128 << 10  # bytes whose words are hashed at once
ODD = np.uint64(0x9E3779B97F4A7C15)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, borders): text i is ``bytes[borders[i]:borders[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0 or column.null_count == len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, borders, data = column.buffers()
    kind = np.dtype(np.int64 if wide else np.int32)
    at = np.frombuffer(borders, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text each (one row at least)."""
    _, at = text_buffer(batch.column(text))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, side="right")) - 1)
        yield batch.slice(lo, min(hi, n) - lo)
        lo = min(hi, n)


def give_back() -> None:
    """Hand freed memory back to the system. Workers live on, and the next stage's tasks need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task yields; memory goes back when the task's own generator, and what it held, is gone."""
    yield from batches
    del batches
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(word_bytes: np.ndarray | None = None, fold: bool = True) -> np.ndarray:
    """A random 64-bit code for each byte; 0 outside ``word_bytes``; A-Z as a-z if ``fold``."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * ODD) | np.uint64(1)
    if fold:
        codes[65:91] = codes[97:123]
    if word_bytes is not None:
        codes[~word_bytes] = 0
    return codes


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), ODD, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of the texts: byte spans, text numbers and 64-bit hashes.

    ``word_bytes``: a 256-entry mask of the bytes that words consist of.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, word_bytes: np.ndarray):
        texts = len(at) - 1
        inside = word_bytes[data]
        border = np.zeros(len(data) + 1, bool)
        border[at] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | border[1:-1]
        last[:-1] &= ~inside[1:] | border[1:-1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        del inside, border, first, last
        #: Words before each text; text i has words ``begin[i]:begin[i + 1]``.
        self.begin = np.searchsorted(self.start, at)
        self.count = np.diff(self.begin)
        self.text = np.repeat(np.arange(texts), self.count)
        self.hash = np.zeros(len(self.start), np.uint64)
        size = self.end - self.start
        codes, power = byte_codes(word_bytes), powers(int(size.max(initial=0)))
        lo = 0
        while lo < len(size):  # some words at a time: a byte takes 8 bytes and more of memory here
            hi = max(lo + 1, int(np.searchsorted(self.end, self.start[lo] + HASH_BYTES, side="right")))
            piece = data[self.start[lo]: self.end[hi - 1]]
            begin = self.start[lo:hi] - self.start[lo]
            place = np.arange(len(piece)) - np.repeat(begin, np.diff(begin, append=len(piece)))
            parts = codes[piece] * power[np.minimum(place, len(power) - 1)]  # codes are 0 between words
            self.hash[lo:hi] = mix(np.add.reduceat(parts, begin) + size[lo:hi].astype(np.uint64) * ODD)
            lo = hi


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every ``k``-word shingle; a text of fewer words, but not none, is one."""
    h, n = words.hash, len(words.hash)
    out, owner = [], []
    if n >= k:
        run = h[: n - k + 1].copy()
        for j in range(1, k):
            run = mix(run * ODD + h[j: n - k + 1 + j])
        whole = words.text[: n - k + 1] == words.text[k - 1:]
        out.append(run[whole])
        owner.append(words.text[: n - k + 1][whole])
    short = np.flatnonzero((words.count < k) & (words.count > 0))
    if len(short):
        run = h[words.begin[short]].copy()
        for j in range(1, k - 1):
            more = words.count[short] > j
            run[more] = mix(run[more] * ODD + h[words.begin[short][more] + j])
        out.append(mix(run + words.count[short].astype(np.uint64)))
        owner.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out, owner = np.concatenate(out), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return out[order], owner[order]


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes (a power of two) from each place on; the last ``k - 1`` places mean nothing."""
    h, width = byte_codes(fold=False)[data], 1
    while width < k:
        step = mix(np.array([width], np.uint64) * ODD)[0] | np.uint64(1)
        nxt = np.zeros_like(h)
        nxt[:-width] = h[width:]
        h = h * step + nxt
        width *= 2
    return mix(h)


def ranges(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``lo[i], lo[i] + 1, ...`` (``size[i]`` numbers) for each i, one after the other."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (a, b) as stars: each node once, with the smallest node that it reaches (itself left out)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        if np.array_equal(rx, ry):
            break
        low = np.minimum(rx, ry)
        np.minimum.at(root, rx, low)
        np.minimum.at(root, ry, low)
        while not np.array_equal(root, root[root]):
            root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
