"""Words of many texts as numpy arrays, straight from the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than blank and ``\\x09``-``\\x0D``. All functions here run inside tasks on one Arrow
batch at a time; a batch is cut into slices of whole texts of about ``SLICE_BYTES``, so that memory depends on that
and on the longest single text only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = (1 << 20) - 1  # with one place more, what the least power table serves
_BASE = 0x9E3779B97F4A7C15 | 1

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def seeded(n: int, seed: int) -> np.ndarray:
    """``n`` fixed random 64-bit numbers, the same on every machine."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)
    return mix(steps * np.uint64(0x9E3779B97F4A7C15))


_BYTES = seeded(256, 1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]  # A-Z as a-z


@cache
def _power_block(log2: int) -> tuple[np.ndarray, np.ndarray]:
    n, inverse = 1 << log2, pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of them."""
    return _power_block(max((int(n) - 1).bit_length(), 20))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hashes of the byte spans ``[start, end)``; equal bytes give equal hashes wherever they stand."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_FOLDED if fold else _BYTES)[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of a slice of texts: byte spans, hashes, and for text ``i`` the words ``first[i]:first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the number of the first word of each text (one more at the end)."""
    white = WHITE[data]
    inner = np.ones(len(data) + 1, dtype=bool)
    inner[offsets] = False  # a text begins here, so no word goes on
    inner[[0, len(data)]] = False
    solid = ~white
    begins = solid.copy()
    begins[1:] &= white[:-1] | ~inner[1:-1]
    finishes = solid.copy()
    finishes[:-1] &= white[1:] | ~inner[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets)


def words_of(data: np.ndarray, offsets: np.ndarray, fold: bool = False) -> Words:
    starts, ends, first = word_spans(data, offsets)
    return Words(data, starts, ends, span_hashes(data, starts, ends, fold), first)


def text_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as large strings in one piece, null as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, bytes, offsets of the texts in them) for slices of whole texts."""
    texts = text_column(column)
    n = len(texts)
    if n == 0:
        return
    _, where, raw = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + SLICE_BYTES, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


@cache
def _trim() -> Callable[[int], int]:
    """``malloc_trim`` where the C library has it."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that hands its free memory back when it is done: worker processes outlive their tasks, and what
    the allocators keep for later adds up over the workers of an executor."""

    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return tidied


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each word on, and whether those words lie in one text."""
    n = len(words.hashes)
    room = np.repeat(words.first[1:], words.counts) - np.arange(n) >= k
    out = np.zeros(n, np.uint64)
    if n >= k:
        up, _ = powers(k + 1)
        body = out[: n - k + 1]
        for i in range(k):
            body += words.hashes[i : n - k + 1 + i] * up[i]
    return mix(out), room
