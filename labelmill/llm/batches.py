"""Texts of an Arrow batch as flat bytes, and hashes over them, without a loop over rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

# Bytes of text handled at a time inside a task; one longer text is handled alone.
SLICE_BYTES = 1 << 20

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def as_binary(column: pa.Array) -> pa.Array:
    """The column as large binary; null becomes empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after another as bytes, and the row offsets in them (one more than rows)."""
    column = as_binary(column)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give free memory back, which a worker would keep from stage to stage otherwise."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text, at least one row each."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start, before = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        before = int(ends[stop - 1])
        start = stop
    release()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of MurmurHash3)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, BASE, np.uint64)
    down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < size."""
    rounded = 1 << max(16, (size - 1).bit_length())
    up, down = _powers(rounded)
    return up[:size], down[:size]


class SpanHashes:
    """64-bit hashes of any spans of a byte string, equal for equal spans wherever they stand.

    Sums modulo 2**64 of the values, each times a power: strings of two values in the order of Thue and
    Morse, and the same with both exchanged, have equal sums. Where a span is hashed but once, as
    words are, ``span_hashes`` has no such patterns.
    """

    def __init__(self, values: np.ndarray) -> None:
        """``values``: one unsigned 64-bit value for each place."""
        up, self._down = powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])


# Spans are mixed in by 8 bytes up to this length; longer ones are hashed one by one.
MIXED_BYTES = 64
FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, each by itself: equal for equal spans, not a sum over their bytes."""
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # The 8 bytes from any place on, as one number.
    grams = np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))
    hashes = mix(lengths.astype(np.uint64) * U64(BASE))
    for done in range(0, MIXED_BYTES, 8):
        live = np.flatnonzero(lengths > done)
        if not len(live):
            break
        value = grams[starts[live] + done] & FIRST_BYTES[np.minimum(8, lengths[live] - done)]
        hashes[live] = mix((hashes[live] ^ value) + U64(BASE))
    for i in np.flatnonzero(lengths > MIXED_BYTES).tolist():
        hashes[i] = xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return hashes


class Words:
    """The words of a batch of texts: runs of bytes in ``inside``.

    By default ``[^\\x20\\x09-\\x0D]+``; words never cross texts.
    """

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = ~IS_SPACE
    ) -> None:
        n = len(data)
        inside = inside[data]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | first[1:n]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | first[1:n]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        # Words before each row; one more than rows.
        self.rows = np.searchsorted(self.starts, offsets)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of the texts with A-Z in lower case, and their hashes."""
    words = Words(data, offsets)
    return words, span_hashes(LOWER[data], words.starts, words.ends)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of ``width`` successive words.

    A text of fewer words has its whole sequence as one shingle, a text without words none.
    """
    words, hashes = word_hashes(data, offsets)
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for i in range(width):
        rolled[: max(0, n - i)] += mix(hashes[i:] + U64(BASE * (i + 1) % (1 << 64)))
    rolled = mix(rolled)
    sets = []
    for lo, hi in zip(words.rows[:-1].tolist(), words.rows[1:].tolist(), strict=True):
        if hi - lo >= width:
            sets.append(np.unique(rolled[lo : hi - width + 1]))
        elif hi > lo:
            part = hashes[lo:hi] + U64(BASE) * np.arange(1, hi - lo + 1, dtype=np.uint64)
            sets.append(mix(mix(part).sum(dtype=np.uint64, keepdims=True) + U64(hi - lo)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def sum_by_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between successive ``rows`` bounds."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return sums[rows[1:]] - sums[rows[:-1]]
