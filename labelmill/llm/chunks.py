"""Encoding of texts by their chunks: each different chunk of a batch is encoded once.

A chunk is cut where the encoder's own rules keep the two sides apart, so the ids of a text are those
of its chunks one after another. Chunks seen before stay in a table of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa

from labelmill.llm.batches import flat

# Chunks that a table remembers, about 100 MB; a full one starts anew. One that stays in a worker for a
# whole job may be larger.
REMEMBERED = 400_000
REMEMBERED_BY_WORKER = 1_000_000
# Longer chunks are not remembered.
LONGEST = 64
# Bytes of text to encode at a time: the more, the fewer chunks are looked up again.
ENCODE_BYTES = 2 << 20


def _values(array: pa.LargeBinaryArray) -> list[bytes]:
    """``to_pylist`` of an array without nulls, several times as fast for short values."""
    data, offsets = flat(array)
    raw, bounds = data.tobytes(), offsets.tolist()
    return [raw[a:b] for a, b in pairwise(bounds)]


class ChunkEncoder:
    """``encode`` maps a list of chunks (UTF-8) to all their ids, and the number of each one's."""

    def __init__(
        self,
        cuts: Callable[[np.ndarray, np.ndarray], np.ndarray],
        encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
        remembered: int | None = None,
    ) -> None:
        """``cuts`` marks the places in the bytes of texts at which a chunk starts."""
        self._cuts, self._encode = cuts, encode
        self._most = remembered or REMEMBERED
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self._count = 0
        self._ids = np.zeros(1 << 16, np.int32)
        # Ends in ``_ids``, after a zero for the chunk before the first.
        self._ends = np.zeros(1 << 14, np.int64)

    def _learn(self, chunks: list[bytes]) -> np.ndarray:
        """Numbers of the chunks in the table."""
        known = self._known
        numbers = np.fromiter(map(known.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(numbers < 0).tolist()
        if not missing:
            return numbers
        new = [chunks[i] for i in missing]
        ids, sizes = self._encode(new)
        count, used = self._count, int(self._ends[self._count])
        while used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while count + len(new) >= len(self._ends):
            self._ends = np.concatenate([self._ends, np.zeros_like(self._ends)])
        self._ids[used : used + len(ids)] = ids
        self._ends[count + 1 : count + 1 + len(new)] = used + np.cumsum(sizes)
        numbers[missing] = np.arange(count, count + len(new))
        if max(map(len, new)) > LONGEST:
            known.update((c, n) for n, c in enumerate(new, count) if len(c) <= LONGEST)
        else:
            known.update(zip(new, range(count, count + len(new)), strict=True))
        self._count = count + len(new)
        return numbers

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the row offsets in them."""
        if self._count > self._most:
            self._forget()
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        starts = self._cuts(data, offsets)
        starts[offsets[offsets < len(data)]] = True
        starts = np.flatnonzero(starts)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        numbers = self._learn(_values(chunks.dictionary))
        begins, sizes = self._ends[numbers], np.diff(self._ends[: self._count + 1])[numbers]
        each = chunks.indices.to_numpy()
        begins, sizes = begins[each], sizes[each]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self._ids[np.arange(total[-1]) + np.repeat(begins - total[:-1], sizes)]
        return ids, total[np.searchsorted(starts, offsets)]
