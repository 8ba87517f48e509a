"""Ids of a byte-level BPE vocabulary, by the tokenizers library on the different chunks of a text."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import SparkSession

from labelmill.llm.chunks import REMEMBERED_BY_WORKER, ChunkEncoder

# Bytes that surely do not begin white space: printable ASCII and the lead bytes of such characters
# as have no white space among them.
SOLID = np.zeros(256, bool)
SOLID[33:127] = True
SOLID[195:245] = True
SOLID[[0xE1, 0xE2, 0xE3]] = False
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
# Without the apostrophe, which may go with the letters after it.
SIGN = np.zeros(256, bool)
SIGN[33:48] = SIGN[58:65] = SIGN[91:97] = SIGN[123:127] = True
SIGN[39] = False
# All that a byte is, in bits: looked up once.
IS_LETTER, IS_SIGN, IS_SPACE, IS_SOLID = 1, 2, 16, 32
KINDS = (
    LETTER * IS_LETTER + SIGN * IS_SIGN + SPACE * IS_SPACE + SOLID * IS_SOLID
).astype(np.uint8).tobytes()
# Where joined chunks are not plain: white space that is neither a line end between two chunks nor
# the blank that opens one.
ODD = re.compile(r"[^\S\n ]|\s\n|\n\n|(?<=[^\n]) |  | \n| $|\n$|^\n")
# Chunks encoded together: few, so that one that is not plain holds few others up.
JOINED = 64
# How special tokens begin.
SPECIAL = b"<|"


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where the vocabulary's split into words never depends on the other side.

    The last of several white space characters is always apart from those before; a blank goes
    with the word that follows, any other is a piece of its own. Letters and signs are apart.
    """
    text = data.tobytes()
    kinds = np.frombuffer(text.translate(KINDS), np.uint8)
    before, after = kinds[:-1], kinds[1:]
    last = np.zeros(len(data), bool)
    last[:-1] = (before & IS_SPACE != 0) & (after & IS_SOLID != 0)
    last[offsets[1:][offsets[1:] > 0] - 1] = False
    special = SPECIAL in text
    if special:  # a special token ends the text before it, so white space there stays together
        last[:-1] &= data[1:] != SPECIAL[0]
    starts = last.copy()
    starts[1:] |= last[:-1] & (data[:-1] != 32)
    if special:
        return starts
    # Of two neighbours one is a letter, the other a sign.
    either = IS_LETTER | IS_SIGN
    starts[1:] |= (before ^ after) & either == either
    return starts


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(vocabulary)


@lru_cache(maxsize=1)
def worker_encoder(vocabulary: bytes) -> ChunkEncoder:
    """One encoder for all tasks of a Python worker, so that a vocabulary's chunks are learnt once."""
    return chunk_encoder(vocabulary, REMEMBERED_BY_WORKER)


def chunk_encoder(vocabulary: bytes, remembered: int | None = None) -> ChunkEncoder:
    """An encoder of its own, whose table goes with it."""
    tokenizer = _tokenizer(vocabulary)

    def ids_of(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    line_end = ids_of(["\n"])[0]

    def one_by_one(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = ids_of([c.decode() for c in chunks])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def group(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Plain chunks are encoded together, with line ends, which stay apart, between them."""
        joined = b"\n".join(chunks)
        text = joined.decode()
        if len(line_end) == 1 and SPECIAL not in joined and not ODD.search(text):
            ids = np.array(ids_of([text])[0], np.int32)
            ends = np.flatnonzero(ids == line_end[0])
            if len(ends) == len(chunks) - 1:
                sizes = np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1
                return np.delete(ids, ends), sizes
        return one_by_one(chunks)

    def encode(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts = [group(chunks[i : i + JOINED]) for i in range(0, len(chunks), JOINED)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    return ChunkEncoder(cuts, encode, remembered)


class Vocabulary:
    """A tokenizer file's contents, read on the driver and sent to the tasks once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, "rb") as file:
            self._sent = spark.sparkContext.broadcast(file.read())

    def encoder(self, *, stays: bool = False) -> ChunkEncoder:
        """One for a task, or one that stays in the worker for the tasks after it, with its memory."""
        return worker_encoder(self._sent.value) if stays else chunk_encoder(self._sent.value)


def with_end(ids: np.ndarray, rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with one more, ``end``, after each row."""
    n = len(rows) - 1
    out = np.full(len(ids) + n, end, np.int32)
    keep = np.ones(len(out), bool)
    after = rows + np.arange(n + 1)
    keep[after[1:] - 1] = False
    out[keep] = ids
    return out, after
