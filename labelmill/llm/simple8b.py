"""Token ids in Simple-8b files.

A 64-bit word has a selector in its upper four bits, which says how many values of how many bits the
other sixty hold. Selector 0 is an escape: the next word is one value of 2**60 or more as it stands.
Selector 1 stands for 120 zeros. Ids are coded in blocks that start on a word of their own, and the
place of each block's first word is kept, so that all blocks are decoded side by side.

A file is a Parquet file whose rows each hold the ids of some successive documents: their ids and
ends, the words, and the block offsets. Folders ``part=n`` go up with the document id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm.batches import flat, slices
from labelmill.llm.byte_bpe import Vocabulary, with_end
from labelmill.llm.chunks import ENCODE_BYTES
from labelmill.llm.ranges import in_id_ranges

# Fixed values of the coding: values in a word for the selectors 1 to 15.
COUNTS = (120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BLOCK = 1024
# Ids that one row of a file holds at least, but for the last of a range.
ROW_IDS = 1 << 19
U64 = np.uint64

FILE = (
    "part int, first long, doc_ids array<long>, ends array<long>, n_ids long, words binary,"
    " blocks array<int>"
)
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if values.max(initial=0) >> U64(52):
        high = _bits(values >> U64(32))
        return np.where(high > 0, high + 32, _bits(values & U64(0xFFFFFFFF))).astype(np.int8)
    return np.frexp(values.astype(np.float64))[1].astype(np.int8)


def _wider(span: np.ndarray, shift: int) -> np.ndarray:
    """The larger one of each place and the place ``shift`` after it, if its block has that."""
    out = span.copy()
    np.maximum(span[:, :-shift], span[:, shift:], out=out[:, :-shift])
    return out


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for each block of values the place of its first word."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:n] = values
    need = _bits(padded).reshape(blocks, BLOCK)
    # For each place the selector with most values whose largest fits; 0 if not even one does. What
    # fits does so with fewer values of more bits too, so the selectors that fit are counted.
    fitting = np.zeros((blocks, BLOCK), np.int8)
    span, width = need, 1
    for s in range(len(COUNTS), 0, -1):
        count = COUNTS[s - 1]
        size = 0 if s == 1 else 60 // count
        # Largest of ``count`` values; beyond a block's end there are none: a word there holds
        # what is left.
        while 2 * width <= count:
            span = _wider(span, width)
            width *= 2
        fits = (_wider(span, count - width) if count > width else span) <= size
        if not fits.any():
            break
        fitting += fits
    selector = (len(COUNTS) + 1 - fitting) % (len(COUNTS) + 1)
    counts = np.array([1, *COUNTS])
    follow = np.arange(BLOCK) + counts[selector]
    # All blocks go ahead word by word.
    lane = np.arange(blocks)
    at = np.zeros(blocks, np.int64)
    used = np.minimum(BLOCK, n - lane * BLOCK)
    starts = np.zeros((blocks, BLOCK), bool)
    while len(lane):
        starts[lane, at] = True
        at = follow[lane, at]
        more = at < used
        lane, at, used = lane[more], at[more], used[more]
    place = np.flatnonzero(starts)
    lane, at = place // BLOCK, place % BLOCK
    chosen = selector[lane, at].astype(np.int64)
    word = chosen.astype(np.uint64) << U64(60)
    for s in np.unique(chosen):
        if s <= 1:
            continue
        mine = np.flatnonzero(chosen == s)
        count = COUNTS[s - 1]
        size = 60 // count
        packed = np.zeros(len(mine), np.uint64)
        for i in range(count):
            inside = at[mine] + i < BLOCK
            value = np.where(inside, padded[np.minimum(place[mine] + i, len(padded) - 1)], U64(0))
            packed |= value << U64(size * i)
        word[mine] |= packed
    first = np.flatnonzero(at == 0)
    escaped = chosen == 0
    if escaped.any():
        shift = np.cumsum(escaped) - escaped
        out = np.zeros(len(word) + int(escaped.sum()), np.uint64)
        spots = np.arange(len(word)) + shift
        out[spots] = word
        out[spots[escaped] + 1] = padded[place[escaped]]
        return out, spots[first].astype(np.int32)
    return word, first.astype(np.int32)


def decode(words: np.ndarray, blocks: np.ndarray, n: int) -> np.ndarray:
    """The n values of ``encode``, all blocks at once."""
    if n == 0:
        return np.zeros(0, np.uint64)
    selector = (words >> U64(60)).astype(np.int64)
    counts = np.array([1, *COUNTS])[selector]
    # The word after an escape is a value: its upper bits are not 0, so it is none itself.
    raw = np.zeros(len(words), bool)
    raw[1:] = selector[:-1] == 0
    counts[raw] = 0
    ends = np.cumsum(counts)
    begins = ends - counts
    block = np.searchsorted(blocks, np.arange(len(words)), "right") - 1
    at = begins - begins[blocks][block]
    out = np.zeros(len(blocks) * BLOCK, np.uint64)
    for s in range(2, 16):
        mine = np.flatnonzero((selector == s) & ~raw)
        if len(mine) == 0:
            continue
        count = COUNTS[s - 1]
        size = 60 // count
        mask = U64((1 << size) - 1)
        for i in range(count):
            spot = at[mine] + i
            inside = spot < BLOCK
            some = mine[inside]
            out[block[some] * BLOCK + spot[inside]] = words[some] >> U64(size * i) & mask
    escapes = np.flatnonzero((selector == 0) & ~raw)
    out[block[escapes] * BLOCK + at[escapes]] = words[escapes + 1]
    return out[:n]


def write(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all documents, each closed by ``end_id``, in ascending order of their id.

    A null text counts as empty and has the end id alone. Null ids come first; rows with one id are
    all kept, ordered by text. An empty table leaves a folder without files.
    """
    vocabulary = Vocabulary(docs.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder(stays=True)
        part, first, held, doc_ids, ends, size = None, 0, [], [], [], 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate(held)
            words, blocks = encode(ids.astype(np.uint64))
            return pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "first": pa.array([first], pa.int64()),
                    "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                    "ends": pa.array([ends], pa.list_(pa.int64())),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                    "blocks": pa.array([blocks], pa.list_(pa.int32())),
                }
            )

        for batch in batches:
            for piece in slices(batch, "text", 2 * ENCODE_BYTES):
                ids, rows = with_end(*encoder.encode(*flat(piece.column("text"))), end_id)
                parts = piece.column("part").to_numpy()
                names = piece.column("doc_id").to_pylist()
                cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    if parts[lo] != part or size >= ROW_IDS:
                        if held:
                            yield row()
                        first = first + size if parts[lo] == part else 0
                        part, held, doc_ids, ends, size = int(parts[lo]), [], [], [], 0
                    held.append(ids[rows[lo] : rows[hi]])
                    doc_ids += names[lo:hi]
                    ends += (rows[lo + 1 : hi + 1] - rows[lo] + size).tolist()
                    size += int(rows[hi] - rows[lo])
        if held:
            yield row()

    (
        in_id_ranges(docs, id_col, text_col)
        .select("part", "doc_id", "text")
        .mapInArrow(run, FILE)
        .write.option("compression", "zstd")
        .partitionBy("part")
        .parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids``: each document's ids (binary, little-endian unsigned 32-bit), and how
    many ids of all files come before them."""
    files = spark.read.schema(FILE).parquet(path)
    sizes = sorted(
        (r.part, r.n) for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    )
    before = dict(
        zip([p for p, _ in sizes], accumulate((n for _, n in sizes), initial=0), strict=False)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, names, ends, n, words, blocks = (
                    batch.column(c)[row]
                    for c in ("part", "first", "doc_ids", "ends", "n_ids", "words", "blocks")
                )
                ids = decode(
                    np.frombuffer(words.as_buffer(), "<u8"), blocks.values.to_numpy(), n.as_py()
                ).astype("<u4")
                stops = ends.values.to_numpy()
                starts = np.concatenate([[0], stops[:-1]])
                yield pa.record_batch(
                    {
                        "doc_id": names.values,
                        "start": starts + before[part.as_py()] + first.as_py(),
                        "ids": pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(),
                            len(stops),
                            [
                                None,
                                pa.py_buffer(np.append(4 * starts, 4 * n.as_py()).astype(np.int64)),
                                pa.py_buffer(ids),
                            ],
                        ).cast(pa.binary()),
                    }
                )

    return files.mapInArrow(run, "doc_id long, start long, ids binary")


def digests(documents: DataFrame) -> DataFrame:
    """Place, number and checksum of each document's ids, from ``read``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "start": batch.column("start"),
                    "n_tokens": pa.array([len(i.as_buffer()) // 4 for i in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(i.as_buffer()) for i in ids], pa.int64()),
                }
            )

    return documents.mapInArrow(run, RESULT)
