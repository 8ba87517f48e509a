"""Quartile bucket digests of documents, and a bounded difference between digests.

Byte triplets of a sliding window are hashed into buckets and counted. Each bucket is written as its
quartile among the text's own buckets, two bits each, after a header with a checksum, the length on
a logarithmic scale and two ratios of the quartiles. Similar texts have similar digests, equal texts
equal ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import SLICE_BYTES, flat
from labelmill.llm.ranges import in_id_ranges

BUCKETS = 256
HEADER = 4
# Which bytes of a window of four make a triplet.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
# Differences add up to this at most: about what unrelated random texts reach.
BOUND = 384

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text the number of triplets in each bucket; triplets do not cross texts."""
    rows = len(offsets) - 1
    counts = np.zeros(rows * BUCKETS, np.int64)
    values = data.astype(np.uint32)
    row = np.repeat(np.arange(rows, dtype=np.int64) * BUCKETS, np.diff(offsets))
    for salt, (a, b, c) in enumerate(TRIPLETS):
        n = len(data) - c
        if n <= 0:
            continue
        x = (values[a : a + n] << np.uint32(16)) | (values[b : b + n] << np.uint32(8))
        x |= values[c : c + n]
        x += np.uint32(salt << 24)
        x *= np.uint32(0x9E3779B1)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA77)
        own = row[:n] == row[c : c + n]
        bucket = row[:n][own] + (x[own] >> np.uint32(24))
        counts += np.bincount(bucket, minlength=len(counts))
    return counts.reshape(rows, BUCKETS)


def digests(texts: list[bytes]) -> np.ndarray:
    """One row of bytes for each text."""
    data, offsets = flat(pa.array(texts, pa.large_binary()))
    counts = bucket_counts(data, offsets)
    ordered = np.sort(counts, axis=1)
    quarters = ordered[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, :, None] > quarters[:, None, :]).sum(2).astype(np.uint8)
    packed = codes[:, 0::4] | codes[:, 1::4] << 2 | codes[:, 2::4] << 4 | codes[:, 3::4] << 6
    lengths = np.diff(offsets)
    header = np.zeros((len(texts), HEADER), np.uint8)
    header[:, 0] = [hashlib.blake2b(t, digest_size=1).digest()[0] for t in texts]
    # Eight steps for each doubling: a byte reaches 2**31 bytes and stays at 255 from there.
    header[:, 1] = np.minimum(255, np.floor(8 * np.log2(lengths + 1)))
    top = np.maximum(quarters[:, 2], 1)
    header[:, 2] = np.minimum(15, 16 * quarters[:, 0] // top)
    header[:, 3] = np.minimum(15, 16 * quarters[:, 1] // top)
    return np.hstack([header, packed])


def _codes(rows: np.ndarray) -> np.ndarray:
    body = rows[:, HEADER:]
    return np.stack([body >> s & 3 for s in (0, 2, 4, 6)], 2).reshape(len(rows), -1)


def differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differences of digest rows, from 0 to BOUND.

    One for each step between quartiles, six between the outer two; four for each doubling of the
    length beyond the first; one for each step of the ratios; one for another checksum.
    """
    step = np.abs(_codes(a).astype(np.int32) - _codes(b))
    total = np.where(step == 3, 6, step).sum(1)
    head = np.abs(a[:, :HEADER].astype(np.int32) - b[:, :HEADER])
    total += np.maximum(0, head[:, 1] - 8) // 2
    total += head[:, 2] + head[:, 3] + (head[:, 0] > 0)
    return np.minimum(total, BOUND)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 from BOUND on."""
    return 1.0 - differences(a, b) / BOUND


def written(rows: np.ndarray) -> list[str]:
    return [r.tobytes().hex() for r in rows]


def read(fingerprints: list[str]) -> np.ndarray:
    width = HEADER + BUCKETS // 4
    return np.frombuffer(bytes.fromhex("".join(fingerprints)), np.uint8).reshape(-1, width)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _pieces(batch.column("id").to_pylist(), batch.column("text")):
                yield pa.record_batch(
                    {"doc_id": pa.array(ids, pa.int64()), "fingerprint": written(digests(texts))}
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def _pieces(ids: list, column: pa.Array) -> Iterator[tuple[list, list[bytes]]]:
    held_ids, held, size = [], [], 0
    for i, text in zip(ids, column, strict=True):
        value = (text.as_py() or "").encode()
        held_ids.append(i)
        held.append(value)
        size += len(value)
        if size >= SLICE_BYTES:
            yield held_ids, held
            held_ids, held, size = [], [], 0
    if held:
        yield held_ids, held


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every document and of its edited text, and how alike they are.

    The edited text has its last quarter of code points replaced by the first as many of the next
    document in ascending order of id (after the last: the first). Null ids come first, rows with
    one id are ordered by text, a null text counts as empty; a lone document follows itself. An
    empty table gives no rows.
    """

    def results(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
        texts = [t.encode() for _, t, _ in rows]
        edited = []
        for _, text, following in rows:
            quarter = len(text) // 4
            edited.append((text[: len(text) - quarter] + following[:quarter]).encode())
        plain, changed = digests(texts), digests(edited)
        after = digests([t.encode() for _, _, t in rows[-1:]])
        # The digest of the next document is the next row's, except after the last row.
        return pa.record_batch(
            {
                "doc_id": pa.array([i for i, _, _ in rows], pa.int64()),
                "n_chars": pa.array([len(t) for _, t, _ in rows], pa.int64()),
                "edited_sha256": [hashlib.sha256(t).hexdigest() for t in edited],
                "fingerprint": written(plain),
                "edited_fingerprint": written(changed),
                "near_edited": likeness(plain, changed),
                "near_next": likeness(plain, np.vstack([plain[1:], after])),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, ready, size = None, None, [], 0
        for batch in batches:
            columns = (batch.column(c) for c in ("part", "after", "doc_id", "text"))
            for now, after, i, value in zip(*columns, strict=True):
                if now.as_py() != part:
                    part, last = now.as_py(), None
                elif last is None:  # a further row of those that open the next part
                    continue
                text = value.as_py()
                if last is not None:
                    ready.append((*last, text))
                    size += len(last[1])
                    # ``results`` takes successive rows only, so a part's end closes a piece too.
                    if size >= SLICE_BYTES or after.as_py():
                        yield results(ready)
                        ready, size = [], 0
                last = None if after.as_py() else (i.as_py(), text)
        if ready:
            yield results(ready)

    return in_id_ranges(docs, id_col, text_col, with_next=True).mapInArrow(run, RESULT)
