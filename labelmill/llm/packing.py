"""Token sequences of a fixed size with little padding, packed by minimum bin slack.

A document gives as many full sequences as it can; what is left, shorter than a sequence, is packed.
The plan needs only how many remainders there are of each length. For the longest length that is
left, a subset-sum over a bitset of reachable sums picks the lengths, and how many of each, that fill
a sequence closest to its capacity; the choice is repeated as long as the lengths last. Lengths that
no others complete are laid end to end and cut where sequences end, the last ones at powers of two.
So nothing is padded.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelmill.llm.batches import flat, slices
from labelmill.llm.byte_bpe import Vocabulary, with_end
from labelmill.sources.staging import Staging

CAPACITY = 1024
# A table of ranks (one row for each task that read documents) up to this size is broadcast.
RANKS_BYTES = 64 << 20

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long,"
    " offset long"
)


def closest_fill(lengths: dict[int, int], capacity: int) -> Counter[int]:
    """The lengths, and how many of each, whose sum comes closest to ``capacity`` from below."""
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(lengths, reverse=True):
        left = min(lengths[length], capacity // length)
        part = 1
        while left > 0 and not reach >> capacity & 1:
            times = min(part, left)
            steps.append((length, times, reach))
            reach = (reach | reach << (length * times)) & mask
            left -= times
            part *= 2
    total = reach.bit_length() - 1
    chosen: Counter[int] = Counter()
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += times
            total -= length * times
    return chosen


@dataclass
class Plan:
    """Where the remainder of a given length and rank goes.

    Entry i holds the ranks from ``rank[i]`` on of ``length[i]``: in successive sequences from
    ``sequence[i]``, ``each[i]`` of them in a sequence, from ``offset[i]`` on. Entries with
    ``each`` 0 lie end to end instead, from place ``offset[i]`` of the line that is cut up.
    """

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    line_first: int  # sequence where the line starts
    line_size: int
    capacity: int

    def entry(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        own = self.length.astype(np.int64) << 48 | self.rank
        return np.searchsorted(own, length.astype(np.int64) << 48 | rank, "right") - 1

    def cut(self, at: int, length: int) -> list[tuple[int, int, int]]:
        """``sequence, offset, length`` of the pieces of the line's places at .. at + length."""
        out = []
        end = at + length
        full = self.line_size // self.capacity
        while at < end:
            if at < full * self.capacity:
                sequence, offset = divmod(at, self.capacity)
                size = self.capacity
            else:  # powers of two, the largest first
                sequence, start, left = full, full * self.capacity, self.line_size % self.capacity
                while True:
                    size = 1 << (left.bit_length() - 1)
                    if at < start + size:
                        break
                    sequence, start, left = sequence + 1, start + size, left - size
                offset = at - start
            stop = min(end, at - offset + size)
            out.append((self.line_first + sequence, offset, stop - at))
            at = stop
        return out


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for ``counts`` remainders of each length from 1 to ``capacity - 1``."""
    left = {length: n for length, n in counts.items() if n > 0}
    next_rank = dict.fromkeys(left, 0)
    entries, rest, sequence = [], [], 0
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        chosen = closest_fill({x: n for x, n in others.items() if n}, capacity - longest)
        chosen[longest] += 1
        if sum(x * m for x, m in chosen.items()) < capacity:
            rest.append((longest, next_rank[longest], left.pop(longest)))
            continue
        times = min(left[x] // m for x, m in chosen.items())
        offset = 0
        for x, m in chosen.items():
            entries.append((x, next_rank[x], m, sequence, offset))
            offset += x * m
            next_rank[x] += m * times
            left[x] -= m * times
            if left[x] == 0:
                del left[x]
        sequence += times
    line = 0
    for length, rank, n in rest:
        entries.append((length, rank, 0, 0, line))
        line += length * n
    table = np.array(sorted(entries), np.int64).reshape(-1, 5)
    return Plan(*table.T, line_first=sequence, line_size=line, capacity=capacity)


def n_sequences(plan: Plan) -> int:
    return plan.line_first + plan.line_size // plan.capacity + (plan.line_size % plan.capacity).bit_count()


def tokenized(
    docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int, id_col: str, text_col: str
) -> DataFrame:
    """Documents' ids, and how they stand among the rows of the task that read them.

    ``blocks`` full sequences come before in the task; ``rank`` remainders of the same length.
    """
    vocabulary = Vocabulary(docs.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encoder = vocabulary.encoder()
        seen = np.zeros(capacity, np.int64)
        blocks = 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids, rows = with_end(*encoder.encode(*flat(part.column("text"))), end_id)
                kind = "<u2" if ids.max(initial=0) < 1 << 16 else "<u4"
                raw = ids.astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                sizes = np.diff(rows)
                full, rest = sizes // capacity, sizes % capacity
                order = np.argsort(rest, kind="stable")
                ordered = rest[order]
                first = np.searchsorted(ordered, ordered)
                rank = np.empty(len(rest), np.int64)
                rank[order] = np.arange(len(rest)) - first + seen[ordered]
                seen += np.bincount(rest, minlength=capacity)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array(sizes, pa.int64()),
                        "ids": pa.array(
                            [
                                raw[width * a : width * b]
                                for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)
                            ],
                            pa.binary(),
                        ),
                        "width": pa.array(np.full(len(sizes), width), pa.int32()),
                        "task": pa.array(np.full(len(sizes), task), pa.int32()),
                        "blocks": pa.array(blocks + np.cumsum(full) - full, pa.int64()),
                        "rank": pa.array(rank, pa.int64()),
                    }
                )
                blocks += int(full.sum())

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n long, ids binary, width int, task int, blocks long, rank long"
    )


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    end_id: int,
    *,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of a document: where it starts there, its ids, and its place.

    ``ids`` are little-endian unsigned 32-bit numbers; ``offset`` is the piece's place in sequence
    ``sequence_id``, whose pieces lie without gaps. Sequences have ``capacity`` ids, the last few a
    power of two each. A document's ids end with ``end_id``; a null text counts as empty, so it has
    the end id alone. Null and repeated document ids are kept as they are. An empty table gives no
    rows.

    Only counts reach the driver: remainders by length, and full sequences by task.
    """
    staging = Staging(docs.sparkSession)
    rows = staging.table(
        tokenized(docs, vocabulary_path, end_id, capacity, id_col, text_col), "ids"
    )
    rest = F.col("n") % capacity
    by_task = rows.groupBy("task", rest.cast("int").alias("rest")).agg(F.count("*").alias("c"))
    by_task = staging.table(by_task, "by_task")
    counts = by_task.where("rest > 0").groupBy("rest").agg(F.sum("c").alias("c")).collect()
    plan = make_plan({r.rest: r.c for r in counts}, capacity)
    # Ranks of each task's first remainder of each length; sequences before its first full one.
    earlier = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        by_task.select("task", "rest", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"))
        .groupBy("task")
        .agg(F.map_from_entries(F.collect_list(F.struct("rest", "before"))).alias("before"))
    )
    full = (
        rows.groupBy("task")
        .agg(F.sum(F.floor(F.col("n") / capacity)).alias("full"))
        .orderBy("task")
        .collect()
    )
    first_full, at = {}, n_sequences(plan)
    for r in full:
        first_full[r.task] = at
        at += int(r.full)
    if len(full) * capacity * 16 <= RANKS_BYTES:
        ranks = F.broadcast(ranks)
    placed = rows.join(ranks, "task").select(
        "doc_id",
        "n",
        "ids",
        "width",
        "task",
        "blocks",
        (F.col("rank") + F.element_at("before", rest.cast("int"))).alias("rank"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "task", "blocks", "rank")}
            over = columns["n"] % capacity
            entry = plan.entry(over, columns["rank"])
            names, widths = batch.column("doc_id").to_pylist(), batch.column("width").to_pylist()
            out: list[tuple] = []
            size = 0
            for i, (name, raw) in enumerate(zip(names, batch.column("ids"), strict=True)):
                n = int(columns["n"][i])
                ids = np.frombuffer(raw.as_buffer(), f"<u{widths[i]}").astype("<u4").tobytes()
                first = first_full[int(columns["task"][i])] + int(columns["blocks"][i])
                places = [(first + b, 0, capacity) for b in range(n // capacity)]
                length = int(over[i])
                if length:
                    e = entry[i]
                    turn = int(columns["rank"][i] - plan.rank[e])
                    if plan.each[e]:
                        later, slot = divmod(turn, int(plan.each[e]))
                        offset = int(plan.offset[e]) + slot * length
                        places.append((int(plan.sequence[e]) + later, offset, length))
                    else:
                        places += plan.cut(int(plan.offset[e]) + turn * length, length)
                start = 0
                for sequence, offset, m in places:
                    piece = ids[4 * start : 4 * (start + m)]
                    out.append((name, start, m, piece, n, sequence, offset))
                    start += m
                size += n
                if size > 1 << 20:
                    yield _pieces(out)
                    out, size = [], 0
            if out:
                yield _pieces(out)

    return placed.mapInArrow(run, PIECES)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    kinds = {"ids": pa.binary()}
    return pa.record_batch(
        {
            name: pa.array(column, kinds.get(name, pa.int64()))
            for name, column in zip(names, zip(*rows, strict=True), strict=True)
        }
    )


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.array([zlib.crc32(i.as_buffer()) for i in batch.column("ids")], pa.int64())
            at = batch.schema.get_field_index("ids")
            yield batch.set_column(at, "ids_crc32", sums)

    return pieces.mapInArrow(run, PIECES.replace("ids binary", "ids_crc32 long"))
