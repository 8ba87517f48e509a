"""Removal of long repeated byte strings, found with run-length indexes.

Every string of ``length`` bytes has an anchor: of its k-byte strings the one with the least hash,
the leftmost of equals. Equal strings have equal anchors at the same place, so the strings can be
dealt by anchor. The strings with the same occurrence of an anchor start next to one another; the
bytes that they cover are a segment.

1. Equal segments are counted. What occurs twice is removed whole, wherever it stands.
2. Different segments of one anchor meet in a task. It builds the Burrows-Wheeler transform of its
   segments and keeps its runs, with the text places at both sides of each run's start. The length of
   the longest match elsewhere (a place's matching statistic) falls by one from each place to the
   next, except at those places; so they give all long matches.
3. An anchor with more segments than a task may hold is dealt anew, by the bytes that strings of
   neighbouring starts have in common, in the last resort by single strings. That is exact too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import BASE, U64, SpanHashes, flat, mix, release, slices
from labelmill.llm.lookup import fresh, only, with_row
from labelmill.sources.staging import Staging

LENGTH = 400
# Bytes of segments that a task indexes at a time, on average.
INDEX_BYTES = 1 << 20
# Segments of one anchor that a task holds; beyond it, strings are dealt by so many starts, then one.
ANCHOR_SEGMENTS = 8192
REFINED = (16, 1)
# Texts longer than this are read in overlapping pieces.
PIECE_BYTES = 1 << 18
POSITION_BITS = 22

ROWS = "anchor long, digest long, row long, s long, e long, p long"


def gram_hashes(data: np.ndarray) -> SpanHashes:
    """Hashes of spans, from their 8-byte strings: a span [s, e) is ``of(s, e - 7)``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    value = np.zeros(len(data), np.uint64)
    for i in range(8):
        value |= padded[i : i + len(data)].astype(np.uint64) << U64(8 * i)
    return SpanHashes(mix(value * U64(BASE) + U64(1)))


def anchor_size(length: int) -> int:
    return max(8, min(96, length // 4))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``row, s, e, p, anchor, digest``: segments [s, e) of the texts, places within the batch.

    ``p`` is where the anchor stands; successive starts with the same anchor make one segment.
    """
    k = anchor_size(length)
    width = length - k + 1
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    hashes = gram_hashes(data)
    places = np.arange(n - k + 1)
    ranks = hashes.of(places, places + k - 7)
    low = U64((1 << POSITION_BITS) - 1)
    ranks = (ranks & ~low) | places.astype(np.uint64)
    # Minimum over sliding windows from running minima of blocks, forwards and backwards.
    blocks = -(-len(ranks) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(ranks)] = ranks
    padded = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(padded, 1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    starts = np.arange(n - length + 1)
    least = np.minimum(backward[starts], forward[starts + width - 1])
    row = np.searchsorted(offsets, starts, "right") - 1
    whole = starts + length <= offsets[row + 1]
    starts, row = starts[whole], row[whole]
    at = (least[whole] & low).astype(np.int64)
    if len(starts) == 0:
        return empty, empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    new = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(np.concatenate([[True], new]))
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    s, e, p = starts[first], starts[last] + length, at[first]
    return row[first], s, e, p, hashes.of(p, p + k - 7), hashes.of(s, e - 7)


def _texts(batch: pa.RecordBatch, length: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, int]]:
    """``rows, data, offsets, base`` of pieces: many texts, or a part of one long one from ``base``.

    Parts of a long text overlap so that each string of ``length`` bytes is in exactly one.
    """
    for piece in slices(batch, "text", PIECE_BYTES):
        data, offsets = flat(piece.column("text"))
        rows = piece.column("row")
        if len(data) <= 2 * PIECE_BYTES:
            yield rows, data, offsets, 0
            continue
        # The slice is one or more short texts and a long one at the end.
        for i in range(len(rows)):
            text = data[offsets[i] : offsets[i + 1]]
            for base in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
                part = text[base : base + PIECE_BYTES + length - 1]
                yield rows.slice(i, 1), part, np.array([0, len(part)]), base


def segments(rows: DataFrame, length: int) -> DataFrame:
    """All segments of ``row, text``: anchor, digest of the segment, row, and places in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, offsets, base in _texts(batch, length):
                row, s, e, p, anchor, digest = anchors(data, offsets, length)
                start = offsets[row] - base
                yield pa.record_batch(
                    {
                        "anchor": anchor.view(np.int64),
                        "digest": digest.view(np.int64),
                        "row": ids.take(pa.array(row)),
                        "s": s - start,
                        "e": e - start,
                        "p": p - start,
                    }
                )

    return rows.select("row", "text").mapInArrow(run, ROWS)


class RunLengthIndex:
    """The runs of the Burrows-Wheeler transform of several strings, sampled at their ends.

    The strings are taken to end in separators that are all different and in ascending order.
    """

    def __init__(self, strings: list[bytes]) -> None:
        lengths = np.array([len(s) for s in strings], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.text = np.frombuffer(b"".join(strings), np.uint8)
        self.end_of = np.repeat(self.ends, lengths)
        suffixes = self._sorted_suffixes(int(lengths.max(initial=0)))
        first = np.zeros(len(self.text), bool)
        first[self.starts[lengths > 0]] = True
        before = self.text[suffixes - 1].astype(np.int64)
        before[first[suffixes]] = -1
        # A separator is a run of its own.
        head = np.ones(len(suffixes), bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] < 0)
        places = np.flatnonzero(head)
        self.symbols = before[places]
        self.run_lengths = np.diff(np.append(places, len(suffixes)))
        # Text places of each run's first suffix and of the suffix before it, the last run's end.
        self.at_start = suffixes[places]
        self.at_end_before = suffixes[places - 1]

    def _sorted_suffixes(self, longest: int) -> np.ndarray:
        """Places in order of the suffixes that start there, by prefix doubling."""
        n = len(self.text)
        place = np.arange(n)
        key = np.zeros(n, np.int64)
        padded = np.concatenate([self.text, np.zeros(8, np.uint8)]).astype(np.int64)
        for i in range(7):  # seven symbols of nine bits; 0 where the string has ended
            key = key << 9 | np.where(place + i < self.end_of, padded[i : i + n] + 1, 0)
        depth = 7
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.ones(n, np.int64)
            new[1:] = ordered[1:] != ordered[:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            if depth >= longest or (n and rank[order[-1]] == n):
                return order
            after = place + depth
            inside = after < self.end_of
            following = np.where(inside, rank[np.minimum(after, n - 1)], 0)
            key = rank * (n + 1) + following
            depth *= 2

    def long_matches(self, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and lengths of matches of ``length`` bytes or more with another place.

        Their union covers every such match; shorter ones inside a longer one are not repeated.
        """
        if len(self.at_start) < 2:
            return
        a, b = self.at_end_before[1:], self.at_start[1:]
        room = np.minimum(self.end_of[a] - a, self.end_of[b] - b)
        fits = room >= length
        a, b, room = a[fits], b[fits], room[fits]
        common = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        step = 64
        while len(open_):
            # Equal bytes of the next step, up to the first that differs or the end of a string.
            left = room[open_] - common[open_]
            reach = np.minimum(np.arange(step), np.maximum(left - 1, 0)[:, None])
            same = (
                self.text[(a + common)[open_][:, None].clip(0, len(self.text) - 1) + reach * 1]
                == self.text[(b + common)[open_][:, None].clip(0, len(self.text) - 1) + reach * 1]
            ) & (np.arange(step) < left[:, None])
            run = np.where(same.all(1), step, same.argmin(1))
            common[open_] += run
            open_ = open_[(run == step) & (common[open_] < room[open_])]
        long_ = common >= length
        yield a[long_], common[long_]
        yield b[long_], common[long_]


def _cut_out(
    texts: DataFrame, wanted: DataFrame, staging: Staging, name: str, step: int, length: int
) -> DataFrame:
    """Segments with their bytes (step 0), or dealt anew by strings of ``step`` successive starts."""
    lists = staging.table(
        wanted.groupBy("row").agg(
            F.collect_list(F.struct("anchor", "digest", "s", "e", "p", "many")).alias("wanted")
        ),
        name,
    )
    joined = only(texts, lists, "row").join(lists, "row").select("row", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.column("row"), batch.column("text"), batch.column("wanted")
            for row, text, wanted in zip(*columns, strict=True):
                data = (text.as_py() or "").encode()
                if step:
                    yield _dealt_anew(row.as_py(), data, wanted.as_py(), step, length)
                    continue
                asked = wanted.as_py()
                yield pa.record_batch(
                    {
                        "anchor": pa.array([w["anchor"] for w in asked], pa.int64()),
                        "many": pa.array([w["many"] for w in asked], pa.bool_()),
                        "row": pa.array([row.as_py()] * len(asked), pa.int64()),
                        "s": pa.array([w["s"] for w in asked], pa.int64()),
                        "bytes": pa.array([data[w["s"] : w["e"]] for w in asked], pa.binary()),
                    }
                )

    schema = f"{ROWS}, many boolean" if step else "anchor long, many boolean, row long, s long, bytes binary"
    return joined.mapInArrow(run, schema)


def _dealt_anew(row: int, data: bytes, asked: list[dict], step: int, length: int) -> pa.RecordBatch:
    """Parts of segments, keyed by the bytes that all strings of a part have in common."""
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    out: list[list] = [[], [], [], [], [], []]
    for w in asked:
        starts = np.arange(w["s"], w["e"] - length + 1)
        # Parts are fixed relative to the anchor, so that equal strings come into equal parts.
        part = (w["p"] - starts) // step
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        last = np.concatenate([first[1:], [len(starts)]]) - 1
        # All strings that may be in the part have these bytes.
        inner = w["p"] - part[first] * step
        outer = w["p"] - (part[first] + 1) * step + 1 + length
        key = hashes.of(inner, np.maximum(inner, outer - 7)) ^ mix(part[first].astype(np.uint64))
        s, e = starts[first], starts[last] + length
        for column, values in zip(
            out,
            (key.view(np.int64), hashes.of(s, e - 7).view(np.int64), s, e, np.full(len(s), w["p"])),
            strict=False,
        ):
            column.append(values)
        out[5].append(np.full(len(s), w["many"]))
    key, digest, s, e, p, many = (np.concatenate(c) for c in out)
    return pa.record_batch(
        {
            "anchor": key,
            "digest": digest,
            "row": np.full(len(s), row),
            "s": s,
            "e": e,
            "p": p,
            "many": pa.array(many.astype(bool)),
        }
    )


def _indexed(cut: DataFrame, buckets: int, length: int) -> DataFrame:
    """``row, s, e`` of long matches among the segments of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def matched(held: list[tuple]) -> pa.RecordBatch:
            rows, starts, many, strings = (list(c) for c in zip(*held, strict=True))
            index = RunLengthIndex(strings)
            out = [[], [], []]
            for place, size in index.long_matches(length):
                string = np.searchsorted(index.ends, place, "right")
                # Segments that stand in several places are removed whole already.
                once = ~np.array(many, bool)[string]
                place, size, string = place[once], size[once], string[once]
                s = np.array(starts, np.int64)[string] + place - index.starts[string]
                for column, values in zip(
                    out, (np.array(rows, np.int64)[string], s, s + size), strict=True
                ):
                    column.append(values)
            row, s, e = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)
            found = np.unique(np.stack([row, s, e], 1), axis=0)
            return pa.record_batch(
                {"row": found[:, 0].copy(), "s": found[:, 1].copy(), "e": found[:, 2].copy()}
            )

        at, held = None, []
        for batch in batches:
            names = ("bucket", "row", "s", "many", "bytes")
            for bucket, *rest in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if bucket != at and held:
                    yield matched(held)
                    held = []
                at = bucket
                held.append(tuple(rest))
        if held:
            yield matched(held)
        release()

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).cast("int")
    return (
        cut.withColumn("bucket", bucket)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(run, "row long, s long, e long")
    )


def repeated_spans(
    texts: DataFrame, staging: Staging, length: int, most: int = ANCHOR_SEGMENTS
) -> DataFrame:
    """``row, s, e``: byte spans that together cover all that repeats; they may overlap.

    ``texts`` has ``row`` (long, unique) and ``text``.
    """
    found = []
    level = staging.table(segments(texts, length).withColumn("many", F.lit(False)), "segments")
    for at, step in enumerate((*REFINED, 0)):
        counted = staging.table(
            level.groupBy("anchor", "digest").agg(
                F.count("*").alias("c"),
                F.bool_or("many").alias("many"),
                F.min(F.struct("row", "s", "e", "p")).alias("one"),
            )
            # A segment that stands alone with its anchor has nothing to meet.
            .join(
                level.groupBy("anchor").agg(F.count("*").alias("all")).where("all > 1"),
                "anchor",
                "left_semi",
            ),
            f"counted-{at}",
        )
        several = counted.where("c > 1 or many").select("anchor", "digest")
        found.append(
            level.join(several, ["anchor", "digest"], "left_semi").select("row", "s", "e")
        )
        kinds = counted.groupBy("anchor").agg(
            F.count("*").alias("kinds"), F.sum(F.expr("one.e - one.s")).alias("size")
        )
        kinds = staging.table(kinds.where("kinds > 1"), f"kinds-{at}")
        samples = counted.select(
            "anchor", "digest", "one.*", (F.col("many") | (F.col("c") > 1)).alias("many")
        )
        size = kinds.where(F.col("kinds") <= most).agg(F.sum("size")).first()[0] or 0
        if size:
            wanted = samples.join(
                kinds.where(F.col("kinds") <= most).select("anchor"), "anchor", "left_semi"
            )
            cut = _cut_out(texts, wanted, staging, f"wanted-{at}", 0, length)
            found.append(
                staging.table(_indexed(cut, -(-size // INDEX_BYTES), length), f"matches-{at}")
            )
        crowded = kinds.where(F.col("kinds") > most).select("anchor")
        if not step or crowded.isEmpty():
            break
        wanted = samples.join(crowded, "anchor", "left_semi")
        level = staging.table(
            _cut_out(texts, wanted, staging, f"crowded-{at}", step, length), f"level-{at + 1}"
        )
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def _with_spans(
    docs: DataFrame, length: int, id_col: str, text_col: str, most: int
) -> tuple[DataFrame, str]:
    """The rows with a column of their spans (null where there are none), and its name."""
    if length < 32:
        raise ValueError(f"length must be at least 32 bytes, got {length}")
    staging = Staging(docs.sparkSession)
    rows, row = with_row(docs, id_col, staging)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = rows.select(F.col(row).alias("row"), text.alias("text"))
    spans = fresh("_spans", docs.columns)
    found = staging.table(
        repeated_spans(texts, staging, length, most)
        .groupBy("row")
        .agg(F.collect_list(F.struct("s", "e")).alias(spans))
        .withColumnRenamed("row", row),
        "spans",
    )
    return rows.join(found, row, "left").select(*docs.columns, spans), spans


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint spans that do not touch, in order."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for s, e in spans:
        parts.append(data[at:s])
        at = e
    return b"".join([*parts, data[at:]])


def remove_repeats(
    docs: DataFrame,
    *,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = ANCHOR_SEGMENTS,
) -> DataFrame:
    """``doc_id, n_bytes, kept (binary), spans`` of every row, without repeated bytes.

    Each byte goes that is covered by a string of ``length`` bytes that also starts elsewhere, in the
    same text or another; strings are judged on the input. ``spans`` are the maximal runs of removed
    bytes. A null text counts as empty, texts under ``length`` bytes can only be kept; rows may share
    an id or have none, each is a text of its own. An empty table gives no rows. Strings are compared
    by two 64-bit hashes where they stand in several places, byte by byte otherwise.
    """
    joined, found = _with_spans(docs.select(id_col, text_col), length, id_col, text_col, most)
    joined = joined.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(found).alias("spans"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, left, cut = [], [], []
                for text, spans in zip(part.column("text"), part.column("spans"), strict=True):
                    data = (text.as_py() or "").encode()
                    own = merged_spans([(x["s"], x["e"]) for x in spans.as_py() or []])
                    sizes.append(len(data))
                    cut.append([{"s": s, "e": e} for s, e in own])
                    left.append(kept(data, own))
                kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_bytes": pa.array(sizes, pa.int64()),
                        "kept": pa.array(left, pa.binary()),
                        "spans": pa.array(cut, kind),
                    }
                )

    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, kept binary, spans array<struct<s:long,e:long>>"
    )


def summary(removed: DataFrame) -> DataFrame:
    """Counts, the digest of what is left, and its ``text``, from ``remove_repeats``.

    Bytes of characters that were cut in two show as the replacement character in ``text``.
    """
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of UTF-8 characters at their ends."""
    out = []
    for s, e in spans:
        while s < e and data[s] & 0xC0 == 0x80:
            s += 1
        while s < e < len(data) and data[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def without_repeats(
    docs: DataFrame,
    *,
    length: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = None,
) -> DataFrame:
    """The rows, all columns, with texts that have lost their repeated bytes, whole characters only.

    ``length_col`` gets the new number of code points. A null text stays null.
    """
    joined, found = _with_spans(docs, length, id_col, text_col, ANCHOR_SEGMENTS)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                spans = part.column(found).to_pylist()
                columns = {n: part.column(n) for n in names}
                changed = [i for i, own in enumerate(spans) if own]
                if changed:
                    texts = columns[text_col].to_pylist()
                    lengths = columns[length_col].to_pylist() if length_col else []
                    for i in changed:
                        data = texts[i].encode()
                        own = merged_spans([(x["s"], x["e"]) for x in spans[i]])
                        texts[i] = kept(data, whole_characters(data, own)).decode()
                        if length_col:
                            lengths[i] = len(texts[i])
                    columns[text_col] = pa.array(texts, pa.string())
                    if length_col:
                        columns[length_col] = pa.array(lengths, columns[length_col].type)
                yield pa.record_batch(list(columns.values()), names=list(columns))

    return joined.mapInArrow(run, docs.schema)
