"""Periodic runs of words: maximal stretches that repeat with a smallest period.

All documents of a slice are one sequence of names, equal for equal words of one document. Names of
stretches of 2, 4, 8, ... words come from pairs of names (only stretches that stand in a document
twice go on), so two places are compared over any length by a few look-ups. The suffixes that
start with a repeated block are sorted, and a wavelet matrix over their places answers range
successor: the next place of a block after a given one.

A run of period q holds a dyadic block of about q / 4 words within its first period, and the block
stands q words further on as well. So each block asks for its places in the window that such
periods reach. Places less than half a block apart are a progression by the block's own period, which
one comparison finds the end of. Each place found is a candidate period; comparing to both sides
gives the run, and of equal stretches the smallest period counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import Words, flat, slices

# Words of a run at least, by default.
LEAST = 12
# Candidates that are compared at a time.
COMPARED = 1 << 20

RUN = "array<struct<start: long, length: long, period: long>>"
RESULT = f"doc_id long, n_words long, runs {RUN}, collapsed string"


def word_names(data: np.ndarray, words: Words) -> np.ndarray:
    """A number for each word, equal for equal words of one document and for no others."""
    lengths = words.ends - words.starts
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    letters = data[np.arange(bounds[-1]) + np.repeat(words.starts - bounds[:-1], lengths)]
    spelled = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(lengths),
        [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(letters)],
    ).dictionary_encode()
    named = words.row_of() * max(1, len(spelled.dictionary)) + spelled.indices.to_numpy()
    return np.unique(named, return_inverse=True)[1]


class Names:
    """``levels[j][i]`` names the 2**j words from place i. Stretches that stand only once have negative
    names of their own, so that they are equal to no other."""

    def __init__(self, names: np.ndarray) -> None:
        n = len(names)
        alone = -1 - np.arange(n + 1, dtype=np.int64)
        again = np.bincount(names, minlength=1)[names] > 1
        active = np.flatnonzero(again)
        first = alone.copy()
        first[active] = names[active]
        self.levels, self.active = [first], [active]
        while len(active):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            active = active[active + step < n]
            active = active[last[active + step] >= 0]
            keys = last[active] * (n + 1) + last[active + step]
            _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
            again = count[name] > 1
            active = active[again]
            if not len(active):
                break
            level = alone.copy()
            level[active] = name[again]
            self.levels.append(level)
            self.active.append(active)

    def after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal from the places a and b > a on."""
        equal = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            same = self.levels[j][a + equal] == self.levels[j][b + equal]
            equal[same] += 1 << j
        return equal

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words are equal right before the places a and b > a."""
        equal = np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            step = 1 << j
            left, right = a - equal - step, b - equal - step
            same = left >= 0
            same[same] = self.levels[j][left[same]] == self.levels[j][right[same]]
            equal[same] += step
        return equal


class WaveletMatrix:
    """Numbers below 2**bits, for counts and order statistics of any stretch of them."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits = bits
        self._zeros = []
        for bit in range(bits - 1, -1, -1):
            is_zero = (values >> bit & 1) == 0
            self._zeros.append(np.concatenate([[0], np.cumsum(is_zero)]))
            values = np.concatenate([values[is_zero], values[~is_zero]])

    def less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values lo..hi are less than x < 2**bits."""
        count = np.zeros(len(lo), np.int64)
        for zeros, bit in zip(self._zeros, range(self.bits - 1, -1, -1), strict=True):
            zlo, zhi = zeros[lo], zeros[hi]
            one = (x >> bit & 1) == 1
            count += np.where(one, zhi - zlo, 0)
            lo = np.where(one, zeros[-1] + lo - zlo, zlo)
            hi = np.where(one, zeros[-1] + hi - zhi, zhi)
        return count

    def ranked(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank k (from 0) among those at lo..hi."""
        value = np.zeros(len(lo), np.int64)
        for zeros, bit in zip(self._zeros, range(self.bits - 1, -1, -1), strict=True):
            zlo, zhi = zeros[lo], zeros[hi]
            one = k >= zhi - zlo
            value += one.astype(np.int64) << bit
            k = np.where(one, k - (zhi - zlo), k)
            lo = np.where(one, zeros[-1] + lo - zlo, zlo)
            hi = np.where(one, zeros[-1] + hi - zhi, zhi)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of at least x among those at lo..hi, or -1."""
        rank = self.less(lo, hi, x)
        found = rank < hi - lo
        out = np.full(len(lo), -1, np.int64)
        out[found] = self.ranked(lo[found], hi[found], rank[found])
        return out


def base_blocks(least: int) -> tuple[int, int]:
    """Level of the shortest blocks, and how far apart they start.

    A run of at least ``least`` words and two periods goes on for ceil(least / 2) words or more after
    its first period; so many words surely hold one of these blocks.
    """
    sure = -(-least // 2)
    level = sure.bit_length() - 1
    return level, 1 << ((sure - (1 << level) + 1).bit_length() - 1)


def candidates(names: Names, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): a block at the place stands one period further on, too."""
    base, apart = base_blocks(least)
    if len(names.levels) <= base:
        return
    places = names.active[base]
    order = np.lexsort([level[places] for level in names.levels[:base - 1 if base else None:-1]])
    suffixes = places[order]
    n = len(names.levels[0]) - 1
    # Windows reach beyond the end by less than four blocks.
    wavelet = WaveletMatrix(suffixes, (5 * n + 8).bit_length())
    rank = np.full(n, -1, np.int64)
    rank[suffixes] = np.arange(len(suffixes))
    for j in range(base, len(names.levels)):
        length = 1 << j
        step = apart if j == base else length
        blocks = names.active[j][names.active[j] % step == 0]
        # Suffixes that start with the same block are neighbours.
        own = names.levels[j][suffixes]
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        at = np.searchsorted(starts, rank[blocks], "right")
        lo, hi = starts[at - 1], np.append(starts, len(own))[at]
        end = blocks + 4 * length - 2
        place = wavelet.successor(lo, hi, blocks + (1 if j == base else 2 * length - 1))
        while True:
            live = (place >= 0) & (place <= end)
            if not live.any():
                break
            blocks, lo, hi, end, place = (x[live] for x in (blocks, lo, hi, end, place))
            yield blocks, place - blocks
            then = wavelet.successor(lo, hi, place + 1)
            # Closer than half a block: the block repeats by that distance within itself.
            close = np.flatnonzero((then >= 0) & (then - place <= length // 2))
            if len(close):
                p, first = blocks[close], place[close]
                own_period = then[close] - first
                stretch = own_period + names.after(first, first + own_period)
                last = first + (stretch - length) // own_period * own_period
                # If the block lies in the same stretch, its own period is the only one there.
                apart_from = p + own_period + names.after(p, p + own_period) < first + length
                more = np.minimum(last, end[close]) - first
                more = np.where(apart_from, np.maximum(0, more // own_period), 0)
                yield from _progression(p, first, own_period, more)
                then[close] = wavelet.successor(lo[close], hi[close], last + 1)
            place = then


def _progression(
    p: np.ndarray, first: np.ndarray, period: np.ndarray, more: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates of ``more`` further places, each a period on from the one before."""
    ends = np.cumsum(more)
    start = 0
    while start < len(more):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + COMPARED, "right")))
        part = more[start:stop]
        number = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part) + 1
        places = np.repeat(first[start:stop], part) + number * np.repeat(period[start:stop], part)
        owner = np.repeat(p[start:stop], part)
        yield owner, places - owner
        start = stop


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Each stretch (start, length) once, with the smallest of its periods."""
    runs = runs[:, np.lexsort(runs[::-1])]
    first = np.ones(runs.shape[1], bool)
    first[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
    return runs[:, first]


def find(names: Names, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of at least ``least`` words, by start and period."""
    held = [np.zeros((3, 0), np.int64)]
    for place, period in candidates(names, least):
        for at in range(0, len(place), COMPARED):
            p, q = place[at : at + COMPARED], period[at : at + COMPARED]
            back = names.before(p, p + q)
            length = back + names.after(p, p + q) + q
            kept = length >= np.maximum(least, 2 * q)
            found = np.stack([p - back, length, q])[:, kept]
            held.append(_smallest(found))
    start, length, period = _smallest(np.concatenate(held, axis=1))
    order = np.lexsort([period, start])
    return start[order], length[order], period[order]


def _joined(data: np.ndarray, words: Words, kept: np.ndarray) -> pa.Array:
    """Each row's kept words with a blank between them."""
    starts, ends, rows = words.starts[kept], words.ends[kept], words.row_of()[kept]
    lengths = ends - starts + 1
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    source = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths)
    source[bounds[1:] - 1] = len(data)
    letters = np.append(data, np.uint8(32))[source]
    per_row = np.bincount(rows, lengths, minlength=len(words.rows) - 1).astype(np.int64)
    ends_of_rows = np.cumsum(per_row)
    # No blank after a row's last word.
    mask = np.ones(len(letters), bool)
    mask[ends_of_rows[per_row > 0] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(np.maximum(per_row - 1, 0))])
    return pa.LargeStringArray.from_buffers(
        len(per_row), pa.py_buffer(offsets), pa.py_buffer(letters[mask])
    ).cast(pa.string())


def _runs_of(part: pa.RecordBatch, least: int) -> pa.RecordBatch:
    data, offsets = flat(part.column("text"))
    words = Words(data, offsets)
    start, length, period = find(Names(word_names(data, words)), least)
    # Words from the second period on, over all runs.
    depth = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    kept = np.cumsum(depth[:-1]) == 0
    row = np.searchsorted(words.rows, start, "right") - 1
    runs = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(row, np.arange(len(words.rows))), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (start - words.rows[row], length, period)],
            names=["start", "length", "period"],
        ),
    )
    return pa.record_batch(
        {
            "doc_id": pc.cast(part.column("doc_id"), pa.int64()),
            "n_words": pa.array(np.diff(words.rows), pa.int64()),
            "runs": runs,
            "collapsed": _joined(data, words, kept),
        }
    )


def runs(
    docs: DataFrame, *, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words with smallest period
    q, of at least ``least`` words and two periods, that no neighbouring word extends; ``runs`` lists
    them by start, then period. ``collapsed`` is the text without the words that some run holds after
    its first q words, joined by one blank.

    Rows are independent: null ids, repeated rows and ids are worked on like others. A null text, or
    one without words, has no runs and collapses to an empty text. An empty table gives no rows. A
    text is handled whole; memory grows with it, about 200 bytes a word that stands in repetitions.
    """
    if least < 2:
        raise ValueError(f"a run has at least 2 words, got {least}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _runs_of(part, least)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(run, RESULT)


def summary(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and digests."""
    best = F.array_min(
        F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period)).cast(
            "array<struct<length: long, start: long, period: long>>"
        )
    )
    line = F.concat(
        F.array_join(
            F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n"
        ),
        F.when(F.size("runs") > 0, "\n").otherwise(""),
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.length")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: about a tenth of the texts, chosen by id, given a tail that repeats.

    With h the id's CRC-32 and g = h / 10: where h is divisible by 10, the words from a = g % n on
    repeat those from a by a period of 1 + (n - a) / (3 + g % 8). Other texts, those without words and
    those with a null id stay as they are.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    repeats = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), repeats)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    text = F.when((h % 10 == 0) & F.rlike("text", F.lit("[^\\x20\\x09-\\x0D]")), planted)
    return rows.withColumn("text", F.coalesce(text, "text"))
