"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

A sequence of pieces is what merging gives if and only if every piece is, and every two neighbours
are. So the encoder goes through the text with the longest pieces that match (found by an
Aho-Corasick automaton), shortens a piece that its neighbour does not go with, steps back when none
is left, and marks the places that it failed at in a bitfield. Whether two pieces go together is
found by merging their joint text again; the answers are kept.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import flat, slices
from labelmill.llm.chunks import ENCODE_BYTES, ChunkEncoder

MARK = "▁"  # stands for a blank inside pieces
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Answers about pairs of pieces that a worker keeps.
PAIRS = 1_000_000


class MergeModel:
    """Pieces and scores of a model without normalisation, with byte fallback."""

    def __init__(self, model: bytes) -> None:
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = library.get_piece_size()
        self.begin, self.end = library.bos_id(), library.eos_id()
        ids = range(self.size)
        texts = [library.id_to_piece(i) for i in ids]
        self._scores = [library.get_score(i) for i in ids]
        special = {i for i in ids if library.is_control(i) or library.is_unknown(i)}
        self.bytes = {int(texts[i][3:5], 16): i for i in ids if library.is_byte(i)}
        special |= set(self.bytes.values())
        self._pieces = {texts[i]: i for i in ids if i not in special}
        self.texts = texts
        if any(MARK in t.lstrip(MARK) or (t.startswith(MARK * 2) and t.strip(MARK)) for t in self._pieces):
            raise ValueError("pieces with blanks inside are not supported")
        self._automaton = ahocorasick.Automaton()
        for text, i in self._pieces.items():
            self._automaton.add_word(text, (i, len(text)))
        self._automaton.make_automaton()
        # For each piece the longest piece that it begins with, itself excepted.
        self._shorter = {}
        for text, i in self._pieces.items():
            longest = (text[:n] for n in range(len(text) - 1, 0, -1))
            self._shorter[i] = next((self._pieces[t] for t in longest if t in self._pieces), -1)
        self._goes: dict[int, bool] = {}
        self._runs: dict[int, list[int]] = {}
        # Decoding: what each id stands for in bytes.
        written = [b"" if i in special else texts[i].replace(MARK, " ").encode() for i in ids]
        for value, i in self.bytes.items():
            written[i] = bytes([value])
        self.written = pa.array(written, pa.large_binary())

    def merged(self, text: str) -> list[str]:
        """The text's pieces by merging: the best score first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        left = list(range(-1, len(parts) - 1))
        right = list(range(1, len(parts) + 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts):
                both = parts[i] + parts[j]
                if both in self._pieces:
                    heapq.heappush(queue, (-self._scores[self._pieces[both]], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != both or right[i] != j:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def _go_together(self, a: int, b: int) -> bool:
        key = a * self.size + b
        answer = self._goes.get(key)
        if answer is None:
            if len(self._goes) > PAIRS:
                self._goes.clear()
            # ``a`` is -1 at the start of a text: then the piece alone is asked about.
            pieces = [self.texts[i] for i in (a, b) if i >= 0]
            answer = self._goes[key] = self.merged("".join(pieces)) == pieces
        return answer

    def _backtrack(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        n = len(text)
        longest = [-1] * n
        for end, (i, size) in self._automaton.iter(text):
            longest[end + 1 - size] = i  # matches come in order of their end
        texts, shorter, together = self.texts, self._shorter, self._go_together
        failed = 0  # bitfield of places from which the text cannot be finished
        ids: list[int] = []
        at, piece = 0, longest[0]
        while at < n:
            before = ids[-1] if ids else -1
            while piece >= 0:
                stop = at + len(texts[piece])
                if not failed >> stop & 1 and together(before, piece) and together(-1, piece):
                    break
                piece = shorter[piece]
            if piece >= 0:
                ids.append(piece)
                at = stop
                piece = longest[at] if at < n else -1
            else:
                failed |= 1 << at
                piece = ids.pop()
                at -= len(texts[piece])
        return ids

    def _blanks(self, n: int) -> list[int]:
        """Ids of n blanks: their pieces all have one score, so they are merged as they come."""
        if n not in self._runs:
            ids = [self._pieces[p] for p in self.merged(MARK * n)]
            if len(self._runs) > 1000:
                self._runs.clear()
            self._runs[n] = ids
        return self._runs[n]

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of some blanks and the text without blanks that follows."""
        word = chunk.lstrip(" ")
        blanks = len(chunk) - len(word)
        if not word:
            return self._blanks(blanks) if blanks else []
        out: list[int] = []
        known = MARK if blanks else ""
        for c in word:
            if c in self._pieces:
                known += c
                continue
            if known:
                out += self._backtrack(known)
                known = ""
            out += [self.bytes[b] for b in c.encode()]
        if known:
            out += self._backtrack(known)
        if blanks == 0:
            return out
        # The last blank has joined the word, or else it stays with the blanks before.
        if out[0] == self._pieces[MARK]:
            return self._blanks(blanks) + out[1:]
        return (self._blanks(blanks - 1) if blanks > 1 else []) + out

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts one after another, and the row offsets in them.

        The blank that encoding puts before a text is taken off again.
        """
        pieces = self.written.take(pa.array(ids))
        data, ends = flat(pieces)
        bounds = ends[rows]
        keep = np.ones(len(data), bool)
        first = bounds[:-1][bounds[1:] > bounds[:-1]]
        keep[first[data[first] == 32]] = False
        dropped = np.concatenate([[0], np.cumsum(~keep)])
        return data[keep], bounds - dropped[bounds]


def cuts(data: np.ndarray, _offsets: np.ndarray) -> np.ndarray:
    """A chunk starts at blanks after another character, and on both sides of a line end."""
    line = data == 10
    blank = data == 32
    starts = line.copy()
    starts[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
    return starts


@lru_cache(maxsize=2)
def _model(model: bytes) -> MergeModel:
    own = MergeModel(model)
    if "\n" in own._pieces:
        raise ValueError("models with pieces that have line ends are not supported")
    return own


def loaded(model: bytes) -> tuple[MergeModel, ChunkEncoder]:
    """The model, and an encoder with a table of its own."""
    own = _model(model)

    def encode_chunks(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [own.encode_chunk(c.decode()) for c in chunks]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    return own, ChunkEncoder(cuts, encode_chunks)


def with_first_blank(texts: pa.Array) -> pa.Array:
    """Texts with a blank before all that are not empty; the blank's mark itself reads as a blank."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pc.replace_substring(texts, MARK, " ")
    blank = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
    return pc.binary_join_element_wise(blank, texts, pa.scalar("", pa.large_string()))


def encode(
    docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids`` (with begin and end id) and ``decoded`` for every row, in no order.

    A null text counts as empty: the begin and the end id alone. Null and repeated ids are kept as
    they are. The model must be of merge type without normalisation.
    """
    with open(model_path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encoder = loaded(sent.value)
        for batch in batches:
            for part in slices(batch, "text", ENCODE_BYTES):
                ids, rows = encoder.encode(*flat(with_first_blank(part.column("text"))))
                data, ends = model.decode(ids, rows)
                n = part.num_rows
                framed = np.insert(
                    np.insert(ids, rows[1:], model.end), rows[:-1] + np.arange(n), model.begin
                )
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "ids": pa.ListArray.from_arrays(
                            pa.array(rows + 2 * np.arange(n + 1), pa.int32()), pa.array(framed)
                        ),
                        "decoded": pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(),
                            n,
                            [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)],
                        )
                        .cast(pa.large_string())
                        .cast(pa.string()),
                    }
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Number and digest of the ids, and digest of the decoded text, from ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy()
            ids = lists.values.to_numpy().astype("<u4").tobytes()
            bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            texts = batch.column("decoded")
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": np.diff(offsets).astype(np.int64),
                    "ids_sha256": [hashlib.sha256(ids[4 * a : 4 * b]).hexdigest() for a, b in bounds],
                    "decoded_sha256": [hashlib.sha256(t.as_buffer()).hexdigest() for t in texts],
                }
            )

    return encoded.mapInArrow(run, RESULT)
