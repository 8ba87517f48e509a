import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from labelmill.llm import byte_bpe, chunks, pieces, simple8b
from labelmill.llm.batches import flat
from labelmill.llm.queries import QUERIES

SCRAPS = [
    "a", "e", "t", "h", "the", "ing", " ", "  ", "\n", "é", "日", "本", "▁", "x", "Ａ", "<s>", "\t",
    "\x00", "1", "23", ".", "ß", "tion", "　", "   ", "​", "'s", " 'll", "\r\n", "<|endoftext|>",
    " ", " ", "\x1c", "(", "word", ",", "_",
]


def texts(count=4000):
    rng = random.Random(6)
    made = ["".join(rng.choice(SCRAPS) for _ in range(rng.randrange(25))) for _ in range(count)]
    return [*made, *("a" + " " * n + "日" for n in range(40)), *(" " * n for n in range(40)), "x" * 500]


def test_pieces_equal_the_library():
    with open(path("piece_bpe_32k.model"), "rb") as file:
        model, encoder = pieces.loaded(file.read())
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    made = texts()
    ids, rows = encoder.encode(*flat(pieces.with_first_blank(pa.array(made))))
    data, ends = model.decode(ids, rows)
    for i, text in enumerate(made):
        expected = library.encode(text)
        assert ids[rows[i] : rows[i + 1]].tolist() == expected
        assert data[ends[i] : ends[i + 1]].tobytes().decode() == library.decode(expected)


def test_byte_bpe_equals_the_library(monkeypatch):
    monkeypatch.setattr(chunks, "REMEMBERED", 300)
    with open(path("byte_bpe_50k.json"), "rb") as file:
        encoder = byte_bpe.chunk_encoder(file.read())
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    made = texts()
    for at in range(0, len(made), 500):
        some = made[at : at + 500]
        ids, rows = encoder.encode(*flat(pa.array(some)))
        for i, text in enumerate(some):
            expected = library.encode(text, add_special_tokens=False).ids
            assert ids[rows[i] : rows[i + 1]].tolist() == expected


def test_chunks_that_begin_with_a_blank_are_encoded_together(monkeypatch):
    with open(path("byte_bpe_50k.json"), "rb") as file:
        vocabulary = file.read()
    library = byte_bpe._tokenizer(vocabulary)
    given = []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.append(len(texts))
            return library.encode_batch_fast(texts, **options)

    monkeypatch.setattr(byte_bpe, "_tokenizer", lambda _: Counted())
    rng = random.Random(7)
    scraps = ["a", "the", "ing", "é", "日", "ß", "tion", "12", "'s", "'ll", "(", ",", "_"]
    words = ["".join(rng.choice(scraps) for _ in range(rng.randrange(1, 6))) for _ in range(2000)]
    made = [" " + " ".join(words[at : at + 200]) for at in range(0, len(words), 200)]
    encoder = byte_bpe.chunk_encoder(vocabulary)
    ids, rows = encoder.encode(*flat(pa.array(made)))
    for i, text in enumerate(made):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids[rows[i] : rows[i + 1]].tolist() == expected
    # The line end's own ids, and one text for each group.
    assert sum(given) == 1 + -(-encoder._count // byte_bpe.JOINED)


@pytest.mark.parametrize(
    "values",
    [
        [],
        [0],
        [0] * 3000,
        [2**64 - 1] * 70,
        [2**60 - 1, 2**60, 0, 1, 2**63],
        list(range(5000)),
        [2 ** (i % 64) for i in range(4000)],
        [1, 0] * 1024,
    ],
)
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words, blocks = simple8b.encode(values)
    assert (simple8b.decode(words, blocks, len(values)) == values).all()


def test_simple8b_packs_small_values():
    words, _ = simple8b.encode(np.ones(1024 * 60, np.uint64))
    assert len(words) <= 1024 * 60 / 60 * 1.1


def test_files(spark, make, hard, tmp_path):
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    out = str(tmp_path / "ids")
    simple8b.write(make(hard), path("byte_bpe_50k.json"), 2, out)
    rows = simple8b.read(spark, out).orderBy("start").collect()
    order = sorted(hard, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (i, text) in zip(rows, order, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert row.doc_id == i and row.start == at
        assert bytes(row.ids) == np.array(ids, "<u4").tobytes()
        at += len(ids)
    empty = str(tmp_path / "none")
    simple8b.write(make([]), path("byte_bpe_50k.json"), 2, empty)
    assert simple8b.read(spark, empty).collect() == []


def test_pieces_of_hard_rows(make, hard):
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    rows = pieces.encode(make(hard), path("piece_bpe_32k.model")).collect()
    got = sorted((r.doc_id or -1, list(r.ids), r.decoded) for r in rows)
    expected = []
    for i, text in hard:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        expected.append((i or -1, ids, library.decode(ids)))
    assert got == sorted(expected)
    assert pieces.encode(make([]), path("piece_bpe_32k.model")).collect() == []


def test_queries(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    for r in QUERIES["op4_backtracking_pieces"](spark, sf).collect():
        ids = library.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    at = 0
    for r in QUERIES["op9_simple8b_ids"](spark, sf).orderBy("doc_id").collect():
        ids = tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
