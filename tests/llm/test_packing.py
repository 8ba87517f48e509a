import random
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from labelmill.llm import packing
from labelmill.llm.queries import QUERIES

VOCABULARY = path("byte_bpe_50k.json")


def check(pieces, texts, end, capacity):
    """Each id in one piece, sequences gapless, nothing padded but at a power of two."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    left = Counter()
    for text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        left[np.array(ids, "<u4").tobytes()] += 1
    docs, sequences = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        docs.setdefault(p.doc_id, []).append(p)
        assert len(p.ids) == 4 * p.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or (at < capacity and at.bit_count() == 1)
    return docs, left


def test_whole_documents_come_back(make, hard):
    rows = [*hard, *((100 + i, "abc def " * (i * 7)) for i in range(60))]
    pieces = packing.pack(make(rows), VOCABULARY, 0, capacity=64).collect()
    docs, left = check(pieces, [t for _, t in rows], 0, 64)
    assert sum(p.length for p in pieces) == sum(len(k) // 4 * c for k, c in left.items())
    for i in (1, 2, 3, 4, 7, 8, 9, *range(100, 160)):
        parts = sorted(docs[i], key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts[:-1]]))
        whole = b"".join(bytes(p.ids) for p in parts)
        assert left[whole] > 0 and all(p.doc_tokens == len(whole) // 4 for p in parts)


def test_empty(make):
    assert packing.pack(make([]), VOCABULARY, 0).collect() == []


def test_ranks_without_broadcast(make, monkeypatch):
    monkeypatch.setattr(packing, "RANKS_BYTES", 0)
    rows = [(i, "word " * (i % 9)) for i in range(200)]
    check(packing.pack(make(rows), VOCABULARY, 0, capacity=32).collect(), [t for _, t in rows], 0, 32)


def test_closest_fill_is_optimal():
    random.seed(5)
    for _ in range(200):
        lengths = {random.randrange(1, 30): random.randrange(1, 4) for _ in range(5)}
        capacity = random.randrange(1, 60)
        sums = {0}
        for x, n in lengths.items():
            sums = {s + x * m for s in sums for m in range(n + 1)}
        chosen = packing.closest_fill(lengths, capacity)
        assert all(chosen[x] <= lengths[x] for x in chosen)
        assert sum(x * m for x, m in chosen.items()) == max(s for s in sums if s <= capacity)


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_remainder_once(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 64): rng.randrange(1, 40) for _ in range(20)} | {40: 500}
    plan = packing.make_plan(counts, 64)
    filled = Counter()
    for length, n in counts.items():
        ranks = np.arange(n)
        for rank, e in zip(ranks, plan.entry(np.full(n, length), ranks), strict=True):
            assert plan.length[e] == length
            turn = int(rank - plan.rank[e])
            if plan.each[e]:
                later, _ = divmod(turn, int(plan.each[e]))
                filled[int(plan.sequence[e]) + later] += length
            else:
                for sequence, _, m in plan.cut(int(plan.offset[e]) + turn * length, length):
                    filled[sequence] += m
    assert sorted(filled) == list(range(packing.n_sequences(plan)))
    short = [n for n in filled.values() if n < 64]
    assert all(n.bit_count() == 1 for n in short) and len(short) <= 6
    assert max(filled.values()) <= 64


def test_query(spark, sf):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_bin_slack_packing"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(docs)
    for r in rows:
        ids = tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids + [0]
        part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids)
