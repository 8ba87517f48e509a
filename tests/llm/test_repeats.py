import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from labelmill.llm import repeats
from labelmill.llm.queries import QUERIES


def by_hand(texts, length):
    """Which bytes of each text are covered by a string that starts in two places."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        left = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        out.append((len(t), int(covered.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def found(docs, length, **options):
    rows = repeats.summary(repeats.remove_repeats(docs, length=length, **options)).collect()
    return sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


@pytest.fixture
def corpus():
    rng = random.Random(9)

    def prose(n):
        return " ".join(rng.choice("ab cde fgh é 日本 ijklm n opq".split()) for _ in range(n))

    base = prose(120)
    passage = prose(40)
    texts = [prose(80) for _ in range(20)] + [base] * 4
    for _ in range(25):  # near copies, each with an edit of its own
        at = rng.randrange(len(base))
        texts.append(base[:at] + str(rng.randrange(1000)) + base[at:])
    texts += [prose(20) + passage + prose(rng.randrange(30)) for _ in range(15)]
    texts += ["x" * 500, "x" * 90, "ab" * 200, "abc" * 100 + "é", passage + passage]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("length", [32, 64, 150])
@pytest.mark.parametrize("most", [8192, 2])
def test_against_all_strings(make, corpus, length, most):
    """Also with so few segments to an anchor that groups are dealt anew."""
    docs = make(list(enumerate(corpus)))
    assert found(docs, length, most=most) == sorted(by_hand(corpus, length))


def test_long_text_in_parts(make, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_BYTES", 700)
    rng = random.Random(10)
    passage = "".join(rng.choice("abcdef ") for _ in range(90))
    text = "".join(rng.choice("abcdefghij ") for _ in range(6000))
    text = text[:650] + passage + text[650:3000] + passage + text[3000:]
    texts = ["short", text, "z" + passage + "z", "tail"]
    data, parts = text.encode(), []
    batch = pa.record_batch({"row": pa.array([5]), "text": pa.array([text])})
    for _, piece, offsets, base in repeats._texts(batch, 64):
        _, s, e, *_ = repeats.anchors(piece, offsets, 64)
        parts += [(s + base, e + base) for s, e in zip(s, e, strict=True)]
    starts = sorted(i for s, e in parts for i in range(s, e - 63))
    assert starts == list(range(len(data) - 63))  # each string in exactly one segment
    assert found(make(list(enumerate(texts))), 64) == sorted(by_hand(texts, 64))


def test_hard_rows(make, hard):
    short = [t for i, t in hard if i not in (7, 8)]
    assert found(make(hard), 400) == sorted(by_hand(short, 400) + long_rows(hard))
    assert found(make([]), 400) == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(make([]), length=8)


def long_rows(hard):
    """Two equal long texts: everything goes."""
    sizes = [len(t.encode()) for i, t in hard if i in (7, 8)]
    return [(n, n, 1, hashlib.sha256(b"").hexdigest()) for n in sizes]


def test_index_runs_and_matches():
    strings = [b"banana banana", b"a banana split", b"", b"xyz"]
    index = repeats.RunLengthIndex(strings)
    assert index.run_lengths.sum() == sum(map(len, strings))
    assert (index.symbols < 0).sum() == 3  # one for each string that is not empty
    covered = np.zeros(len(index.text), bool)
    for place, size in index.long_matches(6):
        for s, n in zip(place, size, strict=True):
            covered[s : s + n] = True
    assert bytes(index.text[covered]) == b"banana banana" + b"a banana "
    assert len(repeats.RunLengthIndex([b"ab" * 500]).symbols) < 20


def test_whole_characters_and_other_columns(make):
    head, tail = "é" * 40, "日" * 30
    docs = make([(1, "a" + head + "b"), (2, "c" + head + "d" + tail), (3, "日" * 31), (4, None)])
    rows = repeats.without_repeats(docs, length=41)
    assert rows.columns == docs.columns
    assert {r.doc_id: r.text for r in rows.collect()} == {1: "ab", 2: "cd", 3: "", 4: None}
    assert {r.spans for r in rows.collect()} == {"own"}


def test_query(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = QUERIES["op6_suffix_dedup"](spark, sf).collect()
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)
    assert got == sorted(by_hand(texts, 400)) and any(r.n_removed for r in rows)
