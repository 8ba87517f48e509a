import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from labelmill.llm import fingerprint
from labelmill.llm.batches import flat
from labelmill.llm.queries import QUERIES


def edited(rows):
    """Rows in order, with the text that has its last quarter from the next."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in rows]
    out = []
    for (i, _), a, b in zip(rows, texts, texts[1:] + texts[:1], strict=True):
        out.append((i, a, a[: len(a) - len(a) // 4] + b[: len(a) // 4], b))
    return out


def check(found, rows):
    expected = []
    for i, text, changed, following in edited(rows):
        a, b, c = fingerprint.digests([x.encode() for x in (text, changed, following)])
        near = fingerprint.likeness(a[None], b[None])[0]
        far = fingerprint.likeness(a[None], c[None])[0]
        expected.append(
            (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.tobytes().hex(), near, far)
        )
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_hard_rows(make, hard):
    check(fingerprint.compare_edited(make(hard)).collect(), hard)
    assert fingerprint.compare_edited(make([])).collect() == []
    check(fingerprint.compare_edited(make([(5, "alone éé")])).collect(), [(5, "alone éé")])


def test_many_ranges(make):
    rng = random.Random(13)
    rows = [(rng.randrange(-(10**12), 10**12), "t" * rng.randrange(50) + str(i)) for i in range(700)]
    check(fingerprint.compare_edited(make(rows)).collect(), rows)


def test_counts_against_plain_loops():
    texts = [b"", b"ab", b"abc", b"abcd", bytes(range(256)) * 2]
    counts = fingerprint.bucket_counts(*flat(pa.array(texts, pa.large_binary())))
    for text, row in zip(texts, counts, strict=True):
        n = max(0, len(text) - 2) + 2 * max(0, len(text) - 3)
        assert row.sum() == n
    alone = [fingerprint.bucket_counts(*flat(pa.array([t], pa.large_binary())))[0] for t in texts]
    assert (np.stack(alone) == counts).all()
    assert Counter(alone[2])[1] == 1


def test_difference_is_bounded_and_symmetric():
    rng = random.Random(14)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(900))).encode() for _ in range(60)]
    rows = fingerprint.digests(texts)
    for i in range(60):
        one = np.repeat(rows[i : i + 1], 60, 0)
        there = fingerprint.likeness(one, rows)
        assert (there == fingerprint.likeness(rows, one)).all()
        assert there[i] == 1 and (there >= 0).all() and (there <= 1).all()
    assert (fingerprint.read(fingerprint.written(rows)) == rows).all()


def test_equal_texts(make):
    rows = fingerprint.fingerprints(make([(1, "same text"), (2, "same text"), (3, None), (4, "")])).collect()
    got = {r.doc_id: r.fingerprint for r in rows}
    assert got[1] == got[2] and got[3] == got[4] and got[1] != got[3]


def test_query_tells_edits_from_other_documents(spark, sf):
    rows = QUERIES["op10_quartile_digest"](spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, docs)
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.98
