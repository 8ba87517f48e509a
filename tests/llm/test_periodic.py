import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from labelmill.llm import periodic, queries


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_hand(words, least=12):
    """Runs from every period's stretches, each with its smallest period."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, text):
    words = split(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def quick(words, least=12):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    names = periodic.Names(np.array([numbers[w] for w in words], np.int64))
    return list(zip(*(x.tolist() for x in periodic.find(names, least)), strict=True))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("least", [2, 3, 4, 5, 7, 8, 12, 20])
def test_runs_of_random_and_periodic_words(least):
    rng = random.Random(least)
    for _ in range(300):
        words = [rng.choice("ab" if rng.random() < 0.7 else "abc") for _ in range(rng.randrange(60))]
        assert quick(words, least) == by_hand(words, least)
    for _ in range(150):
        words = []
        while len(words) < 100:
            piece = [rng.choice("abc") for _ in range(rng.randrange(1, 14))]
            words += (piece * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        assert quick(words, least) == by_hand(words, least)


def test_famous_strings():
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(512))
    for text in ("a" * 400, "ab" * 300, fibonacci(500), thue, "babababa" + "abababab", "aab" * 50 + "a" * 60):
        for least in (4, 12):
            assert quick(list(text), least) == by_hand(list(text), least)


def test_wavelet_matrix():
    rng = np.random.default_rng(0)
    values = rng.permutation(300)[:200]
    matrix = periodic.WaveletMatrix(values, 9)
    lo = rng.integers(0, 200, 500)
    hi = np.minimum(200, lo + rng.integers(0, 60, 500))
    x = rng.integers(0, 400, 500)
    wanted = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(lo, hi, x, strict=True)]
    assert matrix.successor(lo, hi, x).tolist() == wanted


def rows_of(found):
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
        for r in found.collect()
    )


def expected(rows):
    out = []
    for i, text in rows:
        words = split(text)
        runs = by_hand(words) if len(words) < 5000 else None
        out.append((i if i is not None else -1, len(words), runs, collapsed(words, runs or [])))
    return sorted(out)


def test_documents_stay_apart(spark, make, hard, monkeypatch):
    rng = random.Random(9)
    rows = [(i, t) for i, t in hard if len(t or "") < 1000]
    for i in range(100, 160):
        piece = [rng.choice(["é", "to", "x" * 70, "日本"]) for _ in range(rng.randrange(1, 6))]
        words = piece * rng.randrange(1, 12) + [rng.choice("pqr") for _ in range(rng.randrange(20))]
        rows.append((i, rng.choice([" ", "\n\t", "  "]).join(words)))
    for limit in (1 << 20, 300):
        monkeypatch.setattr(periodic.slices, "__defaults__", (limit,))
        assert rows_of(periodic.runs(make(rows))) == expected(rows)


def test_long_texts(spark, make, hard):
    long = next(t for i, t in hard if i == 7)
    words = split(long)
    runs = rows_of(periodic.runs(make([(7, long), (8, "to " * 200_000)])))
    period = 977 * 2
    assert runs[0][2] == [(0, len(words), period)]
    assert runs[0][3] == " ".join(words[:period])
    assert runs[1][2:] == ([(0, 200_000, 1)], "to")


def test_empty_table_and_parameters(spark, make):
    assert periodic.runs(make([])).collect() == []
    assert periodic.summary(periodic.runs(make([(1, None)]))).collect()[0][1:6] == (0, None, None, None, None)
    with pytest.raises(ValueError):
        periodic.runs(make([]), least=1)


def test_query_against_plain_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert len(found) == len(docs)
    checked = 0
    for doc in docs:
        words, r = planted(doc.doc_id, doc.text), found[doc.doc_id]
        if len(words) > 3000:
            continue
        runs = by_hand(words)
        checked += bool(runs)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, length, q = min(runs, key=lambda x: (-x[1], x[0], x[2]))
            assert (r.start, r.length, r.period) == (s, length, q)
            assert r.exponent_milli == 1000 * length // q
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert checked > 10
