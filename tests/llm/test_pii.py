import hashlib
import random
import re
from math import log2

from labelmill.llm import pii
from labelmill.llm.queries import QUERIES

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def by_pattern(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                sums = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or sum(s - 9 * (s > 9) for s in sums) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_entities_equal_the_patterns():
    rng = random.Random(11)
    scraps = ["a", "b.", "@", "@", "1", "22", "255", ".", ".", "-", " ", "+", "(", ")", "é", "_", "%"]
    scraps += ["4111111111111111", "0", "\n", "9 9", "256.", "+1 (555) 010-9999", "007."]
    for _ in range(40_000):
        text = "".join(rng.choice(scraps) for _ in range(rng.randrange(22)))
        assert pii.entities(text) == by_pattern(text)


def test_long_runs_take_linear_time():
    text = "a" * 300_000 + "@" + "1" * 300_000 + "@ " + "1.2." * 50_000 + "+1" + " " * 300_000
    assert isinstance(pii.entities(text), list)


def corpus():
    """An address whose company gives it away: a rare word in all its texts, a common one."""
    rows = [(i, f"common words {i} stand in every text number {i}") for i in range(40)]
    for i in range(6):
        rows.append((100 + i, f"the Fisherman common wrote to ann@site.org about{'abcdef'[i]} it"))
    rows.append((200, "the Fisherman elsewhere, without any address"))
    return rows


def test_terms_that_reveal(make):
    rows = corpus()
    found = {r.doc_id: r for r in pii.find(make(rows)).collect()}
    n, entity, both = len(rows), 6, 6
    share = log2(n * both / (entity * 7)) / log2(n / entity)
    spans = {s.kind: s for s in found[100].spans}
    assert pii.GENERALISE <= share < pii.REMOVE
    term = [s for s in found[100].spans if s.kind == "term" and s.start == 4]
    assert len(term) == 1 and abs(term[0].share - share) < 1e-12
    # The word that all its texts and no others have is removed, those that one more text has are
    # generalised; the common one stays, and so does the one that too few texts have.
    assert found[100].sanitised == "[WORD] [NAME] common  to [EMAIL] abouta it"
    assert "ann@site.org" not in found[100].sanitised and "Fisherman" not in found[100].sanitised
    assert found[200].sanitised == rows[-1][1] and found[200].spans == []
    assert spans["email"].share is None


def test_rare_entities_reveal(make):
    """An address of one text, and different addresses whose domain gives a name away."""
    rows = [(i, f"common words {i} stand in every text number {i}") for i in range(600)]
    rows.append((1000, "Winterbottom, in common words, wrote to solo@alone.net"))
    rows += [(1010 + i, f"every common Kestrel text {'abc'[i] * 3}{i}@kestrel.org") for i in range(3)]
    rows.append((1020, "Kestrel, in common words"))
    found = {r.doc_id: r for r in pii.find(make(rows)).collect()}
    assert found[1000].sanitised.startswith(", in common words")
    assert "[EMAIL]" in found[1000].sanitised
    for i in range(1010, 1013):
        assert found[i].sanitised == "every common [NAME] text [EMAIL]"
    n, domain, both, term = len(rows), 3, 3, 4
    share = log2(n * both / (domain * term)) / log2(n / domain)
    (kestrel,) = [s.share for s in found[1010].spans if s.kind == "term"]
    assert abs(kestrel - share) < 1e-12
    assert found[1020].spans == []


def test_terms_far_from_the_entity(make):
    """A name in the first line, a two-letter name and a number, with the address at the foot."""
    rows = [(i, f"common words {'xyz'[i % 3]} stand in every text, to say so") for i in range(600)]
    words = "common words stand in every text " * 20
    rows += [(1000 + i, f"Winterbottom Li 4711 {words * (i + 1)} to w@place.org") for i in range(2)]
    rows.append((1010, f"Short Winterbottom Li 4711 {words}"))
    found = {r.doc_id: r for r in pii.find(make(rows)).collect()}
    for i in range(2):
        assert found[1000 + i].sanitised == f"[NAME] [NAME] [WORD] {words * (i + 1)} to [EMAIL]"
    assert found[1010].spans == []


def test_query_gives_terms(spark):
    rows = QUERIES["op7_disclosure_pii"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.n_email + r.n_ip + r.n_card + r.n_phone]
    assert sum("term:" in r.spans for r in held) > len(held) // 2
    assert not any(r.spans for r in rows if r not in held)


def test_without_broadcast(make, monkeypatch):
    rows = corpus()
    expected = sorted(map(tuple, pii.find(make(rows)).collect()))
    kept = sorted(r.text for r in pii.sanitised(make(rows)).collect())
    monkeypatch.setattr(pii, "BROADCAST_PAIRS", 0)
    assert sorted(map(tuple, pii.find(make(rows)).collect())) == expected
    again = pii.sanitised(make(rows))
    assert sorted(r.text for r in again.collect()) == kept
    assert again.columns == make(rows).columns


def test_hard_rows(make, hard):
    rows = [*hard, (30, "x" * 9999 + " bob@mail.example.org, 4111 1111 1111 1111 and +1 (555) 010-9999")]
    found = pii.find(make(rows)).collect()
    assert len(found) == len(rows)
    (one,) = [r for r in found if r.doc_id == 30]
    assert one.sanitised.endswith("[EMAIL], [CARD] and [PHONE]")
    assert sorted(r.sanitised for r in found if r.doc_id != 30) == sorted(t or "" for _, t in hard)
    kept = pii.sanitised(make(rows)).collect()
    assert sum(r.text is None for r in kept) == 1
    assert pii.find(make([])).collect() == []
    assert pii.sanitised(make([])).collect() == []


def test_length_column(make):
    from pyspark.sql import functions as F

    docs = make([(1, "mail a@b.c now"), (2, None)]).withColumn("n_chars", F.length("text").cast("long"))
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.sanitised(docs, length_col="n_chars").collect()}
    assert got == {1: ("mail [EMAIL] now", 16), 2: (None, None)}


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_disclosure_pii"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = by_pattern(docs[r.doc_id])
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        kinds = [k for k, _, _ in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in PATTERNS]
        shown = [s for s in r.spans.split(",") if s and not s.startswith("term")]
        assert ",".join(shown) == text
