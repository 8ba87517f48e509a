import random

import numpy as np

from labelmill.llm import licenses


def test_finds_notices_and_their_places(make):
    mit = licenses.TEMPLATES["MIT permission"].replace("hereby ", "")
    texts = {
        1: "Ünder é. Licensed under CC BY-NC 4.0. More text",
        2: "x " * 5000 + mit.replace("merge,", "merge, three new words") + " y" * 5000,
        3: "released UNDER the\nMIT license\n" * 3,
        4: "the License and the software are not a notice by themselves",
    }
    rows = licenses.scan(make([*texts.items(), (5, None), (6, "")])).collect()
    got = {(r.doc_id, r.license, texts[r.doc_id][r.start : r.end]) for r in rows}
    assert (1, "CC-BY-NC-4.0 line", "Licensed under CC BY-NC 4.0") in got
    assert {r.doc_id for r in rows} == {1, 2, 3}
    assert sum(r.doc_id == 3 for r in rows) == 3
    (long,) = [r for r in rows if r.doc_id == 2]
    assert long.license == "MIT permission" and long.n_matched == long.n_words - 1
    assert texts[2][long.start : long.end].startswith("Permission is granted")


def test_coverage_bound_and_overlaps(make):
    words = [f"w{i}" for i in range(40)]
    templates = {"whole": " ".join(words), "part": " ".join(words[:20])}
    half = " ".join(words[:25])
    rows = licenses.scan(make([(1, " ".join(words)), (2, half), (3, " ".join(words[5:12]))]), templates)
    assert [(r.doc_id, r.license, r.coverage) for r in rows.orderBy("doc_id").collect()] == [
        (1, "whole", 1.0),
        (2, "part", 1.0),
    ]


def test_long_insertions_and_omissions(make):
    """Pieces of one notice on diagonals far apart count together; notices in a row stay apart."""
    mit = licenses.TEMPLATES["MIT permission"].split(" ")
    new = [f"inserted{i}" for i in range(15)]
    middle = len(mit) // 2
    inserted = " ".join(["before", *mit[:middle], *new, *mit[middle:], "after"])
    third = len(mit) // 3
    twice = " ".join([*mit[:third], *new, *mit[third : 2 * third], *new, *mit[2 * third :]])
    omitted = " ".join([*mit[:middle], *mit[middle + 14 :]])
    far = " ".join([*mit[:middle], *(f"x{i}" for i in range(500)), *mit[middle:]])
    texts = {1: inserted, 2: twice, 3: omitted, 4: far, 5: " \n".join([inserted] * 3), 6: " ".join(mit[:middle])}
    rows = licenses.scan(make(list(texts.items()))).collect()
    got = {i: [r for r in rows if r.doc_id == i and r.license == "MIT permission"] for i in texts}
    assert [(r.coverage, r.n_matched) for r in got[1]] == [(1.0, got[1][0].n_words)]
    assert texts[1][got[1][0].start : got[1][0].end] == texts[1][len("before ") : -len(". after")]
    assert [r.coverage for r in got[2]] == [1.0]
    assert len(got[3]) == 1 and 0.8 <= got[3][0].coverage < 0.9
    assert got[4] == [] and got[6] == []
    assert [r.coverage for r in got[5]] == [1.0] * 3


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_banded_alignment_against_a_full_one():
    """With few changes the band holds the best alignment, and its matches are all there are."""
    rng = random.Random(2)
    for _ in range(200):
        template = [rng.randrange(1, 10**6) for _ in range(rng.randrange(6, 60))]
        text = list(template)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text))
            if rng.random() < 0.5:
                text[at:at] = [rng.randrange(1, 10**6)]
            elif len(text) > 4:
                del text[at]
        lead = [rng.randrange(1, 10**6) for _ in range(rng.randrange(5))]
        both = np.array(template, np.uint64), np.array(lead + text, np.uint64)
        pairs = licenses.aligned(*both, len(lead))
        assert all(both[1][i] == both[0][j] for i, j in pairs)
        assert pairs == sorted(pairs) and len(pairs) == longest_common(template, text)


def test_hard_rows(make, hard):
    assert licenses.scan(make(hard)).collect() == []
    assert licenses.scan(make([])).collect() == []


def test_matches_a_plain_search_of_the_given_lines(spark, sf):
    import re

    from labelmill.llm.queries import QUERIES

    pattern = re.compile(
        r"Licensed under CC BY-NC 4\.0|licensed under the GNU General Public License, version 3|"
        r"Licensed under the Apache License, Version 2\.0|Released under the MIT License"
    )
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    expected = {(d.doc_id, m.end()) for d in docs for m in pattern.finditer(d.text)}
    rows = QUERIES["op2_license_scan"](spark, sf).collect()
    assert {(r.doc_id, r.end) for r in rows} == expected
