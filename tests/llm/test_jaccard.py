import random
import re

import pytest

from labelmill.llm import jaccard
from labelmill.llm.components import components
from labelmill.sources.staging import Staging


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def by_hand(rows, words, num, den):
    """Number of shingles and smallest linked id of each row, by comparing all pairs."""
    sets = [shingles(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j])
            if linked and rows[i][0] is not None and rows[j][0] is not None:
                up[root(i)] = root(j)
    groups = {}
    for i, (name, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(name)
    return sorted(
        (-1 if name is None else name, len(sets[i]), min(groups[root(i)]) if name is not None else None)
        for i, (name, _) in enumerate(rows)
    )


def found(docs, words, num, den):
    rows = jaccard.similar_components(docs, words=words, num=num, den=den).collect()
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in rows
    )


def family(rng, count, size, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(size)]
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.fixture
def corpus():
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = family(rng, 40, 150, 6) + family(rng, 30, 60, 5) + family(rng, 20, 12, 1)
    texts += [f"{t} {passage}" for t in family(rng, 20, 90, 60)]
    texts += [texts[0]] * 15 + ["one two", "ONE two", "one", "One"] * 3
    rng.shuffle(texts)
    return [(3 * i + 7, t) for i, t in enumerate(texts)]


def test_against_all_pairs(make, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_SETS", 8)
    monkeypatch.setattr(jaccard, "SEARCH_SETS", 10)
    assert found(make(corpus), 4, 85, 100) == by_hand(corpus, 4, 85, 100)


def test_other_thresholds(make, corpus):
    assert found(make(corpus), 2, 50, 100) == by_hand(corpus, 2, 50, 100)
    assert found(make(corpus), 5, 1, 1) == by_hand(corpus, 5, 1, 1)


def test_hard_rows(make, hard):
    rows = [(i, t) for i, t in hard if i not in (7, 8)]
    assert found(make(rows), 4, 85, 100) == by_hand(rows, 4, 85, 100)
    assert found(make([]), 4, 85, 100) == []
    assert {c for i, _, c in found(make(hard), 4, 85, 100) if i in (7, 8)} == {7}
    with pytest.raises(ValueError):
        jaccard.Threshold(0, 100)


def test_links_that_no_hub_shows(spark, make, corpus, monkeypatch):
    """With groups that search nothing, the last step alone must find every link."""
    monkeypatch.setattr(jaccard, "links_within", lambda sets, threshold: [])
    # Nor may any group count as searched.
    nothing = jaccard.F.lit(None).cast("map<long,int>")
    monkeypatch.setattr(jaccard.F, "map_from_entries", lambda _: jaccard.F.first(nothing))
    assert found(make(corpus), 4, 85, 100) == by_hand(corpus, 4, 85, 100)


def test_one_of_each(make, hard):
    rows = [*hard, (20, "one two three four five six")]
    docs = make(rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    worded = [t for t in texts if (t or "").strip()]
    assert sorted(worded) == sorted({t for _, t in rows if (t or "").strip()})
    assert len(texts) - len(worded) == sum(not (t or "").strip() for _, t in rows)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (3, 4)], "a long, b long")
    with Staging(spark) as staging:
        roots = {r.node: r.root for r in components(edges, staging, "t").collect()}
    assert roots == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)}
    with Staging(spark) as staging:
        assert components(edges.limit(0), staging, "t").collect() == []
