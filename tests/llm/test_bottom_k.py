import random
from itertools import combinations

import numpy as np
import pytest
from test_jaccard import by_hand, family

from labelmill.llm import bottom_k
from labelmill.llm.batches import shingle_sets


def found(docs, words=4, num=80, den=100, **options):
    rows = bottom_k.near_duplicates(docs, words=words, num=num, den=den, **options).collect()
    for r in rows:
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in rows
    )


def corpus(rng, families=12, passage=""):
    texts = []
    for _ in range(families):
        size = rng.choice([3, 8, 40, 200, 400])
        texts += family(rng, rng.randrange(1, 12), size, rng.choice([1, 3, 12]))
    texts += [f"{t} {passage}" for t in family(rng, 20, 12, 12)] if passage else []
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts, strict=True))


def test_families_against_all_pairs(spark, make):
    rows = corpus(random.Random(1), passage=" ".join(f"p{i}" for i in range(60)))
    assert found(make(rows)) == by_hand(rows, 4, 80, 100)


@pytest.mark.parametrize("seed", [2, 3])
def test_parts_and_blocks_lose_no_link(spark, make, monkeypatch, seed):
    """Groups of a few sets each, so that nearly all links lie between parts."""
    monkeypatch.setattr(bottom_k, "PART_SETS", 3)
    rng = random.Random(seed)
    rows = corpus(rng, 6, " ".join(f"p{i}" for i in range(60)))
    rows += [(20_000 + i, t) for i, t in enumerate(family(rng, 60, 60, 4))]
    assert found(make(rows)) == by_hand(rows, 4, 80, 100)


def test_small_sketches(spark, make):
    rows = corpus(random.Random(4))
    assert found(make(rows), k=64) == by_hand(rows, 4, 80, 100)
    assert found(make(rows), words=2, num=1, den=1) == by_hand(rows, 2, 1, 1)


def test_hard_rows(spark, make, hard):
    assert found(make(hard)) == by_hand(hard, 4, 80, 100)
    assert found(make([])) == []


def test_unlike_words_of_one_pattern_stay_apart(spark, make):
    """Words of two letters in the order of Thue and Morse, and the same with both exchanged."""
    rows = []
    for i, size in enumerate((64, 1024, 2048)):
        word = "".join("ab"[bin(j).count("1") % 2] for j in range(size))
        swapped = word.translate(str.maketrans("ab", "ba"))
        rows += [(10 * i, f"{word} x y z"), (10 * i + 1, f"{swapped} x y z")]
    assert [r[2] for r in found(make(rows))] == [0, 1, 10, 11, 20, 21]


def test_parameters(spark, make):
    with pytest.raises(ValueError):
        found(make([]), num=0)
    with pytest.raises(ValueError):
        found(make([]), num=10, k=16)


def test_estimates_miss_no_linked_pair():
    rng = random.Random(6)
    rule = bottom_k.Sketching(80, 100, 128)
    assert 60 < rule.shared < 80
    texts = [t for _ in range(20) for t in family(rng, 6, 300, 14)]
    data = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, data)])
    sets = shingle_sets(np.frombuffer(b"".join(data), np.uint8), bounds, 4)
    linked = set()
    for i, j in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            linked.add((i, j))
    assert linked
    task = bottom_k.Sets(sets, -1 - np.arange(len(sets)), rule)
    likely = {(min(i, j), max(i, j)) for i in range(len(sets)) for j in task.estimated(i).tolist()}
    assert linked <= likely
    # Pairs that have nothing in common are not looked at.
    assert len(likely) < 20 * 15
