import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from labelmill.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, id string, mask string"
LABELS = "doc_id long, quality int, toxic int"


def fails(doc_id, text, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    twins = [i for i, t, _ in rows if i is not None and (t or "") == text]
    return out + ("E" if doc_id is not None and min(twins) < doc_id else "")


def by_hand(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for i, text, source in rows:
        parts.setdefault(source or "", []).append((i, fails(i, text or "", rows)))
    out = {}
    for part, docs in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                total[name] += len(gone)
                failing = sum(name in f for _, f in docs)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    failing - len(gone),
                    sum(f == name for _, f in docs),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def found(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], DOCS)
    table = spark.createDataFrame(labels, LABELS)
    result = filter_audit.audit(docs, table).collect()
    out = {(r.part, r.filter_order, r.step): [*r[3:]] for r in result}
    assert len(out) == len(result)
    return out


def text(rng):
    words = [f"w{rng.randrange(60)}" for _ in range(rng.choice([10, 60, 90, 200]))]
    if rng.random() < 0.4:
        words = [w.upper() if rng.random() < 0.4 else w for w in words]
    if rng.random() < 0.3:
        words.append(rng.choice("#$%&*|"))
    return rng.choice([" ", "\n", "  "]).join(words)


def test_all_orders_against_plain_filters(spark):
    rng = random.Random(5)
    texts = [text(rng) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", "", None])) for i in range(150)]
    labels = [(rng.randrange(170), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(120)]
    assert found(spark, rows, labels) == by_hand(rows, labels)


def test_hard_rows(spark, hard):
    rows = [(i, t, s) for (i, t), s in zip(hard, ["x", None, "", "x"] * 3, strict=False)]
    labels = [(None, 1, 1), (5, 1, None), (5, 0, 1), (7, None, None)]
    assert found(spark, rows, labels) == by_hand(rows, labels)


def test_empty_tables(spark):
    assert found(spark, [], [(1, 1, 1)]) == {}
    assert found(spark, [(1, "a", "s")], [])["s", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "b", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    failures = {"x": F.col("text").contains("a"), "y": F.lit(None).cast("boolean")}
    rows = filter_audit.audit(docs, labels, failures, copies=None).collect()
    assert {r.filter_order for r in rows} == {"xy", "yx"}
    assert {(r.step, r.kept, r.good_lost) for r in rows if r.filter_order == "xy"} == {(1, 1, 1), (2, 1, 0)}
    with pytest.raises(ValueError):
        filter_audit.audit(docs, labels, {}, copies=None)
    with pytest.raises(ValueError):
        filter_audit.audit(docs, labels, {"E": F.lit(True)})


def test_swaps_visit_every_order():
    for n in range(1, 7):
        order, seen = list(range(n)), set()
        seen.add(tuple(order))
        for i in filter_audit.plain_changes(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert seen == set(permutations(range(n)))


def test_equal_subgraphs_are_shared():
    counts = {m: (1, 0, 0) for m in range(32)}
    diagram = filter_audit.Diagram("ABCDE", counts, 3)
    assert [len(level) for level in diagram.levels] == [1] * 5
    assert diagram.weight[diagram.root][0] == 32
    diagram.swap(2)
    assert "".join(diagram.order) == "ABDCE"
    assert [len(level) for level in diagram.levels] == [1] * 5
