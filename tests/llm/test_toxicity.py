import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelmill.llm import toxicity
from labelmill.llm.batches import span_hashes
from labelmill.llm.queries import QUERIES

GRADE = "case when toxic = 1 then if(quality = 0, 2, 1) when toxic = 0 then 0 end"
LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(count=900):
    """Grade 1 texts have a word of one list, grade 2 texts of two lists."""
    rng = random.Random(12)
    mild, foul = ["dunce", "nitwit", "clod"], ["vermin", "filthy", "scourge"]
    docs, labels = [], []
    for i in range(count):
        words = [f"word{rng.randrange(300)}" for _ in range(60)]
        grade = rng.choice([0, 0, 0, 1, 2])
        if grade:
            words[rng.randrange(60)] = rng.choice(mild)
        if grade == 2:
            for _ in range(2):
                words[rng.randrange(60)] = rng.choice(foul)
        docs.append((i, " ".join(words)))
        labels.append((i, 0 if grade == 2 else 1, int(grade > 0), "own"))
    return docs, labels


def test_held_out_grades(spark, make):
    docs, labels = corpus()
    frame = make(docs)
    table = spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(frame, table.where("doc_id % 3 <> 0"), F.expr(GRADE))
    assert model.thresholds[0] < model.thresholds[1]
    true = {i: 0 if not t else 1 if q else 2 for i, q, t, _ in labels}
    rows = [r for r in toxicity.score(frame, model).collect() if r.doc_id % 3 == 0]
    assert np.mean([r.grade == true[r.doc_id] for r in rows]) > 0.9
    by_grade = [np.mean([r.expected_severity for r in rows if true[r.doc_id] == g]) for g in range(3)]
    assert by_grade[0] < 0.2 < by_grade[1] < by_grade[2]
    assert all(r.p_severe <= r.p_toxic for r in rows)
    again = toxicity.fit(frame.repartition(7), table.where("doc_id % 3 <> 0"), F.expr(GRADE))
    assert (again.weights == model.weights).all()


def test_given_labels_held_out(spark):
    """On the given table: toxic rows score above others, clean ones are left alone."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"), F.expr(GRADE))
    held = toxicity.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    flagged = held.expected_severity >= toxicity.REJECT
    assert flagged[held.toxic == 1].mean() > 0.6
    assert flagged[held.toxic == 0].mean() < 0.01


def test_few_or_no_labels(spark, make, hard):
    docs = make(hard)
    labels = spark.createDataFrame([], LABELS)
    model = toxicity.fit(docs, labels, F.expr(GRADE))
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == len(hard) and all(r.grade == 0 and r.expected_severity < 1e-9 for r in rows)
    one = spark.createDataFrame([(4, 1, 1, ""), (4, 1, 0, ""), (None, 1, 1, ""), (5, None, None, "")], LABELS)
    model = toxicity.fit(docs, one, F.expr(GRADE))
    assert all(r.grade == 1 for r in toxicity.score(docs, model).collect())


def test_all_rows_and_columns_of_mild_texts(spark, make, hard):
    docs = make(hard)
    model = toxicity.OrdinalModel()
    kept = toxicity.keep_mild(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(hard)
    assert toxicity.keep_mild(make([]), model).collect() == []
    model.thresholds = np.full(2, -50.0)
    assert toxicity.keep_mild(docs, model).count() == 0


def test_few_labels_reject_nothing_without_evidence(spark, make):
    docs, _ = corpus(17)
    for labels in ([(0, 1, 1, ""), (1, 1, 0, "")], [(0, 1, 0, ""), (1, 1, 0, "")]):
        model = toxicity.fit(make(docs), spark.createDataFrame(labels, LABELS), F.expr(GRADE))
        assert toxicity.keep_mild(make(docs), model).count() == 17


def test_scores_against_a_plain_loop(spark, make, hard):
    docs, labels = corpus(200)
    model = toxicity.fit(make(docs), spark.createDataFrame(labels, LABELS), F.expr(GRADE))
    assert (model.weights != 0).any()
    texts = docs[:50] + hard
    found = {}
    for r in toxicity.score(make(texts), model).collect():
        found.setdefault(r.doc_id, []).append(r.expected_severity)
    wanted = {}
    for i, text in texts:
        seen = set()
        for word in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode()):
            word = word.lower()
            spans = [(word, 0)] + [(word[:n], n) for n in toxicity.BEGINNINGS if len(word) > n]
            for span, plus in spans:
                data = np.frombuffer(span, np.uint8)
                number = span_hashes(data, np.array([0]), np.array([len(data)]))[0]
                seen.add((int(number) + plus) % 2**64 & ((1 << toxicity.BITS) - 1))
        score = sum(float(model.weights[f]) for f in seen)
        p = [1 / (1 + math.exp(min(700, t - score))) for t in model.thresholds]
        wanted.setdefault(i, []).append(sum(p))
    assert {i: sorted(v) for i, v in found.items()} == {
        i: pytest.approx(sorted(v), abs=1e-6) for i, v in wanted.items()
    }


def test_likelihood_gradient_by_differences():
    """The fitted thresholds of a model without features are the grades' log odds."""
    grades = np.array([0] * 60 + [1] * 30 + [2] * 10)
    model = toxicity.fit_rows(grades, np.zeros(0, int), np.zeros(0, int), np.ones(100))
    reach = model.reach(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0]
    assert reach == pytest.approx([0.4, 0.1], abs=0.02)


def test_query(spark, sf):
    rows = QUERIES["op8_ordinal_toxicity"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
