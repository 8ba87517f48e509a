"""The pipeline against plain versions of its stages, and on cases that were planted."""

import numpy as np
from pyspark.sql import functions as F
from public_tokenizers import path
from test_jaccard import by_hand as linked
from test_pii import by_pattern
from test_repeats import by_hand as repeated
from tokenizers import Tokenizer

import corpus_pipeline
from labelmill.llm import pii, repeats, toxicity


def staged(spark, docs, sf, tmp_path):
    out = []
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(at)))
        docs = spark.read.parquet(str(tmp_path / str(at)))
        out.append(docs)
    return out


def test_stages_and_result(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mild, distinct, unrepeated, private, packed = staged(spark, docs, sf, tmp_path)
    for stage in (mild, distinct, unrepeated, private):
        assert stage.dtypes == docs.dtypes
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels, toxicity.severity(F.col("quality"), F.col("toxic")))
    severe = {
        r.doc_id
        for r in toxicity.score(docs, model).collect()
        if r.expected_severity >= toxicity.limit_for(model)
    }
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in severe}
    assert {r.doc_id: r.text for r in mild.collect()} == texts

    keep = {i for i, _, c in linked(list(texts.items()), 5, 80, 100) if c == i}
    texts = {i: t for i, t in texts.items() if i in keep}
    assert {r.doc_id: r.text for r in distinct.collect()} == texts

    length = corpus_pipeline.PASSAGE_BYTES
    rows = {r.doc_id: r for r in unrepeated.collect()}
    for (i, text), (_, removed, _, _) in zip(
        texts.items(), repeated(texts.values(), length), strict=True
    ):
        # At most the ends of characters that are removed in part stay.
        assert 0 <= len(rows[i].text.encode()) - (len(text.encode()) - removed) < 8 * 4
        assert rows[i].n_chars == len(rows[i].text)
    texts = {i: r.text for i, r in rows.items()}

    shares = pii.disclosure(unrepeated).collect()
    table = {}
    for r in shares:
        table.setdefault(r.entity, {})[r.term] = r.share
    known = pii.Disclosure(table)
    for i, text in texts.items():
        base = by_pattern(text)
        texts[i] = pii.sanitise(text, base, known.spans(text, base))
    assert {r.doc_id: r.text for r in private.collect()} == texts

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces = {}
    for p in packed.orderBy("doc_id", "start").collect():
        pieces[p.doc_id] = pieces.get(p.doc_id, b"") + bytes(p.ids)
    for i, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [corpus_pipeline.END_ID]
        assert pieces[i] == np.array(ids, "<u4").tobytes()
    assert set(pieces) == set(texts)
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_planted_cases(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.orderBy("doc_id").limit(6).collect()
    passage = " ".join(f"planted{i} word" for i in range(26))
    new = [
        (10_001, rows[0].text, "en", "s", 0),
        (10_002, rows[0].text.replace(" ", "  ", 3) + " end", "en", "s", 0),
        (10_003, f"{rows[1].text[:300]} {passage} own ending one", "en", "s", 0),
        (10_004, f"other {rows[2].text[:300]} {passage} more", "en", "s", 0),
        (10_005, "call +1 (555) 010-9999 or ann.b@mail.example.com", "en", "s", 0),
    ]
    planted = docs.unionByName(spark.createDataFrame(new, docs.schema))
    texts = [
        {r.doc_id: r.text for r in s.collect()} for s in staged(spark, planted, sf, tmp_path)[:4]
    ]
    assert sum(i in texts[1] for i in (rows[0].doc_id, 10_001, 10_002)) <= 1
    assert all("planted7 word" not in t for t in texts[2].values())
    assert texts[3][10_005] == "call [PHONE] or [EMAIL]"
    assert repeats.merged_spans([(3, 5), (5, 9), (1, 2)]) == [(1, 2), (3, 9)]


def test_hard_and_empty_documents(spark, make, hard, sf):
    for rows in (hard, []):
        docs = make(rows)
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, sf)
            assert docs.columns == columns
        # The two long copies are one, so are the repeated rows; nothing else goes.
        assert docs.count() == (len(rows) - 2 if rows else 0)
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() > 0) == bool(rows)
