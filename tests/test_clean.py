from labelmill.operators import clean
from labelmill.sources.members import separate


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_fixture_rows(samples):
    regular, new = separate(samples)
    assert seqs(clean.clean(regular)) == [1, 7, 8, 10, 12]
    assert seqs(clean.clean(new)) == [13, 14]
    assert {r.output for r in clean.clean(regular).collect()} == {"寿险意图", "拒识"}
    m = clean.validation_metrics(regular).first()
    assert (m.raw_count, m.null_count, m.invalid_label_count, m.duplicate_count) == (12, 4, 2, 1)
    assert (m.final_count, m.removed_count, m.is_valid) == (5, 7, True)
    counted = clean.validation_metrics(regular, cleaned=clean.clean(regular)).first()
    assert counted == m
    errors, warnings = clean.validation_messages(m)
    assert not errors and len(warnings) == 3
    assert "12 read, 5 kept" in clean.validation_summary(m)


def test_group_wise_cleaning_keeps_text_in_both(samples):
    tagged = samples.withColumn("is_new", samples.sheet == "new")
    assert seqs(clean.clean(tagged, within=["is_new"])) == [1, 7, 8, 10, 12, 13, 14]


def test_empty_table(samples):
    m = clean.validation_metrics(samples.where("false")).first()
    assert (m.raw_count, m.null_count, m.final_count, m.is_valid) == (0, 0, 0, False)
    assert clean.validation_messages(m)[0]
    none = samples.where("false")
    assert clean.validation_metrics(none, cleaned=none).first() == m


def test_illegal_values(samples):
    got = {r.output: r.rows for r in clean.illegal_labels(samples).collect()}
    assert got == {"寿险相关": 1, "其他": 1}


def test_keep_last_with_a_hot_text(spark):
    df = spark.range(30000).selectExpr(
        "id as seq", "if(id % 3 = 0, 'hot', concat('t', id % 1000)) as input", "'拒识' as output"
    )
    want = {}
    for i in range(30000):
        want["hot" if i % 3 == 0 else f"t{i % 1000}"] = i
    for parts in (1, 7):
        got = {r.input: r.seq for r in clean.keep_last(df.repartition(parts)).collect()}
        assert got == want


def test_limit_is_applied_before_the_shuffle(spark, samples):
    plan = clean.keep_last(samples)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
