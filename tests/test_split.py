import pytest
from pyspark.sql import functions as F

from labelmill.defaults import SplitRatios
from labelmill.operators import split
from labelmill.operators.rank import add_ids
from labelmill.sources.staging import Staging


def table(spark, *counts):
    rows = [(label, i) for label, n in counts for i in range(n)]
    return spark.createDataFrame(
        [(s, label) for s, (label, _) in enumerate(rows)], "seq long, output string"
    )


def sizes(df, *by):
    return {tuple(r)[:-1] if len(by) > 1 else r[0]: r[-1] for r in df.groupBy(*by).count().collect()}


@pytest.mark.parametrize(
    "counts, want, test, val",
    [
        ((("a", 199), ("b", 96)), (235, 30, 30), (20, 10), (20, 10)),
        ((("a", 200), ("b", 100)), (239, 31, 30), (20, 10), (21, 10)),
        ((("drop", 44), ("keep", 277)), (256, 32, 33), (5, 28), (4, 28)),
    ],
)
def test_exact_sizes(spark, counts, want, test, val):
    df = split.split_dataset(table(spark, *counts), digits=2)
    by_split = sizes(df, "split")
    assert (by_split["train"], by_split["val"], by_split["test"]) == want
    per_label = sizes(df, "output", "split")
    labels = [label for label, _ in counts]
    assert tuple(per_label[x, "test"] for x in labels) == test
    assert tuple(per_label[x, "val"] for x in labels) == val
    assert df.select("seq").distinct().count() == sum(n for _, n in counts)


def test_fallback(spark, caplog):
    df = table(spark, ("a", 5), ("b", 1))
    assert sizes(split.split_dataset(df), "split") == {"train": 4, "val": 1, "test": 1}
    assert "without regard to labels" in caplog.text
    with pytest.raises(ValueError):
        split.stratified_split(df)


def test_second_cut_can_rule_out_strata(spark):
    # 2 rows of b: one goes to test, so val cannot be cut by label.
    with pytest.raises(ValueError):
        split.stratified_split(table(spark, ("a", 20), ("b", 2)), SplitRatios(0.4, 0.1, 0.5))


def test_too_few_rows(spark):
    for n in (0, 1, 2):
        with pytest.raises(ValueError):
            split.split_dataset(table(spark, ("a", n)))


def test_reproducible_whatever_the_partitions_and_digits(spark):
    df = table(spark, ("a", 700), ("b", 300))

    def rows(d, **options):
        return sorted(map(tuple, split.split_dataset(d, **options).collect()))

    base = rows(df)
    assert rows(df.repartition(13)) == rows(df.coalesce(1), digits=1) == rows(df, digits=3) == base
    assert rows(df, seed=7) != base


def test_matches_a_plain_ranking(spark):
    df = table(spark, ("a", 90), ("b", 210))
    ranked = df.selectExpr(
        "*", "row_number() over (partition by output order by md5(concat('42:', seq)), seq) as r"
    ).collect()
    quota = {"a": (9, 9), "b": (21, 22)}
    got = {r.seq: r.split for r in split.split_dataset(df).collect()}
    for r in ranked:
        test, val = quota[r.output]
        assert got[r.seq] == ("test" if r.r <= test else "val" if r.r <= test + val else "train")


def test_tagging_does_not_shuffle_the_rows(spark):
    df = table(spark, ("a", 50), ("b", 50)).withColumn("payload", F.lit("x"))
    plan = split.split_dataset(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_many_labels_are_joined_with_salt(spark, monkeypatch):
    df = table(spark, ("hot", 200), *((f"l{i}", 10) for i in range(20)))
    want = sorted(map(tuple, split.split_dataset(df).collect()))
    monkeypatch.setattr(split, "BROADCAST_LABELS", 3)
    assert sorted(map(tuple, split.split_dataset(df).collect())) == want


@pytest.mark.parametrize("bad", [(0.8, 0.1, 0.2), (0.9, 0.1, 0.0), (1.2, -0.1, -0.1)])
def test_ratios_are_checked(bad):
    with pytest.raises(ValueError):
        SplitRatios(*bad)
    SplitRatios(0.8, 0.1, 0.1000005)


def test_injection_and_summary(spark):
    base = split.split_dataset(table(spark, ("a", 60), ("b", 40)))
    new = spark.createDataFrame([(1000, "a"), (1001, "b")], "seq long, output string")
    both = split.inject_new(base, new)
    assert sizes(both, "split") == {"train": 82, "val": 12, "test": 10}
    assert {(r.split, r.seq) for r in both.where("injected").collect()} == {
        (s, n) for s in ("train", "val") for n in (1000, 1001)
    }
    summary = {(r.split, r.output): r.rows for r in split.split_summary(both).collect()}
    assert summary["train", None] == 82
    assert summary["test", "a"] + summary["test", "b"] == 10
    ids = add_ids(both, ["split"], ["injected"], width=8).collect()
    for name in ("train", "val", "test"):
        mine = sorted((r for r in ids if r.split == name), key=lambda r: r.id)
        assert [r.id for r in mine] == list(range(1, len(mine) + 1))
        assert [(r.injected, r.seq) for r in mine] == sorted((r.injected, r.seq) for r in mine)


def test_quotas_of_huge_tables_do_not_overflow(spark):
    counts = spark.createDataFrame(
        [("a", 3 * 10**12), ("b", 10**12 + 1)], "stratum string, rows long"
    )
    sizes = split.Sizes(4 * 10**12 + 1, 2, 10**12 + 1, SplitRatios())
    with Staging(spark) as staging:
        got = split.split_quotas(counts, sizes, staging).collect()
    assert sum(r.q_test for r in got) == sizes.n_test == 400000000001
    assert sum(r.q_val for r in got) == sizes.n_val


def test_quotas_of_many_labels_are_the_same(spark, monkeypatch):
    counts = spark.createDataFrame(
        [(f"={i}", 2 + i * i % 17) for i in range(300)], "stratum string, rows long"
    )
    n = counts.agg({"rows": "sum"}).first()[0]
    sizes = split.Sizes(n, 300, 2, SplitRatios())

    def quotas():
        with Staging(spark) as staging:
            return sorted(map(tuple, split.split_quotas(counts, sizes, staging).collect()))

    few = quotas()
    monkeypatch.setattr(split, "BROADCAST_LABELS", 10)
    assert quotas() == few


def test_missing_labels_are_a_stratum(spark):
    rows = [(i, None if i % 3 == 0 else f"l{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, output string")
    for tagged in (split.stratified_split(df), split.split_dataset(df)):
        got = tagged.groupBy("output", "split").count().collect()
        assert sum(r["count"] for r in got) == 300
        assert {r["count"] for r in got if r.split == "test"} == {10}


def test_a_label_for_each_row_needs_no_quotas(spark):
    df = spark.range(400).selectExpr("id as seq", "cast(id as string) as output")
    cut = split._Cut(df, split._stratum(df.output), SplitRatios(), 1, 2)
    assert cut.unstratifiable()
    assert "quotas" not in vars(cut)
    assert split.split_dataset(df).count() == 400
