import random

import numpy as np
from pyspark.sql import functions as F

from labelmill.functions.numbers import l2_normalize, round_half_even
from labelmill.operators import analyze
from labelmill.sources.sinks import write_report


def rows(spark, *pairs):
    return spark.createDataFrame([("x" * n, label) for n, label in pairs], "input string, output string")


def test_lengths(spark):
    df = rows(spark, (1, "a"), (2, "a"), (3, "b"), (10, "a"))
    r = analyze.length_stats(analyze.histogram(df)).first()
    assert (r.dataset, r.total, r.mean, r.max, r.min) == ("全量数据", 4, 4.0, 10, 1)
    assert (r.p50, r.p90, r.p99) == (2.5, 7.9, 9.79)


def test_length_counts_code_points(spark):
    df = spark.createDataFrame([("寿险a😀", "a")], "input string, output string")
    assert analyze.length_stats(analyze.histogram(df)).first().max == 4


def test_labels(spark):
    df = rows(spark, *[(1, "a")] * 2, (1, "b"))
    got = {r.label: (r["count"], r.ratio) for r in analyze.label_stats(analyze.histogram(df)).collect()}
    assert got == {"a": (2, 66.67), "b": (1, 33.33)}


def test_empty(spark):
    hist = analyze.histogram(rows(spark, (1, "a")).where("false"))
    assert analyze.length_stats(hist).count() == analyze.label_stats(hist).count() == 0


def test_empty_sets_have_a_row_and_a_report(spark):
    hist = analyze.histogram(rows(spark, (3, "a"), (5, "a")))
    got = {r.dataset: r[1:] for r in analyze.length_stats(hist, ("全量数据", "val")).collect()}
    assert got == {"全量数据": (2, 4.0, 5, 3, 4.0, 4.8, 4.98), "val": (0, *[None] * 6)}
    lines = analyze.report_lines(hist, ("val",)).where("dataset = 'val'").orderBy("line_no").collect()
    text = [r.line for r in lines]
    assert [r.line_no for r in lines] == list(range(1, 16))
    assert "  总条数：0" in text and "  平均值   : -" in text and "  P99      : -" in text


def test_percentiles_of_many_lengths(spark):
    rng = np.random.default_rng(1)
    lengths = np.concatenate([rng.integers(0, 50, 400), rng.integers(0, 2**31, 300), [70_000] * 99])
    df = spark.createDataFrame([("x", int(n), "ab"[i % 2]) for i, n in enumerate(lengths)], "input string, length long, output string")
    hist = analyze.histogram(df.withColumn("dataset", F.col("output")))
    for r in analyze.length_stats(hist).collect():
        own = lengths[r.dataset == "b" :: 2]
        assert (r.total, r.min, r.max) == (len(own), own.min(), own.max())
        assert (r.p50, r.p90, r.p99) == tuple(round(x, 6) for x in np.percentile(own, [50, 90, 99]))


def test_label_lines_over_a_range_shuffle(spark):
    pairs = [(1, f"l{i % 40:02d}") for i in range(300)] + [(1, "top")] * 20
    df = rows(spark, *pairs).withColumn("dataset", F.expr("if(output > 'l20', 'x', 'y')"))
    labels = analyze.label_stats(analyze.histogram(df))
    one, many = (
        sorted(map(tuple, analyze.label_lines(labels, most=most).collect())) for most in (10**6, 0)
    )
    assert one == many and len(one) == 41
    assert [p for d, p, _ in one if d == "y"] == list(range(1, 22))


def test_split_histogram_counts_injected_rows_once_in_the_whole(spark):
    df = spark.createDataFrame(
        [("aa", "x", "train", False), ("b", "x", "test", False), ("ccc", "y", "train", True), ("ccc", "y", "val", True)],
        "input string, output string, split string, injected boolean",
    )
    got = {r.dataset: r.total for r in analyze.length_stats(analyze.split_histogram(df)).collect()}
    assert got == {"全量数据": 3, "train": 2, "val": 1, "test": 1}


def test_rounding_is_python_rounding(spark):
    rng = random.Random(1)
    values = [rng.uniform(-100, 100) for _ in range(3000)]
    values += [i / 200 for i in range(-400, 400)] + [i / 2000 for i in range(2000)] + [12.35, 2.675, 0.125]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (1, 2, 4):
        got = df.select("x", round_half_even(F.col("x"), digits).alias("r")).collect()
        assert [r.r for r in got] == [round(r.x, digits) for r in got]


def test_report_text(spark, tmp_path):
    df = rows(spark, (4, "寿险意图"), (5, "寿险意图"), (9, "拒识"))
    sets = df.withColumn("split", F.lit("train")).withColumn("injected", F.lit(False))
    path = tmp_path / "r"
    write_report(analyze.split_histogram(sets), str(path), ("全量数据", "train"))
    (part,) = path.glob("part-*")
    rule = "=" * 45
    body = [
        "  总条数：3",
        "",
        "  ── 标签分布 ──────────────────────────",
        "  寿险意图          2 条  ( 66.7%)  █████████████",
        "  拒识            1 条  ( 33.3%)  ██████",
        "",
        "  ── input 文本长度（字符数）─────────",
        "  平均值   : 6.0",
        "  最大值   : 9",
        "  最小值   : 4",
        "  中位数   : 5.0",
        "  P90      : 8.2",
        "  P99      : 8.9",
        rule,
    ]
    reports = [
        "\n".join([rule, f"  数据分析报告 — {name}", rule, *body]) for name in ("全量数据", "train")
    ]
    assert part.read_text(encoding="utf-8").rstrip("\n") == "\n\n".join(reports)


def test_l2_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r[0] for r in df.select(l2_normalize(F.col("v"))).collect()]
    assert got == [[0.6, 0.8], [0.0, 0.0]]
