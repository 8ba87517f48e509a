"""Label distribution and text length reports, per data set."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.functions.numbers import round_half_even
from labelmill.operators.rank import add_places
from labelmill.operators.skew import salted_join
from labelmill.sources.staging import Staging

WHOLE = "全量数据"  # fixed value: title of the report over the whole data
DATASETS = (WHOLE, "train", "val", "test")

# Wording and layout of the text report.
RULE = "=" * 45
TITLE = "  数据分析报告 — %s"
TOTAL = "  总条数：%d"
LABELS = "  ── 标签分布 ──────────────────────────"
LABEL = "  %-8s  %5d 条  (%5.1f%%)  %s"
LENGTHS = "  ── input 文本长度（字符数）─────────"
MEAN, MAX, MIN = "  平均值   : %.1f", "  最大值   : %d", "  最小值   : %d"
P50, P90, P99 = "  中位数   : %.1f", "  P90      : %.1f", "  P99      : %.1f"

PERCENTILES = (50, 90, 99)
# Bits of a length by which rows are counted at a time, and how often: lengths are below 2**32.
DIGIT, DIGITS = 16, 2
# So many labels are summed up and ranked by one task for each data set; more are dealt by range.
LABELS_IN_ONE_TASK = 100_000


def _length(df: DataFrame) -> Column:
    """Text length; tables that carry it spare the report the reading of all texts."""
    length = F.col("length") if "length" in df.columns else F.length("input").cast("long")
    return length.alias("length")


def histogram(df: DataFrame, label_col: str = "output") -> DataFrame:
    """Rows per (dataset, label, text length): all that the reports need, in one small table.

    Without a ``dataset`` column the rows form the whole data set.
    """
    if "dataset" not in df.columns:
        df = df.withColumn("dataset", F.lit(WHOLE))
    return df.groupBy("dataset", F.col(label_col).alias("label"), _length(df)).agg(
        F.count("*").alias("rows")
    )


def split_histogram(split: DataFrame, label_col: str = "output") -> DataFrame:
    """``histogram`` per split and over the whole data, from one pass over the tagged rows.

    An injected row is in two splits but only once in the whole data.
    """
    per_split = split.groupBy(
        "split", "injected", F.col(label_col).alias("label"), _length(split)
    ).agg(F.count("*").alias("rows"))
    copy = F.col("injected") & (F.col("split") != "train")
    datasets = F.when(copy, F.array("split")).otherwise(F.array("split", F.lit(WHOLE)))
    return (
        per_split.withColumn("dataset", F.explode(datasets))
        .groupBy("dataset", "label", "length")
        .agg(F.sum("rows").alias("rows"))
    )


def label_stats(hist: DataFrame) -> DataFrame:
    """(dataset, label, count, ratio): rows per label, and percent of the data set to 2 digits."""
    counts = hist.groupBy("dataset", "label").agg(F.sum("rows").alias("count"))
    # A row for each data set, summed up before the shuffle: no task sees all labels of one.
    totals = hist.groupBy("dataset").agg(F.sum("rows").alias("total"))
    return counts.join(totals, "dataset").select(
        "dataset", "label", "count", round_half_even(F.col("count") / F.col("total") * 100, 2).alias("ratio")
    )


def length_stats(hist: DataFrame, datasets: Sequence[str] = ()) -> DataFrame:
    """(dataset, total, mean, max, min, p50, p90, p99) of the text lengths in code points.

    Of ``datasets``, those without rows have a row as well: total 0, and NULL for the rest.

    The percentiles are exact and interpolate linearly; rounding to 6 digits takes off the noise of the
    interpolation. They are found by selection (``_at_rank``), so no task holds a data set's lengths.
    """
    lengths = hist.groupBy("dataset", "length").agg(F.sum("rows").alias("rows"))
    if datasets:
        none = hist.sparkSession.createDataFrame([(d,) for d in datasets], "dataset string")
        lengths = lengths.unionByName(
            none.select("dataset", F.lit(None).cast("long").alias("length"), F.lit(0).cast("long").alias("rows"))
        )
    mean = F.sum(F.col("length") * F.col("rows")) / F.nullif(F.sum("rows"), F.lit(0))
    # Summed up before the shuffle: a task hands on one row for each data set.
    totals = lengths.groupBy("dataset").agg(
        F.sum("rows").alias("total"),
        (F.rint(mean * 100) / 100).alias("mean"),
        F.max("length").alias("max"),
        F.min("length").alias("min"),
        # Lengths are missing where texts are; they have no rank.
        F.sum(F.when(F.col("length").isNotNull(), F.col("rows")).otherwise(0)).alias("placed"),
    )
    # The place among the rows, in hundredths.
    place = (F.col("placed") - 1) * F.col("share")
    wanted = totals.where("placed > 0").select(
        "dataset",
        F.explode(F.array(*map(F.lit, PERCENTILES))).alias("share"),
        "placed",
    )
    sides = F.array(
        *(
            F.struct(F.lit(side).alias("side"), rank.alias("rank"))
            for side, rank in ((0, F.floor(place / 100)), (1, F.ceil(place / 100)))
        )
    )
    ranks = wanted.select(
        "dataset", "share", (F.pmod(place, F.lit(100)) / 100).alias("part"), F.inline(sides)
    )
    found = _at_rank(lengths.where("rows > 0 and length is not null"), ranks)
    between = (F.col("high") - F.col("low")) * F.col("part") + F.col("low")
    points = (
        found.groupBy("dataset", "share", "part")
        .agg(
            F.max(F.when(F.col("side") == 0, F.col("value"))).alias("low"),
            F.max(F.when(F.col("side") == 1, F.col("value"))).alias("high"),
        )
        .groupBy("dataset")
        .agg(
            *(
                F.max(F.when(F.col("share") == p, F.round(between, 6))).alias(f"p{p}")
                for p in PERCENTILES
            )
        )
    )
    return totals.drop("placed").join(points, "dataset", "left")


def _at_rank(lengths: DataFrame, ranks: DataFrame) -> DataFrame:
    """``ranks`` (dataset, share, side, part, rank from 0) with ``value``, the length of that rank.

    Rows are counted by the highest digits of their length, then within the digit that holds the rank by
    the next ones, and so on. A step looks at no more than 2**DIGIT counts for each rank.
    """
    who = ["dataset", "share", "side", "part"]
    state = ranks.select(*who, "rank", F.lit(0).cast("long").alias("value"))
    for shift in (DIGIT * i for i in reversed(range(DIGITS))):
        cell = F.shiftright("length", shift).alias("cell")
        cells = (
            lengths.join(state, "dataset")
            .where(F.shiftright("length", shift + DIGIT) == F.col("value"))
            .groupBy(*who, "rank", cell)
            .agg(F.sum("rows").alias("n"))
        )
        until = F.sum("n").over(W.partitionBy(*who).orderBy("cell"))
        state = (
            cells.withColumn("until", until)
            .where("until > rank and until - n <= rank")
            .select(*who, (F.col("rank") - F.col("until") + F.col("n")).alias("rank"), F.col("cell").alias("value"))
        )
    return state.select(*who, "value")


def _one_digit(name: str) -> Column:
    return round_half_even(F.col(name), 1)


def label_lines(
    labels: DataFrame, most: int = LABELS_IN_ONE_TASK, staging: Staging | None = None
) -> DataFrame:
    """(dataset, place, line): one line per label, most frequent first, a block per full 5 %.

    Up to ``most`` labels a task ranks those of a data set; more are numbered over a range shuffle,
    with tables in ``staging``: clear it when nothing reads the lines any more.
    """
    staging = (staging or Staging(labels.sparkSession)).part()
    labels = staging.table(labels, "labels")
    bar = F.repeat(F.lit("█"), F.floor(F.col("ratio") / 5).cast("int"))
    line = F.format_string(LABEL, "label", "count", _one_digit("ratio"), bar).alias("line")
    order = [F.desc("count"), F.asc("label")]
    if labels.count() <= most:
        place = F.row_number().over(W.partitionBy("dataset").orderBy(*order))
        return labels.select("dataset", place.cast("long").alias("place"), line)
    placed = add_places(labels, [F.asc("dataset"), *order], staging, "places")
    before = staging.table(
        placed.groupBy("dataset").agg((F.min("place") - 1).alias("before"), F.count("*").alias("n")),
        "before",
    )
    joined = salted_join(
        placed,
        before.select("dataset", "before"),
        "dataset",
        "place",
        before.select("dataset", "n"),
        labels.count(),
    )
    return joined.select("dataset", (F.col("place") - F.col("before")).alias("place"), line)


def _measure(pattern: str, value: Column | str) -> Column:
    """A line with a number, or with a dash where there is none."""
    value = F.col(value) if isinstance(value, str) else value
    dash = F.lit(re.sub(r"%[.0-9]*[df]", "-", pattern))
    return F.when(value.isNotNull(), F.format_string(pattern, value)).otherwise(dash)


def report_lines(
    hist: DataFrame, datasets: Sequence[str] = (), staging: Staging | None = None
) -> DataFrame:
    """(dataset, line_no, line): the report of each data set as text.

    Of ``datasets``, those without rows have a report, too. ``staging`` as for ``label_lines``.
    """
    head = (
        F.lit(RULE),
        F.format_string(TITLE, "dataset"),
        F.lit(RULE),
        F.format_string(TOTAL, "total"),
        F.lit(""),
        F.lit(LABELS),
    )
    tail = (
        F.lit(""),
        F.lit(LENGTHS),
        _measure(MEAN, _one_digit("mean")),
        _measure(MAX, "max"),
        _measure(MIN, "min"),
        _measure(P50, _one_digit("p50")),
        _measure(P90, _one_digit("p90")),
        _measure(P99, _one_digit("p99")),
        F.lit(RULE),
    )
    labels = label_lines(label_stats(hist), staging=staging)
    before = F.lit(len(head))
    per_set = labels.groupBy("dataset").agg(F.count("*").alias("labels"))
    frame = (
        length_stats(hist, datasets)
        .join(per_set, "dataset", "left")
        .withColumn("labels", F.coalesce("labels", F.lit(0)))
        .select("dataset", "labels", F.posexplode(F.array(*head, *tail)).alias("i", "line"))
    )
    after = F.when(F.col("i") < before, 1).otherwise(F.col("labels") + 1)
    return frame.select(
        "dataset", (F.col("i") + after).cast("long").alias("line_no"), "line"
    ).unionByName(
        labels.select("dataset", (F.col("place") + before).cast("long").alias("line_no"), "line")
    )
