"""Train / val / test split with exact sizes, optionally exact per label, and injection."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.defaults import SEED, SplitRatios
from labelmill.operators.rank import add_places
from labelmill.operators.skew import salted_join
from labelmill.sources.staging import Staging

log = logging.getLogger(__name__)

# Leading hex digits of the order key that form a bucket: 65,536 buckets per label.
DIGITS = 4
# Up to this many labels the cut-off table (two rows' worth per label) is broadcast.
BROADCAST_LABELS = 100_000


def label_counts(df: DataFrame, label_col: str = "output") -> DataFrame:
    return df.groupBy(label_col).agg(F.count("*").alias("rows"))


def split_summary(df: DataFrame, label_col: str = "output") -> DataFrame:
    """Rows per split and label, and per split (label NULL)."""
    per_label = df.groupBy("split", label_col).agg(F.count("*").alias("rows"))
    per_split = per_label.groupBy("split").agg(F.sum("rows").alias("rows"))
    return per_label.unionByName(per_split.withColumn(label_col, F.lit(None).cast("string")))


@dataclass(frozen=True)
class Sizes:
    """Rows, strata, and the sizes of the splits: test of all rows first, then val of the rest.

    They round up in double arithmetic.
    """

    n: int
    strata: int
    smallest: int
    ratios: SplitRatios

    @property
    def n_test(self) -> int:
        return ceil(float(self.n) * self.ratios.test)

    @property
    def n_rest(self) -> int:
        return self.n - self.n_test

    @property
    def n_val(self) -> int:
        return ceil(float(self.n_rest) * self.ratios.val_of_rest)

    @property
    def n_train(self) -> int:
        return self.n_rest - self.n_val


def _shared(
    counts: DataFrame, count: str, total: int, draw: int, name: str, few: bool, staging: Staging
) -> DataFrame:
    """``counts`` with ``name``: each stratum's largest-remainder share of ``draw`` of ``total``.

    Integer arithmetic in DECIMAL(38): exact for any table size. Equal remainders go to the
    smaller label. Up to BROADCAST_LABELS strata are ranked in one task, more by a range shuffle.
    """
    whole = F.lit(max(total, 1)).cast("decimal(19,0)")
    wide = F.col(count).cast("decimal(19,0)") * F.lit(draw).cast("decimal(19,0)")
    rest = wide % whole
    parts = counts.withColumn("_rest", rest).withColumn(
        "_floor", ((wide - F.col("_rest")) / whole).cast("long")
    )
    spare = draw - (parts.agg(F.sum("_floor")).first()[0] or 0)
    order = (F.desc("_rest"), F.col("stratum"))
    if few:
        parts = parts.withColumn("place", F.row_number().over(W.orderBy(*order)))
    else:
        parts = add_places(parts, order, staging, f"places_{name}")
    got = F.col("_floor") + (F.col("place") <= spare).cast("long")
    return parts.withColumn(name, got).drop("_rest", "_floor", "place")


def split_quotas(counts: DataFrame, sizes: Sizes, staging: Staging) -> DataFrame:
    """Test and val quotas per stratum from ``counts(stratum, rows)``, one row per stratum."""
    few = sizes.strata <= BROADCAST_LABELS
    tests = _shared(counts, "rows", sizes.n, sizes.n_test, "q_test", few, staging)
    tests = staging.table(tests.withColumn("left", F.col("rows") - F.col("q_test")), "tests")
    return _shared(tests, "left", sizes.n_rest, sizes.n_val, "q_val", few, staging).drop("left")


def _stratum(label: Column) -> Column:
    """The label as a key that is never null: a missing label is a stratum of its own, the first."""
    return F.when(label.isNull(), "").otherwise(F.concat(F.lit("="), label.cast("string")))


def _order_key(seed: int) -> Column:
    """Reproducible shuffle key; ``seq`` breaks the (unheard-of) ties."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("seq").cast("string")))


class _Cut:
    """The cut-offs that turn quotas into splits without sorting or shuffling the rows.

    Rows of a stratum are ordered by the md5 of (seed, seq). The first q_test of them are test,
    the next q_val val, the others train. Counting the rows per leading digits of the key shows
    in which bucket each cut-off falls, and only that bucket's rows are numbered. Tagging a row
    then means comparing its key with its stratum's two cut-offs. Counts and cut-offs are written
    down, so that using the result several times never repeats the passes that found them.
    """

    def __init__(
        self,
        df: DataFrame,
        stratum: Column,
        ratios: SplitRatios,
        seed: int,
        digits: int,
        staging: Staging | None = None,
    ) -> None:
        self.df, self.stratum, self.seed = df, stratum, seed
        self.staging = staging.part() if staging else Staging(df.sparkSession)
        self.keyed = df.select(
            stratum.alias("stratum"), _order_key(seed).alias("h"), "seq"
        ).withColumn("b", F.substring("h", 1, digits))
        counts = self.keyed.groupBy("stratum", "b").agg(F.count("*").alias("rows"))
        self.buckets = self.staging.table(counts, "buckets")
        self.per_stratum = self.buckets.groupBy("stratum").agg(F.sum("rows").alias("rows"))
        found = self.per_stratum.agg(
            F.sum("rows").alias("n"), F.count("*").alias("strata"), F.min("rows").alias("smallest")
        ).first()
        if not found.n:
            raise ValueError("there are no rows to split")
        self.sizes = Sizes(found.n, found.strata, found.smallest, ratios)
        if self.sizes.n_rest < 1 or self.sizes.n_train < 1:
            raise ValueError(f"{self.sizes.n} rows are too few: train would be empty")

    @cached_property
    def quotas(self) -> DataFrame:
        quotas = split_quotas(self.per_stratum, self.sizes, self.staging)
        return self.staging.table(quotas, "quotas")

    def unstratifiable(self) -> str | None:
        """Why the split cannot follow the strata, or None where it can.

        What the sizes settle is settled first: with a label for each row there are no quotas.
        """
        s = self.sizes
        rare = "a label has fewer than 2 rows in one of the two cuts"
        if s.smallest < 2:
            return rare
        if min(s.n_test, s.n_rest, s.n_val, s.n_train) < s.strata:
            return f"a split has fewer rows than there are labels ({s.strata})"
        left = self.quotas.agg(F.min(F.col("rows") - F.col("q_test"))).first()[0]
        return rare if left < 2 else None

    def _cuts(self, few: bool) -> DataFrame:
        """(stratum, test, val): the (h, seq) of the last test row and of the last val row."""
        before = W.partitionBy("stratum").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
        places = self.quotas.select(
            "stratum",
            F.explode(
                F.create_map(
                    F.lit("test"), F.col("q_test"), F.lit("val"), F.col("q_test") + F.col("q_val")
                )
            ).alias("cut", "place"),
        )
        cut_buckets = (
            self.buckets.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
            .join(places, "stratum")
            .where("place > before and place <= before + rows")
            .select("stratum", "b", "cut", (F.col("place") - F.col("before")).alias("place"))
        )
        # A bucket holds a 65,536th of its label, so no bucket is hot even where a label is.
        inside = W.partitionBy("stratum", "b", "cut").orderBy("h", "seq")
        return (
            self.keyed.join(F.broadcast(cut_buckets) if few else cut_buckets, ["stratum", "b"])
            .withColumn("rn", F.row_number().over(inside))
            .where("rn = place")
            .groupBy("stratum")
            .agg(
                *(
                    F.max(F.when(F.col("cut") == cut, F.struct("h", "seq"))).alias(cut)
                    for cut in ("test", "val")
                )
            )
        )

    def tag(self) -> DataFrame:
        few = self.sizes.strata <= BROADCAST_LABELS
        cuts = self.staging.table(self._cuts(few), "cuts")
        all_cuts = self.quotas.select("stratum", F.col("rows").alias("n")).join(
            cuts, "stratum", "left"
        )
        rows = self.df.withColumns({"stratum": self.stratum, "_h": _order_key(self.seed)})
        if few:
            placed = rows.join(F.broadcast(all_cuts), "stratum")
        else:
            placed = salted_join(
                rows, all_cuts, "stratum", "seq", all_cuts.select("stratum", "n"), self.sizes.n
            )

        def up_to(cut: str) -> Column:
            same = F.col("_h") == F.col(f"{cut}.h")
            return (F.col("_h") < F.col(f"{cut}.h")) | (same & (F.col("seq") <= F.col(f"{cut}.seq")))

        split = F.when(up_to("test"), "test").when(up_to("val"), "val").otherwise("train")
        return placed.select(*self.df.columns, split.alias("split"))


def stratified_split(
    df: DataFrame,
    ratios: SplitRatios = SplitRatios(),
    seed: int = SEED,
    label_col: str = "output",
    digits: int = DIGITS,
    staging: Staging | None = None,
) -> DataFrame:
    """``df`` with ``split``: exact sizes, each label in proportion. ValueError where impossible.

    Rows without a label are a stratum of their own. Counts and cut-offs are written in ``staging``
    if that is given: clear it when nothing reads the result any more.
    """
    cut = _Cut(df, _stratum(F.col(label_col)), ratios, seed, digits, staging)
    reason = cut.unstratifiable()
    if reason:
        raise ValueError(reason)
    return cut.tag()


def random_split(
    df: DataFrame,
    ratios: SplitRatios = SplitRatios(),
    seed: int = SEED,
    digits: int = DIGITS,
    staging: Staging | None = None,
) -> DataFrame:
    """``df`` with ``split``: the same sizes, labels not considered."""
    return _Cut(df, F.lit(""), ratios, seed, digits, staging).tag()


def split_dataset(
    df: DataFrame,
    ratios: SplitRatios = SplitRatios(),
    seed: int = SEED,
    label_col: str = "output",
    digits: int = DIGITS,
    staging: Staging | None = None,
) -> DataFrame:
    """Stratified where possible, else random. ``df`` is read three times: stage costly input."""
    return split_with_sizes(df, ratios, seed, label_col, digits, staging)[0]


def split_with_sizes(
    df: DataFrame,
    ratios: SplitRatios = SplitRatios(),
    seed: int = SEED,
    label_col: str = "output",
    digits: int = DIGITS,
    staging: Staging | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """``split_dataset``, and the rows of each split, which the cut knows without counting."""
    cut = _Cut(df, _stratum(F.col(label_col)), ratios, seed, digits, staging)
    if cut.sizes.smallest < 3:
        log.warning("a label has only %d rows, the split may ignore labels", cut.sizes.smallest)
    reason = cut.unstratifiable()
    if reason:
        log.warning("splitting without regard to labels: %s", reason)
        cut = _Cut(df, F.lit(""), ratios, seed, digits, staging)
    s = cut.sizes
    return cut.tag(), {"train": s.n_train, "val": s.n_val, "test": s.n_test}


def inject_new(
    split: DataFrame, new: DataFrame, into: Sequence[str] = ("train", "val")
) -> DataFrame:
    """All *new* rows appended to each split of ``into``; ``injected`` tells them apart."""
    copies = new.withColumn("split", F.explode(F.array(*map(F.lit, into))))
    return split.withColumn("injected", F.lit(False)).unionByName(
        copies.withColumn("injected", F.lit(True))
    )
