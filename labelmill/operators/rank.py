"""Contiguous numbers over a table of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.sources.staging import Staging

# Rows per bucket, about, and buckets at most: their cut-offs pass the driver.
BUCKET_ROWS = 1 << 17
MAX_BUCKETS = 10_000


def _bucketed(df: DataFrame, width: int) -> DataFrame:
    """``df`` with ``_bucket``: ranges of ``seq`` with about as many rows each, however it is spread."""
    rows = df.count()
    buckets = min(MAX_BUCKETS, -(-rows // width))
    if buckets < 2:
        return df.withColumn("_bucket", F.lit(0.0))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = sorted({float(c) for c in df.approxQuantile("seq", shares, 0.25 / buckets)})
    splits = [float("-inf"), *cuts, float("inf")]
    # Equal numbers stay together and the order holds, also where a double rounds them.
    return (
        Bucketizer(splits=splits, inputCol="_seq", outputCol="_bucket", handleInvalid="keep")
        .transform(df.withColumn("_seq", F.col("seq").cast("double")))
        .drop("_seq")
    )


def add_ids(
    df: DataFrame,
    within: Sequence[str] = ("split",),
    first: Sequence[str] = (),
    width: int = BUCKET_ROWS,
    id_col: str = "id",
) -> DataFrame:
    """Ids 1, 2, … per group of ``within``, in the order of ``first`` and then ``seq``.

    A window over a whole group would sort it in one task. Rows are numbered inside buckets of
    about ``width`` rows instead, and a bucket's offset is the running sum of the bucket counts, a
    table of at most MAX_BUCKETS rows per group. Nulls in ``within`` and ``first`` are values like
    others. ``df`` is read several times: stage it first if it is costly.
    """
    within, first = list(within), list(first)
    slots = _bucketed(df, width)
    keys = [*within, *first, "_bucket"]
    before = W.partitionBy(*within).orderBy(*first, "_bucket").rowsBetween(
        W.unboundedPreceding, -1
    )
    offsets = (
        slots.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(
            *(F.col(k).alias(f"_o_{k}") for k in keys),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        )
    )
    # Numbered before the join, which then finds its order in place: one shuffle, one sort.
    inside = F.row_number().over(W.partitionBy(*keys).orderBy("seq"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys))
    return (
        slots.withColumn("_inside", inside)
        .join(offsets, same)
        .withColumn(id_col, (F.col("_offset") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_offset", "_inside", *(f"_o_{k}" for k in keys))
    )


def add_places(df: DataFrame, order: Sequence[Column], staging: Staging, name: str) -> DataFrame:
    """``df`` with ``place`` 1, 2, … over all rows, by a range shuffle of a narrow table.

    The sorted rows are written; of each part only its number of rows passes the driver.
    """
    sort = [*order]
    placed = staging.table(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_at", 33).cast("int").alias("_part")
    counts = sorted(placed.groupBy(part).count().collect())
    starts = accumulate((n for _, n in counts), initial=0)
    table = [(p, s) for (p, _), s in zip(counts, starts, strict=False)]
    if not table:
        return placed.withColumn("place", F.lit(0).cast("long")).drop("_at")
    first = F.broadcast(df.sparkSession.createDataFrame(table, "_part int, _first long"))
    return (
        placed.withColumn("_part", part)
        .join(first, "_part")
        .withColumn("place", F.col("_first") + F.expr("_at & 8589934591") + 1)
        .drop("_at", "_part", "_first")
    )
