"""Documents dealt by ranges of their id, for work that goes by ascending id."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# More ranges than partitions, so that a hash of the range's number deals them evenly.
RANGES_PER_PARTITION = 4
# Bytes of input files for one range, and ranges at most: their bounds pass the driver.
RANGE_BYTES = 32 << 20
MOST_RANGES = 20_000


def in_id_ranges(
    docs: DataFrame, id_col: str, text_col: str, *, with_next: bool = False
) -> DataFrame:
    """``part, after, ord, doc_id, text``: each range in one task, in order, one after another.

    Ranges go up with ``part``. Null ids come first, rows with one id are ordered by text, a null
    text counts as empty. With ``with_next``, rows with ``after`` = 1 are the rows that open the next
    range that has any (the first one for the last), so that each range can see what follows its
    last row. Only ids pass the driver: the quantiles that bound the ranges, and the smallest of each.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("ord"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The planner's size of the input: that of its files, where nothing else is known.
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0  # more stands for a size that the planner does not know
    parts = max(RANGES_PER_PARTITION * partitions, min(MOST_RANGES, -(-known // RANGE_BYTES)))
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.select("ord").approxQuantile("ord", shares, 1 / (4 * parts))
    bounds = np.unique(np.array([int(c) for c in cuts], np.int64))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right"))

    if with_next:
        firsts = sorted(
            rows.select(part_of("ord").alias("part"), "ord")
            .groupBy("part")
            .agg(F.min("ord").alias("low"))
            .collect(),
            key=lambda r: r.part,
        )
        before = {firsts[i].low: firsts[i - 1].part for i in range(len(firsts))}

        @F.pandas_udf("array<int>")
        def parts_of(ids: pd.Series) -> pd.Series:
            own = np.searchsorted(bounds, ids.to_numpy(), "right")
            lead = [before.get(i, -1) for i in ids]
            return pd.Series([[p] if b < 0 else [p, b] for p, b in zip(own, lead, strict=True)])

        dealt = rows.withColumn("parts", parts_of("ord")).select(
            F.posexplode("parts").alias("after", "part"), "ord", "doc_id", "text"
        )
    else:
        dealt = rows.select(
            part_of("ord").alias("part"), F.lit(0).alias("after"), "ord", "doc_id", "text"
        )
    return dealt.repartition("part").sortWithinPartitions("part", "after", "ord", "text")
