"""Equi-join of many rows with a small result when one key may hold a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task takes.
ROWS_PER_SALT = 1_000_000
# The list of keys to salt stays below this, hence it may be broadcast.
MAX_HOT_KEYS = 20_000


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    row_id: str,
    counts: DataFrame,
    total: int,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Inner join on ``key``, the rows of a hot key spread over several tasks.

    ``counts(key, n)`` says how many of the ``total`` rows bear a key. At most
    ``total / rows_per_salt`` keys can be hot, and the quotient is held below ``MAX_HOT_KEYS``,
    which bounds the broadcast. Only the lookup rows of hot keys are repeated.
    """
    per_salt = max(rows_per_salt, total // MAX_HOT_KEYS, 1)
    if total <= per_salt:
        return rows.join(lookup, key)  # too few rows for any key to be hot
    hot = F.broadcast(
        counts.where(F.col("n") > per_salt).select(
            key, F.ceil(F.col("n") / F.lit(per_salt)).cast("int").alias("_salts")
        )
    )
    salts = F.coalesce("_salts", F.lit(1))
    left = (
        rows.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(row_id), salts).cast("int"))
        .drop("_salts")
    )
    right = (
        lookup.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return left.join(right, [key, "_salt"]).drop("_salt")
