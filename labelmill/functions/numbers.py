"""Column expressions on numbers and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, digits: int) -> Column:
    """Round a double by its exact binary value, ties to even, as Python's ``round`` does.

    ``bround`` works on the shortest decimal text, so it takes 12.35 for a tie although the
    double lies below it. The rounding error of ``x * 10**digits`` is recovered exactly by
    splitting ``x`` into two halves, and decides the apparent ties.
    """
    scale = F.lit(float(10**digits))
    product = x * scale
    spread = x * F.lit(134217729.0)  # 2**27 + 1
    high = spread - (spread - x)
    error = (high * scale - product) + (x - high) * scale
    below = F.floor(product).cast("double")
    tie = (product - below) == 0.5
    rounded = (
        F.when(tie & (error > 0), below + 1)
        .when(tie & (error < 0), below)
        .otherwise(F.rint(product))
    )
    return rounded / scale


def l2_norm(vec: Column) -> Column:
    return F.sqrt(
        F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def l2_normalize(vec: Column) -> Column:
    """Unit-length vector of doubles; a zero vector stays zero.

    The norm is the element of an outer array, so that it is worked out once and not per element.
    """

    def scaled(norm: Column) -> Column:
        return F.transform(
            vec, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0))
        )

    return F.transform(F.array(l2_norm(vec)), scaled)[0]
