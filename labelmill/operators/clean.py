"""Cleaning: null rows, then illegal labels, then keep-last deduplication, with counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.defaults import LEGAL_LABELS
from labelmill.functions.text import NULL_TOKENS, null_if_token, text_key


def blank_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """NULL for the texts and labels that stand for a missing cell."""
    return df.withColumns({c: null_if_token(F.col(c), tokens) for c in ("input", "output")})


def is_complete() -> Column:
    return F.col("input").isNotNull() & F.col("output").isNotNull()


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.where(is_complete())


def keep_legal(df: DataFrame, labels: Sequence[str] = LEGAL_LABELS) -> DataFrame:
    return df.where(F.col("output").isin(*labels))


def illegal_labels(df: DataFrame, labels: Sequence[str] = LEGAL_LABELS) -> DataFrame:
    """Labels outside ``labels`` among the complete rows, with their row counts."""
    return (
        drop_null_rows(blank_tokens(df))
        .where(~F.col("output").isin(*labels))
        .groupBy("output")
        .agg(F.count("*").alias("rows"))
    )


def keep_last(df: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``seq`` of each ``input`` (and ``within``).

    The limit on the row number is applied before the shuffle too, so a text that fills a third
    of the table leaves each map task at most once. The hash leads the sort, which then compares
    long texts only within one hash value.
    """
    same = W.partitionBy(*within, F.xxhash64("input"), "input").orderBy(F.desc("seq"))
    return df.withColumn("_rn", F.row_number().over(same)).where("_rn = 1").drop("_rn")


def clean(
    df: DataFrame,
    labels: Sequence[str] = LEGAL_LABELS,
    within: Sequence[str] = (),
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Rows that pass all three checks, in this order: a later illegal row never displaces an
    earlier legal one. ``within`` keeps groups apart in the deduplication."""
    return keep_last(keep_legal(drop_null_rows(blank_tokens(df, tokens)), labels), within)


def validation_metrics(
    df: DataFrame,
    labels: Sequence[str] = LEGAL_LABELS,
    by: Sequence[str] = (),
    tokens: Sequence[str] = NULL_TOKENS,
    cleaned: DataFrame | None = None,
) -> DataFrame:
    """The counters of ``clean`` on the same rows: one row, or one per group of ``by``.

    Rows shrink to (verdict, text key) and are counted before the shuffle, so neither long texts
    nor frequent ones travel. Where the ``cleaned`` rows are at hand, written down, they are
    counted instead of telling texts apart again.
    """
    verdict = (
        F.when(~is_complete(), "null")
        .when(~F.col("output").isin(*labels), "illegal")
        .otherwise("legal")
    )
    marked = blank_tokens(df, tokens).select(*by, verdict.alias("verdict"), "input")
    if cleaned is None:
        key = F.when(F.col("verdict") == "legal", text_key(F.col("input")))
        texts = marked.groupBy(*by, "verdict", key.alias("key")).agg(F.count("*").alias("n"))
        parts = texts.select(*by, "verdict", "n", F.col("key").isNotNull().cast("long").alias("kept"))
    else:
        read = marked.groupBy(*by, "verdict").agg(F.count("*").alias("n"))
        kept = cleaned.groupBy(*by).agg(F.count("*").alias("kept"))
        parts = read.withColumn("kept", F.lit(0).cast("long")).unionByName(
            kept.withColumns({"verdict": F.lit("legal"), "n": F.lit(0).cast("long")})
        )

    def rows(which: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("verdict") == which, F.col("n"))), F.lit(0))

    final = F.coalesce(F.sum("kept"), F.lit(0))
    return (
        parts.groupBy(*by)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("raw_count"),
            rows("null").alias("null_count"),
            rows("illegal").alias("invalid_label_count"),
            (rows("legal") - final).alias("duplicate_count"),
            final.alias("final_count"),
        )
        .withColumn("removed_count", F.col("raw_count") - F.col("final_count"))
        .withColumn("is_valid", F.col("final_count") > 0)
    )


def validation_messages(
    metrics: Row, labels: Sequence[str] = LEGAL_LABELS
) -> tuple[list[str], list[str]]:
    """(errors, warnings) for one row of ``validation_metrics``."""
    found = (
        (metrics.null_count, "rows without input or output"),
        (metrics.invalid_label_count, f"rows with a label outside {list(labels)}"),
        (metrics.duplicate_count, "repeated inputs, the last of each kept"),
    )
    warnings = [f"removed {n} {what}" for n, what in found if n]
    errors = [] if metrics.is_valid else ["no row is left after cleaning"]
    return errors, warnings


def validation_summary(metrics: Row, labels: Sequence[str] = LEGAL_LABELS) -> str:
    """One row of ``validation_metrics`` as text."""
    errors, warnings = validation_messages(metrics, labels)
    return "\n".join(
        [
            f"valid: {'yes' if metrics.is_valid else 'no'}",
            f"rows: {metrics.raw_count} read, {metrics.final_count} kept",
            *(f"error: {e}" for e in errors),
            *(f"warning: {w}" for w in warnings),
        ]
    )
