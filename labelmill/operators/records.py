"""Samples to training records, as nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.defaults import FORMAT, SYSTEM_PROMPT
from labelmill.operators.formats import RecordFormat, get_format


def prefixed(col: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), col) if prefix else col


def record_column(fmt: RecordFormat, prompt: str = SYSTEM_PROMPT, prefix: str = "") -> Column:
    """The record of a row of ``input``, ``output`` and, where the format has ids, ``id``.

    Missing texts read ``nan``: uncleaned rows keep all keys of their record.
    """
    said = (
        F.lit(prompt),
        prefixed(F.coalesce("input", F.lit("nan")), prefix),
        F.coalesce("output", F.lit("nan")),
    )
    return F.struct(*([F.col("id")] if fmt.with_id else []), *fmt.build(*said))


def to_records(
    df: DataFrame,
    fmt: str | RecordFormat = FORMAT,
    prompt: str = SYSTEM_PROMPT,
    prefix: str = "",
) -> DataFrame:
    """``df`` with a ``record`` column; see ``record_column``."""
    return df.withColumn("record", record_column(get_format(fmt), prompt, prefix))


def to_json_lines(records: DataFrame) -> DataFrame:
    """``records`` with ``json``, one compact object per row; non-ASCII text stays readable."""
    return records.withColumn("json", F.to_json("record", {"ignoreNullFields": "false"}))
