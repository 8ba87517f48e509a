"""Rows numbered without doubt, and rows picked out by id without shuffling the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.sources.staging import Staging

# Ids that may be broadcast: 8 MB.
BROADCAST_IDS = 1 << 20


def fresh(name: str, columns: list[str]) -> str:
    """The name, made longer until no column has it in any spelling."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def with_row(docs: DataFrame, id_col: str, staging: Staging) -> tuple[DataFrame, str]:
    """The rows with a number of their own, and its column: the id, where that will do."""
    row = fresh("_row", docs.columns)
    unclear = docs.select(F.col(id_col).cast("long").alias("i")).groupBy("i").count()
    if unclear.where("i is null or count > 1").isEmpty():
        return docs.withColumn(row, F.col(id_col).cast("long")), row
    # Numbers given on the fly need not be the same in the next scan, so they are written.
    return staging.table(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def only(texts: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """The rows of ``texts`` whose ``name`` (long) is in ``wanted``, a table that is cheap to read.

    Up to BROADCAST_IDS ids, counted first, are sent to the scan. Beyond, all rows are returned: the
    join that follows leaves the others out.
    """
    ids = wanted.select(name).distinct()
    if ids.count() > BROADCAST_IDS:
        return texts
    return texts.join(F.broadcast(ids), name, "left_semi")


def without(rows: DataFrame, unwanted: DataFrame, name: str) -> DataFrame:
    """The rows whose ``name`` (long) is not in ``unwanted``, a table that is cheap to read."""
    ids = unwanted.select(name).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, name, "left_anti").select(*rows.columns)
