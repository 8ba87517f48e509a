"""Sinks: record files, tables and reports. Every task writes its own part files."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.defaults import FORMAT, SYSTEM_PROMPT
from labelmill.operators.analyze import DATASETS, report_lines
from labelmill.operators.formats import ARRAY, RecordFormat, get_format
from labelmill.operators.rank import add_ids
from labelmill.operators.records import to_json_lines, to_records
from labelmill.sources.staging import Staging


def run_stamp(now: datetime | None = None) -> str:
    """Stamp shared by all outputs of one run."""
    return (now or datetime.now()).strftime("%Y-%m-%d_%H-%M-%S")


def run_path(base: str, name: str, stamp: str, suffix: str = "") -> str:
    """``<base>/<name>_<stamp><suffix>``: no run overwrites another's output."""
    return f"{base}/{name}_{stamp}{suffix}"


def write_json_lines(lines: DataFrame, path: str) -> None:
    """``lines(split, json)`` as JSONL, one folder ``split=<name>`` per split."""
    lines.select("split", "json").write.partitionBy("split").text(path)


def write_json_array(lines: DataFrame, sizes: dict[str, int], path: str) -> None:
    """``lines(split, json)`` as JSON arrays, one folder ``split=<name>`` per split.

    Each part file is a whole array by itself, whatever the size; a split's records are those of all
    its files. Rows stay in the task that read them. A split with 0 rows in ``sizes`` is written as
    ``[]``.
    """

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``split, at, json``: a task's rows of a split between brackets. One row is held back
        until it is known whether it closes the array."""
        held, at, before = None, 0, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, rows]) if held is not None else rows
            names = table["split"].to_pylist()
            ready = len(names) - 1
            if ready < 0:
                continue
            yield _bracketed(table.slice(0, ready), names, before, at)
            before, at, held = names[ready - 1] if ready else before, at + ready, table.slice(ready)
        if held is not None:
            yield _bracketed(held, [*held["split"].to_pylist(), None], before, at)

    (
        lines.select("split", "json")
        .sortWithinPartitions("split")
        .mapInArrow(bracketed, "split string, at long, json string")
        .sortWithinPartitions("split", "at")
        .select("split", "json")
        .write.partitionBy("split")
        .text(path)
    )
    empty = [(name, "[]") for name, n in sizes.items() if n == 0]
    if empty:
        none = lines.sparkSession.createDataFrame(empty, "split string, json string").coalesce(1)
        none.write.mode("append").partitionBy("split").text(path)


def _bracketed(
    rows: pa.Table, names: list[str | None], before: str | None, at: int
) -> pa.RecordBatch:
    """``names`` has the splits of the rows and of the one after them, ``before`` the one before."""
    n = rows.num_rows
    own = names[:n]
    opener = [",\n" if a == b else "[" for a, b in zip(own, [before, *own], strict=False)]
    closer = ["" if a == b else "]" for a, b in zip(own, names[1 : n + 1], strict=True)]
    json = rows["json"].combine_chunks()
    if isinstance(json, pa.ChunkedArray):
        json = pa.concat_arrays(json.chunks) if json.num_chunks else pa.array([], pa.string())
    return pa.record_batch(
        {
            "split": pa.array(own, pa.string()),
            "at": pa.array(range(at, at + n), pa.int64()),
            "json": pc.binary_join_element_wise(
                pa.array(opener, json.type), json, pa.array(closer, json.type), pa.scalar("", json.type)
            ),
        }
    )


def export(
    split: DataFrame,
    path: str,
    fmt: str | RecordFormat = FORMAT,
    prompt: str = SYSTEM_PROMPT,
    prefix: str = "",
    sizes: dict[str, int] | None = None,
    ordered: bool = False,
) -> dict[str, int]:
    """Write the records of every split in one pass; returns the rows per split.

    Ids restart at 1 in each split, injected rows come last. Formats that need no ids are written
    straight from the scan, without any shuffle. ``sizes`` saves counting when it is known; list
    a split with 0 rows there to have it written as an empty file. With ``ordered`` the part files,
    in the order of their names, follow the source's order, which costs a range shuffle.
    """
    fmt = get_format(fmt)
    if sizes is None:
        sizes = {r.split: r.n for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}
    last = ["injected"] if "injected" in split.columns else []
    if fmt.with_id:
        split = add_ids(split, ["split"], last)
    if ordered:
        order = ["split", *last, "seq"]
        split = split.repartitionByRange(*order).sortWithinPartitions(*order)
    lines = to_json_lines(to_records(split, fmt, prompt, prefix))
    if fmt.container == ARRAY:
        write_json_array(lines, sizes, path)
    else:
        write_json_lines(lines, path)
    return sizes


def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    """A result table; an empty one keeps its columns (Parquet schema, or a CSV header)."""
    writer = df.write.format(format)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
        if df.isEmpty():
            # A CSV task without rows writes no header.
            spark = df.sparkSession
            header = ",".join(f'"{c}"' for c in df.columns)
            spark.createDataFrame([(header,)], "value string").coalesce(1).write.text(path)
            return
    writer.save(path)


def write_report(
    hist: DataFrame,
    path: str,
    datasets: tuple[str, ...] = DATASETS,
    staging: Staging | None = None,
) -> None:
    """The text reports of ``datasets``, in this order, a blank line between two of them.

    The part files, in the order of their names, are the report: one file, unless there are very many
    labels. A data set without rows has a report of dashes.
    """
    own = (staging or Staging(hist.sparkSession)).part()
    place = F.array_position(F.array(*map(F.lit, datasets)), F.col("dataset"))
    lines = report_lines(hist.where(F.col("dataset").isin(*datasets)), datasets, own)
    gap = (F.col("line_no") == 1) & (place > 1)
    (
        lines.withColumn("line", F.when(gap, F.concat(F.lit("\n"), "line")).otherwise(F.col("line")))
        .withColumn("place", place)
        .repartitionByRange("place", "line_no")
        .sortWithinPartitions("place", "line_no")
        .select("line")
        .write.text(path)
    )
    own.clear()
