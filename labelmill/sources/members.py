"""Sources: samples made of several named members.

Every source yields ``samples(seq LONG, sheet STRING, input STRING, output STRING)``. ``seq`` is
unique and carries the order of the rows: members in the order given, rows in file order.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from labelmill.defaults import NEW_SHEET
from labelmill.functions.text import null_if_token, strip_text
from labelmill.operators.skew import salted_join
from labelmill.sources.staging import Staging

log = logging.getLogger(__name__)

# Up to this many files or splits their table of offsets is broadcast (about 20 MB).
BROADCAST_FILES = 100_000


@dataclass(frozen=True)
class Member:
    """One named part of the samples: a path with its reader options, or a DataFrame.

    ``order_col`` names a unique, non-negative integer column that gives the row order. A
    DataFrame needs one; for files it is optional.
    """

    source: str | Sequence[str] | DataFrame
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    order_col: str | None = None

    def read(self, spark: SparkSession, base: str | None = None) -> DataFrame:
        if isinstance(self.source, DataFrame):
            return self.source
        paths = [self.source] if isinstance(self.source, str) else list(self.source)
        if base:
            paths = [f"{base}/{p}" for p in paths]
        if self.format != "parquet" and not self.order_col:
            spark = _pinned(spark)
        try:
            return spark.read.format(self.format).options(**self.options).load(paths)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(f"no such input: {self.source}") from e
            raise


PLACE = ["member", "sheet", "file", "block"]


def _pinned(spark: SparkSession) -> SparkSession:
    """A session with the same settings, whose scans cut text files alike every time.

    Where splits begin depends on settings and on the number of cores, both of which may change
    between the count of a split's rows and the read of these rows. A scan keeps to the session it was
    made in, and nobody changes this one.
    """
    pinned = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            pinned.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    pinned.conf.set(
        "spark.sql.files.minPartitionNum", spark.conf.get("spark.sql.files.minPartitionNum", None) or cores
    )
    return pinned


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``pos``, their number within the split. A task reads one split after another."""
    last, after = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        file = batch.column("file").dictionary_encode()
        code = file.indices.to_numpy()
        starts = np.flatnonzero((code[1:] != code[:-1]) | (block[1:] != block[:-1])) + 1
        starts = np.concatenate([[0], starts])
        lengths = np.diff(np.append(starts, batch.num_rows))
        pos = np.arange(batch.num_rows) - np.repeat(starts, lengths)
        if (batch.column("file")[0].as_py(), block[0]) == last:
            pos[: lengths[0]] += after
        last, after = (batch.column("file")[-1].as_py(), block[-1]), int(pos[-1]) + 1
        yield batch.append_column("pos", pa.array(pos, pa.int64()))


@dataclass(frozen=True)
class _Scan:
    """``rows`` have PLACE, ``pos`` that rises within a place, input and output; ``spans`` says for each
    place how far ``pos`` goes (span) and how many rows there are (n)."""

    rows: DataFrame
    spans: DataFrame


def _scan(
    df: DataFrame, member: Member, no: int, sheet: Column, input_col: str, output_col: str
) -> _Scan:
    texts = [
        strip_text(F.col(f"`{input_col}`")).alias("input"),
        strip_text(F.col(f"`{output_col}`")).alias("output"),
    ]
    who = [F.lit(no).alias("member"), sheet.alias("sheet")]
    no_block = F.lit(0).cast("long").alias("block")
    if member.order_col:
        pos = F.col(member.order_col).cast("long").alias("pos")
        rows = df.select(*who, F.lit("").alias("file"), no_block, pos, *texts)
        spans = rows.groupBy(*PLACE).agg((F.max("pos") + 1).alias("span"), F.count("*").alias("n"))
        return _Scan(rows, spans.withColumn("outputs", F.lit(0).cast("long")))
    if isinstance(member.source, DataFrame):
        raise ValueError("a DataFrame member needs order_col: its rows have no order of their own")
    file = F.col("_metadata.file_path").alias("file")
    if member.format == "parquet":
        rows = df.select(*who, file, no_block, F.col("_metadata.row_index").alias("pos"), *texts)
        # No column is read for it: the numbers of rows stand in the files' footers.
        places = df.select(*who, file, no_block)
        spans = places.groupBy(*PLACE).agg(F.count("*").alias("span"), F.count("*").alias("n"))
        return _Scan(rows, spans.withColumn("outputs", F.lit(0).cast("long")))
    raw = df.select(*who, file, F.col("_metadata.file_block_start").alias("block"), *texts)
    # Both columns are asked for, since a reader may drop or keep a line by the columns it parses.
    n = F.count("input") + F.count_if(F.col("input").isNull())
    spans = raw.groupBy(*PLACE).agg(n.alias("span"), n.alias("n"), F.count("output").alias("outputs"))
    names = "member int, sheet string, file string, block long, input string, output string"
    return _Scan(raw.mapInArrow(_numbered, f"{names}, pos long"), spans)


def _with_file_table(rows: DataFrame, table: DataFrame, on: list[str], size: int) -> DataFrame:
    """``rows`` with the columns of a table (``on``, n, …) of one row per file or block, n rows
    each. One unsplittable file may hold a third of all rows, hence the salt."""
    if size <= BROADCAST_FILES:
        return rows.join(F.broadcast(table), on)
    key = F.to_json(F.struct(*on))
    total = table.agg(F.sum("n")).first()[0]
    keyed = table.withColumn("key", key)
    joined = salted_join(
        rows.withColumns({"key": key, "row": F.struct(*rows.columns)}).select("key", "row", *on),
        keyed.drop(*on),
        "key",
        "row",
        keyed.select("key", "n"),
        total,
    )
    return joined.select("row.*", *(c for c in table.columns if c not in on))


def usable_members(
    spark: SparkSession,
    members: Mapping[str, Member | str | DataFrame],
    input_col: str = "input",
    output_col: str = "output",
    base: str | None = None,
) -> list[tuple[int, str, Member, DataFrame]]:
    """Number, name, member and rows of those that have both columns; only schemas are read."""
    usable = []
    for no, (name, given) in enumerate(members.items()):
        member = given if isinstance(given, Member) else Member(given)
        df = member.read(spark, base)
        missing = [c for c in (input_col, output_col) if c not in df.columns]
        if missing:
            log.warning("member %r lacks columns %s, skipped", name, missing)
        else:
            usable.append((no, name, member, df))
    return usable


def load_samples(
    spark: SparkSession,
    members: Mapping[str, Member | str | DataFrame],
    input_col: str = "input",
    output_col: str = "output",
    null_tokens: Sequence[str] = (),
    base: str | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """All members that have both columns, projected, cast to string, stripped and united.

    A member without a required column is skipped with a warning; a missing path raises
    ``FileNotFoundError``; no usable member raises ``ValueError``. ``null_tokens`` is for sources
    whose reader should also treat texts such as ``NA`` as missing (``READER_NULL_TOKENS``).
    ``base`` is the folder that member paths are relative to. The number of rows of each file, or of
    each split of a text file, is written down in ``staging``: clear it when nothing reads the
    samples any more. No rows are.
    """
    scans = [
        _scan(df, member, no, F.lit(str(name)), input_col, output_col)
        for no, name, member, df in usable_members(spark, members, input_col, output_col, base)
    ]
    if not scans:
        raise ValueError(f"no member has the columns {input_col!r} and {output_col!r}")
    return _in_order(spark, scans, null_tokens, staging or Staging(spark))


def _in_order(
    spark: SparkSession, scans: list[_Scan], null_tokens: Sequence[str], staging: Staging
) -> DataFrame:
    """The rows of all scans with ``seq``: the span of all places before, and ``pos``."""
    spans = staging.table(reduce(DataFrame.unionByName, (s.spans for s in scans)), "spans")
    # One row for each file, or split of a text file.
    before = W.orderBy(*PLACE).rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("span").over(before), F.lit(0)).alias("start")
    starts = spans.select(*PLACE, start, "n")
    # Scans may be of other sessions; the result is of this one.
    none = spark.createDataFrame([], scans[0].rows.schema)
    rows = reduce(DataFrame.unionByName, (s.rows for s in scans), none)
    if null_tokens:
        rows = rows.withColumns(
            {c: null_if_token(F.col(c), null_tokens) for c in ("input", "output")}
        )
    return _with_file_table(rows, starts, PLACE, spans.count()).select(
        (F.col("start") + F.col("pos")).alias("seq"), "sheet", "input", "output"
    )


def load_folder(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    reader: Mapping[str, str] | None = None,
    input_col: str = "input",
    output_col: str = "output",
    null_tokens: Sequence[str] = (),
    staging: Staging | None = None,
) -> DataFrame:
    """``load_samples`` over the members ``<path>/sheet=<name>/``, in the order of their names.

    The folder is one partitioned data set: members of one schema are read by one scan, in which
    ``sheet`` is the partition column. ``reader`` has options of the format.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        raise FileNotFoundError(f"no such input: {path}")
    names = sorted(
        entry.getPath().getName()
        for entry in fs.listStatus(folder)
        if entry.isDirectory() and entry.getPath().getName().startswith("sheet=")
    )
    options = dict(reader or {})
    members = {name: Member(f"{path}/{name}", format, options) for name in names}
    alike: dict[str, list[str]] = {}
    schemas = {}
    for _, name, _, df in usable_members(spark, members, input_col, output_col):
        columns = StructType([f for f in df.schema.fields if f.name != "sheet"])
        alike.setdefault(columns.json(), []).append(f"{path}/{name}")
        schemas[columns.json()] = columns
    if not alike:
        raise ValueError(f"no member has the columns {input_col!r} and {output_col!r}")
    own = spark if format == "parquet" else _pinned(spark)
    # What the partition column says of a member whose name is missing.
    sheet = F.coalesce(F.col("sheet"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    scans = []
    for key, paths in alike.items():
        schema = StructType([*schemas[key].fields, StructField("sheet", StringType())])
        df = own.read.format(format).options(**options).option("basePath", path).schema(schema)
        member = Member(paths, format, options)
        scans.append(_scan(df.load(paths), member, 0, sheet, input_col, output_col))
    return _in_order(spark, scans, null_tokens, staging or Staging(spark))


def in_member(name: str | None) -> Column:
    """Whether a row is of the member; a row without a member's name is of none."""
    return F.col("sheet").eqNullSafe(F.lit(name)) if name else F.lit(False)


def separate(
    samples: DataFrame, new_sheet: str | None = NEW_SHEET
) -> tuple[DataFrame, DataFrame]:
    """(regular, new): the rows of all other members and those of ``new_sheet``.

    An empty or ``None`` name, or one that no member bears, leaves *new* empty.
    """
    is_new = in_member(new_sheet)
    return samples.where(~is_new), samples.where(is_new)


def load_separated(
    spark: SparkSession,
    members: Mapping[str, Member | str | DataFrame],
    new_sheet: str | None = NEW_SHEET,
    **options: object,
) -> tuple[DataFrame, DataFrame]:
    """(regular, new) straight from the members; no usable regular member is an error."""
    columns = {k: v for k, v in options.items() if k in ("input_col", "output_col", "base")}
    regular = {name: m for name, m in members.items() if not new_sheet or name != new_sheet}
    if not usable_members(spark, regular, **columns):
        raise ValueError("no regular member has the columns of the samples")
    return separate(load_samples(spark, members, **options), new_sheet)


def member_counts(samples: DataFrame) -> DataFrame:
    """Rows per member and in total (``sheet`` NULL)."""
    return samples.rollup("sheet").agg(F.count("*").alias("rows"))
