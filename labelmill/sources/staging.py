"""Tables written to the cluster's shared folder to cut lineage and avoid recomputation."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


# Bytes of rows that a Python worker is sent at a time where rows are large.
BATCH_BYTES = "4m"
# Pages are closed by size after each row, not after a hundred: a reader holds a page.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession) -> AbstractContextManager:
    """What is run inside sends small batches to the Python workers; both sides hold a batch."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def one_by_one(spark: SparkSession) -> AbstractContextManager:
    """What is run inside reads Parquet files of few, large rows without holding several of them."""
    return _setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "1")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="labelmill-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a session in one process, whose driver and tasks share the disk, may go without.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


class Staging:
    """One run's staged tables: written once as Parquet, read back with column pruning.

    A context manager clears its tables at the end, also after an error.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/labelmill/{uuid.uuid4().hex}"

    def part(self) -> Staging:
        """A folder of its own inside this one, cleared with it."""
        inner = Staging(self.spark)
        inner.root = f"{self.root}/{uuid.uuid4().hex}"
        return inner

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.clear()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
        df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete one table that nothing reads any more."""
        self._delete(self.path(name))

    def clear(self) -> None:
        """Delete this run's tables; call it once nothing reads them any more."""
        self._delete(self.root)

    def _delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


