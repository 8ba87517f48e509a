"""A cache of encoded texts as a table that is changed by whole versions.

Vectors lie in version folders, each bucketed and sorted by ``text_key`` into the same number of
buckets, so a look-up shuffles the texts asked for and reads each bucket where it is. A commit file names
the versions that count; it is written beside and renamed into place last. What fails before that
leaves only folders that no commit names. Versions have no text in common.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "text_key string, embedding array<float>"
# Texts of a bucket, about, when a cache is begun, and the limits of the number of buckets.
BUCKET_TEXTS = 200_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 8192
# More versions are merged into one.
MOST_VERSIONS = 8


def buckets_for(texts: int) -> int:
    """A power of two, for a cache that begins with so many texts."""
    wanted = max(1, -(-texts // BUCKET_TEXTS))
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (wanted - 1).bit_length()))


@dataclass(frozen=True)
class Commit:
    number: int
    buckets: int
    versions: tuple[str, ...]


class VectorCache:
    """The vectors of one encoder below ``path``."""

    def __init__(self, spark: SparkSession, path: str, encoder_id: str) -> None:
        self.spark, self.root = spark, f"{path}/encoder={encoder_id}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def commit(self) -> Commit | None:
        """The last commit, or None where there is no cache yet."""
        folder = self._path(f"{self.root}/_commits")
        if not self._fs.exists(folder):
            return None
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        numbers = [int(n) for n in names if n.isdigit()]
        if not numbers:
            return None
        file = self._fs.open(self._path(f"{self.root}/_commits/{max(numbers):010d}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()
        buckets, *versions = text.split()
        return Commit(max(numbers), int(buckets), tuple(versions))

    def tables(self, commit: Commit | None) -> list[DataFrame]:
        """Each version's (text_key, embedding), known to be bucketed by the key."""
        return [self._table(v, commit.buckets) for v in commit.versions] if commit else []

    def _table(self, version: str, buckets: int) -> DataFrame:
        # Only a catalogue entry tells the reader of the buckets; the rows stay when it goes.
        name = f"labelmill_{uuid.uuid4().hex}"
        self.spark.sql(
            f"create table {name} ({SCHEMA}) using parquet clustered by (text_key) sorted by"
            f" (text_key) into {buckets} buckets location '{self.root}/{version}'"
        )
        try:
            table = self.spark.table(name)
            table.schema  # noqa: B018 - looked up now, while the entry is there
            return table
        finally:
            self.spark.sql(f"drop table {name}")

    def write(self, vectors: DataFrame, buckets: int) -> str | None:
        """A version that no commit names yet; None if there is no vector to write.

        A task should hold texts of one bucket, as after ``repartition(buckets, "text_key")``.
        """
        version, name = f"version-{uuid.uuid4().hex}", f"labelmill_{uuid.uuid4().hex}"
        writer = vectors.select("text_key", "embedding").write.format("parquet")
        writer = writer.bucketBy(buckets, "text_key").sortBy("text_key")
        try:
            writer.option("path", f"{self.root}/{version}").saveAsTable(name)
        finally:
            self.spark.sql(f"drop table if exists {name}")
        return None if self._table(version, buckets).isEmpty() else version

    def add(self, version: str, seen: Commit | None, buckets: int, *, alone: bool = False) -> Commit:
        """Commit a version written on top of ``seen``; ``alone`` leaves all others out.

        If another run has committed meanwhile, the texts that it has are taken out of ours first.
        """
        while True:
            last = self.commit()
            if last is None or alone:
                versions = (version,)
            else:
                news = [v for v in last.versions if not seen or v not in seen.versions]
                if last.buckets != buckets or news:
                    version = self._without(version, buckets, news, last.buckets)
                    buckets, seen = last.buckets, last
                versions = (*last.versions, *([version] if version else []))
                if len(versions) > MOST_VERSIONS:
                    versions = (self._merged(versions, buckets),)
            commit = Commit(last.number + 1 if last else 0, buckets, versions)
            if self._put(commit):
                return commit

    def _without(self, version: str, buckets: int, others: list[str], new: int) -> str | None:
        rows = self._table(version, buckets)
        for other in others:
            rows = rows.join(self._table(other, new).select("text_key"), "text_key", "left_anti")
        return self.write(rows.repartition(new, "text_key"), new)

    def _merged(self, versions: tuple[str, ...], buckets: int) -> str:
        rows = reduce(DataFrame.unionByName, (self._table(v, buckets) for v in versions))
        return self.write(rows.repartition(buckets, "text_key"), buckets)

    def _put(self, commit: Commit) -> bool:
        """Whether the commit is the first of its number. The rename makes it count, all at once."""
        target = self._path(f"{self.root}/_commits/{commit.number:010d}")
        beside = self._path(f"{self.root}/_commits/_{uuid.uuid4().hex}")
        out = self._fs.create(beside, False)
        try:
            out.writeBytes("\n".join([str(commit.buckets), *commit.versions]))
        finally:
            out.close()
        if self._fs.exists(target) or not self._fs.rename(beside, target):
            self._fs.delete(beside, False)
            return False
        return True

    def vacuum(self) -> None:
        """Delete folders that the last commit does not name. Nobody may be reading or writing."""
        last = self.commit()
        if not self._fs.exists(self._path(self.root)):
            return
        for status in self._fs.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            if name.startswith("version-") and (last is None or name not in last.versions):
                self._fs.delete(status.getPath(), True)
