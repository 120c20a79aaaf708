"""Mutable tables: numbered directories of immutable Parquet files, or buckets that merges rewrite one by one.

A version counts once Spark's own ``_SUCCESS`` marker is there, so a failed job never becomes visible and earlier
versions stay readable. One writer per table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import input_bytes, settle


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str

    def versions(self) -> list[int]:
        """Numbers of the complete versions, oldest first; works on any file system Spark reaches."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        root = hadoop(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("v=") and fs.exists(hadoop(status.getPath(), "_SUCCESS")):
                found.append(int(name[2:]))
        return sorted(found)

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, back: int = 0) -> DataFrame:
        """The current version, or the one ``back`` publications ago."""
        return self.spark.read.parquet(f"{self.path}/v={self.versions()[-1 - back]}")

    def publish(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write the next version; readers see it when the write has committed."""
        number = (self.versions() or [0])[-1] + 1
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/v={number}")
        return number

    def drop_old(self, keep: int) -> None:
        """Delete all but the newest ``keep`` versions; no reader may still hold one of them."""
        for number in self.versions()[: -max(1, keep)]:
            _delete(self.spark, f"{self.path}/v={number}")


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


BUCKET = "_bucket"
BUCKET_BYTES = 256 << 20
# Bounds the list of touched buckets, which reaches the driver.
MOST_BUCKETS = 20_000


@dataclass(frozen=True)
class BucketedTable:
    """A merge target as Parquet, partitioned by a hash of its key: a merge reads and rewrites only the buckets its source touches.

    Spark's dynamic partition overwrite stages the new files and swaps them in when the job commits; files of other buckets stay. One
    writer per table. The number of buckets is fixed when the table is made: it bounds both the list of touched buckets and the
    size of what a small source rewrites; ``sized`` lets it follow the rows. A bucket is written by as many tasks as its size needs
    (Spark rebalances by size), so none of them is one task's.

    With ``width`` the buckets are ranges of so many numbers of the first key, an integer, instead: where changes cluster on recent
    numbers, a merge touches the last ranges only. A null key stands in bucket -1.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    buckets: int = 64
    width: int | None = None

    @classmethod
    def sized(cls, spark: SparkSession, path: str, keys: Sequence[str], first: DataFrame) -> BucketedTable:
        """A table with a bucket per ``BUCKET_BYTES`` of what it will hold, by Catalyst's estimate of the first load."""
        wanted = input_bytes(first) // BUCKET_BYTES
        return cls(spark, path, keys, int(min(MOST_BUCKETS, max(16, wanted))))

    def bucket(self) -> Column:
        if self.width:
            return F.coalesce(F.call_function("div", F.col(self.keys[0]).cast("long"), F.lit(self.width).cast("long")), F.lit(-1))
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        """A dynamic overwrite moves bucket folders in on commit, and writes no marker of its own."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.exists(root) and any(s.getPath().getName().startswith(f"{BUCKET}=") for s in fs.listStatus(root))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def touched_by(self, source: DataFrame) -> list[int]:
        """Buckets that the keys of ``source`` fall into, at most ``MOST_BUCKETS``."""
        return self.listed(source.select(self.bucket()))

    def listed(self, numbers: DataFrame) -> list[int]:
        """The distinct bucket numbers in a frame's only column."""
        found = numbers.distinct().limit(MOST_BUCKETS + 1).collect()
        if len(found) > MOST_BUCKETS:
            raise ValueError(f"more than {MOST_BUCKETS} buckets touched: choose a greater width")
        return sorted(r[0] for r in found)

    def read_touched(self, source: DataFrame) -> DataFrame:
        """The rows of the buckets that the keys of ``source`` fall into; the others are not read."""
        touched = self.touched_by(source)
        return self.spark.read.parquet(self.path).where(F.col(BUCKET).isin(touched) if touched else F.lit(False)).drop(BUCKET)

    def _write(self, df: DataFrame) -> None:
        placed = df.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def merge(
        self,
        source: DataFrame,
        apply: Callable[[DataFrame | None, DataFrame], DataFrame],
        deletes: bool = False,
        touched: list[int] | None = None,
    ) -> list[int]:
        """Replace the touched buckets by ``apply(their rows, source)``; gives the numbers of these buckets (all at the first load).

        ``deletes``: the merge may remove rows. A bucket left without rows writes no file, so its folder has to go. ``touched``: the only
        buckets in which the merge changes anything, where the caller knows them; ``apply`` then gets the source rows of these.
        """
        if not self.exists():
            touched = self.touched_by(source) if self.width else list(range(self.buckets))
            self._write(apply(None, source))
            return touched
        if touched is None:
            touched = self.touched_by(source)
        else:
            source = source.where(self.bucket().isin(touched) if touched else F.lit(False))
        if not touched:
            return []
        part = self.spark.read.parquet(self.path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        new = apply(part, source)
        if deletes:
            new = settle(new)
            filled = {r[0] for r in new.select(self.bucket()).distinct().collect()}
            self._write(new)
            for number in set(touched) - filled:
                _delete(self.spark, f"{self.path}/{BUCKET}={number}")
        else:
            self._write(new)
        return touched
