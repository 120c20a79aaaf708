"""File sinks: delimited feeds, parts, one file per key, table backups."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys
from tidemart.operators.merge import delete_where

# Fixed values of the feed: rows and bytes of a part.
FEED_PART_ROWS = 500_000
FEED_PART_BYTES = 150 * 1024 * 1024
# Up to so many parts are a task each; of more parts a task writes this many. Files renamed at a time.
FEW_PARTS = 64
TASK_PARTS = 64
RENAMES = 16


def write_delimited(
    df: DataFrame,
    path: str,
    delimiter: str = ",",
    header: bool = True,
    gzip: bool = False,
    quote_all: bool = False,
    lower_names: bool = True,
    part_rows: int = 0,
    partition_by: Sequence[str] = (),
    order: Sequence[Column | str] = (),
) -> None:
    """Delimited files written by the executors in parallel."""
    out = df.toDF(*[c.lower() for c in df.columns]) if lower_names else df
    if order:
        out = out.sortWithinPartitions(*order)
    writer = (
        out.write.mode("overwrite")
        .option("sep", delimiter)
        .option("header", str(header).lower())
        .option("quoteAll", str(quote_all).lower())
        .option("escape", '"')
    )
    if gzip:
        writer = writer.option("compression", "gzip")
    if part_rows:
        writer = writer.option("maxRecordsPerFile", part_rows)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_feed(
    df: DataFrame, path: str, name: str = "feed", part_rows: int = FEED_PART_ROWS, part_bytes: int = FEED_PART_BYTES
) -> list[str]:
    """Pipe-delimited feed in numbered parts (``name-000.csv`` ...) of bounded rows and bytes; a single part has no number.

    Rows and text size are measured first and dealt evenly to tasks, each of which writes up to ``TASK_PARTS`` parts one after the other, so
    their number does not follow that of the parts. Should a part still be too large, the feed is written again in more parts.
    """
    size = reduce(lambda a, b: a + b, [F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 1 for c in df.columns])
    whole = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    room = max(1, part_bytes - sum(len(c) + 1 for c in df.columns))
    parts = max(1, -(-whole.n // part_rows), -(-whole.bytes // room))
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    # Parts of like size differ a little; where there are many, one of them would be too large, and all would be written twice.
    parts = -(-parts * 21 // 20) if parts > FEW_PARTS else parts
    while True:
        if parts > FEW_PARTS:
            # Long rows often stand together, so a task mixes its own; else the parts of those would be too large.
            mixed, tasks = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])], max(FEW_PARTS, -(-parts // TASK_PARTS))
            write_delimited(df.repartition(tasks), path, delimiter="|", part_rows=max(1, min(part_rows, whole.n // parts)), order=mixed)
        else:
            write_delimited(df.repartition(parts), path, delimiter="|", part_rows=part_rows)
        files = sorted((p.getName(), f.getLen()) for f in fs.listStatus(hadoop(path)) if (p := f.getPath()).getName().startswith("part-"))
        if all(length <= part_bytes for _, length in files) or parts >= whole.n:
            break
        parts *= 2
    names = [f"{name}.csv"] if len(files) == 1 else [f"{name}-{i:03}.csv" for i in range(len(files))]
    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(lambda pair: fs.rename(hadoop(path, pair[0][0]), hadoop(path, pair[1])), zip(files, names, strict=True)))
    return names


def write_per_key(df: DataFrame, path: str, key: str, part_rows: int = FEED_PART_ROWS) -> None:
    """One file per batch key value, in a folder of its own; the key stays a column of the file.

    A key above ``part_rows`` rows is dealt to as many files as it needs, so a large key is never one task.
    """
    files = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(part_rows)).alias("_files"))
    dealt = join_keys(df, files, [key]).withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_files")))
    placed = dealt.withColumn("_key", F.col(key)).repartition("_key", "_part").drop("_files", "_part")
    write_delimited(placed, path, partition_by=["_key"])


def backup(df: DataFrame, path: str, fmt: str, where: Column | None = None, delete: bool = False) -> DataFrame:
    """Copy the selected rows as csv, json or parquet; returns the rows that stay in the table."""
    chosen = df.filter(where) if where is not None else df
    writer = chosen.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    writer.format(fmt).save(path)
    if not delete:
        return df
    return delete_where(df, where) if where is not None else df.filter(F.lit(False))
