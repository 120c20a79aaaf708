"""Structured Streaming forms of the continuous loads; each gives the rows of its batch form."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.merge import insert_update
from tidemart.sources.tables import BucketedTable, VersionedTable


def ingest_json(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Continuous file ingest: each line as one raw JSON column with its file name; runs until no file is left."""
    raw = spark.readStream.format("text").load(folder)
    rows = raw.select(
        F.col("value").alias("raw_json"),
        F.try_parse_json("value").alias("document"),
        F.col("_metadata.file_path").alias("meta_file_name"),
    )
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_stream(
    stream: DataFrame,
    table: BucketedTable,
    keys: Sequence[str],
    delta_cols: Sequence[str],
    checkpoint: str,
    run_ts: str,
    select: Callable[[DataFrame], DataFrame] = lambda df: df,
    tie: Sequence[str] = (),
) -> StreamingQuery:
    """Micro-batches merged into a table, each rewriting the buckets of its keys only.

    Repeating a batch changes nothing, since a merge needs a newer version.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        now = F.lit(run_ts).cast("timestamp_ntz")
        table.merge(select(batch), lambda target, source: insert_update(target, source, keys, delta_cols, now, tie))

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_view(
    stream: DataFrame, table: VersionedTable, compute: Callable[[], DataFrame], checkpoint: str, lag: str | None = None
) -> StreamingQuery:
    """Materialised result recomputed when its source has news: every ``lag``, or once over what is available."""

    def refresh(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            table.publish(compute())

    writer = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=lag) if lag else writer.trigger(availableNow=True)).start()


def slot_totals(
    stream: DataFrame, ts: str, keys: Sequence[str], amount: str, minutes: int = 30, late: str = "10 minutes"
) -> DataFrame:
    """Totals per fixed slot, for a batch or a stream. A stream closes a slot once events are later than ``late``."""
    source = stream.withWatermark(ts, late) if stream.isStreaming else stream
    totals = source.groupBy(F.window(ts, f"{minutes} minutes").alias("slot"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total")
    )
    return totals.select(F.col("slot.start").alias("slot_start"), *keys, "n", "total")


def write_slots(totals: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return (
        totals.writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
