"""Bounded extracts: by watermark, by chunk, by change sequence; backfill."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.merge import insert_update

CHUNK_DAYS = 30
CHUNK_IDS = 10_000_000


def increment(
    df: DataFrame, columns: Sequence[str], mark: str, low: Column, high: Column | None = None, strict: bool = False
) -> DataFrame:
    """Distinct rows from the low mark on (after it when ``strict``), up to but not including the high mark."""
    rows = df.filter(F.col(mark) > low if strict else F.col(mark) >= low)
    if high is not None:
        rows = rows.filter(F.col(mark) < high)
    return rows.select(*columns).distinct()


def datetime_chunks(low: datetime, high: datetime, days: int = CHUNK_DAYS) -> list[tuple[datetime, datetime]]:
    """Half-open ranges of a fixed length from low until high is covered."""
    out, start = [], low
    while start < high:
        out.append((start, start + timedelta(days=days)))
        start = out[-1][1]
    return out


def integer_chunks(low: int, high: int, size: int = CHUNK_IDS) -> list[tuple[int, int]]:
    return [(start, start + size) for start in range(low, high, size)]


def chunk_predicates(column: str, chunks: Sequence[tuple]) -> list[str]:
    """One WHERE clause per chunk; a JDBC read turns each into a parallel partition."""
    show = lambda v: f"'{v}'" if isinstance(v, datetime) else str(v)
    return [f"{column} >= {show(a)} AND {column} < {show(b)}" for a, b in chunks]


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, chunks: Sequence[tuple], properties: dict[str, str]
) -> DataFrame:
    """Chunked parallel extract; the bounds are pushed to the source database."""
    return spark.read.jdbc(url, table, predicates=chunk_predicates(column, chunks), properties=properties)


def number_chunks(df: DataFrame, column: str, low: Column, size: Column, out: str) -> DataFrame:
    """Chunk number of every row, counted from the low bound."""
    return df.withColumn(out, F.floor((F.col(column) - low) / size))


def change_range(changes: DataFrame, sequence: str, after: Column, upto: Column) -> DataFrame:
    """Change rows after the last sequence read, up to the highest complete one."""
    return changes.filter((F.col(sequence) > after) & (F.col(sequence) <= upto))


def backfill(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    column: str,
    low: Column,
    high: Column,
    delta_cols: Sequence[str],
    run_ts: Column,
) -> DataFrame:
    """Extract a bounded range of one column again and merge it."""
    part = source.filter((F.col(column) >= low) & (F.col(column) < high))
    return insert_update(target, part, keys, delta_cols, run_ts)
