"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import load, scratch_path

# Words are maximal runs of characters other than space, tab, line feed, vertical tab, form feed and return.
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_BLANK = {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}
_TO_LOWER = {ord(a): b for a, b in zip(UPPER, LOWER, strict=True)}


def words_column(text: Column) -> Column:
    """The words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: str | None) -> list[str]:
    """The same words in Python."""
    if not text:
        return []
    return [w for w in text.translate(_TO_BLANK).split(" ") if w]


def lower_words(text: str | None) -> list[str]:
    return split_words(text.translate(_TO_LOWER)) if text else []


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed."""
    return F.element_at(F.transform(F.array(value), body), 1)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back; cuts the lineage.

    The file survives lost executors, so later stages never recompute what is above it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so what tasks have worked out is there for the next task.

    Only for caches: nothing may depend on what it holds. A worker holds one store at a time: asking for another one empties
    it, so the stages of a pipeline do not add up.
    """
    import sys
    import types

    held = sys.modules.setdefault("_worker_store", types.ModuleType("_worker_store")).__dict__
    if held.get("held") != name:
        held.get("store", {}).clear()
        held.update(held=name, store={})
    return held["store"]


def wrapped(docs: DataFrame, *plain: str) -> DataFrame:
    """The named columns, and all others in one struct ``_rest``: whatever they are called, they clash with nothing."""
    rest = [quoted(c) for c in docs.columns if c not in plain]
    return docs.select(*plain, F.struct(*(rest or [F.lit(None).cast("int").alias("_none")])).alias("_rest"))


def with_fields(schema: T.StructType, **kinds: T.DataType) -> T.StructType:
    """A schema with further fields at its end; whatever its columns are called, nothing is spelled out and parsed."""
    return T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in kinds.items()]])


def quoted(name: str) -> Column:
    """A top-level column of any name."""
    return F.col("`" + name.replace("`", "``") + "`")


def unwrapped(df: DataFrame, columns: list[str], **plain: Column) -> DataFrame:
    """The columns of a wrapped table in their own order; ``plain`` gives those outside the struct."""
    return df.select(*[(plain[c] if c in plain else F.col("_rest").getField(c)).alias(c) for c in columns])
