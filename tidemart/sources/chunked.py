"""Landed tables as a partitioned source: ranges of a column as partitions, changes after a sequence as a stream.

``ChunkedTable`` is a data source of Spark's Python interface over Parquet files. A batch read has one partition per chunk of the column (a
number of ids or days); each task reads its range only, row groups outside it are skipped by their statistics, and conditions on the column
narrow the ranges before they are planned. Nulls are a chunk of their own. As a stream the offset is the change sequence: a trigger
reads what came after the last one, in chunks, and a restart goes on from the checkpoint.

Files are read through Arrow, whose file systems know local and shared paths and the common object stores.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

NAME = "tidemart_chunks"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class Chunk(InputPartition):
    """Rows with low <= column < high; ``nulls`` instead: rows without a value."""

    low: object = None
    high: object = None
    nulls: bool = False


def _dataset(path: str):
    import pyarrow.dataset as ds
    import pyarrow.fs as fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        where, path = fs.FileSystem.from_uri(path)
        return ds.dataset(path, filesystem=where, format="parquet", exclude_invalid_files=False)
    return ds.dataset(path, format="parquet")


def _groups(path: str, column: str) -> Iterator[tuple]:
    """Least and greatest value and number of nulls per row group, from the files' footers."""
    for fragment in _dataset(path).get_fragments():
        for group in fragment.row_groups:
            held = (group.statistics or {}).get(column)
            yield (held["min"], held["max"]) if held else (None, None), group.num_rows, fragment.metadata.row_group(group.id)


def bounds(path: str, column: str) -> tuple | None:
    """Least and greatest value of a column; None where there is none."""
    known = [ends for ends, _, _ in _groups(path, column) if ends[0] is not None]
    return (min(e[0] for e in known), max(e[1] for e in known)) if known else None


def _step(value, size: int):
    return value + timedelta(days=size) if isinstance(value, (date, datetime)) else value + size


def chunks_between(low, high, size: int) -> list[Chunk]:
    """Half-open chunks from ``low`` that cover ``high`` too."""
    out = []
    while low is not None and low <= high:
        out.append(Chunk(low, _step(low, size)))
        low = out[-1].high
    return out


def _read(path: str, column: str, chunk: Chunk, names: Sequence[str], kinds) -> Iterator:
    import pyarrow.compute as pc

    field = pc.field(column)
    wanted = field.is_null() if chunk.nulls else (field >= chunk.low) & (field < chunk.high)
    for batch in _dataset(path).to_batches(columns=list(names), filter=wanted):
        if batch.num_rows:
            yield batch.cast(kinds)


class _Options:
    def __init__(self, options: dict, schema: StructType):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.column, self.size = options["path"], options["column"], int(options.get("size", "10000000"))
        self.names, self.kinds = schema.names, to_arrow_schema(schema)
        self.low = self.high = None

    def read(self, partition: Chunk) -> Iterator:
        return _read(self.path, self.column, partition, self.names, self.kinds)


class ChunkReader(_Options, DataSourceReader):
    def partitions(self) -> Sequence[Chunk]:
        found = bounds(self.path, self.column)
        chunks = [] if found is None else chunks_between(max([found[0], *[x for x in [self.low] if x is not None]]), min([found[1], *[x for x in [self.high] if x is not None]]), self.size)
        if found is not None and self.low is None and self.high is None:
            chunks.append(Chunk(nulls=True))
        return chunks or [Chunk(nulls=True)]


class PushingReader(ChunkReader):
    """Where the session lets Python sources see conditions: those on the column bound the chunks; Spark checks all of them again."""

    def pushFilters(self, filters):  # noqa: N802  the interface's name
        from pyspark.sql import datasource as d

        for f in filters:
            if getattr(f, "attribute", None) == (self.column,):
                if isinstance(f, (d.GreaterThan, d.GreaterThanOrEqual, d.EqualTo)):
                    self.low = f.value if self.low is None else max(self.low, f.value)
                if isinstance(f, (d.LessThan, d.LessThanOrEqual, d.EqualTo)):
                    self.high = f.value if self.high is None else min(self.high, f.value)
            yield f


class SequenceReader(_Options, DataSourceStreamReader):
    """Offsets are the last sequence read; -1 before the first."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"sequence": -1}

    def latestOffset(self) -> dict:  # noqa: N802
        found = bounds(self.path, self.column)
        return {"sequence": -1 if found is None else found[1]}

    def partitions(self, start: dict, end: dict) -> Sequence[Chunk]:
        whole = chunks_between(start["sequence"] + 1, end["sequence"], self.size)
        if whole:
            whole[-1].high = end["sequence"] + 1
        return whole

    def commit(self, end: dict) -> None:
        """The checkpoint holds the offset; the files stay."""


class ChunkedTable(DataSource):
    """Options: path, column, size (ids or days per chunk), push."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        return from_arrow_schema(_dataset(self.options["path"]).schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = PushingReader if self.options.get("push") == "true" else ChunkReader
        return kind(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return SequenceReader(self.options, schema)


def read_chunked(spark: SparkSession, path: str, column: str, size: int, schema: StructType | None = None) -> DataFrame:
    """A landed table, one partition per chunk of an integer, date or timestamp column."""
    spark.dataSource.register(ChunkedTable)
    push = str(spark.conf.get(PUSHDOWN, "false")).lower()
    reader = spark.read.format(NAME).option("path", path).option("column", column).option("size", str(size)).option("push", push)
    return (reader.schema(schema) if schema else reader).load()


def stream_changes(spark: SparkSession, path: str, sequence: str, size: int, schema: StructType) -> DataFrame:
    """Changes of a landed table as a stream, by a sequence that only grows."""
    spark.dataSource.register(ChunkedTable)
    reader = spark.readStream.format(NAME).option("path", path).option("column", sequence).option("size", str(size))
    return reader.schema(schema).load()


def land_changes(changes: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what is new; each change arrives once, restarts included."""
    writer = changes.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
