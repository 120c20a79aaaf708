"""File sources: delimited, JSON, XML; file metadata, error tolerance, load ledger."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class CsvFormat:
    delimiter: str = ","
    record_delimiter: str | None = None
    header_rows: int = 0
    null_if: str = ""
    timestamp_format: str | None = None
    date_format: str | None = None

    def options(self) -> dict[str, str]:
        out = {
            "sep": self.delimiter,
            "quote": '"',
            "escape": '"',
            "header": str(self.header_rows > 0).lower(),
            "nullValue": self.null_if,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT,
            "enforceSchema": "true",
        }
        if self.record_delimiter:
            out["lineSep"] = self.record_delimiter
        if self.timestamp_format:
            out["timestampFormat"] = self.timestamp_format
            out["timestampNTZFormat"] = self.timestamp_format
        if self.date_format:
            out["dateFormat"] = self.date_format
        return out


def _with_corrupt(schema: T.StructType | str) -> T.StructType:
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])


def file_columns(run_ts: Column) -> list[Column]:
    """Source file and load time of every row."""
    return [F.col("_metadata.file_path").alias("meta_file_name"), run_ts.alias("meta_create_datetime")]


def read_csv(spark: SparkSession, path: str | list[str], schema, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """Delimited files with a declared schema; a bad row keeps its text in ``_corrupt_record``."""
    return spark.read.schema(_with_corrupt(schema)).options(**fmt.options()).csv(path)


def _key_is(name: str):
    return lambda entry: F.lower(entry["key"]) == F.lit(name)


def read_json(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    """JSON lines matched to the declared columns by name without regard to case.

    A line that is no JSON object, or a value that does not fit its type, keeps the line in ``_corrupt_record``.
    """
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    entries = F.map_entries(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}))
    parsed = spark.read.text(path).withColumn("_entries", entries)
    texts, values = [], []
    for f in declared.fields:
        text = F.get(F.filter("_entries", _key_is(f.name.lower())), F.lit(0))["value"]
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        texts.append(text)
        values.append(F.from_json(text, f.dataType) if nested else text.try_cast(f.dataType))
    misfit = reduce(lambda x, y: x | y, [t.isNotNull() & v.isNull() for t, v in zip(texts, values)])
    return parsed.select(
        *[v.alias(f.name) for f, v in zip(declared.fields, values)],
        F.when(F.col("_entries").isNull() | misfit, F.col("value")).alias(CORRUPT),
    )


def stage_rows(rows: DataFrame, run_ts: Column, path: str) -> DataFrame:
    """Parsed rows with their file columns, written once as the stage table of a load.

    Whether a row is bad shows only when all its columns are parsed, so the parse must not be repeated on fewer.
    """
    rows.select("*", *file_columns(run_ts)).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def clean_rows(staged: DataFrame, skip_pct: float) -> DataFrame:
    """Good rows of the files whose share of bad rows does not exceed ``skip_pct``; worse files are left out whole."""
    worse = file_report(staged).filter(F.col("rows_bad") * 100 > F.col("rows_parsed") * F.lit(skip_pct))
    kept = staged.join(worse.select("meta_file_name"), "meta_file_name", "left_anti")
    return kept.filter(F.col(CORRUPT).isNull()).select(*[c for c in staged.columns if c != CORRUPT])


def file_report(staged: DataFrame) -> DataFrame:
    """Rows parsed and rows bad per file."""
    return staged.groupBy("meta_file_name").agg(
        F.count(F.lit(1)).alias("rows_parsed"), F.count_if(F.col(CORRUPT).isNotNull()).alias("rows_bad")
    )


class LoadFailed(RuntimeError):
    """A file of a load did not meet its tolerance."""


def check_load(report: DataFrame, skip_pct: float) -> dict[str, int]:
    """Totals of a load from the per-file report; raises when any file failed. No file at all is only a warning."""
    totals = report.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("rows_parsed"), F.lit(0)).alias("rows_parsed"),
        F.coalesce(F.sum(F.col("rows_parsed") - F.col("rows_bad")), F.lit(0)).alias("rows_loaded"),
        F.count_if(F.col("rows_bad") * 100 > F.col("rows_parsed") * F.lit(skip_pct)).alias("files_failed"),
    ).first()
    out = totals.asDict() | {"warning": "no file" if totals["files"] == 0 else ""}
    if totals["files_failed"]:
        raise LoadFailed(f"{totals['files_failed']} of {totals['files']} files failed")
    return out


def unloaded(rows: DataFrame, ledger: DataFrame | None, force: bool = False) -> DataFrame:
    """Rows of files that are not in the ledger of loaded files yet."""
    if ledger is None or force:
        return rows
    return rows.join(ledger.select("meta_file_name"), "meta_file_name", "left_anti")


def copy_table(rows: DataFrame, run_ts: Column, path: str) -> None:
    """Append-only copy with the load time."""
    rows.withColumn("meta_create_datetime", run_ts).write.mode("append").parquet(path)


def raw_json_folders(spark: SparkSession, folders: Sequence[str], run_ts: Column) -> DataFrame:
    """JSON of several folders whose fields may differ: one frame with all fields, absent ones NULL."""
    frames = [spark.read.json(f).select("*", *file_columns(run_ts)) for f in folders]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_select(raw: DataFrame, **columns: str) -> DataFrame:
    """Load through a select list: target column = SQL expression over the raw columns."""
    return raw.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def fixed_columns(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Declared columns in declared order: missing ones NULL, extra ones dropped."""
    return raw.select(
        *[F.col(c).cast(t).alias(c) if c in raw.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()]
    )


def join_sheets(sheets: dict[str, DataFrame], entity: str) -> DataFrame:
    """One row per entity with the metric column of every sheet, whichever sheets know the entity."""
    named = [df.select(entity, F.col(df.columns[-1]).alias(name)) for name, df in sheets.items()]
    return reduce(lambda a, b: a.join(b, entity, "full"), named)


def parse_xml(df: DataFrame, column: str, schema: str, out: str) -> DataFrame:
    """XML document column as a nested struct."""
    return df.withColumn(out, F.from_xml(F.col(column), schema, {"mode": "PERMISSIVE"}))


def explode_path(df: DataFrame, *paths: tuple[str, str]) -> DataFrame:
    """Follow nested lists level by level: each ``(list path, alias)`` becomes one row per element."""
    for path, alias in paths:
        df = df.select("*", F.explode_outer(path).alias(alias))
    return df


def arrow_types(declared: dict[str, str]) -> T.StructType:
    """Spark schema from warehouse type names."""
    return T.StructType([T.StructField(c, warehouse_type(t)) for c, t in declared.items()])


# Warehouse type name to Spark type.
WAREHOUSE_TYPES = {
    "INT": T.LongType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(),
    "VARCHAR": T.StringType(), "STRING": T.StringType(), "TEXT": T.StringType(), "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(), "TIMESTAMP_NTZ": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP_LTZ": T.TimestampType(), "TIMESTAMP_TZ": T.TimestampType(), "TIME": T.StringType(),
    "BINARY": T.BinaryType(), "VARIANT": T.VariantType(),
}


def warehouse_type(name: str) -> T.DataType:
    base, _, rest = name.upper().strip().partition("(")
    if base in ("NUMBER", "DECIMAL", "NUMERIC"):
        digits = [int(x) for x in rest.rstrip(")").split(",")] if rest else [38, 0]
        precision, scale = digits[0], digits[1] if len(digits) > 1 else 0
        return T.LongType() if scale == 0 and precision in (38, 18) else T.DecimalType(precision, scale)
    return WAREHOUSE_TYPES[base]


def write_parquet(df: DataFrame, declared: dict[str, str], path: str, batch_rows: int = 0) -> None:
    """Parquet in the declared schema, files bounded by a row count where one is given."""
    schema = arrow_types(declared)
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    writer = typed.write.mode("overwrite")
    if batch_rows:
        writer = writer.option("maxRecordsPerFile", batch_rows)
    writer.parquet(path)
