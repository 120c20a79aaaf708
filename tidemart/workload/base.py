"""Registration of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import load, scratch_path, stored


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return plain(self.build(Tables(spark, folder)))


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Entry(name, build, sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every client reads alike: long, double, text, boolean."""

    def simple(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("long").alias(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(f.name)
        return c

    return df.select(*[simple(f) for f in df.schema.fields])


class Tables:
    """The provided tables and a few frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load(self.spark, self.folder, name)

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        """A frame written as a table and read back, as the target of a run before."""
        return stored(df, self.scratch(label))

    def sales(self) -> DataFrame:
        """Order lines with their order's customer, dates and exact amounts."""
        orders = self.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
        return self.lines().join(orders, F.col("orderkey") == F.col("o_orderkey")).select(
            "orderkey", F.col("o_custkey").alias("custkey"), F.col("o_orderdate").alias("order_date"),
            F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
            "partkey", "suppkey", "linenumber", "ship_date", "returnflag", "qty", "gross", "net",
        )

    def lines(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_orderkey").alias("orderkey"),
            F.col("l_partkey").alias("partkey"),
            F.col("l_suppkey").alias("suppkey"),
            F.col("l_linenumber").alias("linenumber"),
            F.col("l_shipdate").alias("ship_date"),
            F.col("l_returnflag").alias("returnflag"),
            F.col("l_quantity").cast("long").alias("qty"),
            money("l_extendedprice").alias("gross"),
            net_price().alias("net"),
        )


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def net_price():
    return (F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast(
        "decimal(18,4)"
    )


def when(text: str):
    return F.lit(text).cast("timestamp_ntz")


def month(c):
    return F.to_date(F.date_trunc("month", F.col(c) if isinstance(c, str) else c))


# The same derived inputs as SQL, for the comparison statements.
SQL_LINES = """(SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey, l_linenumber AS linenumber,
  l_shipdate AS ship_date, l_returnflag AS returnflag, CAST(l_quantity AS BIGINT) AS qty,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net
  FROM lineitem)"""
SQL_SALES = f"""(SELECT l.*, o_custkey AS custkey, o_orderdate AS order_date, o_orderpriority AS priority,
  o_orderstatus AS status FROM {SQL_LINES} l JOIN orders ON orderkey = o_orderkey)"""
