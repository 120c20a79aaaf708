"""Pivots, unpivots, rows from texts and objects, exact ranks on large groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.semantics import join_keys
from tidemart.operators.scan import Scan, ordered_scan
from tidemart.session import reused

def pivot_sum(df: DataFrame, grain: Sequence[str], column: str, values: Sequence[str], amount: str) -> DataFrame:
    """One summed column per listed value, named by the value; missing combinations are NULL."""
    return df.groupBy(*grain).pivot(column, list(values)).agg(F.sum(amount))


def pivot_all(df: DataFrame, grain: Sequence[str], column: str, amount: str, max_columns: int = 1000) -> DataFrame:
    """One column per key found, holding the least value.

    The key list is read first. A table cannot have any number of columns: above ``max_columns`` keys the call fails, and
    ``pivot_map`` gives the same content for any number of keys.
    """
    keys = [r[0] for r in df.select(column).distinct().orderBy(column).limit(max_columns + 1).collect()]
    if len(keys) > max_columns:
        raise ValueError(f"more than {max_columns} keys to pivot")
    return df.groupBy(*grain).pivot(column, keys).agg(F.min(amount))


def pivot_map(df: DataFrame, grain: Sequence[str], column: str, amount: str, out: str) -> DataFrame:
    """The pivot as one map per grain from key to least value, for any number of keys; a NULL key has no entry."""
    least = df.filter(F.col(column).isNotNull()).groupBy(*grain, column).agg(F.min(amount).alias("_v"))
    return least.groupBy(*grain).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(column, "_v")))).alias(out))


def unpivot(df: DataFrame, grain: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows; NULL values give no row."""
    return df.unpivot(list(grain), list(columns), name, value).filter(F.col(value).isNotNull())


def split_rows(df: DataFrame, column: str, delimiter: str, out: str, index: str = "part_index") -> DataFrame:
    """One row per part of a delimited text, with its 1-based place."""
    pattern = "\\Q" + delimiter + "\\E"
    return df.select("*", F.posexplode(F.split(F.col(column), pattern)).alias(index, out)).withColumn(
        index, F.col(index) + 1
    )


def url_parameters(df: DataFrame, column: str) -> DataFrame:
    """One row per query parameter of a URL; of a repeated parameter the last value counts."""
    query = F.regexp_extract(F.col(column), r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    exploded = df.select("*", F.posexplode(pairs).alias("_pos", "_pair"))
    parsed = exploded.select(
        *df.columns,
        "_pos",
        F.substring_index("_pair", "=", 1).alias("parameter"),
        F.when(F.instr("_pair", "=") > 0, F.expr("substring(_pair, instr(_pair, '=') + 1)")).alias("parameter_value"),
    )
    return parsed.groupBy(*df.columns, "parameter").agg(
        F.max_by("parameter_value", "_pos").alias("parameter_value")
    )


def struct_leaves(schema: T.StructType, prefix: str = "", path: str = "") -> list[tuple[str, str]]:
    """(path, flat name) of every leaf of a nested schema; names joined by '_' in upper case."""
    out = []
    for f in schema.fields:
        flat = f"{prefix}_{f.name}" if prefix else f.name
        flat = "".join(ch if ch.isalnum() else "_" for ch in flat).upper()
        where = f"{path}.`{f.name}`" if path else f"`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            out += struct_leaves(f.dataType, flat, where)
        else:
            out.append((where, flat))
    return out


def flatten_object(
    df: DataFrame, column: str, exploded: str = "PROPERTIES_PRODUCTS", position: str | None = None
) -> DataFrame:
    """Nested object as flat columns; the one named list of objects becomes rows, other lists stay lists.

    ``position`` names a column for the place in the list (0 where there is no list).
    """
    others = [c for c in df.columns if c != column]
    leaves = struct_leaves(df.schema[column].dataType, "", f"`{column}`")
    flat = df.select(*others, *[F.col(path).alias(name) for path, name in leaves])
    if exploded not in flat.columns:
        return flat.withColumn(position, F.lit(0)) if position else flat
    rest = [c for c in flat.columns if c != exploded]
    rows = flat.select(*rest, F.posexplode_outer(exploded).alias("_place", exploded))
    place = F.coalesce("_place", F.lit(0)).alias(position) if position else None
    rows = rows.select(*rest, exploded, *([place] if position else []))
    element = rows.schema[exploded].dataType
    if not isinstance(element, T.StructType):
        return rows
    inner = struct_leaves(element, exploded, f"`{exploded}`")
    return rows.select(
        *[c for c in rows.columns if c != exploded], *[F.col(path).alias(name) for path, name in inner]
    )


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, share: float, out: str, **limits) -> DataFrame:
    """Continuous percentile per key.

    Values are counted first, so equal values are one row, and the place is found in their running count: no group
    is held in memory.
    """
    counted = reused(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    running = ordered_scan(counted, keys, [value], [Scan("_upto", "sum", "_n")], **limits)
    totals = counted.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    place = (F.col("_all") - 1) * F.lit(share)
    joined = join_keys(running, totals, keys)
    below, above = F.floor(place), F.ceil(place)
    covers = lambda at: (F.col("_upto") > at) & (F.col("_upto") - F.col("_n") <= at)
    ends = joined.groupBy(*keys).agg(
        F.max(F.when(covers(below), F.col(value).cast("double"))).alias("_lo"),
        F.max(F.when(covers(above), F.col(value).cast("double"))).alias("_hi"),
        F.max(place - below).alias("_frac"),
    )
    return ends.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias(out))


def distinct_over(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Distinct count per key on every row: a pre-aggregated count joined back."""
    counted = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count_distinct(column).alias(out))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(counted, on, "left").select(*df.columns, out)


def share_of_total(df: DataFrame, keys: Sequence[str], amount: str, out: str) -> DataFrame:
    """Amount as a share of its group's total (0 total gives NULL)."""
    totals = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum(amount).alias("_total"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    part = F.col(amount).cast("double") / F.nullif(F.col("_total").cast("double"), F.lit(0.0))
    return df.join(totals, on, "left").select(*df.columns, part.alias(out))


def ordered_list(df: DataFrame, keys: Sequence[str], column: str, separator: str, out: str) -> DataFrame:
    """Distinct values per key as one sorted text; duplicates go before the lists are built."""
    return df.select(*keys, column).distinct().groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(F.col(column).cast("string"))), separator).alias(out)
    )


def first_match(df: DataFrame, rules: Sequence[tuple[Column, str]], out: str, otherwise: str | None = None) -> DataFrame:
    """Label of the first rule that holds, as one CASE expression."""
    chain = F.lit(otherwise)
    for condition, label in reversed(list(rules)):
        chain = F.when(condition, F.lit(label)).otherwise(chain)
    return df.withColumn(out, chain)
