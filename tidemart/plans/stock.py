"""Inventory: daily snapshots, out-of-stock, size scales, health, purchase cost."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.semantics import earliest_by, join_keys, latest_by, least_strict, millis_before, ntz, ratio, row_count
from tidemart.operators.reshape import exact_percentile
from tidemart.operators.scan import Scan, ordered_scan
from tidemart.session import reused


def daily_snapshot(sources: Sequence[DataFrame], keys: Sequence[str], moment: str, tie: Sequence[str]) -> DataFrame:
    """First row per item and day; a later source only fills days no earlier source has."""
    tagged = [
        earliest_by(df.withColumn("day", F.to_date(moment)), [*keys, "day"], [moment, *tie]).withColumn("source_rank", F.lit(i))
        for i, df in enumerate(sources)
    ]
    union = reduce(lambda a, b: a.unionByName(b), tagged)
    return earliest_by(union, [*keys, "day"], ["source_rank"])


def day_grid(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Every day between the first and last day of each key."""
    span = df.groupBy(*keys).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    return span.select(*keys, F.explode(F.sequence("_a", "_b")).alias(day))


def stock_status(stock: DataFrame, style: str, size: str, day: str, quantity: str, core: Sequence[str]) -> DataFrame:
    """Per style and day: sizes, sizes in stock, sold out, core size broken; a day without a row counts as 0."""
    grid = day_grid(stock, [style, size], day)
    filled = join_keys(grid, stock, [style, size, day], "left").fillna(0, [quantity])
    has = F.col(quantity) > 0
    is_core = F.col(size).isin(list(core))
    return (
        filled.groupBy(style, day)
        .agg(
            row_count().alias("sizes"),
            F.count_if(has).alias("sizes_in_stock"),
            F.count_if(is_core & ~has).alias("core_out"),
        )
        .withColumn("sold_out", F.col("sizes_in_stock") == 0)
        .withColumn("core_broken", (F.col("core_out") > 0) & (F.col("sizes_in_stock") > 0))
    )


def full_size_periods(status: DataFrame, style: str, day: str) -> DataFrame:
    """Periods in which all sizes of a style are in stock: start, end (last such day) and length.

    ``status`` has one row per style and day with ``sizes`` and ``sizes_in_stock``.
    """
    flagged = status.withColumn("_full", (F.col("sizes_in_stock") == F.col("sizes")).cast("int"))
    lagged = ordered_scan(flagged, [style], [day], [Scan("_before", "lag", "_full"), Scan("_day_before", "lag", day)])
    opens = (F.col("_full") == 1) & (
        (F.coalesce("_before", F.lit(0)) == 0) | (F.datediff(day, "_day_before") > 1)
    )
    numbered = ordered_scan(
        lagged.withColumn("_open", opens.cast("long")), [style], [day], [Scan("period", "sum", "_open")]
    )
    return (
        numbered.filter("_full = 1")
        .groupBy(style, "period")
        .agg(F.min(day).alias("start_day"), F.max(day).alias("end_day"), row_count().alias("days"))
    )


def trailing(df: DataFrame, keys: Sequence[str], day: str, measures: Sequence[str], rows: int = 30) -> DataFrame:
    """Trailing sums and averages over ``rows`` rows; the input is one row per key and day."""
    w = W.partitionBy(*keys).orderBy(day).rowsBetween(-(rows - 1), 0)
    return df.select(
        "*",
        *[F.sum(m).over(w).alias(f"{m}_{rows}_sum") for m in measures],
        *[
            (F.sum(m).over(w).cast("double") / F.count(m).over(w)).alias(f"{m}_{rows}_avg")
            for m in measures
        ],
    )


def bottom_threshold(df: DataFrame, group: Sequence[str], value: str, share: float = 0.15) -> DataFrame:
    """Members with their group's low percentile of positive values and a flag when they are under it."""
    edge = exact_percentile(df.filter(F.col(value) > 0), list(group), value, share, "threshold")
    return join_keys(df, edge, group, "left").withColumn(
        "under_threshold", F.coalesce(F.col(value) < F.col("threshold"), F.lit(False))
    )


def percent_rank_of(df: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Percent rank per group; equal values share a rank. Values are counted first, so a group may be large."""
    counted = reused(df.groupBy(*group, value).agg(row_count().alias("_n")))
    running = ordered_scan(counted, list(group), [value], [Scan("_upto", "sum", "_n")])
    totals = counted.groupBy(*group).agg(F.sum("_n").alias("_all"))
    ranked = join_keys(running, totals, group).select(
        *group, value, F.coalesce(ratio(F.col("_upto") - F.col("_n"), F.col("_all") - 1), F.lit(0.0)).alias(out)
    )
    return join_keys(df, ranked, [*group, value], "left")


def earliest_of(dates: Sequence[str]) -> Column:
    """Earliest of several dates, absent ones ignored; 1900-01-01 when none is known."""
    late, none = F.lit("9999-12-31").cast("date"), F.lit("1900-01-01").cast("date")
    known = [F.coalesce(F.col(d), late) for d in dates]
    return least_strict(*known, F.coalesce(*[F.col(d) for d in dates], none))


def purchase_costs(
    lines: DataFrame, order: str, sku: str, line: str, dates: Sequence[str], costs: Sequence[str], quantity: str, tie: Sequence[str]
) -> DataFrame:
    """Cost per order line with its effective range per sku, and a line -1 with the quantity-weighted order average."""
    single = reused(latest_by(lines, [order, sku, line], [quantity, *tie]).withColumn("start_date", earliest_of(dates)))
    keep = [order, sku, line, quantity, *costs, "start_date"]
    total = single.groupBy(order, sku).agg(
        F.sum(quantity).alias("_q"),
        F.min("start_date").alias("start_date"),
        *[F.sum(F.col(c) * F.col(quantity)).alias(f"_{c}") for c in costs],
    )
    types = dict(single.dtypes)
    average = total.select(
        order,
        sku,
        F.lit(-1).cast(types[line]).alias(line),
        F.col("_q").cast(types[quantity]).alias(quantity),
        *[F.round(F.col(f"_{c}") / F.nullif("_q", F.lit(0)), 4).cast(types[c]).alias(c) for c in costs],
        "start_date",
    )
    return single.select(*keep).unionByName(average)


def cost_ranges(costs: DataFrame, sku: str, order: str, line: str) -> DataFrame:
    """Order-average costs of a sku as effective ranges; of several orders on one day the highest number counts."""
    average = costs.filter(F.col(line) == -1)
    daily = latest_by(average, [sku, "start_date"], [order]).withColumn("effective_start", F.col("start_date").cast("timestamp_ntz"))
    scanned = ordered_scan(daily, [sku], ["effective_start"], [Scan("_next", "lead", "effective_start")])
    return scanned.withColumn(
        "effective_end", F.coalesce(millis_before(F.col("_next")), ntz("9999-12-31 00:00:00"))
    ).drop("_next", "start_date")


def sales_inventory_base(sales: DataFrame, stock: DataFrame, product: str, day: str) -> DataFrame:
    """Product x day with units sold and units on hand, whichever side has the day."""
    return sales.join(stock, [product, day], "full").fillna(0, [c for c in (*sales.columns, *stock.columns) if c not in (product, day)])
