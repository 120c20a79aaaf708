"""Ordered scans per key (running totals, fills, lags, ranks) that survive a hot key.

A plain window sends every row of a key to one task. That is right while no key is large. When the input may be
large, the keys are counted first (a pre-aggregated pass over the key columns). Keys above ``hot_rows`` are cut
into ordered slices by range partitioning, each slice is scanned alone, one summary row per slice carries the
state from slice to slice, and the rest of the keys keeps the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys
from tidemart.session import SMALL_BYTES, input_bytes, settle

HOT_ROWS = 5_000_000
# Key lists up to this length are broadcast; their length is counted first.
LISTED_KEYS = 100_000
# Slots in which keys are counted before they are counted themselves.
KEY_SLOTS = 1 << 16


@dataclass(frozen=True)
class Scan:
    """One output column of an ordered scan.

    kind: ``size`` (rows of the key), ``number`` (row number), ``sum``, ``min``, ``max``, ``fill`` (last non-NULL up to this row),
    ``fill_next`` (first non-NULL from this row on), ``lag``, ``lead``. All run over
    rows from the start of the key to the current row, in ascending order.
    """

    out: str
    kind: str
    source: str | None = None


_START = Window.unboundedPreceding


def _local(scan: Scan, keys: Sequence[str], order: Sequence[str]) -> Column:
    base = Window.partitionBy(*keys).orderBy(*order)
    upto = base.rowsBetween(_START, Window.currentRow)
    if scan.kind == "number":
        return F.row_number().over(base).cast("long")
    if scan.kind == "size":
        return F.count(F.lit(1)).over(Window.partitionBy(*keys))
    value = F.col(scan.source)
    if scan.kind == "sum":
        return F.sum(value).over(upto)
    if scan.kind == "min":
        return F.min(value).over(upto)
    if scan.kind == "max":
        return F.max(value).over(upto)
    if scan.kind == "fill":
        return F.last(value, ignorenulls=True).over(upto)
    if scan.kind == "fill_next":
        return F.first(value, ignorenulls=True).over(base.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    if scan.kind == "lag":
        return F.lag(value).over(base)
    if scan.kind == "lead":
        return F.lead(value).over(base)
    raise ValueError(f"unknown scan kind {scan.kind}")


def _window_all(df: DataFrame, keys: Sequence[str], order: Sequence[str], scans: Sequence[Scan]) -> DataFrame:
    return df.select("*", *[_local(s, keys, order).alias(s.out) for s in scans])


def _summary(scan: Scan, i: int, position: Column) -> Column:
    if scan.kind in ("number", "size"):
        return F.count(F.lit(1)).alias(f"_c{i}")
    value = F.col(scan.source)
    boxed = F.struct(value.alias("v"))
    by_kind = {
        "sum": lambda: F.sum(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "fill": lambda: F.max_by(value, F.when(value.isNotNull(), position)),
        "fill_next": lambda: F.min_by(value, F.when(value.isNotNull(), position)),
        "lag": lambda: F.max_by(boxed, position),
        "lead": lambda: F.min_by(boxed, position),
    }
    return by_kind[scan.kind]().alias(f"_c{i}")


def _carry(scan: Scan, i: int, keys: Sequence[str]) -> Column:
    base = Window.partitionBy(*keys).orderBy("_slice")
    before, after = base.rowsBetween(_START, -1), base.rowsBetween(1, Window.unboundedFollowing)
    value = F.col(f"_c{i}")
    by_kind = {
        "size": lambda: F.sum(value).over(Window.partitionBy(*keys)),
        "number": lambda: F.sum(value).over(before),
        "sum": lambda: F.sum(value).over(before),
        "min": lambda: F.min(value).over(before),
        "max": lambda: F.max(value).over(before),
        "fill": lambda: F.last(value, ignorenulls=True).over(before),
        "fill_next": lambda: F.first(value, ignorenulls=True).over(after),
        "lag": lambda: F.lag(value).over(base),
        "lead": lambda: F.lead(value).over(base),
    }
    return by_kind[scan.kind]().alias(f"_p{i}")


def _combine(scan: Scan, i: int) -> Column:
    local, prior = F.col(scan.out), F.col(f"_p{i}")
    if scan.kind == "size":
        joined = prior
    elif scan.kind in ("number", "sum"):
        joined = F.when(prior.isNull(), local).when(local.isNull(), prior).otherwise(local + prior)
    elif scan.kind == "min":
        joined = F.least(local, prior)
    elif scan.kind == "max":
        joined = F.greatest(local, prior)
    elif scan.kind in ("fill", "fill_next"):
        joined = F.coalesce(local, prior)
    elif scan.kind == "lag":
        joined = F.when(F.col("_first"), prior["v"]).otherwise(local)
    else:
        joined = F.when(F.col("_last"), prior["v"]).otherwise(local)
    return joined.alias(scan.out)


def _sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], scans: Sequence[Scan], slices: int
) -> DataFrame:
    """Scan of large keys: ordered slices, one summary row per (key, slice), carried state joined back.

    The slice number comes from the range partitioner, so it is fixed with a checkpoint before it is used twice.
    """
    names = df.columns
    cut = settle(
        df.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id())
    )
    by_slice = [*keys, "_slice"]
    position = F.struct(*[F.col(c) for c in order])
    inner = Window.partitionBy(*by_slice).orderBy(*order)
    local = _window_all(cut, by_slice, order, scans).select(
        "*",
        (F.row_number().over(inner) == 1).alias("_first"),
        F.lead(F.lit(1)).over(inner).isNull().alias("_last"),
    )
    totals = cut.groupBy(*by_slice).agg(*[_summary(s, i, position) for i, s in enumerate(scans)])
    carried = totals.select(*by_slice, *[_carry(s, i, keys) for i, s in enumerate(scans)])
    on = (F.col("l._slice") == F.col("r._slice"))
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = local.alias("l").join(carried.alias("r"), on, "left")
    return joined.select(
        *[F.col(f"l.{n}") for n in names],
        *[_combine(s, i) for i, s in enumerate(scans)],
    )


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)


@dataclass(frozen=True)
class KeyPlan:
    """Which keys of a frame are too large for one task: their list, its length, and the rows they hold.

    An empty plan states that no key is large, as when a key has one row per calendar day or month.
    """

    hot: DataFrame | None = None
    keys: int = 0
    rows: int = 0


def key_plan(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, small_bytes: int = SMALL_BYTES
) -> KeyPlan:
    """Count the keys of a large input once; the plan also holds for frames derived from it with no more rows a key."""
    if input_bytes(df) <= small_bytes:
        return KeyPlan()
    if not keys:
        rows = df.count()
        return KeyPlan(None, int(rows > hot_rows), rows)
    # Keys share slots, so what is shuffled does not grow with their number; a slot that is not large holds no large key.
    slots = df.groupBy(F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(KEY_SLOTS)).alias("_slot"))
    if hot_rows > 0 and slots.agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows).isEmpty():
        return KeyPlan()
    hot = settle(hot_keys(df, keys, hot_rows))
    found = hot.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows")).first()
    return KeyPlan(hot, found["n"], found["rows"])


def with_totals(df: DataFrame, keys: Sequence[str], totals: dict[str, Column], plan: KeyPlan) -> DataFrame:
    """Aggregates of a key on each of its rows; NULL is a key too.

    Where the plan knows no large key this is one window, which needs no shuffle when the rows are dealt by some of the keys already.
    Otherwise the aggregates are joined to the rows, so that no key is one task.
    """
    if not plan.keys:
        whole = Window.partitionBy(*keys)
        return df.select("*", *[c.over(whole).alias(n) for n, c in totals.items()])
    df = settle(df)
    return join_keys(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()]), keys)


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scans: Sequence[Scan],
    hot_rows: int = HOT_ROWS,
    small_bytes: int = SMALL_BYTES,
    plan: KeyPlan | None = None,
) -> DataFrame:
    """Add scan columns over ``keys`` in ascending ``order`` (which should be total within a key).

    A large input is settled before its keys are counted, so it is computed once, whatever the scan then needs of it.
    """
    keys, order = list(keys), list(order)
    if plan is None and input_bytes(df) > small_bytes:
        df = settle(df)
        plan = key_plan(df, keys, hot_rows, -1)
    elif plan is not None and plan.keys:
        df = settle(df)
    if plan is None or not plan.keys:
        return _window_all(df, keys, order, scans)
    slices = max(2, plan.rows // hot_rows + 1)
    if not keys:
        return _sliced(df, [], order, scans, slices)
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}"))
    tagged = df.alias("d")
    hot = (F.broadcast(plan.hot) if plan.keys <= LISTED_KEYS else plan.hot).alias("h")
    cold_part = _window_all(tagged.join(hot, match, "left_anti"), keys, order, scans)
    hot_part = _sliced(tagged.join(hot, match, "left_semi"), keys, order, scans, slices)
    return cold_part.unionByName(hot_part)


def key_tiles(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiles: int, out: str, **limits: int
) -> DataFrame:
    """``ntile`` per key as a formula over row number and key size."""
    ranked = ordered_scan(df, keys, order, [Scan("_rn", "number"), Scan("_n", "size")], **limits)
    n, rn = F.col("_n"), F.col("_rn")
    size, extra = F.floor(n / F.lit(tiles)), n % F.lit(tiles)
    edge = extra * (size + 1)  # the first tiles take one row more
    tile = F.when(rn <= edge, F.floor((rn - 1) / (size + 1)) + 1).otherwise(
        extra + F.floor((rn - 1 - edge) / F.greatest(size, F.lit(1))) + 1
    )
    return ranked.select(*df.columns, tile.cast("long").alias(out))


def global_tiles(df: DataFrame, order: Sequence[str], tiles: int, out: str, **limits: int) -> DataFrame:
    """``ntile`` over the whole table; a large table is ranked in slices, not by one task."""
    return key_tiles(df, [], order, tiles, out, **limits)


def dense_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str, **limits: int) -> DataFrame:
    """Dense rank of a value per key, highest first; ranked over distinct values, so a group may be large."""
    values = df.select(*keys, value).distinct().withColumn("_down", -F.col(value))
    ranked = ordered_scan(values, keys, ["_down"], [Scan(out, "number")], **limits).drop("_down")
    return join_keys(df, ranked, [*keys, value])
