"""Exact quantiles by narrowing.

A mergeable sketch gives each group two values between which its quantile must lie. One more pass counts what is below them and keeps only the
values between; these are counted, ordered and walked. So rows are reduced before the shuffle to one row per group and task plus
the values inside the brackets. A group whose bracket should miss (the sketch promises it does not) is computed from all its values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys
from tidemart.operators.reshape import exact_percentile
from tidemart.operators.scan import Scan, ordered_scan
from tidemart.session import broadcast_limit, plan_bytes, settle

ACCURACY = 2_000


def brackets(df: DataFrame, keys: Sequence[str], value: str, shares: float | Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """keys, _n, _share and the values _lo, _hi (null: no bound) around each quantile of the non-null values; one sketch serves all shares."""
    shares = [shares] if isinstance(shares, (int, float)) else list(shares)
    slack = 3.0 / accuracy
    places = [p for s in shares for p in (max(0.0, s - slack), min(1.0, s + slack))]
    ends = F.percentile_approx(value, places, accuracy)
    rough = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(value).alias("_n"), ends.alias("_e"))
    each = []
    for i, s in enumerate(shares):
        low = F.when(F.lit(s - slack > 0), F.col("_e")[2 * i])
        high = F.when(F.lit(s + slack < 1), F.col("_e")[2 * i + 1])
        each.append(F.struct(F.lit(float(s)).alias("_share"), low.alias("_lo"), high.alias("_hi")))
    return rough.select(*keys, "_n", F.explode(F.array(*each)).alias("_b")).select(*keys, "_n", "_b.*")


def bracketed(df: DataFrame, keys: Sequence[str], value: str, bounds: DataFrame) -> DataFrame:
    """keys, _share, _below (0 or 1), value, _rows: how many rows of a group stand below a bracket, and how often each value inside does."""
    listed = bounds.groupBy(*keys).agg(F.collect_list(F.struct("_share", "_lo", "_hi")).alias("_b"))
    joined = join_keys(df.filter(F.col(value).isNotNull()).select(*keys, value), F.broadcast(listed), keys)
    reached = F.filter("_b", lambda b: F.coalesce(F.col(value) <= b["_hi"], F.lit(True)))
    each = joined.select(*keys, F.col(value).alias("_v"), F.explode(reached).alias("_b"))
    below = F.coalesce(F.col("_v") < F.col("_b._lo"), F.lit(False))
    zoned = each.select(*keys, F.col("_b._share").alias("_share"), below.cast("int").alias("_below"), F.when(~below, F.col("_v")).alias(value))
    return zoned.groupBy(*keys, "_share", "_below", value).agg(F.count(F.lit(1)).alias("_rows"))


def narrowed_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], out: str, accuracy: int = ACCURACY, **limits: int) -> DataFrame:
    """keys, _share and the continuous quantile of each share per key, null keys being a group; the rows are read twice for all shares.

    Each is the same result as ``exact_percentile``. More groups than a broadcast holds are computed from counted values instead.
    """
    keys, shares = list(keys), [float(s) for s in dict.fromkeys(shares)]
    group = keys or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(0))
    bounds = settle(brackets(source, group, value, shares, accuracy))
    exact = lambda rows, by, s: exact_percentile(rows, by, value, s, out, **limits).withColumn("_share", F.lit(s)).select(*by, "_share", out)
    if plan_bytes(bounds) > broadcast_limit(df.sparkSession):
        return reduce(DataFrame.unionByName, [exact(df, keys, s) for s in shares])
    by = [*group, "_share"]
    counted = settle(bracketed(source, group, value, bounds))
    under = counted.filter("_below = 1").groupBy(*by).agg(F.sum("_rows").alias("_under"))
    running = ordered_scan(counted.filter("_below = 0"), by, [value], [Scan("_upto", "sum", "_rows")], **limits)
    placed = join_keys(join_keys(running, bounds.select(*by, "_n"), by), under, by, "left").withColumn("_under", F.coalesce("_under", F.lit(0)))
    place = (F.col("_n") - 1) * F.col("_share")
    covers = lambda at: (F.col("_under") + F.col("_upto") > at) & (F.col("_under") + F.col("_upto") - F.col("_rows") <= at)
    ends = placed.groupBy(*by).agg(
        F.max(F.when(covers(F.floor(place)), F.col(value).cast("double"))).alias("_a"), F.max(F.when(covers(F.ceil(place)), F.col(value).cast("double"))).alias("_b"),
        F.max(place - F.floor(place)).alias("_frac"),
    )
    found = settle(join_keys(bounds.select(*by), ends, by, "left"))
    sure = found.filter("_a IS NOT NULL AND _b IS NOT NULL").select(*by, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac")).alias(out))
    missed = found.filter("_a IS NULL OR _b IS NULL").select(*by)
    for s in [r["_share"] for r in missed.select("_share").distinct().collect()]:
        some = missed.filter(F.col("_share") == s).select(*group)
        sure = sure.unionByName(exact(join_keys(source, some, group, "left_semi"), group, s))
    return sure.select(*keys, "_share", out)


def narrowed_quantile(df: DataFrame, keys: Sequence[str], value: str, share: float, out: str, accuracy: int = ACCURACY, **limits: int) -> DataFrame:
    """Continuous quantile per key, null keys being a group; the same result as ``exact_percentile``."""
    return narrowed_quantiles(df, keys, value, [share], out, accuracy, **limits).drop("_share")
