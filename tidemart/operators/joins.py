"""Joins Spark has no operator for: effective ranges, as-of, nearest in time, within a radius.

None of them forms all pairs of a key. A small lookup side (checked size) is joined on its range; otherwise
both sides are laid on one time line and a single ordered scan carries the latest version forward.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys
from tidemart.operators.scan import LISTED_KEYS, KeyPlan, Scan, key_plan, ordered_scan
from tidemart.operators.sweep import HOT_BOUNDS, cut_versions, held_versions
from tidemart.session import ROW_BYTES, SMALL_BYTES, beside, broadcast_limit, input_bytes, reused, settle


FEW_VERSIONS = 64


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    carry: Sequence[str],
    forward: bool = False,
    inclusive: bool = True,
    prefix: str = "",
    tie: Sequence[str] = (),
    plan: KeyPlan | None = None,
    **limits: int,
) -> DataFrame:
    """Every left row with columns of the latest right row at or before it (``forward``: first at or after).

    One union and one ordered scan; work is linear in the rows of both sides even for one huge key.
    """
    # Place of right rows among rows of one moment; left rows have place 1.
    right_rank = 0 if inclusive != forward else 2
    tie_types = dict(right.dtypes)
    a = left.select(
        *keys,
        F.col(left_ts).alias("_ts"),
        F.lit(1).alias("_side"),
        *[F.lit(None).cast(tie_types[c]).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.struct(*left.columns).alias("_l"),
        F.lit(None).cast(right.select(F.struct(*carry).alias("r")).schema["r"].dataType).alias("_r"),
    )
    b = right.select(
        *[F.col(k).cast(dict(left.dtypes)[k]).alias(k) for k in keys],
        F.col(right_ts).alias("_ts"),
        F.lit(right_rank).alias("_side"),
        *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.lit(None).cast(a.schema["_l"].dataType).alias("_l"),
        F.struct(*carry).alias("_r"),
    )
    scanned = ordered_scan(
        a.unionByName(b),
        keys,
        ["_ts", "_side", *[f"_tie{i}" for i in range(len(tie))]],
        [Scan("_hit", "fill_next" if forward else "fill", "_r")],
        plan=plan,
        **limits,
    )
    return scanned.filter("_side = 1").select(
        "_l.*", *[F.col(f"_hit.{c}").alias(f"{prefix}{c}") for c in carry]
    )


def _beside(c: Column, kind: str, step: int) -> Column:
    """The next moment (``step`` 1) or the one before (-1) in a type's own resolution."""
    if kind == "date":
        return F.date_add(c, step)
    if kind.startswith("timestamp"):
        return F.timestamp_add("MICROSECOND", F.lit(step), c)
    return c + F.lit(step).cast(kind)


def disjoint_versions(
    dim: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    half_open: bool = False,
    plan: KeyPlan | None = None,
    hot_rows: int = HOT_BOUNDS,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Versions of which no two of a key hold the same moment.

    Where ranges overlap, the version that starts last holds (of equal starts the one that ends last); one that it interrupts holds again
    after it. Ranges without a moment go. One pass over the versions of a key with a stack of open versions cuts them where they lie
    (``sweep.cut_versions``); a key with many of them is swept in slices (``sweep.held_versions``). ``plan`` has the keys with more than
    ``HOT_BOUNDS // 2`` versions, where a caller knows them; otherwise a large input is settled and its keys are counted.
    """
    keys, kind = list(keys), dict(dim.dtypes)[start]
    stop = F.col(end) if half_open else _beside(F.col(end), kind, 1)
    real = dim.filter(F.col(start) < stop).withColumn("_stop", stop)
    if plan is None and input_bytes(real) > small_bytes:
        real = settle(real)
        plan = key_plan(real, keys, max(1, hot_rows // 2), -1)
    elif plan is not None and plan.keys:
        real = settle(real)
    if plan is None or not plan.keys:
        cut = cut_versions(real, keys, start, "_stop")
    else:
        hot = (F.broadcast(plan.hot) if plan.keys <= LISTED_KEYS else plan.hot).select(*keys)
        large = join_keys(real, hot, keys, "left_semi")
        # Of versions with equal bounds one stands for all, the same in every run.
        one = large.groupBy(*keys, start, "_stop").agg(F.max_by(F.struct(*real.columns), F.xxhash64(*dim.columns)).alias("_row"))
        held = held_versions(large, keys, start, "_stop", hot_rows, small_bytes)
        sliced = join_keys(held, beside(one, plan.rows), [*keys, start, "_stop"]).select("_row.*", "_at", "_until")
        cut = cut_versions(join_keys(real, hot, keys, "left_anti"), keys, start, "_stop").unionByName(sliced)
    last = F.col("_until") if half_open else _beside(F.col("_until"), kind, -1)
    place = {start: F.col("_at"), end: last}
    return cut.select(*[place.get(c, F.col(c)).alias(c) for c in dim.columns])


def effective_lookup(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: str,
    end: str,
    carry: Sequence[str],
    half_open: bool = False,
    strategy: str = "auto",
    prefix: str = "",
    disjoint: bool = False,
    plan: KeyPlan | None = None,
) -> DataFrame:
    """Left join to the version valid at ``ts``; where several are, to the one that starts last.

    Every fact row comes back once, whichever plan runs: overlaps are resolved before, unless ``disjoint`` states that there are none. A
    dimension that fits a broadcast (its rows are counted) and has few versions per key: equi key plus range predicate. Otherwise the
    as-of scan finds the last version started and its end is tested, so no key ever pairs all rows with all versions. ``plan`` has the keys
    with many rows of both sides, where a caller knows them; otherwise the scan settles a large input and counts them.
    """
    if not disjoint:
        dim = reused(disjoint_versions(dim.select(*dict.fromkeys([*keys, start, end, *carry])), keys, start, end, half_open))
    rows = versions = 0
    if strategy == "auto":
        limit = broadcast_limit(fact.sparkSession)
        small = input_bytes(dim) <= SMALL_BYTES or dim.count() * ROW_BYTES <= limit
        if small:
            sizes = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            rows, versions = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
            small = rows * ROW_BYTES <= limit
        strategy = "range" if small and versions <= FEW_VERSIONS else "scan"
    elif strategy == "range":
        rows = dim.count()
    if strategy == "range":
        fits = rows * ROW_BYTES <= broadcast_limit(fact.sparkSession)
        f, d = fact.alias("f"), (F.broadcast(dim) if fits else beside(dim, rows)).alias("d")
        on = F.lit(True)
        for k in keys:
            on = on & (F.col(f"f.{k}") == F.col(f"d.{k}"))
        upper = F.col(f"f.{ts}") < F.col(f"d.{end}") if half_open else F.col(f"f.{ts}") <= F.col(f"d.{end}")
        on = on & (F.col(f"f.{ts}") >= F.col(f"d.{start}")) & upper
        return f.join(d, on, "left").select("f.*", *[F.col(f"d.{c}").alias(f"{prefix}{c}") for c in carry])
    hit = as_of(fact, dim.withColumn("_end", F.col(end)), keys, ts, start, [*carry, "_end"], prefix="_c_", plan=plan)
    upper = F.col(ts) < F.col("_c__end") if half_open else F.col(ts) <= F.col("_c__end")
    matchable = F.lit(True)
    for k in keys:
        matchable = matchable & F.col(k).isNotNull()
    return hit.select(
        *fact.columns, *[F.when(upper & matchable, F.col(f"_c_{c}")).alias(f"{prefix}{c}") for c in carry]
    )


def key_lookup(
    stage: DataFrame,
    dim: DataFrame,
    pairs: dict[str, str],
    dim_key: str,
    out: str,
    event_ts: str | None,
    run_ts: Column,
    strategy: str = "auto",
) -> DataFrame:
    """Surrogate key of the dimension row valid at the event (run time where it has none); -1 when none is found."""
    renamed = dim.select(
        *[F.col(d).alias(s) for s, d in pairs.items()],
        F.col(dim_key).alias("_dk"),
        *([F.col("effective_start_datetime"), F.col("effective_end_datetime")] if event_ts else []),
    )
    if event_ts:
        probe = stage.withColumn("_at", F.coalesce(F.col(event_ts), run_ts))
        found = effective_lookup(
            probe, renamed, list(pairs), "_at", "effective_start_datetime", "effective_end_datetime", ["_dk"],
            strategy=strategy,
        )
    else:
        found = stage.join(renamed, list(pairs), "left")
    return found.select(*stage.columns, F.coalesce("_dk", F.lit(-1)).cast("long").alias(out))


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    left_ts: str,
    right_ts: str,
    tolerance_seconds: int,
    **limits: int,
) -> DataFrame:
    """One-to-one matches: rows that are each other's nearest within the tolerance.

    The nearest row of the other side is a neighbour on the time line, so two as-of scans per side replace the
    pairs. Equal distance: the earlier moment wins, then the lower id.
    """
    micros = lambda c: F.unix_micros(c.cast("timestamp"))

    def side(own, other, own_id, other_id, own_ts, other_ts):
        # One representative per moment is enough: the lowest id wins a tie.
        points = other.groupBy(*keys, F.col(other_ts).alias("o_ts")).agg(F.min(other_id).alias("o_id"))
        base = own.select(*keys, F.col(own_id).alias("own"), F.col(own_ts).alias("at"))
        # One time line serves both directions: points stand before rows of the same moment.
        line = base.select("*", F.lit(1).alias("_side"), F.lit(None).cast(points.select(F.struct("o_id", "o_ts").alias("p")).schema["p"].dataType).alias("_p"))
        there = points.select(*keys, F.lit(None).cast(dict(base.dtypes)["own"]).alias("own"), F.col("o_ts").alias("at"), F.lit(0).alias("_side"), F.struct("o_id", "o_ts").alias("_p"))
        scanned = ordered_scan(line.unionByName(there), keys, ["at", "_side"], [Scan("_b", "fill", "_p"), Scan("_n", "fill_next", "_p")], **limits)
        both = scanned.filter("_side = 1").select(
            *keys, "own", "at", F.col("_b.o_id").alias("b_o_id"), F.col("_b.o_ts").alias("b_o_ts"), F.col("_n.o_id").alias("n_o_id"), F.col("_n.o_ts").alias("n_o_ts")
        )
        gap_b = micros(F.col("at")) - micros(F.col("b_o_ts"))
        gap_n = micros(F.col("n_o_ts")) - micros(F.col("at"))
        limit = F.lit(tolerance_seconds * 1_000_000)
        gap_b = F.when(gap_b <= limit, gap_b)
        gap_n = F.when(gap_n <= limit, gap_n)
        take_b = gap_b.isNotNull() & (gap_n.isNull() | (gap_b <= gap_n))
        return both.select(
            *keys,
            "own",
            F.when(take_b, F.col("b_o_id")).when(gap_n.isNotNull(), F.col("n_o_id")).alias("other"),
            F.when(take_b, gap_b).otherwise(gap_n).alias("gap"),
        ).filter("other IS NOT NULL")

    from_left = side(left, right, left_id, right_id, left_ts, right_ts).select(
        *keys, F.col("own").alias(left_id), F.col("other").alias(right_id), (F.col("gap") / 1e6).alias("gap_seconds")
    )
    from_right = side(right, left, right_id, left_id, right_ts, left_ts).select(
        *keys, F.col("own").alias(right_id), F.col("other").alias(left_id)
    )
    return from_left.join(from_right, [*keys, left_id, right_id])


# Fixed values of the distance formula: earth radius in miles and degrees per radian.
EARTH_MILES = 3963.0
DEGREES = 57.2958


def miles(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle miles, two decimals; a cosine pushed to 1 by rounding counts as distance 0."""
    rad = lambda c: c / F.lit(DEGREES)
    cosine = F.sin(rad(lat_a)) * F.sin(rad(lat_b)) + F.cos(rad(lat_a)) * F.cos(rad(lat_b)) * F.cos(
        rad(lon_b) - rad(lon_a)
    )
    return F.when(cosine >= 1, F.lit(0.0)).otherwise(F.round(F.acos(F.greatest(cosine, F.lit(-1.0))) * EARTH_MILES, 2))


def within_radius(
    points: DataFrame,
    centres: DataFrame,
    point_cols: tuple[str, str, str],
    centre_cols: tuple[str, str, str],
    radius_miles: float,
) -> DataFrame:
    """(centre, point) pairs within the radius.

    Points fall into a latitude/longitude grid, a centre is sent to the cells its circle can touch, and an equi join
    on the cell replaces the cross join. The exact distance decides.
    """
    reach = (radius_miles + 0.01) / 69.0  # degrees of latitude; 69 miles per degree is a low bound
    columns = max(1, int(360 // reach))
    width = 360.0 / columns
    pid, plat, plon = point_cols
    cid, clat, clon = centre_cols
    row_of = lambda lat: F.floor(lat / F.lit(reach))
    p = points.select(
        F.col(pid).alias("point_id"),
        F.col(plat).alias("p_lat"),
        F.col(plon).alias("p_lon"),
        row_of(F.col(plat)).alias("cell_row"),
        F.pmod(F.floor((F.col(plon) + 180) / width), F.lit(columns)).alias("cell_col"),
    )
    # Longitude reach of the circle; near a pole it spans all columns.
    sine = F.lit(math.sin(math.radians(reach))) / F.greatest(F.cos(F.radians(F.col(clat))), F.lit(1e-9))
    spread = F.when(sine >= 1, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(sine, F.lit(1.0)))))
    first = F.floor((F.col(clon) + 180 - spread) / width) - 1
    last = F.least(F.floor((F.col(clon) + 180 + spread) / width) + 1, first + columns - 1)
    c = (
        centres.select(
            F.col(cid).alias("centre_id"),
            F.col(clat).alias("c_lat"),
            F.col(clon).alias("c_lon"),
            F.explode(F.sequence(row_of(F.col(clat)) - 1, row_of(F.col(clat)) + 1)).alias("cell_row"),
            F.sequence(first, last).alias("_cols"),
        )
        .withColumn("cell_col", F.explode("_cols"))
        .withColumn("cell_col", F.pmod(F.col("cell_col"), F.lit(columns)))
        .drop("_cols")
    )
    distance = miles(F.col("c_lat"), F.col("c_lon"), F.col("p_lat"), F.col("p_lon"))
    return (
        p.join(c, ["cell_row", "cell_col"])
        .select("centre_id", "point_id", distance.alias("miles"))
        .filter(F.col("miles") <= radius_miles)
    )
