"""Slowly changing dimensions and dimension keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import FIRST_START, OPEN_END, latest_by, millis_before, ntz, row_hash
from tidemart.operators.merge import apply_merge
from tidemart.operators.scan import Scan, key_plan, ordered_scan
from tidemart.session import reused

LOAD_FIRST_START = "1970-01-01 00:00:00"
LOAD_OPEN_END = "2065-01-24 05:20:00"  # epoch second 3,000,000,000


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return on


@dataclass(frozen=True)
class ScdSpec:
    keys: tuple[str, ...]
    type_1: tuple[str, ...]
    type_2: tuple[str, ...]
    event: str


def scd_load(
    target: DataFrame | None,
    stage: DataFrame,
    spec: ScdSpec,
    run_ts: Column,
    min_type_1_updates: bool = True,
) -> DataFrame:
    """Dimension load that takes one version per key and batch; ranges touch without a gap."""
    keys = list(spec.keys)
    body = [*keys, *spec.type_1, *spec.type_2, spec.event]
    batch = latest_by(stage, keys, [spec.event, *spec.type_2, *spec.type_1]).select(
        *body,
        row_hash(*spec.type_1).alias("meta_type_1_hash"),
        row_hash(*spec.type_2).alias("meta_type_2_hash"),
        F.col(spec.event).alias("meta_from_datetime"),
    )

    def versions(rows: DataFrame, start: Column) -> DataFrame:
        return rows.select(
            *body,
            "meta_type_1_hash",
            "meta_type_2_hash",
            start.alias("meta_from_datetime"),
            ntz(LOAD_OPEN_END).alias("meta_to_datetime"),
            F.lit(True).alias("meta_is_current"),
            run_ts.alias("meta_create_datetime"),
            run_ts.alias("meta_update_datetime"),
        )

    if target is None:
        return versions(batch, ntz(LOAD_FIRST_START))
    current = target.filter("meta_is_current").alias("t")
    s_1, s_2 = F.col("s.meta_type_1_hash"), F.col("s.meta_type_2_hash")
    t_1, t_2 = F.col("t.meta_type_1_hash"), F.col("t.meta_type_2_hash")
    status = (
        F.when(F.col("t.meta_is_current").isNull(), "new")
        .when(F.col("s.meta_from_datetime") < F.col("t.meta_from_datetime"), "ignore")
        .when((s_1 != t_1) & (s_2 != t_2), "both")
        .when(s_1 != t_1, "type 1")
        .when(s_2 != t_2, "type 2")
        .otherwise("ignore")
    )
    delta = reused(batch.alias("s").join(current, _same(keys, "s", "t"), "left").select("s.*", status.alias("status")))
    fresh = delta.filter("status IN ('new', 'type 2', 'both')")
    inserted = versions(
        fresh, F.when(F.col("status") == "new", ntz(LOAD_FIRST_START)).otherwise(F.col("meta_from_datetime"))
    )
    changes = delta.filter("status <> 'ignore' AND status <> 'new'")
    gets_1 = F.col("s_status").isin("type 1", "both") & (
        F.col("meta_is_current") if min_type_1_updates else F.lit(True)
    )
    closes = F.col("s_status").isin("type 2", "both") & F.col("meta_is_current")

    def rewritten(t, s):
        out = {c: F.when(gets_1, s(c)).otherwise(t(c)) for c in spec.type_1}
        out["meta_to_datetime"] = F.when(closes, s("meta_from_datetime")).otherwise(t("meta_to_datetime"))
        out["meta_update_datetime"] = F.when(closes, run_ts).otherwise(t("meta_update_datetime"))
        out["meta_is_current"] = t("meta_is_current") & ~closes
        return out

    kept = apply_merge(target, changes, keys, matched=rewritten, insert=False, unique_source=True)
    return kept.unionByName(inserted)


def scd_mart(target: DataFrame | None, stage: DataFrame, spec: ScdSpec, run_ts: Column) -> DataFrame:
    """Dimension load that takes any number of events per key and batch.

    Every event is compared with the one before it (the first with the current version). Kept type-2 events become
    versions ended 1 ms before the next kept one. The latest type-1 event rewrites all versions of its key last.
    """
    keys = list(spec.keys)
    body = [*keys, *spec.type_1, *spec.type_2]
    events = stage.select(
        *body,
        F.col(spec.event).alias("effective_start_datetime"),
        F.col(spec.event).alias("meta_event_datetime"),
        row_hash(*spec.type_1).alias("meta_type_1_hash"),
        row_hash(*spec.type_2).alias("meta_type_2_hash"),
    )
    if target is None:
        joined = events.select(
            "*",
            F.lit(None).cast("long").alias("t_1"),
            F.lit(None).cast("long").alias("t_2"),
            F.lit(None).cast("timestamp_ntz").alias("t_start"),
            F.lit(True).alias("is_new"),
        )
    else:
        current = target.filter("is_current").alias("t")
        joined = (
            events.alias("s")
            .join(current, _same(keys, "s", "t"), "left")
            .filter(
                F.col("t.is_current").isNull()
                | (F.col("t.effective_start_datetime") < F.col("s.effective_start_datetime"))
            )
            .select(
                "s.*",
                F.col("t.meta_type_1_hash").alias("t_1"),
                F.col("t.meta_type_2_hash").alias("t_2"),
                F.col("t.effective_start_datetime").alias("t_start"),
                F.col("t.is_current").isNull().alias("is_new"),
            )
        )
    order = ["effective_start_datetime", "meta_type_2_hash", "meta_type_1_hash"]
    plan = key_plan(events, keys)
    scanned = ordered_scan(
        joined,
        keys,
        order,
        plan=plan,
        scans=[
            Scan("lag_1", "lag", "meta_type_1_hash"),
            Scan("lag_2", "lag", "meta_type_2_hash"),
            Scan("lag_start", "lag", "effective_start_datetime"),
            Scan("rn", "number"),
        ],
    )
    p_1, p_2 = F.coalesce("lag_1", "t_1"), F.coalesce("lag_2", "t_2")
    differs_1, differs_2 = F.col("meta_type_1_hash") != p_1, F.col("meta_type_2_hash") != p_2
    status = (
        F.when(F.col("is_new") & (F.col("rn") == 1), "new")
        .when(F.col("effective_start_datetime") <= F.coalesce("lag_start", "t_start"), "ignore")
        .when(differs_1 & differs_2, "both")
        .when(differs_1, "type 1")
        .when(differs_2, "type 2")
        .otherwise("ignore")
    )
    delta = reused(scanned.withColumn("status", status))
    chain = ordered_scan(
        delta.filter("status IN ('type 2', 'both', 'new')"),
        keys,
        order,
        [Scan("next_start", "lead", "effective_start_datetime"), Scan("seq", "number")],
        plan=plan,
    )
    inserted = chain.select(
        *body,
        F.when(F.col("status") == "new", ntz(FIRST_START))
        .otherwise(F.col("effective_start_datetime"))
        .alias("effective_start_datetime"),
        F.coalesce(millis_before(F.col("next_start")), ntz(OPEN_END)).alias("effective_end_datetime"),
        F.col("next_start").isNull().alias("is_current"),
        "meta_event_datetime",
        "meta_type_1_hash",
        "meta_type_2_hash",
        run_ts.alias("meta_create_datetime"),
        run_ts.alias("meta_update_datetime"),
    )
    if target is None:
        versions = inserted
    else:
        closing = chain.filter("seq = 1 AND status IN ('both', 'type 2')").select(*keys, "effective_start_datetime")
        closed = apply_merge(
            target,
            closing,
            keys,
            unique_source=True,
            matched=lambda t, s: {
                "effective_end_datetime": millis_before(s("effective_start_datetime")),
                "is_current": F.lit(False),
                "meta_update_datetime": run_ts,
            },
            update_when=lambda t, s: t("is_current"),
            insert=False,
        )
        versions = closed.unionByName(inserted.select(*target.columns))
    if not spec.type_1:
        return versions
    last = latest_by(
        delta.filter("status IN ('type 1', 'both')").select(*keys, *spec.type_1, "meta_type_1_hash", *order[:2]),
        keys,
        order,
    )
    return apply_merge(
        versions,
        last,
        keys,
        unique_source=True,
        matched=lambda t, s: {
            **{c: s(c) for c in spec.type_1},
            "meta_type_1_hash": s("meta_type_1_hash"),
            "meta_update_datetime": run_ts,
        },
        insert=False,
    )


def mart_upsert(
    target: DataFrame | None,
    delta: DataFrame,
    keys: Sequence[str],
    run_ts: Column,
    newer_by: str | None = None,
    is_dim: bool = False,
) -> DataFrame:
    """Mart load of a fact, or of a type-1 dimension (one open row per key): update where the hash differs."""
    names = delta.columns
    source = delta.select(
        "*",
        row_hash(*[c for c in names if c not in keys]).alias("meta_row_hash"),
        run_ts.alias("meta_create_datetime"),
        run_ts.alias("meta_update_datetime"),
    )
    if is_dim:
        source = source.select(
            "*",
            ntz(FIRST_START).alias("effective_start_datetime"),
            ntz(OPEN_END).alias("effective_end_datetime"),
            F.lit(True).alias("is_current"),
        )
    if target is None:
        return source

    def changed(t, s):
        differs = t("meta_row_hash") != s("meta_row_hash")
        return differs & (s(newer_by) > t(newer_by)) if newer_by else differs

    return apply_merge(
        target,
        source,
        keys,
        matched=lambda t, s: {c: s(c) for c in [*names, "meta_row_hash", "meta_update_datetime"]},
        update_when=changed,
    )


# Fixed values of the unknown member by type.
UNKNOWN = {"string": "Unknown", "date": "1900-01-01", "timestamp_ntz": FIRST_START, "timestamp": FIRST_START}


def unknown_member(dim: DataFrame, key: str, overrides: dict[str, object] | None = None) -> DataFrame:
    """Add the row every failed lookup points to, unless the dimension already has it."""
    given = {
        key: -1, "is_current": True, "effective_start_datetime": FIRST_START, "effective_end_datetime": OPEN_END,
        **(overrides or {}),
    }
    row = dim.sparkSession.range(1).select(
        *[
            F.lit(given[c] if c in given else -1 if kind in ("bigint", "int") else UNKNOWN.get(kind))
            .cast(kind)
            .alias(c)
            for c, kind in dim.dtypes
        ]
    )
    present = dim.filter(F.col(key) == -1).select(key)
    return dim.unionByName(row.join(present, key, "left_anti").select(*dim.columns))


def surrogate_keys(
    new_rows: DataFrame, business_keys: Sequence[str], key: str, start: Column | int = 0, **limits: int
) -> DataFrame:
    """Dense keys above ``start`` for new rows only, in business-key order, without one global sort task."""
    numbered = ordered_scan(new_rows, [], business_keys, [Scan("_rn", "number")], **limits)
    base = start if isinstance(start, Column) else F.lit(start)
    return numbered.select((F.col("_rn") + base).cast("long").alias(key), *new_rows.columns)
