"""Merge operators: each one maps (target, source) to the new content of the target.

Spark alone has no MERGE on Parquet, so the new content is computed and published as a new table version.
Two plans give the same rows. A small source is joined to a large target from the right, which Catalyst broadcasts,
so the target is never shuffled; new keys are found by looking up only the key columns. Otherwise one null-safe full
outer join does all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import latest_by, row_hash, version_order
from tidemart.operators.digests import range_digests
from tidemart.session import broadcast_limit, plan_bytes
from tidemart.sources.tables import BucketedTable

# A target this many broadcast limits large is not worth shuffling for a small source.
LARGE_TARGET = 10


@dataclass(frozen=True)
class Field:
    """One column of a loaded table and its roles."""

    name: str
    type: str = "string"
    key: bool = False
    delta_rank: int | None = None
    type_1: bool = False
    type_2: bool = False
    source_name: str | None = None
    allow_nulls: bool = True


@dataclass(frozen=True)
class TableSpec:
    """Columns of a table; the business key falls back to all columns when none is flagged."""

    fields: tuple[Field, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def keys(self) -> list[str]:
        return [f.name for f in self.fields if f.key] or self.names

    @property
    def delta_cols(self) -> list[str]:
        ranked = [f for f in self.fields if f.delta_rank is not None]
        return [f.name for f in sorted(ranked, key=lambda f: f.delta_rank)]

    def shape(self, raw: DataFrame) -> DataFrame:
        """Source frame with the declared names, order and types."""
        return raw.select(*[F.col(f.source_name or f.name).cast(f.type).alias(f.name) for f in self.fields])


def require_unique(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source with a runtime failure when two rows share a key (a merge would be ambiguous)."""
    others = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_"), *others)).alias("_row")
    )
    guard = F.when(F.col("_n") > 1, F.raise_error(F.lit("merge source has several rows for one key")).cast("int"))
    return (
        grouped.withColumn("_guard", guard)
        .filter(F.col("_guard").isNull())
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in source.columns])
    )


def apply_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Callable[[Callable[[str], Column], Callable[[str], Column]], dict[str, Column]],
    update_when: Callable | None = None,
    delete_when: Callable | None = None,
    missing: Callable[[Callable[[str], Column]], dict[str, Column]] | None = None,
    insert: dict[str, Column] | bool = True,
    strategy: str = "auto",
    unique_source: bool = False,
) -> DataFrame:
    """New target content after a merge on null-safe key equality.

    A second source row for a key is an error, as the merge would be ambiguous; ``unique_source`` says that the caller has made the
    keys unique already.

    ``matched(t, s)`` maps target columns to their new value for updated rows, ``t`` and ``s`` being column getters;
    ``update_when(t, s)`` / ``delete_when(t, s)`` restrict the branches; ``missing(t)`` gives new values for target
    rows without a source row; ``insert`` maps target columns to source expressions for new keys (True: same names,
    False: no insert branch).
    """
    columns = target.columns
    types = dict(target.dtypes)
    source = source if unique_source else require_unique(source, keys)
    t = F.col
    s = lambda c: F.col(f"s_{c}")
    hit = F.col("s__hit").isNotNull()
    updated = hit & F.coalesce(update_when(t, s) if update_when else F.lit(True), F.lit(False))
    values = matched(t, s)
    absent = missing(t) if missing else {}
    kept = {}
    for c in columns:
        kept[c] = F.col(c)
        if c in absent:
            kept[c] = F.when(~hit, absent[c]).otherwise(kept[c])
        if c in values:
            kept[c] = F.when(updated, values[c]).otherwise(kept[c])
    fresh = {}
    if insert:
        given = insert if isinstance(insert, dict) else {c: F.col(c) for c in source.columns}
        fresh = {c: given.get(c, F.lit(None)).cast(types[c]) for c in columns}
    # The joined row holds prefixed source columns, so insert values of their own are computed before the join; the others are there anyway.
    made = {c: F.col(f"s__new.{c}") for c in columns}
    if insert is True:
        made = {c: F.col(f"s_{c}").cast(types[c]) if c in source.columns else fresh[c] for c in columns}
    right = source.select(
        *[F.col(c).alias(f"s_{c}") for c in source.columns],
        F.lit(True).alias("s__hit"),
        *([F.struct(*[fresh[c].alias(c) for c in columns]).alias("s__new")] if insert and insert is not True else []),
    )
    left = target.withColumn("t__hit", F.lit(True))
    on = F.lit(True)
    for key in keys:
        on = on & left[key].eqNullSafe(right[f"s_{key}"])
    if strategy == "auto":
        limit = broadcast_limit(target.sparkSession)
        small = plan_bytes(source) <= limit < plan_bytes(target) // LARGE_TARGET
        strategy = "lookup" if small else "full"
    outer = insert and strategy == "full"
    joined = left.join(right, on, "full" if outer else "left")
    if delete_when:
        doomed = F.col("t__hit").isNotNull() & hit & F.coalesce(delete_when(t, s), F.lit(False))
        joined = joined.filter(~doomed)
    if outer:
        return joined.select(
            *[F.when(F.col("t__hit").isNull(), made[c]).otherwise(kept[c]).alias(c) for c in columns]
        )
    out = joined.select(*[kept[c].alias(c) for c in columns])
    if not insert:
        return out
    probe = target.select(*[F.col(k).alias(f"t_{k}") for k in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"t_{key}"))
    present = probe.join(source.select(*keys), same, "left_semi")
    added = source.join(present, same, "left_anti").select(*[fresh[c].alias(c) for c in columns])
    return out.unionByName(added)


def with_meta(df: DataFrame, run_ts: Column, hash_cols: Sequence[str]) -> DataFrame:
    return df.select(
        "*",
        row_hash(*hash_cols).alias("meta_row_hash"),
        run_ts.alias("meta_create_datetime"),
        run_ts.alias("meta_update_datetime"),
    )


def dedupe(stage: DataFrame, keys: Sequence[str], delta_cols: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Latest row per key by the coalesced version columns; any row where there are none."""
    names = stage.columns
    if delta_cols:
        ranked = stage.withColumn("_v", version_order(delta_cols, stage))
        return latest_by(ranked, keys, ["_v", *tie]).select(*names)
    return latest_by(stage, keys, list(tie) or [F.lit(1)]).select(*names)


def insert_update(
    target: DataFrame | None,
    stage: DataFrame,
    keys: Sequence[str],
    delta_cols: Sequence[str],
    run_ts: Column,
    tie: Sequence[str] = (),
    strategy: str = "auto",
) -> DataFrame:
    """Insert new keys; replace changed rows whose version is strictly newer. Creation time is kept."""
    names = stage.columns
    source = with_meta(dedupe(stage, keys, delta_cols, tie), run_ts, names)
    if target is None:
        return source
    order_of = lambda get: F.coalesce(
        *[get(c) for c in delta_cols],
        F.lit("1900-01-01" if dict(stage.dtypes)[delta_cols[0]].startswith(("timestamp", "date")) else "0").cast(
            dict(stage.dtypes)[delta_cols[0]]
        ),
    )

    def changed(t, s):
        differs = t("meta_row_hash") != s("meta_row_hash")
        return differs & (order_of(s) > order_of(t)) if delta_cols else differs

    return apply_merge(
        target,
        source,
        keys,
        matched=lambda t, s: {c: s(c) for c in [*names, "meta_row_hash", "meta_update_datetime"]},
        update_when=changed,
        strategy=strategy,
        unique_source=True,
    )


def insert_update_delete(
    target: DataFrame | None,
    stage: DataFrame,
    keys: Sequence[str],
    run_ts: Column,
    delta_cols: Sequence[str] = (),
    tie: Sequence[str] = (),
    strategy: str = "auto",
    several: bool | None = None,
) -> DataFrame:
    """Full-feed merge: as ``insert_update``, revives deleted keys, soft-deletes keys absent from the feed.

    A feed of one row or none deletes nothing, so that an empty delivery cannot wipe the table. ``several`` says whether the feed has
    more rows, where ``stage`` is a part of it.
    """
    names = stage.columns
    source = with_meta(dedupe(stage, keys, delta_cols, tie), run_ts, names).withColumn(
        "meta_is_deleted", F.lit(False)
    )
    if target is None:
        return source
    newer = lambda t, s: F.coalesce(*[s(c) for c in delta_cols]) > F.coalesce(
        *[t(c) for c in delta_cols]
    )

    def changed(t, s):
        differs = t("meta_row_hash") != s("meta_row_hash")
        differs = differs & newer(t, s) if delta_cols else differs
        return differs | t("meta_is_deleted")

    several = stage.select((F.count(F.lit(1)) > 1).alias("ok")).scalar() if several is None else F.lit(several)
    return apply_merge(
        target,
        source,
        keys,
        matched=lambda t, s: {
            **{c: s(c) for c in [*names, "meta_row_hash", "meta_update_datetime"]},
            "meta_is_deleted": F.lit(False),
        },
        update_when=changed,
        missing=lambda t: {
            "meta_is_deleted": t("meta_is_deleted") | several,
            "meta_update_datetime": F.when(several & ~t("meta_is_deleted"), run_ts).otherwise(t("meta_update_datetime")),
        },
        strategy=strategy,
        unique_source=True,
    )


def merge_feed(
    table: BucketedTable, stage: DataFrame, run_ts: Column, delta_cols: Sequence[str] = (), tie: Sequence[str] = ()
) -> list[int]:
    """``insert_update_delete`` of a full feed into ``table``; gives the buckets rewritten.

    A bucket whose live rows have the digest of its part of the feed stays as it is. The digests need keys and row hashes only and are
    reduced before they are shuffled, so a feed in which little has changed moves few rows. (Repeated feed rows change a
    digest, and their bucket is merged.)
    """
    keys = list(table.keys)
    load = lambda several: lambda t, s: insert_update_delete(t, s, keys, run_ts, delta_cols, tie, several=several)
    if not table.exists():
        return table.merge(stage, load(None))
    if len(stage.take(2)) < 2:
        return table.merge(stage, load(False))
    sides = [stage.select(*keys, row_hash(*stage.columns).alias("meta_row_hash")), live_rows(table.read())]
    new, old = (range_digests(side, table.bucket(), [*keys, "meta_row_hash"]) for side in sides)
    same = F.lit(True)
    for c in ("_range", "n", "a", "b"):
        same = same & new[c].eqNullSafe(old[c])
    differ = new.join(old, same, "left_anti").select("_range").union(old.join(new, same, "left_anti").select("_range"))
    return table.merge(stage, load(True), touched=table.listed(differ))


def merge_changed(
    table: BucketedTable,
    source: DataFrame,
    apply: Callable[[DataFrame | None, DataFrame], DataFrame],
    hashes: dict[str, Sequence[str]],
    among: Column | None = None,
) -> list[int]:
    """``apply`` (a merge by the table's keys that alters nothing where the hashes agree) on the buckets that need it; gives these buckets.

    ``hashes`` maps hash columns of the table to the source columns they are made of; ``among`` restricts the target rows they are compared
    with, such as the current versions of a dimension. Keys and hashes alone are compared, so a source that repeats most of
    the table rewrites the buckets of what is new in it.
    """
    if not table.exists():
        return table.merge(source, apply)
    held = table.read().filter(among) if among is not None else table.read()
    held = held.select(*[F.col(c).alias(f"t_{c}") for c in [*table.keys, *hashes]])
    brought = source.select(*table.keys, *[row_hash(*columns).alias(c) for c, columns in hashes.items()])
    same = F.lit(True)
    for c in [*table.keys, *hashes]:
        same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    return table.merge(source, apply, touched=table.touched_by(brought.join(held, same, "left_anti")))


def live_rows(target: DataFrame) -> DataFrame:
    """The view readers see: soft-deleted rows hidden."""
    return target.filter(~F.col("meta_is_deleted"))


def truncate_load(stage: DataFrame, keys: Sequence[str], delta_cols: Sequence[str], run_ts: Column) -> DataFrame:
    """Full replacement, still one row per key."""
    return insert_update(None, stage, keys, delta_cols, run_ts, tie=[c for c in stage.columns if c not in keys])


def insert_absent(target: DataFrame, stage: DataFrame, run_ts: Column) -> DataFrame:
    """Rows whose content is not yet in the target, once each; nothing is ever updated.

    The row hash narrows the lookup, the compared columns decide.
    """
    names = stage.columns
    source = with_meta(stage.distinct(), run_ts, names)
    same = F.col("s.meta_row_hash") == F.col("t.meta_row_hash")
    for c in names:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    absent = source.alias("s").join(target.alias("t"), same, "left_anti")
    return target.unionByName(absent.select(*target.columns))


def brand_merge(
    target: DataFrame, stages: dict[str, DataFrame], keys: Sequence[str], run_ts: Column
) -> DataFrame:
    """One stage per brand, merged with an unconditional update on every match."""
    out = target
    for brand, stage in stages.items():
        names = stage.columns
        source = latest_by(stage, keys, [c for c in names if c not in keys]).select(
            "*",
            F.lit(0).alias("hvr_is_deleted"),
            run_ts.alias("hvr_change_time"),
            F.lit(brand).alias("meta_row_source"),
        )
        out = apply_merge(
            out,
            source,
            keys,
            matched=lambda t, s, names=names: {
                c: s(c) for c in [*names, "hvr_is_deleted", "hvr_change_time", "meta_row_source"]
            },
            unique_source=True,
        )
    return out


def merge_with_delete(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    delete_flag: str,
    update_cols: Sequence[str],
    update_when: Callable | None = None,
) -> DataFrame:
    """Merge whose flagged matches disappear from the target; flagged new keys are not inserted."""
    merged = apply_merge(
        target,
        source.filter(~F.col(delete_flag)),
        keys,
        matched=lambda t, s: {c: s(c) for c in update_cols},
        update_when=update_when,
    )
    doomed = source.filter(F.col(delete_flag)).select(*[F.col(k).alias(f"d_{k}") for k in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"d_{key}"))
    return merged.join(doomed, same, "left_anti")


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], assignments: dict[str, Callable], where=None
) -> DataFrame:
    """UPDATE ... FROM: rewrite columns of matching rows; a second match for a row is an error."""
    return apply_merge(
        target,
        source,
        keys,
        matched=lambda t, s: {c: f(t, s) for c, f in assignments.items()},
        update_when=where,
        insert=False,
    )


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """DELETE with SQL semantics: only rows for which the condition is true go."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def restate_window(target: DataFrame, fresh: DataFrame, day_col: str, as_of: Column, days: int) -> DataFrame:
    """Replace the last ``days`` days of a table by newly computed rows."""
    start = F.date_sub(F.to_date(as_of), days)
    return delete_where(target, F.col(day_col) >= start).unionByName(
        fresh.filter(F.col(day_col) >= start).select(*target.columns)
    )


def replace_groups(target: DataFrame, delta: DataFrame, group: Sequence[str]) -> DataFrame:
    """Drop every target row of the groups the delta holds, before the delta is merged."""
    groups = delta.select(*[F.col(c).alias(f"g_{c}") for c in group]).distinct()
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"g_{c}"))
    return target.join(groups, same, "left_anti")


def sql_target_merge(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge whose keys compare as text with NULL equal to '', updating every match."""
    names = source.columns
    plain = [f"_k{i}" for i in range(len(keys))]
    flat = lambda df: df.select(
        "*", *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(p) for k, p in zip(keys, plain)]
    )
    merged = apply_merge(
        flat(target), flat(source), plain, matched=lambda t, s: {c: s(c) for c in names if c not in keys}
    )
    return merged.select(*target.columns)


def effective_rates(
    rates: DataFrame,
    keys: Sequence[str],
    start: str,
    gap: str = "INTERVAL '0.001' SECOND",
    open_end: str = "9999-12-31 00:00:00",
    first_start: str = "1900-01-01 00:00:00",
) -> DataFrame:
    """Dated rates as ranges: each ends just before the next starts; the first one reaches back to 1900."""
    from tidemart.operators.scan import Scan, ordered_scan

    kind = dict(rates.dtypes)[start]
    scanned = ordered_scan(
        rates, keys, [start], [Scan("_next", "lead", start), Scan("_rn", "number")]
    )
    return scanned.select(
        *rates.columns,
        F.when(F.col("_rn") == 1, F.lit(first_start).cast(kind)).otherwise(F.col(start)).alias("effective_start"),
        F.coalesce((F.col("_next") - F.expr(gap)).cast(kind), F.lit(open_end).cast(kind)).alias("effective_end"),
    ).withColumn("is_current", F.col("effective_end") == F.lit(open_end).cast(kind))


def evolve(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append with schema evolution: new columns are added, missing ones become NULL."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def rescue(incoming: DataFrame, declared: dict[str, str], rescued: str = "_rescued_data") -> DataFrame:
    """Declared columns cast safely; everything else, and values that did not cast, as JSON in one column."""
    extra = [c for c in incoming.columns if c not in declared]
    typed = {c: F.col(c).try_cast(kind) for c, kind in declared.items() if c in incoming.columns}
    failed = [
        F.when(typed[c].isNull() & F.col(c).isNotNull(), F.col(c).cast("string")).alias(c) for c in typed
    ]
    spill = F.to_json(F.struct(*failed, *[F.col(c) for c in extra]))
    return incoming.select(
        *[typed.get(c, F.lit(None).cast(kind)).alias(c) for c, kind in declared.items()],
        F.when(spill != "{}", spill).alias(rescued),
    )
