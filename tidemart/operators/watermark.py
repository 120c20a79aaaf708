"""High-watermarks, changed keys and snapshots for incremental runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys, ntz
from tidemart.functions.text import zoned_instant
from tidemart.operators.merge import apply_merge
from tidemart.sources.tables import VersionedTable

NEVER = "1900-01-01 00:00:00"
STATE_COLUMNS = (
    "table_name string, dependent_table_name string, high_watermark_datetime timestamp_ntz, "
    "new_high_watermark_datetime timestamp_ntz"
)


@dataclass(frozen=True)
class Dependency:
    """A source whose newest ``column`` bounds a run; a naive column needs its zone."""

    name: str
    df: DataFrame
    column: str
    zone: str | None = None

    def newest(self) -> DataFrame:
        top = F.max(self.column)
        if self.zone:
            top = zoned_instant(top, self.zone)
        return self.df.agg(top.cast("timestamp_ntz").alias("high")).select(
            F.lit(self.name).alias("dependent_table_name"), "high"
        )


def highs(dependencies: Sequence[Dependency]) -> DataFrame:
    """One row per dependency with its newest moment."""
    return reduce(lambda a, b: a.unionByName(b), [d.newest() for d in dependencies])


def common_high(dependencies: Sequence[Dependency]) -> DataFrame:
    """The moment up to which all dependencies are complete: the least of their newest moments."""
    return highs(dependencies).agg(F.min("high").alias("high_watermark"))


def prepare(state: DataFrame, table: str, dependencies: Sequence[Dependency]) -> DataFrame:
    """State with the new highs recorded, before the run; the committed highs stay as they are."""
    own = state.sparkSession.range(1).select(
        F.lit(table).alias("table_name"),
        F.lit(None).cast("string").alias("dependent_table_name"),
        F.lit(None).cast("timestamp_ntz").alias("new_high_watermark_datetime"),
    )
    news = highs(dependencies).select(
        F.lit(table).alias("table_name"),
        "dependent_table_name",
        F.col("high").alias("new_high_watermark_datetime"),
    )
    return apply_merge(
        state,
        news.unionByName(own),
        ["table_name", "dependent_table_name"],
        matched=lambda t, s: {
            "new_high_watermark_datetime": F.coalesce(
                s("new_high_watermark_datetime"), t("new_high_watermark_datetime")
            )
        },
        insert={
            "table_name": F.col("table_name"),
            "dependent_table_name": F.col("dependent_table_name"),
            "high_watermark_datetime": ntz(NEVER),
            "new_high_watermark_datetime": F.col("new_high_watermark_datetime"),
        },
    )


def commit(state: DataFrame, table: str, target: DataFrame, updated: str = "meta_update_datetime") -> DataFrame:
    """State after a successful run: new highs count, the table itself advances to its newest update."""
    mine = F.lower("table_name") == table.lower()
    itself = mine & F.col("dependent_table_name").isNull()
    newest = target.agg(F.max(updated).cast("timestamp_ntz")).scalar()
    advanced = (
        F.when(itself, F.coalesce(newest, F.col("high_watermark_datetime")))
        .when(mine, F.coalesce("new_high_watermark_datetime", "high_watermark_datetime"))
        .otherwise(F.col("high_watermark_datetime"))
    )
    return state.withColumn("high_watermark_datetime", advanced)


def get_watermark(state: DataFrame, table: str, dependency: str | None = None) -> DataFrame:
    """One-row frame with the committed high of (table, dependency); never run means 1900-01-01."""
    hit = (F.lower("table_name") == table.lower()) & F.lower("dependent_table_name").eqNullSafe(
        F.lit(dependency.lower() if dependency else None)
    )
    return state.filter(hit).agg(
        F.coalesce(F.max("high_watermark_datetime"), ntz(NEVER)).alias("watermark")
    )


def push_back(state: DataFrame, table: str, to: Column) -> DataFrame:
    """Lower the committed highs of a table, so that the next run restates from there."""
    lower = (F.lower("table_name") == table.lower()) & (F.col("high_watermark_datetime") > to)
    return state.withColumn(
        "high_watermark_datetime", F.when(lower, to).otherwise(F.col("high_watermark_datetime"))
    )


def run_incremental(
    spark: SparkSession,
    state: VersionedTable,
    table: str,
    dependencies: Sequence[Dependency],
    target: VersionedTable,
    transform: Callable[[Callable[[str | None], object]], DataFrame],
    updated: str = "meta_update_datetime",
) -> DataFrame:
    """Read the low marks, record the new highs, run, and commit the highs only when the run succeeded."""
    before = state.read() if state.exists() else spark.createDataFrame([], STATE_COLUMNS)
    state.publish(prepare(before, table, dependencies))
    marked = state.read()

    def low(dependency: str | None = None):
        return get_watermark(marked, table, dependency).first()["watermark"]

    target.publish(transform(low))
    result = target.read()
    state.publish(commit(marked, table, result, updated))
    return result


def changed_keys(
    key: str,
    low: dict[str, object],
    itself: tuple[DataFrame, str] | None,
    dependencies: Sequence[tuple[str, DataFrame, str, DataFrame | None, str | None]],
    exceptions: DataFrame | None = None,
    all_keys: DataFrame | None = None,
    full_refresh: bool = False,
) -> DataFrame:
    """Keys a run has to rebuild.

    Each dependency is ``(name, frame, updated column, bridge to the key or None, bridge column)``. Keys come from own
    edits, changed dependencies and rows that failed validation last time. On a full refresh all keys count.
    """
    if full_refresh and all_keys is not None:
        return all_keys.select(key).distinct()
    parts = []
    if itself is not None:
        frame, updated = itself
        parts.append(frame.filter(F.col(updated) > F.lit(low["self"])).select(key))
    for name, frame, updated, bridge, via in dependencies:
        moved = frame.filter(F.col(updated) > F.lit(low[name]))
        if bridge is None:
            parts.append(moved.select(key))
        else:
            parts.append(bridge.join(moved.select(via).distinct(), via, "left_semi").select(key))
    if exceptions is not None:
        parts.append(exceptions.filter("meta_is_current_excp").select(key))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def adaptive_look_back(last_load: Column, now: Column, source_max: Column) -> Column:
    """Start of the look-back, counted back from the last load: 3 h right after it, three times its age, or the age plus 18 h when it is old.

    Everything since 1900 without a load before, and never later than the newest row of the source.
    """
    age = F.timestamp_diff("MINUTE", F.date_trunc("minute", last_load), F.date_trunc("minute", now))
    back = F.when(age < 60, F.lit(-180)).when(age >= 360, -(age + 1080)).otherwise(-3 * age)
    since = F.coalesce(F.timestamp_add("MINUTE", back.cast("int"), last_load), ntz(NEVER))
    return F.least(since, source_max)


def look_back(low: Column, part: str, amount: int) -> Column:
    return F.timestamp_add(part.upper(), F.lit(amount), low)


def source_high(df: DataFrame, column: str, kind: str, last: Column | None = None) -> DataFrame:
    """New high of a source column: plain maximum, row version as hex, text moment, or moment with offset."""
    c = F.col(column)
    value = {
        "max": lambda: F.max(c).cast("string"),
        "rowversion": lambda: F.concat(F.lit("0x"), F.hex(F.max(c))),
        "text_datetime": lambda: F.max(F.try_to_timestamp(c)).cast("string"),
        "offset_datetime": lambda: F.max(c.cast("timestamp")).cast("string"),
    }[kind]()
    return df.agg((F.coalesce(value, last) if last is not None else value).alias("high_watermark"))


def insert_since_target(
    target: DataFrame, source: DataFrame, keys: Sequence[str], ts: str, look_back_minutes: int = 5
) -> DataFrame:
    """Append source rows newer than the target's own newest moment (less a look-back) that it does not hold."""
    low = target.agg(
        F.coalesce(F.timestamp_add("MINUTE", F.lit(-look_back_minutes), F.max(ts)), ntz(NEVER))
    ).scalar()
    recent = source.filter(F.col(ts) >= low)
    return target.unionByName(join_keys(recent, target.select(*keys), keys, "left_anti").select(*target.columns))


def snapshot(snapshots: DataFrame | None, current: DataFrame, day: Column, keep_months: int) -> DataFrame:
    """Append today's copy and drop copies older than ``keep_months``; a rerun replaces the day's copy."""
    today = current.withColumn("snapshot_date", day)
    if snapshots is None:
        return today
    kept = snapshots.filter(
        (F.col("snapshot_date") >= F.add_months(day, -keep_months)) & (F.col("snapshot_date") != day)
    )
    return kept.unionByName(today)


def retain_days(snapshots: DataFrame, day_col: str, day: Column, days: int) -> DataFrame:
    """Keep the last ``days`` days of a feed snapshot."""
    return snapshots.filter(F.col(day_col) >= F.date_sub(day, days))


def state_changes(now: DataFrame, then: DataFrame, keys: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """Rows whose compared columns differ between two states of a table, with both values."""
    a = now.select(*keys, *[F.col(c).alias(f"new_{c}") for c in compared])
    b = then.select(*keys, *[F.col(c).alias(f"old_{c}") for c in compared])
    differs = F.lit(False)
    for c in compared:
        differs = differs | ~F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}"))
    return a.join(b, list(keys)).filter(differs)
