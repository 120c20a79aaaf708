"""Exact distinct counts that add up over grains and periods.

Counts of distinct members cannot be summed, but sets of members can be united. Members get dense numbers; per finest grain and
block of 32,768 numbers one bitmap holds who was there (Spark's bitmap aggregates). Any coarser grain, cube or period total unites bitmaps
and counts their bits, without reading the rows again. A block is its own group, so a grain with all members is many tasks' work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys
from tidemart.operators.scan import Scan, ordered_scan


def numbered_members(df: DataFrame, member: str, out: str = "_number", **limits: int) -> DataFrame:
    """Each distinct member (not null) and its number, from 1 without a gap; a large list is numbered in slices."""
    members = df.select(member).filter(F.col(member).isNotNull()).distinct()
    return ordered_scan(members, [], [member], [Scan(out, "number")], **limits)


def member_bitmaps(df: DataFrame, grain: Sequence[str], number: str) -> DataFrame:
    """grain, block, members: one bitmap per grain and block of numbers (null numbers are in none)."""
    known = df.filter(F.col(number).isNotNull())
    placed = known.select(*grain, F.bitmap_bucket_number(F.col(number).cast("long")).alias("block"), F.bitmap_bit_position(F.col(number).cast("long")).alias("_bit"))
    return placed.groupBy(*grain, "block").agg(F.bitmap_construct_agg("_bit").alias("members"))


def base_bitmaps(df: DataFrame, grain: Sequence[str], member: str, **limits: int) -> DataFrame:
    """The base table of a member column of any type: members are numbered first."""
    numbers = numbered_members(df, member, **limits)
    pairs = df.select(*grain, member).filter(F.col(member).isNotNull()).distinct()
    return member_bitmaps(join_keys(pairs, numbers, [member]), grain, "_number")


def rolled_up(base: DataFrame, grain: Sequence[str | Column], out: str) -> DataFrame:
    """Distinct members per coarser grain; expressions in it (the quarter of a month) give period totals."""
    columns = [F.col(g) if isinstance(g, str) else g for g in grain]
    united = base.groupBy(*columns, "block").agg(F.bitmap_or_agg("members").alias("members"))
    names = [c for c in united.columns if c not in ("block", "members")]
    return united.groupBy(*names).agg(F.sum(F.bitmap_count("members")).alias(out))


def cubed(base: DataFrame, grain: Sequence[str], out: str, sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Distinct members for every subset of the grain (or the given ones), with ``_set``, the grouping number of GROUPING_ID.

    Columns that a set leaves out are null, as in GROUP BY CUBE.
    """
    n = len(grain)
    chosen = [[g for i, g in enumerate(grain) if not k >> (n - 1 - i) & 1] for k in range(1 << n)] if sets is None else [list(s) for s in sets]
    number = lambda kept: sum(1 << (n - 1 - i) for i, g in enumerate(grain) if g not in kept)
    each = F.explode(F.array(*[F.struct(F.lit(number(kept)).cast("long").alias("_set"), *[(F.col(g) if g in kept else F.lit(None).cast(base.schema[g].dataType)).alias(g) for g in grain]) for kept in chosen]))
    spread = base.select(each.alias("_g"), "block", "members").select("_g.*", "block", "members")
    united = spread.groupBy("_set", *grain, "block").agg(F.bitmap_or_agg("members").alias("members"))
    return united.groupBy("_set", *grain).agg(F.sum(F.bitmap_count("members")).alias(out))


def merged_bitmaps(base: DataFrame, more: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Two base tables over the same numbers as one, as when a day is added to a month."""
    return base.unionByName(more).groupBy(*grain, "block").agg(F.bitmap_or_agg("members").alias("members"))
