"""Distinct counts from bitmaps against counts of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemart.operators import distinct as D


@pytest.fixture(scope="module")
def rows(spark):
    n = spark.range(60_000)
    m = F.pmod(F.xxhash64("id"), F.lit(100_000))
    return n.select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 7).cast("string")).alias("g"), (F.col("id") % 12).cast("int").alias("month"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("m"), m.cast("string"))).alias("member"),
    ).repartition(6)


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 5000, "small_bytes": 0}])
def test_cube_and_periods(spark, rows, limits):
    base = D.base_bitmaps(rows, ["g", "month"], "member", **limits)
    got = {(r["_set"], r.g, r.month): r.n for r in D.cubed(base, ["g", "month"], "n").collect()}
    want = rows.cube("g", "month").agg(F.grouping_id().alias("s"), F.count_distinct("member").alias("n")).collect()
    assert got == {(r.s, r.g, r.month): r.n for r in want if r.n}
    quarter = F.floor(F.col("month") / 3).alias("q")
    assert {(r.q, r.n) for r in D.rolled_up(base, [quarter], "n").collect()} == {(r.q, r.n) for r in rows.groupBy(quarter).agg(F.count_distinct("member").alias("n")).collect()}
    some = D.cubed(base, ["g", "month"], "n", sets=[["month"], []]).collect()
    assert {r["_set"] for r in some} == {2, 3}


def test_base_tables_merge(rows):
    numbers = D.numbered_members(rows, "member")
    pairs = rows.join(numbers, "member")
    parts = [D.member_bitmaps(pairs.filter(c), ["g"], "_number") for c in ("month < 5", "month >= 4")]
    got = D.rolled_up(D.merged_bitmaps(*parts, ["g"]), ["g"], "n").collect()
    assert {(r.g, r.n) for r in got} == {(r.g, r.n) for r in rows.groupBy("g").agg(F.count_distinct("member").alias("n")).collect()}


def test_empty_and_numbers_without_a_gap(rows):
    assert D.cubed(D.base_bitmaps(rows.limit(0), ["g"], "member"), ["g"], "n").count() == 0
    numbers = D.numbered_members(rows, "member").agg(F.min("_number"), F.max("_number"), F.count_distinct("_number")).first()
    assert numbers[0] == 1 and numbers[1] == numbers[2] == rows.select(F.count_distinct("member")).first()[0]
