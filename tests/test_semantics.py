"""One assertion per dialect difference."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemart.functions import semantics as S
from tidemart.functions import text as X
from tidemart.operators import reshape as R


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r.v for r in df.orderBy(S.ascending("v")).collect()] == [1, 2, None]
    assert [r.v for r in df.orderBy(S.descending("v")).collect()] == [None, 2, 1]


def test_latest_row_null_versions(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (None, 1, "z")], "k int, v int, p string")
    assert {(r.k, r.p) for r in S.latest_by(df, ["k"], ["v"]).collect()} == {(1, "y"), (None, "z")}
    assert {(r.k, r.p) for r in S.latest_by(df, ["k"], ["v"], nulls_newest=True).collect()} == {(1, "x"), (None, "z")}


def test_greatest_least_strict(spark):
    n = F.lit(None).cast("int")
    r = one(spark, S.greatest_strict(F.lit(1), n).alias("a"), S.least_strict(F.lit(1), F.lit(2)).alias("b"))
    assert (r.a, r.b) == (None, 1)


def test_boundaries(spark):
    a, b = F.lit("2024-01-31 23:59:00").cast("timestamp_ntz"), F.lit("2024-02-01 00:01:00").cast("timestamp_ntz")
    parts = ["month", "day", "year", "quarter", "week", "hour", "minute"]
    r = one(spark, *[S.boundaries(p, a, b).alias(p) for p in parts])
    assert tuple(r) == (1, 1, 0, 0, 0, 1, 2)


def test_hash_sees_nulls_and_positions(spark):
    n = F.lit(None).cast("string")
    r = one(spark, S.row_hash(F.lit("a"), n).alias("x"), S.row_hash(n, F.lit("a")).alias("y"), S.row_hash(F.lit("a")).alias("z"))
    assert len({r.x, r.y, r.z}) == 3


def test_division_and_split(spark):
    n = F.lit(None).cast("double")
    r = one(
        spark,
        S.div0(F.lit(4.0), F.lit(0.0)).alias("a"),
        S.div0(F.lit(4.0), n).alias("b"),
        S.div0_null(F.lit(4.0), n).alias("c"),
        S.split_part(F.lit("x-y"), "-", 0).alias("d"),
        S.split_part(F.lit("x-y"), "-", 3).alias("e"),
        S.full_match(F.lit("abc"), "b").alias("f"),
        S.initcap_any(F.lit("o'neil-SMITH x")).alias("g"),
    )
    assert tuple(r) == (0.0, None, 0.0, "x", "", False, "O'Neil-Smith X")


def test_unpivot_drops_nulls_and_url_keeps_last(spark):
    df = spark.createDataFrame([(1, 5, None)], "id int, a int, b int")
    assert R.unpivot(df, ["id"], ["a", "b"], "m", "v").count() == 1
    urls = spark.createDataFrame([("http://x/p?a=1&b=2&a=3#z",)], "u string")
    got = {(r.parameter, r.parameter_value) for r in R.url_parameters(urls, "u").collect()}
    assert got == {("a", "3"), ("b", "2")}


def test_time_slice(spark):
    r = one(spark, S.time_slice(F.lit("2024-01-01 10:44:59").cast("timestamp_ntz"), 30).alias("s"))
    assert r.s == dt.datetime(2024, 1, 1, 10, 30)


def test_texts(spark):
    r = one(
        spark,
        X.without_company(F.lit("12320")).alias("a"),
        X.without_company(F.lit("123")).alias("b"),
        X.without_repeats(F.lit("x | y | x")).alias("c"),
        X.decoded_url(F.lit("a%20b+c")).alias("d"),
        X.decoded_url(F.lit("50%")).alias("e"),
        X.clean_field(F.lit(" a|b&c ")).alias("f"),
        X.standard_zip(F.lit("123456789")).alias("g"),
        X.country_of_shard(F.lit("web_brand_ecom")).alias("h"),
    )
    assert tuple(r) == (123, 123, "x | y", "a b+c", "50%", "a_b_c", "12345-6789", "")


def test_clock_change_days(spark):
    df = spark.range(1)
    days = X.date_range_zoned(df, F.lit("2024-03-09"), F.lit("2024-03-11"), "America/Los_Angeles", "t")
    hours = [r.h for r in days.select(F.date_format("t", "HH").alias("h")).orderBy("t").collect()]
    assert hours == ["08", "08", "07"]


def test_exact_percentile_hot(spark):
    df = spark.createDataFrame([("a", float(i % 17)) for i in range(200)] + [("b", 3.0)], "k string, v double")
    want = {r.k: r.m for r in df.groupBy("k").agg(F.expr("percentile(v, 0.3)").alias("m")).collect()}
    got = R.exact_percentile(df, ["k"], "v", 0.3, "m", hot_rows=4, small_bytes=0)
    assert {r.k: round(r.m, 9) for r in got.collect()} == {k: round(v, 9) for k, v in want.items()}
