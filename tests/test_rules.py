"""Rules at their edges: overlapping versions, two sources with one key, first loads, NULL groups, signs, accents."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemart import session
from tidemart.functions import semantics as S
from tidemart.functions import text as X
from tidemart.operators import history as H
from tidemart.operators import joins as J
from tidemart.operators import reshape as R
from tidemart.operators.scan import Scan, dense_ranks, ordered_scan
from tidemart.operators.watermark import adaptive_look_back


def at(*parts):
    return dt.datetime(*parts)


@pytest.mark.parametrize("strategy", ["range", "scan", "auto"])
@pytest.mark.parametrize("half_open", [True, False])
def test_overlapping_versions_give_one_row(spark, strategy, half_open):
    dim = spark.createDataFrame([("a", 1, 100, "long"), ("a", 10, 20, "inner"), ("a", 15, 30, "later"), ("a", 40, 40, "point"), ("b", 1, 5, "b"), ("a", 60, 50, "never")], "k string, s int, e int, v string")
    facts = [("a", t) for t in range(0, 103)] + [("b", 3), ("b", 5), ("b", 6), (None, 3)]
    rows = J.effective_lookup(spark.createDataFrame(facts, "k string, t int"), dim, ["k"], "t", "s", "e", ["v"], half_open=half_open, strategy=strategy).collect()

    def want(k, t):
        held = [(s, e, v) for kk, s, e, v in [tuple(r) for r in dim.collect()] if kk == k and s <= t and (t < e if half_open else t <= e)]
        return max(held)[2] if held else None

    assert len(rows) == len(facts) and all(r.v == want(r.k, r.t) for r in rows)


def test_versions_of_dates_and_moments(spark):
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (1, dt.date(2024, 1, 10), dt.date(2024, 1, 12))], "k int, s date, e date")
    cut = sorted(tuple(r)[1:] for r in J.disjoint_versions(days, ["k"], "s", "e").collect())
    assert cut == [(dt.date(2024, 1, 1), dt.date(2024, 1, 9)), (dt.date(2024, 1, 10), dt.date(2024, 1, 12)), (dt.date(2024, 1, 13), dt.date(2024, 1, 31))]
    moments = spark.createDataFrame([(1, at(2024, 1, 1), at(9999, 12, 31)), (1, at(2024, 2, 1), at(9999, 12, 31))], "k int, s timestamp_ntz, e timestamp_ntz")
    first = min(tuple(r)[1:] for r in J.disjoint_versions(moments, ["k"], "s", "e").collect())
    assert first == (at(2024, 1, 1), at(2024, 1, 31, 23, 59, 59, 999999))


def test_consolidation_keeps_sources_apart(spark):
    schema = "data_source_id int, company_id int, k long, meta_original_k long, v int, chg int"
    target = spark.createDataFrame([(1, 10, 510, 5, 1, 1), (2, 10, 510, 5, 2, 1), (1, 10, None, 0, 3, 1), (1, 10, None, None, 4, 1)], schema)
    delta = [spark.createDataFrame([(1, 10, 510, 5, 7, 2), (1, 10, None, 0, 8, 2)], schema), spark.createDataFrame([(2, 10, 510, 5, 9, 1), (2, 10, None, None, 6, 1)], schema)]
    got = sorted((r.data_source_id, r.meta_original_k if r.meta_original_k is not None else -1, r.v) for r in H.consolidate(target, delta, ["k"], "chg").collect())
    assert got == [(1, -1, 4), (1, 0, 8), (1, 5, 7), (2, -1, 6), (2, 5, 2)]


def test_history_of_null_keys_is_added_once(spark):
    schema = "data_source_id int, meta_original_k long, effective_start_datetime timestamp_ntz, effective_end_datetime timestamp_ntz, is_current boolean"
    old = spark.createDataFrame([(1, None, at(2024, 1, 1), at(9999, 12, 31), True)], schema)
    new = spark.createDataFrame([(1, None, at(2024, 2, 1), at(9999, 12, 31), True), (2, None, at(2024, 1, 1), at(9999, 12, 31), True)], schema)
    once = H.consolidate_history(old, [new], ["k"])
    twice = H.consolidate_history(once, [new], ["k"])
    assert once.count() == twice.count() == 3
    assert sorted((r.data_source_id, r.is_current) for r in twice.collect()) == [(1, False), (1, True), (2, True)]


def test_look_back_counts_from_the_last_load(spark):
    cases = [
        (at(2024, 1, 1, 0, 0), at(2024, 1, 1, 7, 0), at(2024, 6, 1), at(2023, 12, 30, 23, 0)),
        (at(2024, 1, 1, 0, 0), at(2024, 1, 1, 2, 0), at(2024, 6, 1), at(2023, 12, 31, 18, 0)),
        (at(2024, 1, 1, 0, 0), at(2024, 1, 1, 0, 30), at(2024, 6, 1), at(2023, 12, 31, 21, 0)),
        (at(2024, 1, 1, 0, 0), at(2024, 1, 1, 0, 30), at(2020, 1, 1), at(2020, 1, 1)),
        (None, at(2024, 1, 1, 0, 0), at(2020, 1, 1), at(1900, 1, 1)),
        (at(2024, 1, 1, 0, 0), at(2024, 1, 1, 0, 30), None, at(2023, 12, 31, 21, 0)),
    ]
    df = spark.createDataFrame(cases, "loaded timestamp_ntz, now timestamp_ntz, newest timestamp_ntz, want timestamp_ntz")
    rows = df.select(adaptive_look_back(F.col("loaded"), F.col("now"), F.col("newest")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in rows)


def test_texts_and_signs(spark):
    long = "a" * 1_100_000
    row = spark.range(1).select(
        S.initcap_any(F.lit("élan CAFÉ-au lait 3rd o'neil")).alias("a"), F.length(S.initcap_any(F.lit(long))).alias("n"),
        S.truncated(F.lit(-1.5)).alias("t"), S.truncated(F.lit(1.29), 1).alias("u"), S.truncated(F.lit(-1.29), 1).alias("v"),
    ).first()
    assert (row.a, row.n) == ("Élan Café-Au Lait 3rd O'Neil", len(long))
    assert (float(row.t), float(row.u), float(row.v)) == (-1.0, 1.2, -1.2)


def test_reversed_ranges_have_no_days(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3), dt.date(2024, 1, 1)), (dt.date(2024, 1, 1), dt.date(2024, 1, 2)), (None, dt.date(2024, 1, 1))], "a date, b date")
    assert [r.d for r in X.date_range(df, "a", "b", "d").collect()] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert X.month_range(df, "a", "b", "m").count() == 2  # both dates of the reversed row are in one month


def test_regions_are_upper_case(spark):
    df = spark.createDataFrame([(1, "tx-", "au"), (2, "ny", "us"), (3, None, "us")], "id int, state string, country string")
    mapping = spark.createDataFrame([("TX-", "AU", "TX", "AU")], "state string, country string, good_state string, good_country string")
    got = {r.id: (r.state, r.country) for r in X.corrected_region(df, mapping, "state", "country").collect()}
    assert got == {1: ("TX", "AU"), 2: ("NY", "US"), 3: (None, "US")}


def test_null_groups_stay(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r.g: r.m for r in R.exact_percentile(df, ["g"], "v", 0.5, "m").collect()}
    assert got == {None: 2.0, "a": 5.0}
    ranks = {(r.g, r.v): r.r for r in dense_ranks(df, ["g"], "v", "r").collect()}
    assert ranks == {(None, 3.0): 1, (None, 1.0): 2, ("a", 5.0): 1}


def test_pivots_of_many_keys(spark):
    df = spark.range(30).select((F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    with pytest.raises(ValueError, match="more than 10 keys"):
        R.pivot_all(df, ["g"], "k", "v", max_columns=10)
    got = {r.g: r.m for r in R.pivot_map(df, ["g"], "k", "v", "m").collect()}
    assert got[1]["4"] == 4 and len(got[1]) == 10


def test_a_large_scan_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(3000).select((F.col("id") % 3).alias("k"), "id").mapInPandas(touch, "k long, id long")
    rows = ordered_scan(df, ["k"], ["id"], [Scan("s", "sum", "id")], hot_rows=500, small_bytes=0)
    assert rows.count() == 3000 and seen.value == 3000


def test_shared_folder_is_required_off_local_mode(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        session.shared_dir(Session())


def test_scratch_is_cleared(spark):
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
