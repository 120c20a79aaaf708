"""Slowly changing dimensions and change history."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import history as H
from tidemart.operators import scd as D
from tidemart.operators.joins import key_lookup


def now():
    return F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
END = dt.datetime(9999, 12, 31)
SPEC = D.ScdSpec(("k",), ("one",), ("two",), "at")


def at(day, ms=0):
    return dt.datetime(2024, 1, day) + dt.timedelta(milliseconds=ms)


def events(spark, rows):
    return spark.createDataFrame(rows, "k int, one string, two string, at timestamp_ntz")


def versions(df):
    cols = ["k", "one", "two", "effective_start_datetime", "effective_end_datetime", "is_current"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_mart_dimension_three_events_in_one_batch(spark):
    out = D.scd_mart(None, events(spark, [(1, "a", "x", at(1)), (1, "a", "y", at(2)), (1, "b", "y", at(3))]), SPEC, now())
    # New, then type 2, then type 1: the last type-1 value rewrites all versions.
    assert versions(out) == [
        (1, "b", "x", dt.datetime(1900, 1, 1), at(2, -1), False),
        (1, "b", "y", at(2), END, True),
    ]
    late = D.scd_mart(out, events(spark, [(1, "z", "z", at(1, 5))]), SPEC, now())
    assert versions(late) == versions(out)
    both = D.scd_mart(out, events(spark, [(1, "c", "w", at(5)), (2, "q", "q", at(5))]), SPEC, now())
    assert versions(both) == [
        (1, "c", "w", at(5), END, True),
        (1, "c", "x", dt.datetime(1900, 1, 1), at(2, -1), False),
        (1, "c", "y", at(2), at(5, -1), False),
        (2, "q", "q", dt.datetime(1900, 1, 1), END, True),
    ]


def test_load_dimension_has_no_gap_and_one_event_per_batch(spark):
    first = D.scd_load(None, events(spark, [(1, "a", "x", at(1)), (1, "a", "y", at(2))]), SPEC, now())
    out = D.scd_load(first, events(spark, [(1, "b", "z", at(4)), (1, "c", "w", at(3))]), SPEC, now())
    rows = sorted(tuple(r) for r in out.select("two", "one", "meta_from_datetime", "meta_to_datetime", "meta_is_current").collect())
    assert rows == [
        ("y", "b", dt.datetime(1970, 1, 1), at(4), False),
        ("z", "b", at(4), dt.datetime(2065, 1, 24, 5, 20), True),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_mart_dimension_ranges_are_contiguous(spark, seed):
    rnd = random.Random(seed)
    feed = [(rnd.randint(1, 5), rnd.choice("ab"), rnd.choice("xyz"), at(1, i * 1000)) for i in range(120)]
    out = None
    for part in (feed[:50], feed[50:80], feed[80:]):
        out = D.scd_mart(out, events(spark, part), SPEC, now())
    by_key = {}
    for row in versions(out):
        by_key.setdefault(row[0], []).append(row[3:])
    for ranges in by_key.values():
        ranges.sort()
        assert sum(current for *_, current in ranges) == 1 and ranges[-1][2]
        for (_, end, _), (start, _, _) in zip(ranges, ranges[1:]):
            assert start - end == dt.timedelta(milliseconds=1)


def _feed(seed, n=150):
    rnd = random.Random(seed)
    return [(rnd.randint(1, 4), at(1, i * 1000), rnd.choice("xyz"), rnd.random() < 0.15) for i in range(n)]


def _history(spark, feed, parts):
    size, out = -(-len(feed) // parts), None
    for i in range(parts):
        chunk = feed[i * size : (i + 1) * size]
        archive = spark.createDataFrame([(k, t, v) for k, t, v, gone in chunk if not gone] or [(0, at(1), "")], "k int, ts timestamp_ntz, v string").filter("k > 0")
        log = spark.createDataFrame([(k, t) for k, t, v, gone in chunk if gone] or [(0, at(1))], "k int, datetime_deleted timestamp_ntz").filter("k > 0")
        deletes = H.delete_rows(log, ["k"], "ts", "deleted", archive)
        out = H.change_history(out, archive, deletes, ["k"], "ts", None, now())
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_incremental_history_equals_one_load(spark, seed):
    feed = _feed(seed)
    cols = ["k", "v", "effective_start_datetime", "effective_end_datetime", "is_current", "meta_row_is_deleted"]
    whole = sorted(map(repr, _history(spark, feed, 1).select(*cols).collect()))
    parts = sorted(map(repr, _history(spark, feed, 3).select(*cols).collect()))
    assert parts == whole


def test_incremental_history_equals_rebuild_apart_from_the_millisecond(spark):
    feed = [(k, t, v, False) for k, t, v, _ in _feed(5)]
    history = _history(spark, feed, 2)
    kept, last = [], {}
    for k, t, v, _ in feed:
        if last.get(k) != v:
            kept.append((k, t, v))
        last[k] = v
    rebuilt = H.rebuild_history(spark.createDataFrame(kept, "k int, ts timestamp_ntz, v string"), ["k"], "ts")
    shift = F.when(F.col("is_current"), F.col("effective_end_datetime")).otherwise(
        F.col("effective_end_datetime") - F.expr("INTERVAL '0.001' SECOND")
    )
    a = sorted(map(tuple, history.select("k", "v", "effective_start_datetime", "effective_end_datetime").collect()))
    b = sorted(map(tuple, rebuilt.select("k", "v", "effective_start_datetime", shift).collect()))
    assert a == b


def test_update_and_delete_at_one_moment(spark):
    archive = spark.createDataFrame([(1, at(1), "a"), (1, at(2), "b")], "k int, ts timestamp_ntz, v string")
    log = spark.createDataFrame([(1, at(2))], "k int, datetime_deleted timestamp_ntz")
    out = H.change_history(None, archive, H.delete_rows(log, ["k"], "ts", "deleted", archive), ["k"], "ts", None, now())
    rows = [tuple(r) for r in out.select("v", "meta_row_is_deleted", "is_current").orderBy("effective_start_datetime").collect()]
    assert rows == [("a", False, False), ("a", True, True)]


def test_first_version_starts_at_the_second_date(spark):
    archive = spark.createDataFrame(
        [(1, at(5), at(2), "a"), (1, at(7), at(2), "b")], "k int, ts timestamp_ntz, added timestamp_ntz, v string"
    )
    out = H.change_history(None, archive, None, ["k"], "ts", "added", now())
    assert sorted(r[0] for r in out.select("effective_start_datetime").collect()) == [at(2), at(7)]


def test_late_version_is_fitted_in(spark):
    schema = "k int, effective_start_datetime timestamp_ntz, effective_end_datetime timestamp_ntz, is_current boolean"
    target = spark.createDataFrame([(1, at(1), at(5, -1), False), (1, at(5), END, True), (2, at(1), END, True)], schema)
    late = spark.createDataFrame([(1, at(3), END, True)], schema)
    out = sorted(tuple(r) for r in H.consolidate_history(target, [late], ["k"]).collect())
    assert out == [(1, at(1), at(3, -1), False), (1, at(3), at(5, -1), False), (1, at(5), END, True), (2, at(1), END, True)]


def test_consolidation_of_sources(spark):
    schema = "id long, other long, chg timestamp_ntz"
    a = spark.createDataFrame([(7, 0, at(2)), (7, 3, at(3)), (0, 1, at(2)), (8, 9, at(1))], schema)
    out = H.consolidate_delta(a, 10, [40], "id", ["other"], "chg", F.lit("2024-01-02 00:04:00").cast("timestamp_ntz"))
    rows = {tuple(r) for r in out.select("data_source_id", "company_id", "id", "other", "meta_original_id").collect()}
    assert rows == {(10, 40, 740, 340, 7), (10, 40, None, 140, 0)}
    low = F.lit("2024-01-01").cast("timestamp_ntz")
    columns = {k: H.consolidate_delta(a, 10, [40], "id", ["other"], "chg", low, kind=k).columns[:3] for k in H.TABLE_KINDS}
    assert columns["nsync"] == ["id", "other", "chg"] and columns["has_value_column"] == ["company_id", "id", "other"]
    assert columns["has_object_column_with_null"] == ["data_source_id", "id", "other"]


def test_key_lookup_miss_and_missing_moment(spark):
    dim = spark.createDataFrame(
        [(1, 100, dt.datetime(2024, 1, 1), at(9)), (1, 101, at(9, 1), END)],
        "bk int, sk int, effective_start_datetime timestamp_ntz, effective_end_datetime timestamp_ntz",
    )
    stage = spark.createDataFrame(
        [(1, 1, at(5)), (2, 1, dt.datetime(2020, 1, 1)), (3, 1, None), (4, 2, at(5)), (5, None, at(5))],
        "id int, bk int, ev timestamp_ntz",
    )
    want = {1: 100, 2: -1, 3: 101, 4: -1, 5: -1}
    for strategy in ("range", "scan"):
        got = key_lookup(stage, dim, {"bk": "bk"}, "sk", "dim_key", "ev", now(), strategy=strategy)
        assert {r.id: r.dim_key for r in got.collect()} == want


def test_surrogate_keys_are_dense(spark):
    df = spark.createDataFrame([(x,) for x in "dbcae" * 1], "bk string")
    got = D.surrogate_keys(df, ["bk"], "sk", 10, hot_rows=2, small_bytes=0)
    assert {r.bk: r.sk for r in got.collect()} == {"a": 11, "b": 12, "c": 13, "d": 14, "e": 15}
