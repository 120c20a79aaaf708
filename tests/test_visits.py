"""Stateful event logic against plain sequential code."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemart.operators import visits as V

BASE = dt.datetime(2024, 1, 1)
FORCED = {"hot_rows": 12, "small_bytes": 0}


def fold(rows, seconds):
    out, start = [], {}
    for who, key, ts in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        s = start.get(who)
        if s is None or (ts - s[1]).total_seconds() >= seconds:
            s = (key, ts, (s[2] if s else 0) + 1, 0)
        s = (s[0], s[1], s[2], s[3] + 1)
        start[who] = s
        out.append((who, key, s[3] == 1, s[2], s[3], s[0], s[1]))
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, FORCED])
@pytest.mark.parametrize("span", [2500, 9000])
def test_visit_count(spark, limits, span):
    rnd = random.Random(span)
    rows = [(rnd.choice([1, 1, 1, 2]), i, BASE + dt.timedelta(seconds=rnd.randint(0, span))) for i in range(160)]
    df = spark.createDataFrame(rows, "who int, key int, ts timestamp_ntz")
    got = V.visit_count(df, "who", "ts", "key", **limits)
    cols = ["who", "key", "is_first", "visit_count", "visit_seq", "start_key", "visit_start_datetime"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == fold(rows, 300)


def test_gap_counts_from_the_visit_start(spark):
    rows = [(1, i, BASE + dt.timedelta(minutes=m)) for i, m in enumerate([0, 4, 6, 9])]
    df = spark.createDataFrame(rows, "who int, key int, ts timestamp_ntz")
    got = V.visit_count(df, "who", "ts", "key").orderBy("key").collect()
    assert [r.visit_count for r in got] == [1, 1, 2, 2]
    plain = V.islands(df, ["who"], "ts", ["key"], 300, "n").orderBy("key").collect()
    assert [r.n for r in plain] == [1, 1, 1, 1]


def test_clamped_balance_scenario(spark):
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate([5, -8, 3, -1, -4])], "k int, i int, p long")
    got = V.clamped_balance(df, ["k"], ["i"], "p", "b").orderBy("i").collect()
    assert [r.b for r in got] == [5, 0, 3, 2, 0]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(-9, 9)), min_size=1, max_size=60))
def test_closed_form_equals_fold(spark, ledger):
    df = spark.createDataFrame([(k, i, p) for i, (k, p) in enumerate(ledger)], "k int, i int, p long")
    closed = V.clamped_balance(df, ["k"], ["i"], "p", "b", **FORCED)
    stepped = V.sequential_fold(df, ["k"], ["i"], lambda s, r: max(0, s + r.p), 0, "b", "long")
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, stepped.collect()))


def test_first_foreign_channel_and_known_customer(spark):
    rows = [(1, 1, "own", None), (1, 2, "ad", 7), (1, 3, "mail", None), (2, 1, "own", None)]
    df = spark.createDataFrame(rows, "v int, i int, ch string, c int")
    got = V.visit_channel(df, ["v"], ["i"], "ch", "own", "first").orderBy("v", "i").collect()
    assert [r["first"] for r in got] == [None, "ad", "ad", None]
    got = V.effective_customer(df, "v", ["i"], "c", "eff").orderBy("v", "i").collect()
    assert [r.eff for r in got] == [None, None, 7, None]


@pytest.mark.parametrize("limits", [{}, FORCED])
def test_unknown_visitors_share_one_time_line(spark, limits):
    rows = [(None, i, BASE + dt.timedelta(seconds=100 * i)) for i in range(30)]
    df = spark.createDataFrame(rows, "who int, key int, ts timestamp_ntz")
    got = V.visit_count(df, "who", "ts", "key", **limits).orderBy("key").collect()
    assert [r.visit_count for r in got] == [i // 3 + 1 for i in range(30)]
