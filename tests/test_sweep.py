"""Overlapping versions by a stack sweep, against the moments one by one."""

from __future__ import annotations

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemart.operators import joins as J
from tidemart.operators.scan import HOT_ROWS, key_plan
from tidemart.operators.sweep import cut_versions, held_versions, spans, swept

FORCED = {"hot_rows": 14, "small_bytes": 0}


def brute(rows):
    """{(key, moment): (start, stop)} at every integer moment."""
    out = {}
    for k, a, b in rows:
        for m in range(a, b):
            out[k, m] = max(out.get((k, m), (a, b)), (a, b))
    return out


def spread(got):
    out = {}
    for r in got:
        for m in range(r._at, r._until):
            assert (r.k, m) not in out
            out[r.k, m] = (r.s, r.e)
    return out


def shapes():
    rng = random.Random(3)
    rows = [("nested", i, 100 - i) for i in range(45)] + [("stairs", i * 2, i * 2 + 7) for i in range(40)]
    rows += [("same", 3, 9)] * 5 + [("same", 3, 20), ("same", 3, 4)] + [("long", 0, 200)] + [("long", i, i + 1) for i in range(5, 190, 5)]
    rows += [("crossing", a, a + rng.randint(1, 60)) for a in (rng.randint(0, 120) for _ in range(90))]
    rows += [(None, a, a + rng.randint(1, 9)) for a in (rng.randint(0, 50) for _ in range(40))]
    return rows


@pytest.mark.parametrize("limits", [{}, FORCED, {"hot_rows": 60, "small_bytes": 0}])
def test_held_versions(spark, limits):
    rows = shapes()
    got = held_versions(spark.createDataFrame(rows, "k string, s long, e long"), ["k"], "s", "e", **limits).collect()
    assert spread(got) == brute(rows)
    # Neighbouring pieces of one version are one piece, in slices too.
    ends = {(r.k, r.s, r.e, r._until) for r in got}
    assert not any((r.k, r.s, r.e, r._at) in ends for r in got)


@pytest.mark.parametrize("limits", [{}, FORCED])
def test_without_keys_and_empty(spark, limits):
    rows = [("x", a, b) for _, a, b in shapes()]
    frame = spark.createDataFrame(rows, "k string, s long, e long")
    got = held_versions(frame, [], "s", "e", **limits).withColumn("k", F.lit("x")).collect()
    assert spread(got) == brute(rows)
    assert held_versions(frame.limit(0), ["k"], "s", "e", **limits).count() == 0


@pytest.mark.parametrize("limits", [{}, FORCED])
@pytest.mark.parametrize("half_open", [True, False])
def test_disjoint_versions_of_moments_and_dates(spark, limits, half_open):
    rows = [(k, a, b, f"{k}{a}-{b}") for k, a, b in dict.fromkeys(shapes()) if k]
    day, base = dt.timedelta(days=1), dt.date(2024, 1, 1)
    frame = spark.createDataFrame([(k, base + a * day, base + b * day, v) for k, a, b, v in rows], "k string, s date, e date, v string")
    for kind in ("date", "timestamp_ntz", "timestamp"):
        cast = frame.withColumns({"s": F.col("s").cast(kind), "e": F.col("e").cast(kind)})
        got = J.disjoint_versions(cast, ["k"], "s", "e", half_open, **limits)
        assert got.columns == ["k", "s", "e", "v"]
        found = got.withColumns({"s": F.to_date("s"), "e": F.to_date(F.col("e") if half_open or kind == "date" else F.col("e") + F.expr("INTERVAL 1 MICROSECOND"))}).collect()
        extra = 1 if not half_open and kind == "date" else 0
        out = {}
        for r in found:
            for m in range((r.s - base).days, (r.e - base).days + extra):
                assert (r.k, m) not in out
                out[r.k, m] = r.v
        want = brute([(k, a, b + extra) for k, a, b, _ in rows])
        assert out == {place: f"{place[0]}{a}-{b - extra}" for place, (a, b) in want.items()}


def test_many_nested_versions_of_one_key(spark):
    n = 20_000
    frame = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("s"), (F.lit(3 * n) - F.col("id")).alias("e"))
    begin = time.time()
    got = held_versions(frame, ["k"], "s", "e", hot_rows=4000, small_bytes=0).agg(F.count(F.lit(1)), F.sum(F.col("_until") - F.col("_at"))).first()
    assert tuple(got) == (2 * n - 1, 3 * n) and time.time() - begin < 60


def test_no_join_of_bounds_and_versions(spark):
    """The sweep itself has no join; the only one brings back the columns of a version by all its bounds."""
    frame = spark.createDataFrame(shapes(), "k string, s long, e long")
    plan = held_versions(frame, ["k"], "s", "e")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert list(swept([(1, 1, 9), (2, 2, 3), (3, 2, 3), (9, 1, 9)])) == [(1, 2, 1, 9), (2, 3, 2, 3), (3, 9, 1, 9), (9, None, None, None)]


@pytest.mark.parametrize("rows_a_batch", ["7", "10000"])
def test_whole_rows_are_cut_in_one_pass(spark, rows_a_batch):
    rows = [(i, k, a, b) for i, (k, a, b) in enumerate(shapes())]
    frame = spark.createDataFrame(rows, "id long, k string, s long, e long").repartition(3)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(setting)
    spark.conf.set(setting, rows_a_batch)
    try:
        got = cut_versions(frame, ["k"], "s", "e").collect()
    finally:
        spark.conf.set(setting, old)
    bounds = {i: (k, a, b) for i, k, a, b in rows}
    assert all(bounds[r.id] == (r.k, r.s, r.e) for r in got)
    assert spread(got) == brute([r[1:] for r in rows])
    ends = {(r.k, r.s, r.e, r._until) for r in got}
    assert not any((r.k, r.s, r.e, r._at) in ends for r in got)
    assert list(spans([1, 1, 1, 2], [1, 2, 2, 5], [9, 3, 3, 6])) == [(0, 1, 2), (2, 2, 3), (0, 3, 9), (3, 5, 6)]


def test_disjoint_versions_without_joins(spark):
    """Neither a search for overlaps nor a join of what was cut back to its rows, and no settled copy where the keys are known."""
    frame = spark.createDataFrame(shapes(), "k string, s long, e long").withColumn("v", F.col("s") * 1000 + F.col("e"))
    got = J.disjoint_versions(frame, ["k"], "s", "e", half_open=True, plan=key_plan(frame, ["k"]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("MapInArrow") == 1
    hot = key_plan(frame, ["k"], hot_rows=50, small_bytes=0)
    assert 0 < hot.keys < 6
    sliced = J.disjoint_versions(frame, ["k"], "s", "e", half_open=True, plan=hot, hot_rows=60, small_bytes=0)
    order = lambda r: (r.k or "", r.s)
    assert sorted(got.collect(), key=order) == sorted(sliced.collect(), key=order)
    facts = spark.range(210).select(F.col("id").alias("at"), F.explode(F.array(*[F.lit(k) for k in ("nested", "same", "crossing", "none")])).alias("k"))
    looked = [J.effective_lookup(facts, got, ["k"], "at", "s", "e", ["v"], half_open=True, strategy="scan", disjoint=True, plan=p) for p in (None, key_plan(facts, ["k"], HOT_ROWS), key_plan(facts, ["k"], 100, 0))]
    a, b, c = (sorted(map(tuple, x.collect()), key=str) for x in looked)
    want = brute([r for r in shapes() if r[0]])
    assert a == b == c == sorted(((m, k, v and v[0] * 1000 + v[1]) for k in ("nested", "same", "crossing", "none") for m in range(210) for v in [want.get((k, m))]), key=str)
