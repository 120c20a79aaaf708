"""As-of, nearest and radius joins against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import joins as J

FORCED = {"hot_rows": 15, "small_bytes": 0}
BASE = dt.datetime(2024, 1, 1)


def moments(seed, n, prefix):
    rnd = random.Random(seed)
    return [(rnd.choice([1, 1, 2]), f"{prefix}{i:03d}", BASE + dt.timedelta(seconds=rnd.randint(0, 600))) for i in range(n)]


@pytest.mark.parametrize("limits", [{}, FORCED])
@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_as_of(spark, limits, forward, inclusive):
    left, right = moments(1, 60, "l"), moments(2, 50, "r")
    a = spark.createDataFrame(left, "k int, l string, lt timestamp_ntz")
    b = spark.createDataFrame(right, "k int, r string, rt timestamp_ntz")
    out = J.as_of(a, b, ["k"], "lt", "rt", ["rt"], forward=forward, inclusive=inclusive, tie=["r"], **limits)
    want = {}
    for k, name, t in left:
        times = [rt for rk, _, rt in right if rk == k and ((rt >= t if inclusive else rt > t) if forward else (rt <= t if inclusive else rt < t))]
        want[name] = (min(times) if forward else max(times)) if times else None
    assert {r.l: r.rt for r in out.collect()} == want


@pytest.mark.parametrize("limits", [{}, FORCED])
def test_nearest_one_to_one(spark, limits):
    left, right = moments(3, 40, "l"), moments(4, 40, "r")
    a = spark.createDataFrame(left, "k int, l string, lt timestamp_ntz")
    b = spark.createDataFrame(right, "k int, r string, rt timestamp_ntz")
    pairs = [(l, r) for l in left for r in right if l[0] == r[0] and abs((l[2] - r[2]).total_seconds()) <= 20]
    best_r = {l[1]: min((p for p in pairs if p[0] == l), key=lambda p: (abs(p[0][2] - p[1][2]), p[1][2], p[1][1]), default=None) for l in left}
    best_l = {r[1]: min((p for p in pairs if p[1] == r), key=lambda p: (abs(p[0][2] - p[1][2]), p[0][2], p[0][1]), default=None) for r in right}
    want = {(p[0][1], p[1][1]) for p in pairs if best_r[p[0][1]] == p and best_l[p[1][1]] == p}
    got = J.nearest_in_time(a, b, ["k"], "l", "r", "lt", "rt", 20, **limits)
    assert {(r.l, r.r) for r in got.collect()} == want


def test_effective_lookup_plans_agree(spark):
    dim = spark.createDataFrame(
        [(1, BASE, BASE + dt.timedelta(seconds=99), "a"), (1, BASE + dt.timedelta(seconds=200), BASE + dt.timedelta(seconds=300), "b")],
        "k int, s timestamp_ntz, e timestamp_ntz, v string",
    )
    fact = spark.createDataFrame(moments(5, 80, "f"), "k int, id string, ts timestamp_ntz")
    for half in (False, True):
        got = [
            {r.id: r.v for r in J.effective_lookup(fact, dim, ["k"], "ts", "s", "e", ["v"], half, strategy=s).collect()}
            for s in ("range", "scan", "auto")
        ]
        assert got[0] == got[1] == got[2]


def test_within_radius_everywhere(spark):
    rnd = random.Random(6)
    spots = [(i, rnd.uniform(-80, 80), rnd.choice([rnd.uniform(-180, 180), rnd.uniform(179, 180), rnd.uniform(-180, -179)])) for i in range(250)]
    points = spark.createDataFrame(spots, "id int, lat double, lon double")
    centres = spark.createDataFrame([(i, a + 0.1, b) for i, a, b in spots[:60]], "id int, lat double, lon double")

    def miles(a, b, c, d):
        x = 57.2958
        cos = math.sin(a / x) * math.sin(c / x) + math.cos(a / x) * math.cos(c / x) * math.cos(d / x - b / x)
        return 0.0 if cos >= 1 else round(math.acos(max(-1, cos)) * 3963, 2)

    for radius in (50, 400):
        want = {(i, j) for i, a, b in spots[:60] for j, c, d in spots if miles(a + 0.1, b, c, d) <= radius}
        got = J.within_radius(points, centres, ("id", "lat", "lon"), ("id", "lat", "lon"), radius)
        assert {(r.centre_id, r.point_id) for r in got.collect()} == want


def test_no_pairs_of_a_key_in_the_scan_plan(spark):
    fact = spark.createDataFrame(moments(7, 20, "f"), "k int, id string, ts timestamp_ntz")
    dim = fact.select("k", F.col("ts").alias("s"), F.col("ts").alias("e"), F.col("id").alias("v"))
    plan = J.effective_lookup(fact, dim, ["k"], "ts", "s", "e", ["v"], strategy="scan")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text


def test_versions_are_counted_before_a_broadcast(spark):
    """Sixteen versions grow out of each row of a source whose estimated size would fit a broadcast."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        dim = spark.range(200).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(1), F.lit(16))).alias("s")).withColumn("e", F.col("s") + 1)
        fact = spark.range(50_000).select((F.col("id") % 200).alias("k"), (F.col("id") % 19).cast("int").alias("at"))
        for strategy in ("range", "auto"):
            hit = J.effective_lookup(fact, dim.withColumn("v", F.col("s") * 10), ["k"], "at", "s", "e", ["v"], half_open=True, strategy=strategy, disjoint=True)
            assert "BroadcastHashJoin" not in hit._jdf.queryExecution().executedPlan().toString()
            assert hit.filter("v <=> if(at BETWEEN 1 AND 16, at * 10, NULL)").count() == 50_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
