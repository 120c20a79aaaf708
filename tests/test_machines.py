"""Finite-state scans against a loop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators.machines import state_scan

FORCED = {"hot_rows": 9, "small_bytes": 0}
# Three states that do not commute: a lock that opens by 0 then 1, shuts by 2, and stays broken after 3 when open.
MOVES = [[1, 1, 2, 3], [0, 2, 2, 3], [0, 0, 0, 3], [0, 0, 3, 3]]


def loop(rows, initial):
    state, out = {}, {}
    for k, t, symbol in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        s = state.get(k, initial)
        state[k] = s if symbol is None else MOVES[symbol][s]
        out[k, t] = state[k]
    return out


def some(seed, n, keys):
    rng = random.Random(seed)
    return [(rng.choice(keys), t, rng.choice([0, 0, 1, 1, 2, None] + [3] * (t % 40 == 0))) for t in range(n)]


@pytest.mark.parametrize("limits", [{}, FORCED, {"hot_rows": 60, "small_bytes": 0}])
@pytest.mark.parametrize("initial", [0, 2])
def test_states_of_cold_and_hot_keys(spark, limits, initial):
    rows = some(1, 400, ["hot", "hot", "hot", "a", "b", None])
    frame = spark.createDataFrame(rows, "k string, t long, `my symbol` int").repartition(5)
    got = state_scan(frame, ["k"], ["t"], F.col("my symbol"), MOVES, initial, "state", **limits)
    assert got.columns == ["k", "t", "my symbol", "state"]
    assert {(r.k, r.t): r.state for r in got.collect()} == loop(rows, initial)


@pytest.mark.parametrize("limits", [{}, FORCED])
def test_without_keys_and_empty(spark, limits):
    rows = some(2, 200, ["x"])
    frame = spark.createDataFrame(rows, "k string, t long, s int")
    assert {(r.k, r.t): r.state for r in state_scan(frame, [], ["t"], F.col("s"), MOVES, 0, "state", **limits).collect()} == loop(rows, 0)
    assert state_scan(frame.limit(0), ["k"], ["t"], F.col("s"), MOVES, 0, "state", **limits).count() == 0


def test_a_hot_key_runs_in_several_tasks(spark):
    frame = spark.range(5000).select(F.lit(1).alias("k"), "id", (F.xxhash64("id") % 3).cast("int").alias("s")).withColumn("s", F.abs("s"))
    got = state_scan(frame, ["k"], ["id"], F.col("s"), MOVES, 0, "state", hot_rows=500, small_bytes=0)
    tasks = got.withColumn("p", F.spark_partition_id()).groupBy("p").count().count()
    assert tasks >= 4
    rows = [(1, r.id, r.s) for r in frame.collect()]
    assert {(r.k, r.id): r.state for r in got.collect()} == loop(rows, 0)


def test_moves_are_checked(spark):
    frame = spark.range(1).select("id", F.lit(0).alias("s"))
    with pytest.raises(ValueError, match="state from 0"):
        state_scan(frame, [], ["id"], F.col("s"), [[0, 5]], 0, "state")
