"""The sliced scan of hot keys gives exactly the rows of the plain window."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators.scan import Scan, dense_ranks, global_tiles, key_tiles, ordered_scan

KINDS = ["size", "number", "sum", "min", "max", "fill", "fill_next", "lag", "lead"]
FORCED = {"hot_rows": 20, "small_bytes": 0}


def rows(n, seed, hot_share=0.4):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < hot_share else rnd.choice([None, "a", "b", "c", "d"])
        value = None if rnd.random() < 0.3 else rnd.randint(-50, 50)
        out.append((key, rnd.randint(0, n // 3), i, value))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(400, 1), "k string, t int, id int, v int")


@pytest.mark.parametrize("kind", KINDS)
def test_sliced_equals_plain(frame, kind):
    scans = [Scan("out", kind, None if kind in ("number", "size") else "v")]
    plain = ordered_scan(frame, ["k"], ["t", "id"], scans)
    sliced = ordered_scan(frame, ["k"], ["t", "id"], scans, **FORCED)
    assert sorted(map(repr, sliced.collect())) == sorted(map(repr, plain.collect()))


def test_several_scans_at_once_and_no_key(frame):
    scans = [Scan(f"o_{k}", k, None if k in ("number", "size") else "v") for k in KINDS]
    for keys in (["k"], []):
        plain = ordered_scan(frame, keys, ["t", "id"], scans)
        sliced = ordered_scan(frame, keys, ["t", "id"], scans, **FORCED)
        assert sorted(map(repr, sliced.collect())) == sorted(map(repr, plain.collect()))


def test_no_hot_key_keeps_the_plain_window(frame):
    out = ordered_scan(frame, ["k"], ["t", "id"], [Scan("n", "number")], hot_rows=10_000, small_bytes=0)
    assert out.count() == 400


def test_tiles(spark, frame):
    frame.createOrReplaceTempView("tiles")
    want = spark.sql("SELECT id, ntile(7) OVER (ORDER BY t, id) AS x, ntile(3) OVER (PARTITION BY k ORDER BY t, id) AS y FROM tiles")
    got = global_tiles(frame, ["t", "id"], 7, "x", **FORCED).select("id", "x")
    assert sorted(map(tuple, got.collect())) == sorted((r.id, r.x) for r in want.collect())
    got = key_tiles(frame, ["k"], ["t", "id"], 3, "y", **FORCED).select("id", "y")
    want = spark.sql("SELECT id, ntile(3) OVER (PARTITION BY k ORDER BY t, id) AS y FROM tiles")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_fewer_rows_than_tiles(spark):
    df = spark.range(3).withColumn("t", F.col("id"))
    assert sorted(r.x for r in global_tiles(df, ["t"], 10, "x").collect()) == [1, 2, 3]


def test_dense_ranks(spark, frame):
    # NULL keys are a group, and NULL values rank first in descending order, as in the source dialect.
    frame.createOrReplaceTempView("ranks")
    want = spark.sql("SELECT id, dense_rank() OVER (PARTITION BY k ORDER BY v DESC NULLS FIRST) AS r FROM ranks")
    got = dense_ranks(frame, ["k"], "v", "r", **FORCED).select("id", "r")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
