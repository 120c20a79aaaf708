"""Chunked sources and keyed streaming state against their batch forms."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.sources import chunked as C
from tidemart.streaming import state as S


def test_chunks_are_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(1000).select(F.when(F.col("id") % 100 != 7, F.col("id") * 3).alias("k"), F.col("id").cast("string").alias("v"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"))
    frame.repartition(4).write.parquet(path)
    got = C.read_chunked(spark, path, "k", 500)
    assert got.rdd.getNumPartitions() == 7 and sorted(got.collect(), key=str) == sorted(frame.collect(), key=str)
    by_chunk = got.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.min("k").alias("a"), F.max("k").alias("b")).filter("a IS NOT NULL").collect()
    assert all(r.b - r.a < 500 for r in by_chunk)
    days = C.read_chunked(spark, "file:" + path, "d", 30)
    assert days.rdd.getNumPartitions() == 4 and days.count() == 1000


def test_conditions_narrow_the_chunks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    old = spark.conf.get(C.PUSHDOWN)
    spark.conf.set(C.PUSHDOWN, "true")
    try:
        part = C.read_chunked(spark, path, "id", 100).filter("id >= 250 AND id < 420")
        assert part.rdd.getNumPartitions() == 2 and part.agg(F.sum("id")).first()[0] == sum(range(250, 420))
        assert C.read_chunked(spark, path, "id", 100).filter("id > 5000").count() == 0
    finally:
        spark.conf.set(C.PUSHDOWN, old)


def test_changes_by_sequence_restart(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    land = lambda a, b: spark.range(a, b).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("op")).write.mode("append").parquet(path)
    land(0, 250)
    schema = spark.read.parquet(path).schema
    run = lambda: C.land_changes(C.stream_changes(spark, path, "seq", 100, schema), out, ckpt).awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 250
    run()
    land(250, 251)
    land(251, 600)
    run()
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(600))


@pytest.mark.parametrize("seed", [1, 2])
def test_late_repeated_and_unordered_events(spark, tmp_path, seed):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rng.choice([1, 1, 1, 2, 3]), base + dt.timedelta(hours=rng.randint(0, 24 * 40), microseconds=rng.randint(0, 9)), rng.choice("abc")) for i in range(150)]
    rows.sort(key=lambda r: r[2] + dt.timedelta(hours=rng.randint(0, 20)))
    schema = "id long, member long, at timestamp, status string"
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    stream = lambda: S.timeline(spark.readStream.schema(schema).parquet(src), "member", "at", "status", "id", "1 day", 5)
    for k in range(3):
        part = rows[k * 50 : (k + 1) * 50]
        again = rng.sample(rows[max(0, k * 50 - 5) : (k + 1) * 50], 15)
        spark.createDataFrame(part + again, schema).write.mode("append").parquet(src)
        S.run_timeline(stream(), out, ckpt).awaitTermination()
    clock = base + dt.timedelta(days=400)
    spark.createDataFrame([(-1, None, clock, None)], schema).write.mode("append").parquet(src)
    S.run_timeline(stream(), out, ckpt).awaitTermination()
    spark.createDataFrame([(-2, None, clock, None)], schema).write.mode("append").parquet(src)
    S.run_timeline(stream(), out, ckpt).awaitTermination()
    until = F.lit(clock - dt.timedelta(days=1)).cast("timestamp")
    want = S.batch_timeline(spark.createDataFrame(rows, schema), "member", "at", "status", "id", until, 5).collect()
    got = spark.read.parquet(out).collect()
    key = lambda r: (r.member, r.start_at, r.end_at, r.status)
    assert sorted(map(key, got)) == sorted(map(key, want)) and len(want) > 100


@pytest.mark.parametrize("kind", ["long", "string"])
def test_members_share_buckets(spark, tmp_path, kind):
    base = dt.datetime(2024, 1, 1)
    name = lambda m: m if kind == "long" else f"m{m}"
    rows = [(f"{m}-{i}", name(2**60 + m), base + dt.timedelta(hours=7 * i + m % 5), "ab"[(i + m) % 2]) for m in range(40) for i in range(4)]
    schema = f"id string, member {kind}, at timestamp, status string"
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    clock = base + dt.timedelta(days=90)
    # NULL members come beside the others, and ids near 2 ** 60 are told apart.
    for part in (rows[::2] + [("h", None, base, None), ("n", rows[0][1], None, "a")], rows[1::2], [("i", None, clock, None)], [("j", None, clock, None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        periods = S.timeline(spark.readStream.schema(schema).parquet(src), "member", "at", "status", "id", "2 days", 1, buckets=3)
        run = S.run_timeline(periods, out, ckpt)
        run.awaitTermination()
        assert run.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3
    until = F.lit(clock - dt.timedelta(days=2)).cast("timestamp")
    want = S.batch_timeline(spark.createDataFrame(rows, schema), "member", "at", "status", "id", until, 1).collect()
    key = lambda r: (r.member, r.start_at, r.end_at, r.status)
    got = spark.read.parquet(out)
    assert dict(got.dtypes)["member"] == spark.createDataFrame([], schema).dtypes[1][1]
    assert sorted(map(key, got.collect())) == sorted(map(key, want)) and len({r.member for r in want}) == 40
