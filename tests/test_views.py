"""Views refreshed by signed changes equal views computed anew."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemart.operators.views import StoredView, View, changes_of, signed

SCHEMA = "id long, g string, h int, amount decimal(12,2), at date"
VIEW = View(["g", "h"], sums={"total": "amount"}, counts={"known": "amount"}, lows={"first": "at", "least": "amount"}, highs={"last": "at"})


def computed(df):
    return df.groupBy("g", "h").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("total"), F.count("amount").alias("known"), F.min("at").alias("first"), F.min("amount").alias("least"), F.max("at").alias("last")
    )


def shown(df):
    return sorted([tuple(r[c] for c in ("g", "h", "n_rows", "total", "known", "first", "least", "last")) for r in df.collect()], key=repr)


def random_row(rng, i):
    import datetime as dt

    amount = None if rng.random() < 0.2 else Decimal(rng.randint(-500, 500)) / 100
    day = None if rng.random() < 0.1 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 9))
    return (i, rng.choice(["a", "a", "a", "b", None, "c"]), rng.choice([1, 2, None]), amount, day)


@pytest.mark.parametrize("buckets", [1, 7])
def test_inserts_updates_and_deletes(spark, tmp_path, buckets):
    rng = random.Random(buckets)
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    view = StoredView(spark, str(tmp_path / "v"), VIEW, buckets)
    now = {i: random_row(rng, i) for i in range(120)}
    view.refresh(signed(None, frame(list(now.values()))), 1)
    for batch in range(2, 5):
        gone, new = [], []
        for i in rng.sample(sorted(now), 50):
            gone.append(now.pop(i))
            if rng.random() < 0.7:  # an update
                now[i] = random_row(rng, i)
                new.append(now[i])
        if batch == 3:  # a whole group goes
            gone += [r for r in now.values() if r[1] == "b"]
            now = {i: r for i, r in now.items() if r[1] != "b"}
        for i in range(batch * 1000, batch * 1000 + 20):
            now[i] = random_row(rng, i)
            new.append(now[i])
        changes = signed(frame(gone), frame(new))
        view.refresh(changes, batch)
        view.refresh(changes, batch)  # repeated after a lost job
        assert shown(view.read()) == shown(computed(frame(list(now.values()))))


def test_only_touched_buckets_move_and_the_source_is_not_read(spark, tmp_path):
    rows = [(i, f"g{i % 200}", 1, Decimal(i), None) for i in range(2000)]
    view = StoredView(spark, str(tmp_path / "v"), VIEW, 50)
    view.refresh(signed(None, spark.createDataFrame(rows, SCHEMA)), 1)
    files = lambda: {p.name: p.stat().st_mtime_ns for p in (tmp_path / "v/groups").rglob("*.parquet")}
    before = files()
    moved = view.refresh(signed(spark.createDataFrame(rows[:1], SCHEMA), spark.createDataFrame([(0, "g0", 1, Decimal(7), None)], SCHEMA)), 2)
    assert len(moved) == 1 and len(set(before) & set(files())) >= len(before) - 2
    assert {r.total for r in view.read().filter("g = 'g0'").collect()} == {Decimal(sum(range(0, 2000, 200)) + 7)}


def test_a_group_with_a_third_of_all_rows(spark, tmp_path):
    frame = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.lit(1).alias("h"), (F.col("id") % 50).cast("decimal(12,2)").alias("amount"), F.lit(None).cast("date").alias("at"))
    view = StoredView(spark, str(tmp_path / "v"), VIEW, 4)
    view.refresh(signed(None, frame), 1)
    gone = frame.filter("g = 'hot' AND amount < 10")
    view.refresh(signed(gone, None), 2)
    assert shown(view.read()) == shown(computed(frame.filter("NOT (g = 'hot' AND amount < 10)")))


def test_a_row_taken_back_twice_is_an_error(spark, tmp_path):
    view = StoredView(spark, str(tmp_path / "v"), VIEW, 1)
    frame = spark.createDataFrame([(1, "a", 1, Decimal(1), None)], SCHEMA)
    view.refresh(signed(None, frame), 1)
    with pytest.raises(Exception, match="never had"):
        view.refresh(signed(frame.union(frame), None), 2)


def test_a_view_on_a_view(spark, tmp_path):
    rng = random.Random(9)
    low = StoredView(spark, str(tmp_path / "low"), VIEW, 4)
    top = StoredView(spark, str(tmp_path / "top"), View(["h"], sums={"total": "total"}, highs={"most": "n_rows"}), 2)
    rows = {i: random_row(rng, i) for i in range(80)}
    top.refresh(low.refresh_with_changes(signed(None, spark.createDataFrame(list(rows.values()), SCHEMA)), 1), 1)
    gone = [rows.pop(i) for i in range(0, 80, 3)]
    top.refresh(low.refresh_with_changes(signed(spark.createDataFrame(gone, SCHEMA), None), 2), 2)
    want = computed(spark.createDataFrame(list(rows.values()), SCHEMA)).groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("t"), F.max("n_rows").alias("m"))
    key = lambda r: str(r[0])
    assert sorted([(r.h, r.n_rows, r.total, r.most) for r in top.read().collect()], key=key) == sorted(map(tuple, want.collect()), key=key)
    assert changes_of(top.read(), top.read(), ["h"]).count() == 0
