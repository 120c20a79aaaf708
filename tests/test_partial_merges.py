"""Merges that rewrite only the buckets in which something changes: same rows as the whole merges, other files untouched."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import merge as M
from tidemart.operators import scd as D
from tidemart.sources import tables
from tidemart.sources.tables import BucketedTable


def at(day):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz")


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def same(a, b):
    columns = sorted(a.columns)
    rows = lambda df: sorted(map(repr, df.select(*columns).collect()))
    return rows(a) == rows(b)


def kept(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def feeds(spark, n=4):
    dice = random.Random(3)
    for _ in range(n):
        rows = [(k, f"v{dice.randint(0, 1)}", dice.randint(1, 3)) for k in [None, *range(-60, 200)] if dice.random() < 0.7]
        yield spark.createDataFrame(rows + rows[:5], "k long, v string, ver int")


@pytest.mark.parametrize("width", [None, 37])
def test_full_feeds_equal_the_whole_merge(spark, tmp_path, width):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=8, width=width)
    whole = None
    for day, feed in enumerate(feeds(spark), 1):
        M.merge_feed(table, feed, at(day), ["ver"], ["v"])
        whole = kept(M.insert_update_delete(whole, feed, ["k"], at(day), ["ver"], ["v"]), str(tmp_path / f"w{day}"))
        assert same(table.read(), whole)
    one = feed.where("k = 150 OR k IS NULL").limit(1)
    M.merge_feed(table, one, at(9), ["ver"], ["v"])
    M.merge_feed(table, feed.limit(0), at(10), ["ver"], ["v"])
    assert same(table.read(), M.insert_update_delete(whole, one, ["k"], at(9), ["ver"], ["v"]))


def test_a_feed_rewrites_only_what_differs(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], width=100)
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert M.merge_feed(table, rows, at(1)) == list(range(10))
    before = files(tmp_path / "t")
    assert M.merge_feed(table, rows, at(2)) == [] and files(tmp_path / "t") == before
    news = rows.where("k <> 455").withColumn("v", F.when(F.col("k") == 950, "b").otherwise(F.col("v"))).union(spark.sql("SELECT 1000L, 'c'"))
    assert M.merge_feed(table, news, at(3)) == [4, 9, 10]
    assert {f for f in before if "_bucket=4/" not in f and "_bucket=9/" not in f} <= files(tmp_path / "t")
    changed = table.read().where(F.col("meta_update_datetime") == at(3)).select("k", "v", "meta_is_deleted").collect()
    assert sorted(map(tuple, changed)) == [(455, "a", True), (950, "b", False), (1000, "c", False)]
    # What is gone already stays gone without another rewrite, and comes back with its row.
    assert M.merge_feed(table, news, at(4)) == []
    assert M.merge_feed(table, news.union(rows.where("k = 455")), at(5)) == [4]
    assert table.read().where("meta_is_deleted").count() == 0


def events(spark, seed, days, users=60):
    dice = random.Random(seed)
    rows = [(u if u else None, dice.choice("xy"), dice.choice("pq"), d) for u in range(users) for d in range(*days) if dice.random() < 0.3]
    return spark.createDataFrame(rows, "u int, s string, l string, d int").select("u", "s", "l", F.date_add(F.lit("2024-01-01"), F.col("d")).cast("timestamp_ntz").alias("ts"))


@pytest.mark.parametrize("load, current", [(D.scd_load, "meta_is_current"), (D.scd_mart, "is_current")])
def test_dimensions_equal_the_whole_load(spark, tmp_path, load, current):
    spec = D.ScdSpec(keys=("u",), type_1=("l",), type_2=("s",), event="ts")
    hashes = {"meta_type_1_hash": spec.type_1, "meta_type_2_hash": spec.type_2}
    table = BucketedTable(spark, str(tmp_path / "t"), ["u"], buckets=16)
    whole = None
    late = events(spark, 9, (20, 24), users=3)
    for day, batch in enumerate([events(spark, 1, (0, 8)), events(spark, 2, (8, 16)), events(spark, 1, (0, 8)), late], 1):
        touched = M.merge_changed(table, batch, lambda t, s, day=day: load(t, s, spec, at(day)), hashes, among=F.col(current))
        whole = kept(load(whole, batch, spec, at(day)), str(tmp_path / f"w{day}"))
        assert same(table.read(), whole)
    assert len(touched) <= 3


def test_a_repeated_fact_delivery_rewrites_nothing(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], width=50)
    deliver = lambda df, day: M.merge_changed(table, df, lambda t, s: D.mart_upsert(t, s, ["k"], at(day)), {"meta_row_hash": ["v"]})
    deliver(rows, 1)
    before = files(tmp_path / "t")
    assert deliver(rows, 2) == [] and deliver(rows.limit(0), 2) == [] and files(tmp_path / "t") == before
    assert deliver(rows.where("k < 20").withColumn("v", F.lit(99).cast("long")), 3) == [0]
    got = table.read()
    assert got.count() == 500 and got.where("v = 99").count() == 20


def test_too_many_ranges_fail_before_anything_is_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_BUCKETS", 5)
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], width=10)
    rows = spark.range(100).select(F.col("id").alias("k"))
    with pytest.raises(ValueError, match="greater width"):
        table.merge(rows, lambda target, source: source)
    assert not table.exists()


@pytest.mark.parametrize("hot", [False, True])
def test_spend_of_an_ad_is_dealt_once(spark, monkeypatch, hot):
    """Running sums count all accounts of a day, also of NULL ads and days; an ad too large for one task keeps the joins."""
    from tidemart import session
    from tidemart.operators import scan
    from tidemart.plans import traffic

    rng = random.Random(7)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["promo", "else"]), rng.choice([None, *range(9)]), rng.choice(["EUR", "USD", None]), rng.choice([None, 1_000_000, 2_500_000]), rng.choice([None, 1, 4])) for _ in range(300)]
    raw = spark.createDataFrame(rows, "ad_id int, account_id string, n int, currency string, spend_micros long, clicks long").withColumn("day", F.date_add(F.lit("2000-01-01").cast("date"), F.col("n"))).drop("n")
    raw = session.stored(raw, f"{session.scratch_path(spark, 'spend')}")
    rates = spark.sql("SELECT * FROM VALUES ('EUR', 1.25, 1.00), ('USD', 1.00, 0.80) AS v(currency, usd_rate, local_rate)")
    names = spark.createDataFrame([(1, "one", 1), (1, "first", 2), (2, "two", 1)], "ad_id int, ad_name string, updated_at int")
    monkeypatch.setattr(session, "SMALL_BYTES", 0)
    monkeypatch.setattr(session, "TASK_BYTES", 500)
    if hot:
        monkeypatch.setattr(traffic, "key_plan", lambda df, keys: scan.key_plan(df, keys, 20, -1))
    out = traffic.platform_spend(raw, names, rates, [("promo%", "2000-01-01", "2000-01-04", 0.05)], ["clicks"])
    got = {(r.ad_id, r.account_id, str(r.day)): (float(r.spend_usd), float(r.spend_usd_to_date), r.clicks_to_date, r.ad_name) for r in out.collect()}
    day = lambda n: "None" if n is None else f"2000-01-{n + 1:02}"
    usd = lambda r: (r[4] or 0) / 1e6 * (1.25 if r[3] == "EUR" else 1)
    upto = lambda r, q: q[0] == r[0] and (q[2] is None or (r[2] is not None and q[2] <= r[2]))
    want = {}
    for r in rows:
        own = [q for q in rows if q[:3] == r[:3]]
        past = [q for q in rows if upto(r, q)]
        want[r[0], r[1], day(r[2])] = (sum(map(usd, own)), sum(map(usd, past)), sum(q[5] or 0 for q in past), {1: "first", 2: "two"}.get(r[0]))
    assert got == want
    if not hot:
        text = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert text.count("REPARTITION_BY_NUM") == 1
