"""Golden scenarios of the merge operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemart.operators import merge as M



def day(i):
    return F.lit(f"2024-01-0{i} 00:00:00").cast("timestamp_ntz")


SCHEMA = "k int, v string, ver int"


def result(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=repr)


@pytest.mark.parametrize("strategy", ["lookup", "full"])
def test_insert_update(spark, strategy):
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 5), (None, "n", 1), (5, "e", 1)], SCHEMA)
    batch = spark.createDataFrame(
        [
            (1, "old", 2), (1, "new", 3),  # two versions, the newer one wins
            (2, "b", 9),  # same content but a newer version: the content hash covers the version column
            (3, "late", 4),  # older than the target: ignored
            (5, "same version", 1),  # equal version: strictly newer is required
            (None, "n2", 2),  # NULL key matches null-safely
            (7, "x", None),  # new
        ],
        SCHEMA,
    )
    target = M.insert_update(None, first, ["k"], ["ver"], day(1))
    out = M.insert_update(target, batch, ["k"], ["ver"], day(2), strategy=strategy)
    assert result(out, "k", "v") == sorted(
        [(1, "new"), (2, "b"), (3, "c"), (5, "e"), (None, "n2"), (7, "x")], key=repr
    )
    created = {r.k: (r.meta_create_datetime.day, r.meta_update_datetime.day) for r in out.collect()}
    assert created[1] == (1, 2) and created[3] == (1, 1) and created[7] == (2, 2)
    again = M.insert_update(out, batch, ["k"], ["ver"], day(3), strategy=strategy)
    assert result(again, *out.columns) == result(out, *out.columns)


def test_full_feed_soft_deletes(spark):
    feed = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    t1 = M.insert_update_delete(None, feed, ["k"], day(1))
    t2 = M.insert_update_delete(t1, feed.filter("k < 3"), ["k"], day(2))
    assert result(M.live_rows(t2), "k") == [(1,), (2,)]
    one_row = M.insert_update_delete(t2, feed.filter("k = 1"), ["k"], day(3))
    assert result(M.live_rows(one_row), "k") == [(1,), (2,)]
    empty = M.insert_update_delete(t2, feed.filter("k = 9"), ["k"], day(3))
    assert result(M.live_rows(empty), "k") == [(1,), (2,)]
    back = M.insert_update_delete(t2, feed, ["k"], day(3))
    assert result(M.live_rows(back), "k") == [(1,), (2,), (3,)]


def test_ambiguous_update_fails(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="several rows for one key"):
        M.update_from(target, twice, ["k"], {"v": lambda t, s: s("v")}).collect()


def test_delete_is_true_only(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert result(M.delete_where(df, F.col("v") == "x"), "k") == [(2,), (3,)]


@pytest.mark.parametrize("strategy", ["lookup", "full"])
def test_merge_with_delete_branch(spark, strategy):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "A", False), (2, "B", True), (4, "D", False)], "k int, v string, gone boolean")
    out = M.apply_merge(
        target, source, ["k"], lambda t, s: {"v": s("v")}, delete_when=lambda t, s: s("gone"),
        insert={"k": F.col("k"), "v": F.col("v")}, strategy=strategy,
    )
    assert result(out, "k", "v") == [(1, "A"), (3, "c"), (4, "D")]


def test_table_spec_roles():
    spec = M.TableSpec((M.Field("a", key=True), M.Field("b", delta_rank=1), M.Field("c", delta_rank=0)))
    assert spec.keys == ["a"] and spec.delta_cols == ["c", "b"]
    assert M.TableSpec((M.Field("a"), M.Field("b"))).keys == ["a", "b"]


def test_rescue_keeps_what_does_not_fit(spark):
    raw = spark.createDataFrame([("1", "x", "extra"), ("bad", "y", None)], "id string, name string, more string")
    out = M.rescue(raw, {"id": "int", "name": "string", "absent": "double"})
    assert [tuple(r) for r in out.orderBy("name").collect()] == [
        (1, "x", None, '{"more":"extra"}'),
        (None, "y", None, '{"id":"bad"}'),
    ]
