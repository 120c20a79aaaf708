"""Order lines dealt by order once: amounts, tokens and shares as from joins, also of NULL orders and of orders too large for one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemart.functions.semantics import earliest_by
from tidemart.operators.merge import apply_merge
from tidemart.plans import facts as P
from tidemart.plans import line_facts as LF

MONEY = "decimal(18,2)"


def exchanges(df) -> int:
    """Shuffles of the plan that ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


@pytest.fixture(params=["whole", "large"])
def large(request, monkeypatch):
    """Orders as they are, or all taken as too large for one task."""
    if request.param == "large":
        from tidemart.operators import scan

        monkeypatch.setattr(P, "key_plan", lambda df, keys: scan.key_plan(df, keys, 1, -1))
        monkeypatch.setattr(LF, "key_plan", lambda df, keys: scan.key_plan(df, keys, 1, -1))
    return request.param == "large"


def _lines(spark):
    rows = [
        (1, 1, "g", "bundle", False, 1, "100.00", "10.00", "1.00", 1), (1, 2, "g", "component", False, 1, "30.00", "0.00", "1.00", 1),
        (1, 3, "g", "component", False, 1, "70.00", "0.00", "1.00", 1), (1, 4, None, "normal", True, 2, "50.00", "5.00", "0.00", 1),
        (2, 1, "g", "bundle", False, 1, "40.00", "4.00", "0.00", 1), (2, 2, None, "normal", False, 1, "60.00", "0.00", "0.00", 1),
        (None, 1, None, "normal", False, 1, "25.00", "0.00", "0.00", 1), (None, None, None, "normal", False, 1, "75.00", "0.00", "0.00", 1),
        (3, 1, None, "normal", False, 1, "0.00", "0.00", "0.00", 1), (3, 2, None, "normal", False, 1, "0.00", "0.00", "0.00", 1),
        (4, 1, None, "normal", False, 1, "9.00", "0.00", "0.00", 1),
    ]
    names = "order_id int, line_id int, group_key string, kind string, cancelled boolean, units int, price string, own_discount string, tax string, modified int"
    df = spark.createDataFrame(rows, names)
    return df.withColumns({c: F.col(c).cast(MONEY) for c in ("price", "own_discount", "tax")})


def test_line_fact(spark, large):
    tokens = spark.createDataFrame([(1, 1, "6.00", "1.01"), (1, 4, "2.00", "0.00"), (1, 1, "4.00", "0.00"), (2, 1, "8.00", "0.00"), (None, 1, "3.00", "0.00")], "order_id int, line_id int, cash_token string, noncash_token string")
    tokens = tokens.withColumns({c: F.col(c).cast(MONEY) for c in ("cash_token", "noncash_token")})
    orders = spark.createDataFrame([(1, 200.0, 20.0, 6.0), (2, 100.0, 10.0, 5.0), (None, 80.0, 8.0, 4.0), (3, 10.0, 6.0, 0.0), (4, 1.0, 1.0, 1.0)], "order_id int, order_paid double, order_cash_credit double, order_noncash_credit double")
    costs = spark.createDataFrame([(1, 2, 5.0, "fixed"), (None, None, 7.0, "feed")], "order_id int, line_id int, cost double, cost_source string")
    keys = spark.createDataFrame([(1,), (2,), (1,), (None,), (3,)], "order_id int")
    fact = LF.line_fact(keys, _lines(spark), tokens, orders, costs)
    got = {(r.order_id, r.line_id): r for r in fact.collect()}
    assert len(got) == 10 and (4, 1) not in got
    # Two token rows of a bundle count its price twice; the last component takes what rounding leaves.
    assert [got[1, i].cash_token for i in (1, 2, 3, 4)] == [0, 1.5, 8.5, 2]
    assert [got[1, i].noncash_token for i in (1, 2, 3, 4)] == [0, 0.15, 0.86, 0]
    assert [got[1, i].discount for i in (1, 2, 3, 4)] == [20, 3, 7, 5]
    assert got[2, 1].cash_token == 8 and got[2, 2].cash_token == 0
    assert sum(got[1, i].cash_credit for i in (1, 2, 3, 4)) == pytest.approx(20, abs=1e-3)
    assert sum(got[1, i].payment for i in (1, 2, 3, 4)) == pytest.approx(200, abs=1e-3)
    # The tokens of no order part its lines by price, as do orders without tokens; where prices are zero, evenly.
    assert got[None, 1].cash_token == 3 and (got[None, 1].cash_credit, got[None, None].cash_credit) == (2, 6)
    assert (got[3, 1].payment, got[3, 2].cash_credit) == (5, 3)
    assert (got[1, 2].cost, got[None, None].cost_source, got[1, 1].cost) == (5, "feed", None)
    if not large:
        assert exchanges(fact) <= 1


def test_order_line_fact(spark, large):
    lines = spark.createDataFrame([(1, 1, 30.0, 1), (1, 2, 70.0, 2), (None, 1, 5.0, 1), (None, None, 15.0, 1), (2, 1, 0.0, 1), (2, 2, 0.0, 3), (3, 1, 1.0, 1)], "order_id int, line_id int, gross double, units int")
    discounts = spark.createDataFrame([(1, 1, "a", 1.0), (1, 1, "b", 2.0), (1, 1, "a", 4.0), (1, 2, None, 3.0), (None, None, "a", 1.0)], "order_id int, line_id int, kind string, amount double")
    orders = spark.createDataFrame([(1, 200.0, 10.0), (2, 9.0, None), (None, 40.0, 4.0)], "order_id int, paid_total double, credit_total double")
    fact = P.order_line_fact(None, lines, orders, discounts)
    got = {(r.order_id, r.line_id): (r.discount, r.discount_kinds, r.net, r.paid_share, r.credit_share) for r in fact.collect()}
    assert got == {
        (1, 1): (7, 2, 23, 60, 3), (1, 2): (3, 0, 67, 140, 7), (None, 1): (0, 0, 5, 10, 1), (None, None): (1, 1, 14, 30, 3),
        (2, 1): (0, 0, 0, 4.5, 0), (2, 2): (0, 0, 0, 4.5, 0), (3, 1): (0, 0, 1, 0, 0),
    }
    assert {r.order_id for r in P.order_line_fact(orders.filter("order_id = 1"), lines, orders, discounts).collect()} == {1}
    if not large:
        assert exchanges(fact) <= 1


def test_earliest_row_is_carried_once(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 1, "b"), (1, 1, "a"), (None, 3, "x")], "k int, a int, b string")
    got = earliest_by(df, ["k"], ["a", "b"])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 1, "a"), (None, 3, "x")]
    assert "min_by" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_merge_carries_a_source_row_once(spark):
    target = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, v string, w string")
    source = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    out = apply_merge(target, source, ["k"], lambda t, s: {"v": s("v")}, strategy="full")
    assert sorted(map(tuple, out.collect())) == [(1, "a", "p"), (2, "c", "q"), (3, "d", None)]
    assert "s__new" not in out._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("copies", [1, 2])
def test_line_costs(spark, copies, monkeypatch):
    """Each source for what is open; a line that stands in several rows is known with all of them."""
    at = F.lit("2000-01-10").cast("timestamp_ntz")
    one = [(1, 1, "A", 1, 7), (1, 2, "a", 1, 7), (1, 3, "b", 1, 7), (1, 4, "c", 1, 8), (None, 1, "d", 2, 7), (2, 1, "e", 9, 9), (2, 2, "x", 9, 9)]
    again = [(1, 3, "x", 9, 9)] * (copies - 1)
    lines = spark.createDataFrame(one + again, "order_id int, line_id int, item string, store int, region int").select("*", F.lit("EUR").alias("currency"), at.alias("day"), F.lit(2).alias("units"))
    fixed = spark.createDataFrame([(1, 1, 10.0), (1, 2, None), (None, 1, None)], "order_id int, line_id int, cost double")
    feed = spark.createDataFrame([(1, 1, 1.0, "EUR", 1), (1, 2, 3.0, "EUR", 1), (1, 2, 4.0, "EUR", 2), (1, 3, None, "EUR", 1)], "order_id int, line_id int, cost double, currency string, number int")
    spans = lambda rows, place: spark.createDataFrame(rows, f"item string, {place} int, unit_cost double").select("*", F.lit("EUR").alias("currency"), F.lit("1999-01-01").cast("timestamp_ntz").alias("start_at"), F.lit("2001-01-01").cast("timestamp_ntz").alias("end_at"))
    bought = spark.createDataFrame([("D", 7.0, 0), ("E", 8.0, 30)], "item string, unit_cost double, n int").select("item", F.timestamp_add("DAY", F.col("n"), F.lit("2000-01-01").cast("timestamp_ntz")).alias("day"), "unit_cost", F.lit("EUR").alias("currency"))
    rates = spark.createDataFrame([], "source string, target string, day timestamp_ntz, rate double")
    kept = []
    monkeypatch.setattr(LF, "settle", lambda df: kept.append(df) or df.checkpoint())
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    out = LF.line_costs(lines, fixed, feed, spans([("B", 1, 5.0)], "store"), spans([("C", 8, 6.0), ("B", 7, 1.0)], "region"), bought, rates)
    assert {(r.order_id, r.line_id): (r.cost, r.cost_source) for r in out.collect()} == {
        (1, 1): (10, "fixed"), (1, 2): (4, "feed"), (1, 3): (10, "same store"), (1, 4): (12, "same region"), (None, 1): (14, "last purchase"), (2, 1): (16, "next purchase"),
    }
    assert out.count() == 6
    # Fixed costs and the feed are one step.
    assert len(kept) == 5


def test_costs_keep_no_copies_of_rows_and_no_shuffles(spark):
    """What a step leaves open lies in compressed files without a checkpoint, and the shuffles of a step go with it."""
    import time

    from tidemart.session import stored

    files = lambda: {f for f in _disk(spark) if f.startswith("shuffle_")}
    kept = lambda: {f.getPath().getName() for f in _status(spark)}
    stamp = "timestamp_ntz"
    lines = spark.range(300).select(F.col("id").alias("order_id"), F.lit(1).alias("line_id"), F.concat(F.lit("I"), F.col("id") % 7).alias("item"), (F.col("id") % 3).alias("store"), (F.col("id") % 2).alias("region"), F.lit("EUR").alias("currency"), F.lit("2000-01-05").cast(stamp).alias("day"), F.lit(2).alias("units"))
    fixed = lines.filter("order_id < 100").select("order_id", "line_id", F.lit(1.0).alias("cost"))
    feed = lines.filter("order_id < 150").select("order_id", "line_id", F.lit(2.0).alias("cost"), "currency", F.lit(1).alias("number"))
    place = lambda c, n: spark.range(3).select(F.concat(F.lit("I"), "id").alias("item"), (F.col("id") % n).alias(c), F.lit("1999-01-01").cast(stamp).alias("start_at"), F.lit("2001-01-01").cast(stamp).alias("end_at"), F.lit(3.0).alias("unit_cost"), F.lit("EUR").alias("currency"))
    bought = spark.range(7).select(F.concat(F.lit("i"), "id").alias("item"), F.lit("2000-01-04").cast(stamp).alias("day"), F.lit(4.0).alias("unit_cost"), F.lit("EUR").alias("currency"))
    rates = lines.select(F.lit("usd").alias("source"), F.lit("eur").alias("target"), "day", F.lit(1.1).alias("rate")).distinct()
    before = kept()
    got = LF.line_costs(lines, fixed, feed, place("store", 3), place("region", 2), bought, rates)
    assert got.count() == 300 and not kept() - before
    shuffled, old = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    rows = stored(spark.range(1000).repartition(8).groupBy(F.col("id") % 10).count(), f"{spark.sparkContext.getCheckpointDir()}-stored")
    for _ in range(100):
        left = {f for f in files() - shuffled if f.endswith(".data")}
        if not left:
            break
        time.sleep(0.1)
    assert not left and rows.count() == 10 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == old


def test_a_fact_is_merged_in_parts(spark, monkeypatch):
    """Part by part the rows are those of one merge, also of NULL keys; every part is kept in files of its own."""
    from tidemart.session import packed

    old = packed(spark.createDataFrame([(i if i % 9 else None, i % 3, f"v{i}") for i in range(40) if i % 9 or i == 9], "k int, l int, v string"))
    new = packed(spark.createDataFrame([(i if i % 9 else None, i % 3, f"v{i}" if i % 2 else "w") for i in range(25, 60) if i % 9 or i == 27], "k int, l int, v string"))
    first = packed(P.load_fact(None, old, ["k", "l"], F.lit("2000-01-01")))
    load = lambda **more: sorted(map(str, P.load_fact(first, new, ["k", "l"], F.lit("2000-01-02"), **more).collect()))
    want, kept = load(), []
    assert load(parts=3) == want  # small, so it is merged at once
    monkeypatch.setattr(P, "SMALL_BYTES", 0)
    monkeypatch.setattr(P, "packed", lambda df, label: kept.append(df) or packed(df, label))
    assert load(parts=3) == want and len(kept) == 3 and sum(df.count() for df in kept) == len(want)


def test_activations_meet_the_orders_while_they_are_narrow(spark, monkeypatch):
    """Nothing that goes by the order is joined before the step that deals rows by the member, whose keys are counted without a copy of them."""
    from compare import DATA

    from tidemart.workload import registry

    seen, plain = [], P.as_of
    monkeypatch.setattr(P, "as_of", lambda df, *a, **b: seen.append((len(df.columns), b.get("plan"))) or plain(df, *a, **b))
    assert registry()["d61_order_fact"](spark, f"{DATA}/sf0.001").count() == spark.read.parquet(f"{DATA}/sf0.001/orders.parquet").count()
    assert len(seen) == 2 and all(columns == 8 and plan is not None for columns, plan in seen)


def test_lines_of_changed_orders_are_picked_before_they_are_summed(spark, monkeypatch):
    from compare import DATA

    from tidemart.workload import facts, registry

    keys, plain = [], P.order_line_fact
    monkeypatch.setattr(facts.P, "order_line_fact", lambda k, lines, *a: keys.append((k, lines.select("order_id").distinct().count())) or plain(k, lines, *a))
    registry()["d62_order_lines"](spark, f"{DATA}/sf0.001").count()
    changed = spark.read.parquet(f"{DATA}/sf0.001/lineitem.parquet").filter("l_shipdate >= '2000-07-01'").select("l_orderkey").distinct().count()
    assert [n for _, n in keys][1:] == [changed] and keys[1][0] is None


def _disk(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return [found.apply(i).getName() for i in range(found.size())]


def _status(spark):
    from tidemart.session import shared_dir

    shared_dir(spark)
    where = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(where)) if fs.exists(where) else []
