"""Watermarks, changed keys, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.operators import watermark as WM
from tidemart.operators.merge import insert_update
from tidemart.sources.tables import VersionedTable
from tidemart.workload.base import money, query, when

CUT = "1999-01-01 00:00:00"


def _deps(t):
    return [WM.Dependency("orders", t.orders, "o_orderdate"), WM.Dependency("lines", t.lineitem, "l_shipdate", "America/Los_Angeles")]


@query("w01_watermark_lifecycle", "SELECT o_orderkey, o_totalprice::DECIMAL(18,2)::DOUBLE AS total, CASE WHEN o_orderdate > TIMESTAMP '1998-12-31' THEN '2002-01-02 00:00:00' ELSE '2002-01-01 00:00:00' END AS created FROM orders")
def _(t):
    o = t.orders.select("o_orderkey", money("o_totalprice").alias("total"), F.col("o_orderdate").alias("day"))
    state, target = VersionedTable(t.spark, t.scratch("w01-state")), VersionedTable(t.spark, t.scratch("w01-fact"))

    def run(source, now):
        def transform(low):
            delta = source.filter(F.col("day") > F.lit(low("orders")))
            before = target.read() if target.exists() else None
            return insert_update(before, delta, ["o_orderkey"], ["day"], when(now))

        return WM.run_incremental(t.spark, state, "fact_order", [WM.Dependency("orders", source, "day")], target, transform)

    run(o.filter(F.col("day") <= when("1998-12-31")), "2002-01-01 00:00:00")
    run(o, "2002-01-02 00:00:00")
    return target.read().select("o_orderkey", "total", F.col("meta_create_datetime").alias("created"))


@query("w02_common_high", "SELECT LEAST((SELECT max(o_orderdate) FROM orders), (SELECT timezone('UTC', timezone('America/Los_Angeles', max(l_shipdate))) FROM lineitem))::VARCHAR AS high_watermark")
def _(t):
    return WM.common_high(_deps(t))


@query("w03_dependency_kinds", "SELECT 'orders' AS dependent_table_name, max(o_orderdate)::VARCHAR AS high FROM orders UNION ALL SELECT 'lines', timezone('UTC', timezone('America/Los_Angeles', max(l_shipdate)))::VARCHAR FROM lineitem")
def _(t):
    return WM.highs(_deps(t))


def _state(t):
    empty = t.spark.createDataFrame([], WM.STATE_COLUMNS)
    return WM.prepare(empty, "fact", _deps(t))


@query("w04_state_table", "SELECT COALESCE(d, 'self') AS dependency, high::VARCHAR AS committed FROM (SELECT 'orders' AS d, max(o_orderdate) AS high FROM orders UNION ALL SELECT 'lines', timezone('UTC', timezone('America/Los_Angeles', max(l_shipdate))) FROM lineitem UNION ALL SELECT NULL, max(ts) FROM events)")
def _(t):
    committed = WM.commit(_state(t), "FACT", t.events, "ts")
    return committed.select(F.coalesce("dependent_table_name", F.lit("self")).alias("dependency"), F.col("high_watermark_datetime").alias("committed"))


@query("w05_get_watermark", "SELECT 'orders' AS dep, max(o_orderdate)::VARCHAR AS watermark FROM orders UNION ALL SELECT 'self', max(ts)::VARCHAR FROM events UNION ALL SELECT 'absent', '1900-01-01 00:00:00'")
def _(t):
    state = WM.commit(_state(t), "fact", t.events, "ts")
    get = lambda label, dep: WM.get_watermark(state, "Fact", dep).select(F.lit(label).alias("dep"), "watermark")
    return get("orders", "ORDERS").unionByName(get("self", None)).unionByName(get("absent", "nothing"))


@query("w06_changed_keys", "SELECT o_orderkey AS orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01' UNION SELECT l_orderkey FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-10-01' UNION SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < -900")
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), "o_orderdate")
    lines = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_shipdate")
    moved = t.customer.select(F.col("c_custkey").alias("custkey"), F.when(F.col("c_acctbal") < -900, when("2001-07-01")).otherwise(when("1995-01-01")).alias("at"))
    low = {"orders": "2001-06-01", "lines": "2001-10-01", "customer": "2001-06-01"}
    low = {k: F.lit(v).cast("timestamp_ntz") for k, v in low.items()}
    return WM.changed_keys("orderkey", low, None, [("orders", orders, "o_orderdate", None, None), ("lines", lines, "l_shipdate", None, None), ("customer", moved, "at", orders, "custkey")])


@query("w07_insert_since_target", "SELECT event_id, ts::VARCHAR AS ts FROM events")
def _(t):
    e = t.events.select("event_id", "ts")
    return WM.insert_since_target(e.filter(F.col("ts") < when("2024-01-16")), e, ["event_id"], "ts")


@query("w08_push_back", "SELECT 'orders' AS dependency, '2000-01-01 00:00:00' AS committed UNION ALL SELECT 'lines', '2000-01-01 00:00:00' UNION ALL SELECT 'self', '2000-01-01 00:00:00'")
def _(t):
    state = WM.push_back(WM.commit(_state(t), "fact", t.events, "ts"), "fact", when("2000-01-01"))
    return state.select(F.coalesce("dependent_table_name", F.lit("self")).alias("dependency"), F.col("high_watermark_datetime").alias("committed"))


@query("w09_source_highs", "SELECT 'max' AS kind, max(o_orderkey)::VARCHAR AS high_watermark FROM orders UNION ALL SELECT 'rowversion', '0x' || hex(max(p_name)) FROM part UNION ALL SELECT 'text_datetime', max(o_orderdate)::VARCHAR FROM orders UNION ALL SELECT 'empty', 'last known'")
def _(t):
    text = t.orders.select(F.col("o_orderdate").cast("string").alias("d"))
    high = lambda kind, df, c, how, last=None: WM.source_high(df, c, how, last).withColumn("kind", F.lit(kind))
    return (
        high("max", t.orders, "o_orderkey", "max")
        .unionByName(high("rowversion", t.part.select(F.col("p_name").cast("binary").alias("v")), "v", "rowversion"))
        .unionByName(high("text_datetime", text, "d", "text_datetime"))
        .unionByName(high("empty", t.orders.filter("o_orderkey < 0"), "o_orderkey", "max", F.lit("last known")))
    )


@query("w10_look_back", "SELECT COUNT(*)::BIGINT AS n FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 3 DAY FROM orders)")
def _(t):
    low = t.orders.agg(WM.look_back(F.max("o_orderdate"), "day", -3)).scalar()
    return t.orders.filter(F.col("o_orderdate") >= low).agg(row_count().alias("n"))


@query("s01_dated_snapshot", "SELECT d::VARCHAR AS snapshot_date, COUNT(*)::BIGINT AS n FROM part CROSS JOIN (VALUES (DATE '2001-03-01'), (DATE '2001-04-01')) v(d) GROUP BY 1")
def _(t):
    p = t.part.select("p_partkey", "p_size")
    day = lambda text: F.lit(text).cast("date")
    out = None
    for text in ("2000-12-01", "2001-03-01", "2001-04-01", "2001-04-01"):
        out = WM.snapshot(out, p, day(text), 3)
    return out.groupBy("snapshot_date").agg(row_count().alias("n"))


@query("s02_compare_with_earlier", "SELECT p_partkey, p_size::BIGINT AS old_p_size, (p_size + 1)::BIGINT AS new_p_size FROM part WHERE p_type = 'PROMO'")
def _(t):
    table = VersionedTable(t.spark, t.scratch("s02"))
    p = t.part.select("p_partkey", "p_type", "p_size")
    table.publish(p)
    table.publish(p.withColumn("p_size", F.when(F.col("p_type") == "PROMO", F.col("p_size") + 1).otherwise(F.col("p_size"))))
    return WM.state_changes(table.read(), table.read(back=1), ["p_partkey"], ["p_size"])


@query("s03_retention", "SELECT o_orderdate::DATE::VARCHAR AS day, COUNT(*)::BIGINT AS n FROM orders WHERE o_orderdate::DATE >= DATE '2001-08-01' - 15 GROUP BY 1")
def _(t):
    o = t.orders.select(F.to_date("o_orderdate").alias("day"))
    return WM.retain_days(o, "day", F.lit("2001-08-01").cast("date"), 15).groupBy("day").agg(row_count().alias("n"))


@query("s05_aggregate_chain", "SELECT year(o_orderdate)::BIGINT AS y, SUM(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders GROUP BY 1")
def _(t):
    # Ordered refreshes: each step reads the published result of the step before.
    daily, yearly = VersionedTable(t.spark, t.scratch("s05-day")), VersionedTable(t.spark, t.scratch("s05-year"))
    daily.publish(t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("total")))
    yearly.publish(daily.read().groupBy(F.year("day").alias("y")).agg(F.sum("total").alias("total")))
    return yearly.read()
