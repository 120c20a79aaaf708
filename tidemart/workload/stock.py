"""Inventory and cost pipelines on order lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.plans import stock as P
from tidemart.workload.base import SQL_LINES, query


@query("d37_inventory_snapshot", f"""WITH a AS (SELECT user_id, ts::DATE AS d, arg_min(event_id, (ts, event_id)) AS e, 0 AS r FROM events WHERE event_type = 'view' GROUP BY 1, 2), b AS (SELECT user_id, ts::DATE AS d, arg_min(event_id, (ts, event_id)) AS e, 1 AS r FROM events WHERE event_type = 'click' GROUP BY 1, 2)
 SELECT user_id, d::VARCHAR AS day, e AS event_id, r::BIGINT AS source_rank FROM (SELECT * FROM a UNION ALL SELECT * FROM b) QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, d ORDER BY r) = 1""")
def _(t):
    kind = lambda k: t.events.filter(F.col("event_type") == k).select("user_id", "ts", "event_id")
    return P.daily_snapshot([kind("view"), kind("click")], ["user_id"], "ts", ["event_id"]).drop("ts")


# Brands as styles, part types as sizes, monthly net moves of quantity as stock on the first of the month.
_STOCK = f"(SELECT p_brand AS style, p_type AS size, date_trunc('month', ship_date)::DATE AS day, SUM(CASE returnflag WHEN 'R' THEN qty ELSE -qty END) AS q FROM {SQL_LINES} JOIN part ON p_partkey = partkey GROUP BY 1, 2, 3)"
_STATUS = f"""(WITH g AS (SELECT style, size, unnest(generate_series(MIN(day)::TIMESTAMP, MAX(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM {_STOCK} GROUP BY 1, 2), f AS (SELECT g.style, g.size, g.day, COALESCE(q, 0) AS q FROM g LEFT JOIN {_STOCK} USING (style, size, day))
 SELECT style, day, COUNT(*) AS sizes, COUNT(*) FILTER (q > 0) AS sizes_in_stock, COUNT(*) FILTER (size IN ('MEDIUM', 'LARGE') AND q <= 0) AS core_out FROM f GROUP BY 1, 2)"""


def _stock(t):
    moved = t.lines().join(t.part, F.col("partkey") == F.col("p_partkey"))
    signed = F.when(F.col("returnflag") == "R", F.col("qty")).otherwise(-F.col("qty"))
    return moved.groupBy(F.col("p_brand").alias("style"), F.col("p_type").alias("size"), F.to_date(F.date_trunc("month", "ship_date")).alias("day")).agg(F.sum(signed).alias("q"))


def _status(t):
    return P.stock_status(_stock(t), "style", "size", "day", "q", ["MEDIUM", "LARGE"])


@query("d38_stock_status", f"SELECT style, day::VARCHAR AS day, sizes::BIGINT AS sizes, sizes_in_stock::BIGINT AS sizes_in_stock, core_out::BIGINT AS core_out, sizes_in_stock = 0 AS sold_out, core_out > 0 AND sizes_in_stock > 0 AS core_broken FROM {_STATUS}")
def _(t):
    return _status(t)


_DAYQ = f"(SELECT p_brand AS style, ship_date::DATE AS day, COUNT(DISTINCT p_type) AS sizes_in_stock, 5 AS sizes FROM {SQL_LINES} JOIN part ON p_partkey = partkey GROUP BY 1, 2)"


@query("d39_full_size_periods", f"""WITH s AS (SELECT style, day, sizes_in_stock >= 4 AS f FROM {_DAYQ}), l AS (SELECT *, LAG(f) OVER w AS pf, LAG(day) OVER w AS pd FROM s WINDOW w AS (PARTITION BY style ORDER BY day)),
 n AS (SELECT *, SUM((f AND (NOT COALESCE(pf, false) OR day - pd > 1))::INT) OVER (PARTITION BY style ORDER BY day) AS p FROM l) SELECT style, p::BIGINT AS period, MIN(day)::VARCHAR AS start_day, MAX(day)::VARCHAR AS end_day, COUNT(*)::BIGINT AS days FROM n WHERE f GROUP BY 1, 2""")
def _(t):
    sold = t.lines().join(t.part, F.col("partkey") == F.col("p_partkey"))
    daily = sold.groupBy(F.col("p_brand").alias("style"), F.to_date("ship_date").alias("day")).agg(F.least(F.count_distinct("p_type"), F.lit(4)).alias("sizes_in_stock"))
    return P.full_size_periods(daily.withColumn("sizes", F.lit(4)), "style", "day")


_BD = f"(SELECT p_brand AS brand, ship_date::DATE AS day, SUM(qty) AS units, COUNT(*) AS orders FROM {SQL_LINES} JOIN part ON p_partkey = partkey GROUP BY 1, 2)"


@query("d40_trailing_windows", f"SELECT brand, day::VARCHAR AS day, SUM(units) OVER w::BIGINT AS units_30_sum, (SUM(units) OVER w)::DOUBLE / (COUNT(units) OVER w)::DOUBLE AS units_30_avg, (SUM(orders) OVER w)::DOUBLE / (COUNT(orders) OVER w)::DOUBLE AS orders_30_avg FROM {_BD} WINDOW w AS (PARTITION BY brand ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)")
def _(t):
    sold = t.lines().join(t.part, F.col("partkey") == F.col("p_partkey"))
    daily = sold.groupBy(F.col("p_brand").alias("brand"), F.to_date("ship_date").alias("day")).agg(F.sum("qty").alias("units"), row_count().alias("orders"))
    out = P.trailing(daily, ["brand"], "day", ["units", "orders"])
    return out.select("brand", "day", "units_30_sum", "units_30_avg", "orders_30_avg")


_PB = f"(SELECT partkey, p_brand, SUM(qty) AS units FROM {SQL_LINES} JOIN part ON p_partkey = partkey GROUP BY 1, 2)"


def _part_units(t):
    units = t.lines().groupBy("partkey").agg(F.sum("qty").alias("units"))
    return units.join(t.part.select(F.col("p_partkey").alias("partkey"), "p_brand"), "partkey")


@query("d40_bottom_threshold", f"SELECT partkey, units::BIGINT AS units, ROUND(h, 6) AS threshold, units < h AS under_threshold FROM {_PB} JOIN (SELECT p_brand, quantile_cont(units::DOUBLE, 0.15) AS h FROM {_PB} GROUP BY 1) USING (p_brand)")
def _(t):
    out = P.bottom_threshold(_part_units(t), ["p_brand"], "units")
    return out.select("partkey", "units", F.round("threshold", 6).alias("threshold"), "under_threshold")


@query("d40_percent_rank", f"SELECT partkey, PERCENT_RANK() OVER (PARTITION BY p_brand ORDER BY units)::DOUBLE AS pr FROM {_PB}")
def _(t):
    return P.percent_rank_of(_part_units(t), ["p_brand"], "units", "pr").select("partkey", "pr")


_PO = """(SELECT l_orderkey AS po, l_partkey AS sku, l_linenumber AS line, l_quantity::BIGINT AS qty, l_suppkey AS supp, l_extendedprice::DECIMAL(18,4) AS cost, CASE WHEN l_returnflag <> 'R' THEN l_shipdate::DATE END AS ship, CASE WHEN l_returnflag <> 'A' THEN o_orderdate::DATE END AS ordered FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""
_PO1 = f"""(SELECT *, LEAST(COALESCE(ship, DATE '9999-12-31'), COALESCE(ordered, DATE '9999-12-31'), COALESCE(ship, ordered, DATE '1900-01-01')) AS start_date FROM {_PO} QUALIFY ROW_NUMBER() OVER (PARTITION BY po, sku, line ORDER BY qty DESC, supp DESC, cost DESC) = 1)"""


def _po(t):
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        F.col("l_orderkey").alias("po"), F.col("l_partkey").alias("sku"), F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("long").alias("qty"),
        F.col("l_suppkey").alias("supp"), F.col("l_extendedprice").cast("decimal(18,4)").alias("cost"),
        F.when(F.col("l_returnflag") != "R", F.to_date("l_shipdate")).alias("ship"), F.when(F.col("l_returnflag") != "A", F.to_date("o_orderdate")).alias("ordered"),
    )


@query("d41_purchase_costs", f"""SELECT po, sku, line::BIGINT AS line, qty, cost::DOUBLE AS cost, start_date::VARCHAR AS start_date FROM {_PO1}
 UNION ALL SELECT po, sku, -1, SUM(qty)::BIGINT, CAST((CAST(SUM(cost * qty) * 10000 AS HUGEINT) * 2 + SUM(qty)) // (2 * SUM(qty)) AS DOUBLE) / 10000, MIN(start_date)::VARCHAR FROM {_PO1} GROUP BY 1, 2""")
def _(t):
    return P.purchase_costs(_po(t), "po", "sku", "line", ["ship", "ordered"], ["cost"], "qty", ["supp", "cost"])


@query("d41_cost_ranges", f"""WITH a AS (SELECT sku, po, MIN(start_date) AS d FROM {_PO1} GROUP BY 1, 2), x AS (SELECT sku, d, MAX(po) AS po FROM a GROUP BY 1, 2)
 SELECT sku, po, d::TIMESTAMP::VARCHAR AS effective_start, COALESCE(LEAD(d) OVER (PARTITION BY sku ORDER BY d)::TIMESTAMP - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31')::VARCHAR AS effective_end FROM x""")
def _(t):
    costs = P.purchase_costs(_po(t), "po", "sku", "line", ["ship", "ordered"], ["cost"], "qty", ["supp", "cost"])
    return P.cost_ranges(costs, "sku", "po", "line").select("sku", "po", "effective_start", "effective_end")


@query("d68_sales_inventory_base", f"""SELECT COALESCE(a.partkey, b.partkey) AS partkey, COALESCE(a.d, b.d)::VARCHAR AS day, COALESCE(sold, 0)::BIGINT AS sold, COALESCE(returned, 0)::BIGINT AS returned FROM (SELECT partkey, ship_date::DATE AS d, SUM(qty) AS sold FROM {SQL_LINES} WHERE returnflag = 'A' GROUP BY 1, 2) a
 FULL JOIN (SELECT partkey, ship_date::DATE AS d, SUM(qty) AS returned FROM {SQL_LINES} WHERE returnflag = 'R' GROUP BY 1, 2) b ON a.partkey = b.partkey AND a.d = b.d""")
def _(t):
    of = lambda flag, out: t.lines().filter(F.col("returnflag") == flag).groupBy("partkey", F.to_date("ship_date").alias("day")).agg(F.sum("qty").alias(out))
    return P.sales_inventory_base(of("A", "sold"), of("R", "returned"), "partkey", "day")
