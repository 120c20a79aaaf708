"""Currency, finance and period pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.functions import semantics as S
from tidemart.operators.merge import effective_rates
from tidemart.plans import money as P
from tidemart.plans.members import month_of
from tidemart.workload.base import SQL_SALES, money, query


# Rates: one currency per order status, re-fixed every quarter from the number of orders.
_RATES = """(SELECT o_orderstatus AS cur, date_trunc('quarter', o_orderdate) AS q, CAST(1 + COUNT(*) / 1000 AS DECIMAL(18,6)) AS r FROM orders GROUP BY 1, 2)"""


def _rates(t):
    q = t.orders.groupBy(
        F.col("o_orderstatus").alias("src_currency"), F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz").alias("rate_datetime")
    )
    return q.agg((F.lit(1) + row_count() / F.lit(1000)).cast("decimal(18,6)").alias("exchange_rate"))


@query("d42_currency_conversion", f"""WITH v AS (SELECT cur, r, CASE WHEN ROW_NUMBER() OVER w = 1 THEN TIMESTAMP '1900-01-01' ELSE q END AS s, COALESCE(LEAD(q) OVER w - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31') AS e FROM {_RATES} WINDOW w AS (PARTITION BY cur ORDER BY q))
 SELECT o_orderkey, CAST(o_totalprice::DECIMAL(18,2) * r AS DECIMAL(28,6))::DOUBLE AS converted FROM orders LEFT JOIN v ON cur = o_orderstatus AND o_orderdate BETWEEN s AND e""")
def _(t):
    ranged = effective_rates(_rates(t), ["src_currency"], "rate_datetime")
    amounts = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("currency"), "o_orderdate", money("o_totalprice").alias("amount"))
    return P.convert(amounts, ranged, "currency", "o_orderdate", "amount", "converted").select("o_orderkey", "converted")


@query("d42_monthly_rates", f"""WITH d AS (SELECT cur, unnest(generate_series(a::DATE::TIMESTAMP, b::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM (SELECT DISTINCT cur FROM {_RATES}) CROSS JOIN (SELECT MIN(q) AS a, MAX(q) AS b FROM {_RATES})), x AS (SELECT d.cur, day, arg_max(r, q) AS r FROM d JOIN {_RATES} v ON v.cur = d.cur AND q <= day GROUP BY 1, 2)
 SELECT cur AS src_currency, date_trunc('month', day)::DATE::VARCHAR AS month, SUM(r)::DOUBLE / COUNT(*)::DOUBLE AS average_rate FROM x GROUP BY 1, 2""")
def _(t):
    rates = _rates(t)
    first, last = (rates.agg(F.to_date(f("rate_datetime"))).scalar() for f in (F.min, F.max))
    return P.monthly_average(P.daily_rates(rates, "src_currency", first, last), "src_currency")


_MON = "(SELECT o_orderpriority AS bu, date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) AS v, COUNT(*) AS n FROM orders GROUP BY 1, 2)"


def _monthly(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("bu"), month_of("o_orderdate").alias("m")).agg(F.sum(money("o_totalprice")).alias("v"), row_count().alias("n"))


@query("d43_carry_forward", f"""WITH a AS (SELECT * FROM {_MON} UNION ALL SELECT bu, (m + INTERVAL 1 MONTH * k)::DATE, v, n FROM {_MON}, generate_series(1, 3) g(k) WHERE m = (SELECT MAX(m) FROM {_MON}))
 SELECT bu, m::VARCHAR AS m, v::DOUBLE AS v, n::BIGINT AS n, (SUM(v) OVER w)::DOUBLE / (SUM(n) OVER w)::DOUBLE AS rolling FROM a WINDOW w AS (PARTITION BY bu ORDER BY m ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)""")
def _(t):
    ahead = P.carried_forward(_monthly(t), ["bu"], "m")
    return P.rolling_ratio(ahead, ["bu"], "m", "v", "n", "rolling")


@query("d43_previous_known", f"SELECT bu, m::VARCHAR AS m, COALESCE(LAST_VALUE(CASE WHEN n % 2 = 0 THEN n END IGNORE NULLS) OVER (PARTITION BY bu ORDER BY m ROWS UNBOUNDED PRECEDING), 0)::DOUBLE AS c FROM {_MON}")
def _(t):
    gaps = _monthly(t).select("bu", "m", F.when(F.col("n") % 2 == 0, F.col("n")).cast("double").alias("c"))
    return P.previous_known(gaps, ["bu"], "m", "c")


@query("d44_budget_forecast_actual", """WITH p AS (SELECT c_mktsegment AS seg, date_trunc('month', o_orderdate)::DATE AS m, o_orderpriority AS ver, o_totalprice::DECIMAL(18,2) AS v FROM orders JOIN customer ON o_custkey = c_custkey),
 l AS (SELECT seg, m, MAX(ver) AS ver FROM p GROUP BY 1, 2), f AS (SELECT p.* FROM p JOIN l USING (seg, m, ver)), b AS (SELECT seg, m, SUM(v) AS v FROM p WHERE ver = '1-URGENT' GROUP BY 1, 2)
 SELECT seg, m::VARCHAR AS m, COALESCE(b, 0)::DOUBLE AS budget, COALESCE(f, 0)::DOUBLE AS forecast, a::DOUBLE AS actual, a::DOUBLE / NULLIF(COALESCE(b, 0)::DOUBLE, 0) AS to_budget, a::DOUBLE / NULLIF(f::DOUBLE, 0) AS to_forecast FROM (SELECT seg, m, SUM(v) AS a FROM p GROUP BY 1, 2) LEFT JOIN (SELECT seg, m, v AS b FROM b) USING (seg, m) LEFT JOIN (SELECT seg, m, SUM(v) AS f FROM f GROUP BY 1, 2) USING (seg, m)""")
def _(t):
    p = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("seg"), month_of("o_orderdate").alias("m"), F.col("o_orderpriority").alias("ver"), money("o_totalprice").alias("v")
    )
    return P.budget_forecast_actual(p.filter("ver = '1-URGENT'"), P.latest_versions(p, ["seg", "m"], "ver"), p, ["seg", "m"], "v")


@query("d45_kpi_base", f"""WITH d AS (SELECT priority AS p, order_date::DATE AS day, SUM(net) AS v, SUM(qty) AS u FROM {SQL_SALES} GROUP BY 1, 2), g AS (SELECT p, unnest(generate_series((SELECT MIN(day) FROM d)::TIMESTAMP, (SELECT MAX(day) FROM d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM (SELECT DISTINCT p FROM d)),
 f AS (SELECT g.p, g.day, COALESCE(v, 0) AS v, COALESCE(u, 0) AS u FROM g LEFT JOIN d USING (p, day)) SELECT p, day::VARCHAR AS day, date_trunc('month', day)::DATE::VARCHAR AS month, v::DOUBLE AS v, u::BIGINT AS u, (SUM(v) OVER w)::DOUBLE AS v_mtd, (SUM(u) OVER w)::BIGINT AS u_mtd FROM f WINDOW w AS (PARTITION BY p, date_trunc('month', day) ORDER BY day)""")
def _(t):
    daily = t.sales().groupBy(F.col("priority").alias("p"), F.to_date("order_date").alias("day")).agg(F.sum("net").alias("v"), F.sum("qty").alias("u"))
    return P.kpi_base(daily, ["p"], "day", ["v", "u"])


@query("d46_restated", f"""WITH c AS (SELECT 'placed' AS date_object, order_date::DATE AS date, returnflag, net, qty FROM {SQL_SALES} UNION ALL SELECT 'shipped', ship_date::DATE, returnflag, net, qty FROM {SQL_SALES})
 SELECT date::VARCHAR AS date, date_object, currency_object, returnflag, SUM(CASE currency_object WHEN 'usd' THEN net ELSE CAST(net * 0.8 AS DECIMAL(18,4)) END)::DOUBLE AS revenue, SUM(qty)::BIGINT AS units FROM c CROSS JOIN (VALUES ('usd'), ('eur')) k(currency_object) GROUP BY 1, 2, 3, 4""")
def _(t):
    s = t.sales().withColumn("net_eur", (F.col("net") * F.lit("0.8").cast("decimal(2,1)")).cast("decimal(18,4)"))
    currencies = {"usd": {"revenue": "net", "units": "qty"}, "eur": {"revenue": "net_eur", "units": "qty"}}
    return P.restated(s, {"placed": "order_date", "shipped": "ship_date"}, currencies, ["returnflag"], ["revenue", "units"])


_SUN = "(d - dayofweek(d)::INT)::DATE"
_PERIODS = f"""(SELECT d, v, 'Weekly' AS period, {_SUN} AS a, ({_SUN} + 6)::DATE AS b, p FROM x UNION ALL SELECT d, v, 'Monthly', date_trunc('month', d)::DATE, (date_trunc('month', d) + INTERVAL 1 MONTH)::DATE - 1, p FROM x
 UNION ALL SELECT d, v, 'Quarterly', date_trunc('quarter', d)::DATE, (date_trunc('quarter', d) + INTERVAL 3 MONTH)::DATE - 1, p FROM x UNION ALL SELECT d, v, 'Yearly', date_trunc('year', d)::DATE, (date_trunc('year', d) + INTERVAL 12 MONTH)::DATE - 1, p FROM x)"""


@query("d55_period_totals", f"""WITH x AS (SELECT order_date::DATE AS d, priority AS p, SUM(net) AS v FROM {SQL_SALES} WHERE order_date < TIMESTAMP '2001-05-16' GROUP BY 1, 2)
 SELECT period, a::VARCHAR AS start_day, LEAST(b, DATE '2001-05-15')::VARCHAR AS end_day, p, SUM(v)::DOUBLE AS v FROM {_PERIODS} GROUP BY 1, 2, 3, 4""")
def _(t):
    daily = t.sales().groupBy(F.to_date("order_date").alias("d"), F.col("priority").alias("p")).agg(F.sum("net").alias("v"))
    return P.period_totals(daily, "d", ["p"], ["v"], F.lit("2001-05-16").cast("date"))


@query("v08_period_comparison", f"""WITH x AS (SELECT order_date::DATE AS d, 1 AS p, SUM(net) AS v FROM {SQL_SALES} WHERE order_date < TIMESTAMP '2001-05-16' GROUP BY 1), t AS (SELECT a, SUM(v) AS v FROM {_PERIODS} WHERE period = 'Monthly' GROUP BY 1)
 SELECT a::VARCHAR AS start_day, v::DOUBLE AS v, COALESCE(LAG(v, 1) OVER (ORDER BY a), 0)::DOUBLE AS last_month, COALESCE(LAG(v, 12) OVER (ORDER BY a), 0)::DOUBLE AS last_year FROM t""")
def _(t):
    daily = t.sales().groupBy(F.to_date("order_date").alias("d")).agg(F.sum("net").alias("v"))
    months = P.period_totals(daily, "d", [], ["v"], F.lit("2001-05-16").cast("date")).filter("period = 'Monthly'").select("start_day", "v")
    back = lambda n, out: months.select(F.add_months("start_day", n).alias("start_day"), F.col("v").alias(out))
    joined = months.join(back(1, "last_month"), "start_day", "left").join(back(12, "last_year"), "start_day", "left")
    return joined.fillna(0, ["last_month", "last_year"])


@query("v07_payback", """WITH c AS (SELECT o_custkey, date_trunc('month', MIN(o_orderdate))::DATE AS m FROM orders GROUP BY 1), r AS (SELECT c.m, date_diff('month', c.m, o_orderdate) AS k, SUM(o_totalprice::DECIMAL(18,2)) AS v FROM orders JOIN c USING (o_custkey) GROUP BY 1, 2),
 s AS (SELECT m, COUNT(*) * 100000 AS cost FROM c GROUP BY 1) SELECT m::VARCHAR AS cohort_month, k::BIGINT AS tenure, (SUM(v) OVER (PARTITION BY m ORDER BY k))::DOUBLE AS value_to_date, (SUM(v) OVER (PARTITION BY m ORDER BY k)) >= cost AS paid_back FROM r JOIN s USING (m)""")
def _(t):
    from tidemart.operators.scan import Scan, ordered_scan
    from tidemart.plans.members import customer_months

    o = t.orders.select("o_custkey", "o_orderdate", money("o_totalprice").alias("v"))
    months = customer_months(o, "o_custkey", "o_orderdate", "v")
    spend = months.groupBy("cohort_month").agg((F.count_distinct("o_custkey") * 100000).alias("cost"))
    by = months.groupBy("cohort_month", S.boundaries("month", "cohort_month", "activity_month").alias("tenure")).agg(F.sum("revenue").alias("v"))
    upto = ordered_scan(by, ["cohort_month"], ["tenure"], [Scan("value_to_date", "sum", "v")])
    return upto.join(spend, "cohort_month").select("cohort_month", "tenure", "value_to_date", (F.col("value_to_date") >= F.col("cost")).alias("paid_back"))


@query("d59_traffic_in_hours", """WITH h AS (SELECT s_suppkey, w, CASE WHEN w IN ('sat', 'sun') THEN 600 ELSE 540 END AS o, CASE WHEN s_nationkey < 12 THEN 1050 ELSE 1200 END AS c FROM supplier CROSS JOIN (VALUES ('mon'), ('tue'), ('wed'), ('thu'), ('fri'), ('sat')) k(w))
 SELECT user_id AS store, ts::DATE::VARCHAR AS day, COUNT(*) FILTER (o IS NOT NULL AND hour(ts) * 60 + minute(ts) >= o AND hour(ts) * 60 + minute(ts) < c)::BIGINT AS in_hours, COUNT(*) FILTER (NOT COALESCE(hour(ts) * 60 + minute(ts) >= o AND hour(ts) * 60 + minute(ts) < c, false))::BIGINT AS out_of_hours
 FROM events LEFT JOIN h ON s_suppkey = user_id AND w = lower(left(dayname(ts), 3)) GROUP BY 1, 2""")
def _(t):
    closes = F.when(F.col("s_nationkey") < 12, "17:30").otherwise("20:00")
    week = F.concat(F.lit("09:00-"), closes)
    stores = t.supplier.select(
        F.col("s_suppkey").alias("store"), *[week.alias(d) for d in ("mon", "tue", "wed", "thu", "fri")],
        F.concat(F.lit("10:00-"), closes).alias("sat"), F.lit("closed").alias("sun"),
    )
    hours = P.open_hours(stores, "store", ["mon", "tue", "wed", "thu", "fri", "sat", "sun"])
    return P.traffic_in_hours(t.events.select(F.col("user_id").alias("store"), "ts"), hours, "store", "ts")


_FC = """(SELECT o_orderpriority AS unit, date_trunc('hour', o_orderdate) + INTERVAL 1 HOUR * k AS tgt, date_trunc('hour', o_orderdate) + INTERVAL 1 HOUR * CASE WHEN k < 2 THEN k ELSE 0 END AS made, COUNT(*) * (k + 1) AS v, COUNT(*) AS act FROM orders, generate_series(0, 3) g(k) GROUP BY 1, 2, 3, k)"""


@query("d67_forecast_by_horizon", f"""WITH s AS (SELECT unit, tgt AS h, v AS forecast, act FROM {_FC} WHERE tgt = made), l AS (SELECT DISTINCT unit, made AS h, tgt AS th, v AS lf FROM {_FC} WHERE tgt <> made), a AS (SELECT DISTINCT unit, h - INTERVAL 1 HOUR AS h, act FROM s)
 SELECT s.unit, s.h::VARCHAR AS hour, s.forecast::BIGINT AS forecast, COALESCE(th::VARCHAR, '-') AS target_hour, COALESCE(lf, -1)::BIGINT AS later_forecast, COALESCE(a.act, -1)::BIGINT AS actual FROM s LEFT JOIN l ON l.unit = s.unit AND l.h = s.h LEFT JOIN a ON a.unit = s.unit AND a.h = s.h""")
def _(t):
    base = t.orders.groupBy(F.col("o_orderpriority").alias("unit"), F.date_trunc("hour", "o_orderdate").cast("timestamp_ntz").alias("h")).agg(row_count().alias("n"))
    k = base.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    ahead = lambda n: F.timestamp_add("HOUR", n, F.col("h"))
    stored = k.select(
        "unit", ahead(F.col("k")).alias("at"), ahead(F.when(F.col("k") < 2, F.col("k")).otherwise(0)).alias("made"),
        (F.col("n") * (F.col("k") + 1)).alias("v"), F.col("n").alias("actual_last_hour"),
    )
    out = P.forecast_by_horizon(stored, ["unit"], "at", "made", "v")
    return out.select(
        "unit", "hour", "forecast", F.coalesce(F.col("target_hour").cast("string"), F.lit("-")).alias("target_hour"),
        F.coalesce("later_forecast", F.lit(-1)).alias("later_forecast"), F.coalesce("actual", F.lit(-1)).alias("actual"),
    )
