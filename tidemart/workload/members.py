"""Cohorts, lifetime value, membership and billing on orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.plans import members as P
from tidemart.workload.base import SQL_SALES, money, query

_M = "date_trunc('month', {})::DATE"


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("amount"), "o_orderpriority")


_CM = """SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m, COUNT(*) AS orders, SUM(o_totalprice::DECIMAL(18,2)) AS revenue FROM orders GROUP BY 1, 2"""


@query("d01_cohort_waterfall", f"""WITH x AS (SELECT cm.*, MIN(m) OVER (PARTITION BY cm.o_custkey) AS cohort, MAX(m) OVER (PARTITION BY cm.o_custkey) AS last_m, c_mktsegment FROM ({_CM}) cm JOIN customer ON c_custkey = o_custkey),
 y AS (SELECT cohort, m, c_mktsegment, COUNT(DISTINCT o_custkey) AS customers, COUNT(*) FILTER (m = cohort) AS activations, COUNT(*) FILTER (m = last_m) AS final_months, SUM(orders) AS orders, SUM(revenue) AS revenue FROM x GROUP BY 1, 2, 3),
 s AS (SELECT DISTINCT o_custkey, cohort, last_m, c_mktsegment FROM x)
 SELECT cohort::VARCHAR AS cohort_month, m::VARCHAR AS activity_month, c_mktsegment, customers::BIGINT AS customers, activations::BIGINT AS activations, final_months::BIGINT AS final_months, orders::BIGINT AS orders, revenue::DOUBLE AS revenue, date_diff('month', cohort, m)::BIGINT AS month_number,
  CASE WHEN m = cohort THEN 0 ELSE (SELECT COUNT(*) FROM s WHERE s.cohort = y.cohort AND s.c_mktsegment = y.c_mktsegment AND s.last_m >= y.m) END::BIGINT AS bop FROM y""")
def _(t):
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return P.cohort_waterfall(_orders(t).join(segments, "o_custkey"), "o_custkey", "o_orderdate", "amount", ["c_mktsegment"])


@query("d02_lead_waterfall", """WITH l AS (SELECT o_custkey, c_mktsegment AS seg, MIN(o_orderdate) AS lead_at, MIN(o_orderdate) FILTER (o_orderpriority = '1-URGENT') AS conv FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
 b AS (SELECT *, date_diff('month', lead_at, conv) + 1 AS n, CASE seg WHEN 'BUILDING' THEN 7 WHEN 'MACHINERY' THEN 10 ELSE 14 END AS cap FROM l)
 SELECT 'lead' AS population, seg, date_trunc('month', lead_at)::DATE::VARCHAR AS month, 'M0' AS tenure, COUNT(*)::BIGINT AS people FROM b GROUP BY ALL
 UNION ALL SELECT 'conversion', seg, date_trunc('month', conv)::DATE::VARCHAR, CASE WHEN n >= cap THEN 'M' || cap || '+' ELSE 'M' || n END, COUNT(*)::BIGINT FROM b WHERE conv IS NOT NULL GROUP BY ALL""")
def _(t):
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("seg"))
    leads = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("lead_at"), F.min(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate"))).alias("conv")
    )
    return P.lead_waterfall(leads.join(segments, "o_custkey"), "lead_at", "conv", "seg", {"BUILDING": 7, "MACHINERY": 10})


@query("d03_refund_waterfall", f"""WITH o AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) AS total FROM orders GROUP BY 1),
 r AS (SELECT date_trunc('month', order_date)::DATE AS m, date_diff('month', order_date, ship_date) AS k, SUM(net) AS refund, COUNT(DISTINCT orderkey) AS n FROM {SQL_SALES} WHERE returnflag = 'R' GROUP BY 1, 2)
 SELECT m::VARCHAR AS order_month, k::BIGINT AS month_offset, refund::DOUBLE AS event_total, n::BIGINT AS event_orders, total::DOUBLE AS order_total, refund::DOUBLE / total::DOUBLE AS share FROM r JOIN o USING (m)""")
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderdate").alias("order_date"), money("o_totalprice").alias("total"))
    refunds = t.lines().filter("returnflag = 'R'").select("orderkey", "ship_date", "net")
    return P.event_waterfall(orders, refunds, "orderkey", "order_date", "total", "ship_date", "net")


ACTIVE = ("signup", "purchase")


def _timeline(t):
    return P.membership_timeline(t.events, "user_id", "ts", "event_type", ["event_id"])


_TL = "(SELECT user_id, event_type AS state, ts AS s, COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31') AS e FROM events)"


@query("d04_bop_eop_counts", f"""WITH a AS (SELECT state, s, e FROM {_TL} WHERE state IN ('signup', 'purchase')),
 d AS (SELECT state, unnest(generate_series((min(s)::DATE)::TIMESTAMP, max(GREATEST(s, CASE WHEN e < TIMESTAMP '9999-01-01' THEN e ELSE s END))::DATE + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM a GROUP BY 1),
 c AS (SELECT d.state, day, COUNT(*) FILTER (s < day AND e >= day) AS bop FROM d JOIN a ON a.state = d.state GROUP BY 1, 2)
 SELECT state, day::DATE::VARCHAR AS day, bop::BIGINT AS bop, COALESCE(LEAD(bop) OVER (PARTITION BY state ORDER BY day), bop)::BIGINT AS eop FROM c""")
def _(t):
    active = _timeline(t).filter(F.col("state").isin(*ACTIVE))
    # The calendar starts the day before the first begin-of-day count, which is the day of the first event.
    return P.period_counts(active, "start_at", "end_at", ["state"])


@query("d05_lifetime_monthly", f"""WITH cm AS ({_CM}), f AS (SELECT o_custkey, MIN(m) AS cohort FROM cm GROUP BY 1),
 g AS (SELECT o_custkey, cohort, unnest(generate_series(cohort::TIMESTAMP, TIMESTAMP '2001-08-01', INTERVAL 1 MONTH))::DATE AS m FROM f),
 x AS (SELECT g.o_custkey, g.m, COALESCE(orders, 0) AS orders, SUM(COALESCE(revenue, 0)) OVER w AS margin_to_date, SUM(COALESCE(orders, 0)) OVER w AS orders_to_date FROM g LEFT JOIN cm USING (o_custkey, m) WINDOW w AS (PARTITION BY g.o_custkey ORDER BY g.m))
 SELECT o_custkey, m::VARCHAR AS month, orders::BIGINT AS orders, margin_to_date::DOUBLE AS margin_to_date, orders_to_date::BIGINT AS orders_to_date, NTILE(10) OVER (PARTITION BY m ORDER BY margin_to_date, o_custkey)::BIGINT AS value_tile FROM x""")
def _(t):
    out = P.lifetime_monthly(_orders(t), "o_custkey", "o_orderdate", "amount", F.lit("2001-08-01").cast("date"))
    return out.select("o_custkey", "month", "orders", "margin_to_date", "orders_to_date", "value_tile")


_SPEND = "(SELECT date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) / 100 AS spend FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1)"


@query("d06_lifetime_to_date", """WITH c AS (SELECT o_custkey, date_trunc('month', MIN(o_orderdate))::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) AS v FROM orders GROUP BY 1),
 g AS (SELECT m, COUNT(*) AS n, SUM(v) AS v FROM c GROUP BY 1), s AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) AS spend FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1)
 SELECT m::VARCHAR AS cohort_month, n::BIGINT AS customers, v::DOUBLE AS value, COALESCE(spend, 0)::DOUBLE AS spend, v::DOUBLE / n::DOUBLE AS value_per_customer, COALESCE(spend, 0)::DOUBLE / n::DOUBLE AS spend_per_customer FROM g LEFT JOIN s USING (m)""")
def _(t):
    spend = t.orders.filter("o_orderpriority = '5-LOW'").groupBy(P.month_of("o_orderdate").alias("cohort_month")).agg(F.sum(money("o_totalprice")).alias("spend"))
    return P.lifetime_to_date(_orders(t), "o_custkey", "o_orderdate", "amount", spend)


_CHANNEL = "(SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS channel FROM orders GROUP BY 1)"


@query("d07_lifetime_by_channel", f"""WITH cm AS (SELECT x.*, MIN(m) OVER (PARTITION BY o_custkey) AS cohort FROM ({_CM}) x)
 SELECT channel, cohort::VARCHAR AS cohort_month, date_diff('month', cohort, m)::BIGINT AS tenure, COUNT(DISTINCT o_custkey)::BIGINT AS customers, SUM(revenue)::DOUBLE AS revenue FROM cm JOIN {_CHANNEL} USING (o_custkey) GROUP BY ALL""")
def _(t):
    first = t.orders.groupBy("o_custkey").agg(F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("channel"))
    return P.lifetime_by_channel(_orders(t), "o_custkey", "o_orderdate", "amount", first, "channel")


@query("d08_membership_timeline", f"SELECT user_id, state, s::VARCHAR AS start_at, e::VARCHAR AS end_at, e = TIMESTAMP '9999-12-31' AS is_current FROM {_TL}")
def _(t):
    return _timeline(t)


_MEMBER = "(SELECT user_id, event_type AS state, ts AS s, COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31') AS e FROM events WHERE event_type IN ('signup', 'error'))"


@query("d09_state_at_event", f"""SELECT event_id, COALESCE(state, 'Prospect') AS membership_state, COALESCE(date_diff('day', s::DATE, ts::DATE), 0)::BIGINT AS tenure_days,
 CASE WHEN state = 'signup' THEN date_diff('month', s, ts) + 1 ELSE 0 END::BIGINT AS tenure_months FROM events v LEFT JOIN {_MEMBER} m ON m.user_id = v.user_id AND v.ts BETWEEN s AND e WHERE event_type = 'purchase'""")
def _(t):
    members = P.membership_timeline(t.events.filter("event_type IN ('signup', 'error')"), "user_id", "ts", "event_type", ["event_id"])
    buys = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return P.state_at_event(buys, members, "user_id", "ts", "signup").drop("user_id", "ts")


@query("d10_action_periods", """WITH a AS (SELECT o_custkey, date_trunc('month', o_orderdate)::DATE AS m, CASE o_orderstatus WHEN 'F' THEN 'Purchase' WHEN 'O' THEN 'Skip' ELSE 'Cancel' END AS k FROM orders),
 g AS (SELECT o_custkey, unnest(generate_series(MIN(m)::TIMESTAMP, TIMESTAMP '2001-08-01', INTERVAL 1 MONTH))::DATE AS m FROM a GROUP BY 1)
 SELECT g.o_custkey, g.m::VARCHAR AS month, COALESCE(MAX((k = 'Purchase')::INT), 0)::BIGINT AS purchase, COALESCE(MAX((k = 'Skip')::INT), 0)::BIGINT AS skip, COALESCE(MAX((k = 'Cancel')::INT), 0)::BIGINT AS cancel, (COUNT(k) = 0)::BIGINT AS no_action, COUNT(k)::BIGINT AS actions FROM g LEFT JOIN a ON a.o_custkey = g.o_custkey AND a.m = g.m GROUP BY 1, 2""")
def _(t):
    kind = F.when(F.col("o_orderstatus") == "F", "Purchase").when(F.col("o_orderstatus") == "O", "Skip").otherwise("Cancel")
    acts = t.orders.select("o_custkey", "o_orderdate", kind.alias("k"))
    return P.action_periods(acts, "o_custkey", "o_orderdate", "k", ["Purchase", "Skip", "Cancel"], F.lit("2001-08-01").cast("date"))


@query("d11_billing_cycle_rates", """WITH o AS (SELECT o_custkey AS c, date_trunc('month', o_orderdate)::DATE AS m, day(o_orderdate) AS d, o_orderstatus AS k FROM orders), u AS (SELECT DISTINCT c, m, c_mktsegment AS seg FROM o JOIN customer ON c_custkey = c),
 f AS (SELECT u.c, u.m, u.seg, MIN(d) FILTER (k = 'F') AS f, MIN(d) FILTER (k = 'O') AS o, MIN(d) FILTER (k = 'P') AS p FROM u JOIN o ON o.c = u.c AND o.m = u.m GROUP BY 1, 2, 3),
 g AS (SELECT seg, m, i AS day, COALESCE(f <= i, false) AS f, COALESCE(o <= i, false) AS o, COALESCE(p <= i, false) AS p FROM f, generate_series(1, 5) x(i))
 SELECT m::VARCHAR AS month, day::BIGINT AS day, seg, COUNT(*)::BIGINT AS members, COUNT(*) FILTER (f)::BIGINT AS "F_unique", COUNT(*) FILTER (o)::BIGINT AS "O_unique", COUNT(*) FILTER (p)::BIGINT AS "P_unique", COUNT(*) FILTER (f)::BIGINT AS "F_only", COUNT(*) FILTER (o AND NOT f)::BIGINT AS "O_only", COUNT(*) FILTER (p AND NOT f AND NOT o)::BIGINT AS "P_only", COUNT(*) FILTER (NOT (f OR o OR p))::BIGINT AS none,
 COUNT(*) FILTER (CASE WHEN (seg = 'BUILDING' AND m < DATE '1998-01-01') OR (seg = 'MACHINERY' AND m < DATE '2000-01-01') THEN NOT (f OR o OR p) ELSE NOT (o OR p) END)::BIGINT AS eligible FROM g GROUP BY 1, 2, 3""")
def _(t):
    segments = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("seg"))
    members = t.orders.select("o_custkey", P.month_of("o_orderdate").alias("month")).distinct().join(segments, "o_custkey")
    until = lambda seg, day: (F.col("seg") == seg) & (F.col("month") < F.lit(day).cast("date"))
    early = until("BUILDING", "1998-01-01") | until("MACHINERY", "2000-01-01")
    return P.billing_cycle_rates(members, t.orders, "o_custkey", "o_orderdate", "o_orderstatus", ["F", "O", "P"], 5, ["O", "P"], ["F", "O", "P"], early, ["seg"])


def _sql_estimate(d: str) -> str:
    before, today = f"d < DATE '{d}'", f"d = DATE '{d}'"
    n = lambda c: f"COUNT(*) FILTER ({c})"
    first, retried = f"NULLIF({n(before + ' AND ok AND NOT rt')}, 0)::DOUBLE", f"NULLIF({n(before + ' AND ok AND rt')}, 0)::DOUBLE"
    every, retries = f"NULLIF({n(before)}, 0)::DOUBLE", f"NULLIF({n(before + ' AND rt')}, 0)::DOUBLE"
    return f"""SELECT '{d}' AS estimate_day, store, {n(today)}::BIGINT AS attempted, {n(today + ' AND ok')}::BIGINT AS succeeded, {n(today + ' AND ok AND rt')}::BIGINT AS retry_successes, COALESCE(SUM(v) FILTER ({today} AND ok), 0)::DOUBLE AS billed,
 {first} / {every} AS first_time_success_rate, {retried} / {retries} AS retry_success_rate, ROUND({n(today)} * ({first} / {every} + {retried} / {every}), 4) AS expected_successes FROM a WHERE d BETWEEN DATE '{d}' - 5 AND DATE '{d}' GROUP BY store"""


@query("d12_billing_estimate", f"""WITH a AS (SELECT ts::DATE AS d, CASE WHEN user_id % 4 < 3 THEN user_id % 4 END AS store, event_type = 'purchase' AS ok, user_id % 3 = 0 AS rt, value::DECIMAL(18,2) AS v FROM events WHERE event_type IN ('purchase', 'error')),
 x AS ({_sql_estimate('2024-01-20')} UNION ALL {_sql_estimate('2024-01-21')}), b AS (SELECT * FROM (VALUES (0, 1000.0::DOUBLE, 900.0::DOUBLE), (1, 500.0, 0.0), (NULL, 250.0, 300.0)) v(store, budget, forecast))
 SELECT estimate_day, x.store::BIGINT AS store, attempted, succeeded, retry_successes, billed, first_time_success_rate, retry_success_rate, expected_successes, budget, forecast, ROUND(billed / budget, 8) AS to_budget, ROUND(billed / NULLIF(forecast, 0), 8) AS to_forecast FROM x LEFT JOIN b ON x.store IS NOT DISTINCT FROM b.store""")
def _(t):
    store = F.when(F.col("user_id") % 4 < 3, F.col("user_id") % 4)
    tries = t.events.filter("event_type IN ('purchase', 'error')").select(
        "ts", store.alias("store"), (F.col("event_type") == "purchase").alias("ok"), (F.col("user_id") % 3 == 0).alias("again"), money("value").alias("v")
    )
    plan = t.spark.sql("SELECT * FROM VALUES (0L, 1000D, 900D), (1L, 500D, 0D), (NULL, 250D, 300D) AS v(store, budget, forecast)")
    out = None
    for day in ("2024-01-20", "2024-01-21"):
        new = P.billing_estimate(tries, "store", "ts", "ok", "again", "v", F.lit(day).cast("date"), budget=plan)
        out = P.append_estimate(out, new, F.lit(day).cast("timestamp_ntz"))
    return out.drop("estimate_created").withColumns({c: F.round(c, 8) for c in ("to_budget", "to_forecast")})

