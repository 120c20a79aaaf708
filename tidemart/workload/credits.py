"""Breakage, roll-forward and balances."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators.merge import update_from
from tidemart.operators.visits import clamped_balance, sequential_fold
from tidemart.plans import credits as P
from tidemart.plans.members import month_of
from tidemart.workload.base import SQL_SALES, money, query

THRU = "2001-07-01"

# Orders issue a credit; their lines redeem (A), cancel (R) or let expire (N) part of it in the month they ship.
_ACT = f"""(SELECT priority AS brand, status AS country, m AS issued_month, m AS activity_month, 'Issued' AS kind, total AS amount FROM (SELECT o_orderpriority AS priority, o_orderstatus AS status, date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) AS total FROM orders GROUP BY 1, 2, 3)
 UNION ALL SELECT priority, status, date_trunc('month', order_date)::DATE, date_trunc('month', ship_date)::DATE, CASE returnflag WHEN 'A' THEN 'Redeemed' WHEN 'R' THEN 'Cancelled' ELSE 'Expired' END, SUM(CAST(net AS DECIMAL(18,2))) FROM {SQL_SALES} WHERE ship_date >= order_date AND ship_date < TIMESTAMP '2001-08-01' GROUP BY 1, 2, 3, 4, 5)"""


def _activity(t):
    issued = t.orders.select(
        F.col("o_orderpriority").alias("brand"), F.col("o_orderstatus").alias("country"), month_of("o_orderdate").alias("issued_month"),
        month_of("o_orderdate").alias("activity_month"), F.lit("Issued").alias("kind"), money("o_totalprice").alias("amount"),
    )
    kind = F.when(F.col("returnflag") == "A", "Redeemed").when(F.col("returnflag") == "R", "Cancelled").otherwise("Expired")
    used = t.sales().filter((F.col("ship_date") >= F.col("order_date")) & (F.col("ship_date") < F.lit("2001-08-01").cast("timestamp_ntz"))).select(
        F.col("priority").alias("brand"), F.col("status").alias("country"), month_of("order_date").alias("issued_month"),
        month_of("ship_date").alias("activity_month"), kind.alias("kind"), F.col("net").cast("decimal(18,2)").alias("amount"),
    )
    return issued.unionByName(used)


_G = f"""i AS (SELECT brand, country, issued_month, SUM(amount) AS issued_amount FROM {_ACT} WHERE kind = 'Issued' GROUP BY 1, 2, 3),
 g AS (SELECT i.*, unnest(generate_series(issued_month::TIMESTAMP, TIMESTAMP '{{thru}}', INTERVAL 1 MONTH))::DATE AS activity_month FROM i WHERE issued_month <= DATE '{{thru}}'),
 p AS (SELECT brand, country, issued_month, activity_month, SUM(amount) FILTER (kind = 'Issued') AS issued, SUM(amount) FILTER (kind = 'Redeemed') AS redeemed, SUM(amount) FILTER (kind = 'Cancelled') AS cancelled, SUM(amount) FILTER (kind = 'Expired') AS expired FROM {_ACT} GROUP BY 1, 2, 3, 4),
 b AS (SELECT g.*, COALESCE(issued, 0) AS issued, COALESCE(redeemed, 0) AS redeemed, COALESCE(cancelled, 0) AS cancelled, COALESCE(expired, 0) AS expired, date_diff('month', issued_month, activity_month) + 1 AS tenure FROM g LEFT JOIN p USING (brand, country, issued_month, activity_month)),
 rt AS (SELECT brand, country, tenure, SUM(redeemed)::DOUBLE / SUM(issued_amount)::DOUBLE AS r, (SUM(issued) - SUM(redeemed) - SUM(cancelled))::DOUBLE / SUM(issued_amount)::DOUBLE AS u FROM b WHERE activity_month >= DATE '{{thru}}' - INTERVAL 23 MONTH AND issued_month >= DATE '{{thru}}' - INTERVAL 23 MONTH GROUP BY 1, 2, 3),
 e AS (SELECT brand, country, SUM(r) FILTER (tenure <= 12) AS er, SUM(r) FILTER (tenure <= 13) AS erm, SUM(u) FILTER (tenure <= 13) AS eu FROM rt GROUP BY 1, 2),
 d AS (SELECT brand, country, issued_month, SUM(issued)::DOUBLE AS issued, SUM(redeemed)::DOUBLE AS redeemed, SUM(cancelled)::DOUBLE AS cancelled, SUM(expired)::DOUBLE AS expired, date_diff('month', issued_month, DATE '{{thru}}') + 1 AS tenure FROM b GROUP BY 1, 2, 3),
 x AS (SELECT d.*, er, erm, eu, issued - redeemed - cancelled AS un, redeemed / issued / er AS progress FROM d JOIN e USING (brand, country)),
 y AS (SELECT *, CASE WHEN tenure <= 13 AND NOT un < issued * eu THEN issued * eu ELSE un END AS eb FROM x)"""


def _sql_breakage(thru):
    return "WITH " + _G.replace("{{thru}}", "{thru}").replace("{thru}", thru) + """ SELECT brand, country, issued_month::VARCHAR AS issued_month, tenure::BIGINT AS tenure, ROUND(eb, 2) + 0 AS expected_breakage, ROUND(CASE WHEN tenure <= 13 THEN eb * LEAST(progress, 1) ELSE eb END, 2) + 0 AS breakage_to_record, ROUND(progress, 4) + 0 AS redemption_progress,
 ROUND(CASE WHEN tenure <= 13 AND NOT un < issued * eu THEN erm * issued - redeemed ELSE 0 END, 2) + 0 AS expected_more_redeemed FROM y"""


@query("d13_breakage", _sql_breakage(THRU))
def _(t):
    out = P.breakage(_activity(t), ["brand", "country"], ["brand", "country"], F.lit(THRU).cast("date"))
    return out.select(
        "brand", "country", "issued_month", "tenure", F.round("expected_breakage", 2).alias("expected_breakage"),
        F.round("breakage_to_record", 2).alias("breakage_to_record"), F.round("redemption_progress", 4).alias("redemption_progress"),
        F.round("expected_more_redeemed", 2).alias("expected_more_redeemed"),
    )


def _rec(thru):
    return f"(SELECT brand, country, issued_month, '{thru}' AS booking, breakage_to_record AS v FROM ({_sql_breakage(thru)}))"


@query("v06_booking_changes", f"SELECT brand, country, issued_month, booking, ROUND(v - COALESCE(LAG(v) OVER (PARTITION BY brand, country, issued_month ORDER BY booking), 0), 2) + 0 AS change FROM (SELECT * FROM {_rec('2001-06-01')} UNION ALL SELECT * FROM {_rec('2001-07-01')})")
def _(t):
    act = _activity(t)
    booked = [P.breakage(act, ["brand", "country"], ["brand", "country"], F.lit(m).cast("date")) for m in ("2001-06-01", "2001-07-01")]
    rows = booked[0].unionByName(booked[1]).select("brand", "country", "issued_month", F.col("booking_month").alias("booking"), F.round("breakage_to_record", 2).alias("v"))
    out = P.booking_changes(rows, ["brand", "country", "issued_month"], "booking", "v")
    return out.select("brand", "country", "issued_month", "booking", F.round("change", 2).alias("change"))


@query("d14_breakage_by_state", """WITH w AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, n_name AS state, SUM(o_totalprice::DECIMAL(18,2)) AS w FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
 a AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) AS amount FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
 SELECT m::VARCHAR AS month, state, w::DOUBLE AS w, ROUND(w::DOUBLE / (SUM(w) OVER (PARTITION BY m))::DOUBLE, 6) AS share, ROUND(amount::DOUBLE * (w::DOUBLE / (SUM(w) OVER (PARTITION BY m))::DOUBLE), 2) AS breakage FROM w JOIN a USING (m)""")
def _(t):
    located = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    weights = located.groupBy(month_of("o_orderdate").alias("month"), F.col("n_name").alias("state")).agg(F.sum(money("o_totalprice")).alias("w"))
    amounts = t.orders.filter("o_orderstatus = 'P'").groupBy(month_of("o_orderdate").alias("month")).agg(F.sum(money("o_totalprice")).alias("amount"))
    out = P.allocate(amounts, weights, ["month"], "amount", "w", "breakage")
    return out.withColumn("share", F.round("share", 6)).withColumn("breakage", F.round("breakage", 2))


@query("d15_roll_forward", f"""WITH m AS (SELECT o_orderpriority AS g, date_trunc('month', o_orderdate)::DATE AS m, o_totalprice::DECIMAL(18,2) AS i, 0 AS u FROM orders
 UNION ALL SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'repaired' ELSE priority END, date_trunc('month', ship_date)::DATE, 0, CAST(net AS DECIMAL(18,2)) FROM {SQL_SALES} JOIN customer ON c_custkey = custkey WHERE returnflag = 'A'),
 a AS (SELECT g, m, SUM(i) AS i, SUM(u) AS u FROM m GROUP BY 1, 2), c AS (SELECT g, unnest(generate_series(MIN(m)::TIMESTAMP, MAX(m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM a GROUP BY 1),
 f AS (SELECT c.g, c.m, COALESCE(i, 0) AS i, COALESCE(u, 0) AS u FROM c LEFT JOIN a USING (g, m))
 SELECT g, m::VARCHAR AS month, (SUM(i - u) OVER w - (i - u))::DOUBLE AS opening, i::DOUBLE AS issued, u::DOUBLE AS used, (SUM(i - u) OVER w)::DOUBLE AS closing FROM f WINDOW w AS (PARTITION BY g ORDER BY m)""")
def _(t):
    zero = F.lit(0).cast("decimal(18,2)")
    issued = t.orders.select(F.col("o_orderpriority").alias("g"), month_of("o_orderdate").alias("month"), money("o_totalprice").alias("issued"), zero.alias("used"))
    used = t.sales().filter("returnflag = 'A'").select(
        F.col("custkey"), F.col("priority").alias("g"), month_of("ship_date").alias("month"), zero.alias("issued"), F.col("net").cast("decimal(18,2)").alias("used")
    )
    # The source of some credits is known only from the customer: an update join repairs it first.
    owners = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("custkey"), F.lit("repaired").alias("g"))
    fixed = update_from(used, owners, ["custkey"], {"g": lambda t_, s: s("g")}).drop("custkey")
    return P.roll_forward([issued, fixed], ["g"])


@query("d15_outstanding_buckets", """WITH p AS (SELECT o_custkey, COUNT(DISTINCT o_orderkey) AS n, SUM(o_totalprice::DECIMAL(18,2)) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
 SELECT CASE WHEN c_acctbal < 0 THEN 'owing' ELSE 'clear' END AS status, CASE WHEN n >= 10 THEN '10+' ELSE n::VARCHAR END AS bucket, COUNT(*)::BIGINT AS customers, SUM(v)::DOUBLE AS outstanding FROM p JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def _(t):
    credits = t.orders.filter("o_orderstatus = 'O'").select("o_custkey", "o_orderkey", money("o_totalprice").alias("v"))
    status = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") < 0, "owing").otherwise("clear").alias("status"))
    return P.outstanding_buckets(credits, "o_custkey", status, "o_orderkey", "v")


def _ledger(t):
    sign = F.when(F.col("event_type").isin("purchase", "signup"), 1).otherwise(-1)
    return t.events.select("event_id", "user_id", "ts", (money("value") * sign).cast("decimal(18,2)").alias("points"))


_LEDGER = "(SELECT event_id, user_id, ts, CASE WHEN event_type IN ('purchase', 'signup') THEN value::DECIMAL(18,2) ELSE -value::DECIMAL(18,2) END AS points FROM events)"
_D16 = f"""WITH s AS (SELECT *, SUM(points) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM {_LEDGER})
 SELECT event_id, (s - LEAST(0, MIN(s) OVER (PARTITION BY user_id ORDER BY ts, event_id)))::DOUBLE AS balance FROM s"""


@query("d16_clamped_balance", _D16)
def _(t):
    return clamped_balance(_ledger(t), ["user_id"], ["ts", "event_id"], "points", "balance").select("event_id", "balance")


@query("d31_sequential_fold", _D16)
def _(t):
    cents = _ledger(t).select("event_id", "user_id", "ts", (F.col("points") * 100).cast("long").alias("cents"))
    out = sequential_fold(cents, ["user_id"], ["ts", "event_id"], lambda state, row: max(0, state + row.cents), 0, "balance", "long")
    return out.select("event_id", (F.col("balance") / F.lit(100)).alias("balance"))
