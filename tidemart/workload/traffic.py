"""Sessions, attribution, media and ranking on events and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.functions import semantics as S
from tidemart.operators import joins as J
from tidemart.plans import traffic as P
from tidemart.plans.members import month_of
from tidemart.workload.base import SQL_LINES, money, query, when


# Events as sessions: the visitor is the user, the customer (a third of the user range each) is known on some.
_S = """(SELECT event_id AS session_id, user_id AS visitor, CASE WHEN event_type IN ('signup', 'purchase', 'click') THEN user_id // 3 END AS customer, ts,
 CASE event_type WHEN 'view' THEN 'direct' WHEN 'signup' THEN 'direct' WHEN 'click' THEN 'search' WHEN 'error' THEN 'social' ELSE 'email' END AS channel FROM events)"""


def _sessions(t):
    kind = F.col("event_type")
    channel = F.when(kind.isin("view", "signup"), "direct").when(kind == "click", "search").when(kind == "error", "social").otherwise("email")
    customer = F.when(kind.isin("signup", "purchase", "click"), F.floor(F.col("user_id") / 3).cast("long"))
    return t.events.select(F.col("event_id").alias("session_id"), F.col("user_id").alias("visitor"), customer.alias("customer"), "ts", channel.alias("channel"))


@query("d17_last_channel", f"""SELECT session_id, COALESCE(NULLIF(channel, 'direct'), CASE WHEN customer IS NOT NULL THEN LAST_VALUE(NULLIF(channel, 'direct') IGNORE NULLS) OVER (PARTITION BY customer ORDER BY ts, session_id ROWS UNBOUNDED PRECEDING) END,
 LAST_VALUE(NULLIF(channel, 'direct') IGNORE NULLS) OVER (PARTITION BY visitor ORDER BY ts, session_id ROWS UNBOUNDED PRECEDING), channel) AS last_channel FROM {_S}""")
def _(t):
    out = P.last_channel(_sessions(t), "customer", "visitor", ["ts", "session_id"], "channel", ["direct"], "last_channel")
    return out.select("session_id", "last_channel")


@query("d18_channel_rules", """WITH r AS (SELECT page_id, CASE WHEN url LIKE '%ref=%' THEN 'affiliate>partner>ref' WHEN url ILIKE '%://m.%' THEN 'direct>mobile' WHEN url ILIKE '%://blog.%' THEN 'content>blog' ELSE 'unclassified>unclassified' END AS p FROM pages)
 SELECT page_id, split_part(p, '>', 1) AS channel, split_part(p, '>', 2) AS subchannel, COALESCE(NULLIF(split_part(p, '>', 3), ''), 'none') AS vendor FROM r""")
def _(t):
    u = F.col("url")
    rules = [(u.like("%ref=%"), "affiliate>partner>ref"), (u.ilike("%://m.%"), "direct>mobile"), (u.ilike("%://blog.%"), "content>blog")]
    return P.channel_of(t.pages.select("page_id", "url"), rules).drop("url")


@query("d19_session_neighbours", f"""SELECT session_id, COALESCE(LAG(session_id) OVER c, -1)::BIGINT AS previous_customer, COALESCE(LEAD(session_id) OVER c, -1)::BIGINT AS next_customer FROM {_S} WHERE customer IS NOT NULL WINDOW c AS (PARTITION BY customer ORDER BY ts, session_id)
 UNION ALL SELECT session_id, -1, -1 FROM {_S} WHERE customer IS NULL""")
def _(t):
    out = P.neighbours(_sessions(t), "customer", ["ts", "session_id"], "ts", "session_id", "customer")
    out = P.neighbours(out, "visitor", ["ts", "session_id"], "ts", "session_id", "visitor")
    return out.select("session_id", F.coalesce("previous_customer_id", F.lit(-1)).alias("previous_customer"), F.coalesce("next_customer_id", F.lit(-1)).alias("next_customer"))


@query("d20_bot_class", """SELECT doc_id, CASE WHEN a ILIKE '%googlebot%' OR a ILIKE '%bingbot%' THEN 'search engine' WHEN a ILIKE '%crawler%' OR a ILIKE '%spider%' THEN 'crawler' WHEN a ILIKE '%curl%' OR a ILIKE '%python%' THEN 'script' ELSE 'human' END AS bot_class
 FROM (SELECT doc_id, CASE source WHEN 'src1' THEN 'Mozilla GoogleBot/2' WHEN 'src2' THEN 'my-spider' WHEN 'src3' THEN 'curl/8' WHEN 'src4' THEN 'Python urllib' ELSE 'Mozilla ' || lang END AS a FROM documents)""")
def _(t):
    s = F.col("source")
    agent = F.when(s == "src1", "Mozilla GoogleBot/2").when(s == "src2", "my-spider").when(s == "src3", "curl/8").when(s == "src4", "Python urllib")
    docs = t.documents.select("doc_id", F.coalesce(agent, F.concat(F.lit("Mozilla "), "lang")).alias("agent"))
    return P.bot_class(docs, "agent").drop("agent")


@query("d21_open_session_match", """WITH o AS (SELECT event_id AS oid, user_id, ts AS ot FROM events WHERE event_type = 'error'), s AS (SELECT event_id AS sid, user_id, ts AS st FROM events WHERE event_type = 'view'),
 p AS (SELECT o.user_id, oid, sid, ABS(epoch_us(ot) - epoch_us(st)) AS g, ot, st FROM o JOIN s ON o.user_id = s.user_id AND ABS(epoch_us(ot) - epoch_us(st)) <= 3600000000)
 SELECT user_id, oid, sid FROM p QUALIFY ROW_NUMBER() OVER (PARTITION BY oid ORDER BY g, st, sid) = 1 AND ROW_NUMBER() OVER (PARTITION BY sid ORDER BY g, ot, oid) = 1""")
def _(t):
    kind = lambda k, i, ts: t.events.filter(F.col("event_type") == k).select("user_id", F.col("event_id").alias(i), F.col("ts").alias(ts))
    return J.nearest_in_time(kind("error", "oid", "ot"), kind("view", "sid", "st"), ["user_id"], "oid", "sid", "ot", "st", 3600).drop("gap_seconds")


_HOUR = "user_id * 100000 + date_diff('hour', TIMESTAMP '2024-01-01', ts)"


@query("d22_click_attribution", f"""WITH e AS (SELECT *, {_HOUR} AS sid FROM events), s AS (SELECT sid, MIN(ts)::DATE AS d, MIN((user_id < 75)::BIGINT) AS grp FROM e GROUP BY 1),
 l AS (SELECT user_id, arg_min(sid, ts) AS sid, MIN(ts) AS t0 FROM e WHERE event_type = 'signup' GROUP BY 1), c AS (SELECT user_id, arg_min(sid, ts) AS sid, MIN(ts) AS t0 FROM e WHERE event_type = 'purchase' GROUP BY 1),
 m AS (SELECT d, grp, 1 AS a, 0 AS b, 0 AS x, 0 AS y FROM s UNION ALL SELECT t0::DATE, grp, 0, 1, 0, 0 FROM l JOIN s USING (sid)
  UNION ALL SELECT l.t0::DATE, grp, 0, 0, 1, 0 FROM l JOIN s USING (sid) JOIN c ON c.user_id = l.user_id WHERE c.t0::DATE - l.t0::DATE BETWEEN 0 AND 6
  UNION ALL SELECT c.t0::DATE, grp, 0, 0, 0, 1 FROM c JOIN s USING (sid) JOIN l ON l.user_id = c.user_id AND l.sid = c.sid),
 g AS (SELECT d, grp, SUM(a) AS a, SUM(b) AS b, SUM(x) AS x, SUM(y) AS y FROM m GROUP BY 1, 2),
 u AS (SELECT d, grp, a, b, x, y, 0 AS pa, 0 AS pb, 0 AS px, 0 AS py FROM g UNION ALL SELECT d + 7, grp, 0, 0, 0, 0, a, b, x, y FROM g)
 SELECT d::VARCHAR AS day, grp, SUM(a)::BIGINT AS sessions, SUM(b)::BIGINT AS leads, SUM(x)::BIGINT AS conversions_from_leads, SUM(y)::BIGINT AS same_session_conversions, SUM(pa)::BIGINT AS previous_sessions, SUM(pb)::BIGINT AS previous_leads, SUM(px)::BIGINT AS previous_conversions_from_leads, SUM(py)::BIGINT AS previous_same_session_conversions FROM u GROUP BY 1, 2""")
def _(t):
    e = t.events.withColumn("session_id", F.col("user_id") * 100000 + S.boundaries("hour", when("2024-01-01"), F.col("ts")))
    sessions = e.groupBy("session_id").agg(F.min("ts").alias("at"), F.min((F.col("user_id") < 75).cast("long")).alias("grp"))
    kind = lambda k: F.when(F.col("event_type") == k, F.struct("ts", "session_id"))
    people = e.groupBy(F.col("user_id").alias("customer")).agg(F.min(kind("signup")).alias("lead"), F.min(kind("purchase")).alias("won"))
    first = lambda c: people.filter(F.col(c).isNotNull()).select("customer", F.col(f"{c}.session_id").alias("session_id"), F.col(f"{c}.ts").alias("at"))
    return P.click_attribution(sessions, first("lead"), first("won"), ["grp"], 7)


_MLEADS = "(SELECT c_mktsegment AS seg, date_trunc('quarter', o_orderdate)::DATE AS m, COUNT(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"


@query("d23_rolling_cohorts", "SELECT seg, m::VARCHAR AS month, n::BIGINT AS m1, " + ", ".join(f"COALESCE(LAG(n, {k}) OVER w, 0)::BIGINT AS m{k + 1}" for k in range(1, 12)) + f" FROM {_MLEADS} WINDOW w AS (PARTITION BY seg ORDER BY m)")
def _(t):
    leads = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("seg"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("month")).agg(row_count().alias("n"))
    return P.rolling_cohorts(leads, ["seg"], "month", "n")


@query("d23_cost_per_lead", "SELECT m::VARCHAR AS month, spend::DOUBLE AS spend, leads::BIGINT AS leads, spend::DOUBLE / NULLIF(leads, 0)::DOUBLE AS cac FROM (SELECT date_trunc('month', o_orderdate)::DATE AS m, COALESCE(SUM(o_totalprice::DECIMAL(18,2)) FILTER (o_orderpriority = '5-LOW'), 0) AS spend, COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS leads FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT') GROUP BY 1)")
def _(t):
    m = month_of("o_orderdate").alias("month")
    spend = t.orders.filter("o_orderpriority = '5-LOW'").groupBy(m).agg(F.sum(money("o_totalprice")).alias("spend"))
    leads = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(m).agg(row_count().alias("leads"))
    return P.cost_per_lead(spend, leads, ["month"])


@query("d24_scaled_targets", """WITH d AS (SELECT o_orderpriority AS p, date_trunc('month', o_orderdate)::DATE AS m, SUM(o_totalprice::DECIMAL(18,2)) AS spend, COUNT(*) AS n FROM orders GROUP BY 1, 2), c AS (SELECT *, spend::DOUBLE / n::DOUBLE AS cac FROM d),
 v AS (SELECT *, AVG(cac) OVER (PARTITION BY p ORDER BY m ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS mv FROM c) SELECT p, m::VARCHAR AS month, ROUND(mv, 4) AS moving_cac, ROUND(250000 / mv, 8) AS scaling, ROUND(250000 * (250000 / mv), 2) AS adjusted_target FROM v""")
def _(t):
    d = t.orders.groupBy(F.col("o_orderpriority").alias("p"), month_of("o_orderdate").alias("month")).agg(F.sum(money("o_totalprice")).alias("spend"), row_count().alias("n"))
    out = P.scaled_targets(d.withColumn("target", F.lit(250000)), ["p"], "month", "spend", "n", "target")
    return out.select("p", "month", F.round("moving_cac", 4).alias("moving_cac"), F.round("scaling", 8).alias("scaling"), F.round("adjusted_target", 2).alias("adjusted_target"))


@query("d25_late_syncs", "SELECT user_id, max(ts)::VARCHAR AS last_sync FROM events GROUP BY 1 HAVING max(ts) + INTERVAL 6 HOUR < (SELECT max(ts) FROM events)")
def _(t):
    return P.late_syncs(t.events, "user_id", "ts", t.events.agg(F.max("ts")).scalar(), 6)


@query("d25_missing_today", "SELECT user_id, SUM(value::DECIMAL(18,2)) FILTER (ts::DATE = DATE '2024-01-19')::DOUBLE AS yesterday, 0::DOUBLE AS today FROM events GROUP BY 1 HAVING COUNT(*) FILTER (ts::DATE = DATE '2024-01-20') = 0 AND SUM(value) FILTER (ts::DATE = DATE '2024-01-19') > 0")
def _(t):
    e = t.events.select("user_id", F.to_date("ts").alias("day"), money("value").alias("v"))
    return P.missing_today(e, "user_id", "day", "v", F.lit("2024-01-20").cast("date"))


@query("d25_target_scaffold", """SELECT seg, p, m::DATE::VARCHAR AS month, COALESCE(n, 0)::BIGINT AS target FROM (SELECT DISTINCT c_mktsegment AS seg, o_orderpriority AS p FROM orders JOIN customer ON c_custkey = o_custkey) CROSS JOIN (SELECT unnest(generate_series(date_trunc('month', MIN(o_orderdate)), date_trunc('month', MAX(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders) x
 LEFT JOIN (SELECT c_mktsegment AS seg, o_orderpriority AS p, date_trunc('month', o_orderdate) AS m, COUNT(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 400000 GROUP BY 1, 2, 3) USING (seg, p, m)""")
def _(t):
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("seg"), F.col("o_orderpriority").alias("p"), month_of("o_orderdate").alias("month"), "o_totalprice")
    targets = j.filter("o_totalprice > 400000").groupBy("seg", "p", "month").agg(row_count().alias("target"))
    return P.target_scaffold(j.select("seg", "p"), (j.agg(F.min("month")).scalar(), j.agg(F.max("month")).scalar()), targets, ["seg", "p"])


@query("d26_platform_spend", f"""WITH r AS (SELECT partkey AS ad_id, p_type AS account_id, ship_date::DATE AS day, CASE WHEN returnflag = 'A' THEN 'EUR' WHEN returnflag = 'R' THEN 'USD' ELSE 'XXX' END AS currency, CAST(gross AS DECIMAL(18,4)) AS units, qty, p_name FROM {SQL_LINES} JOIN part ON p_partkey = partkey),
 u AS (SELECT ad_id, account_id, day, p_name, SUM(units) AS acc, SUM(CAST(units * CASE WHEN currency = 'EUR' THEN 1.25 ELSE 1.00 END AS DECIMAL(18,4))) AS usd, SUM(CAST(units * CASE WHEN currency = 'USD' THEN 0.80 ELSE 1.00 END AS DECIMAL(18,4))) AS loc, SUM(qty) AS impressions FROM r GROUP BY 1, 2, 3, 4),
 f AS (SELECT *, CAST(CASE WHEN account_id ILIKE 'promo%' AND day BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN 0.05 WHEN account_id ILIKE '%e' THEN 0.01 ELSE 0 END AS DECIMAL(6,4)) AS p FROM u)
 SELECT ad_id, account_id, day::VARCHAR AS day, acc::DOUBLE AS spend_account, usd::DOUBLE AS spend_usd, loc::DOUBLE AS spend_local, impressions::BIGINT AS impressions, ROUND(usd * p, 4)::DOUBLE AS vendor_fee_usd, (SUM(acc) OVER w)::DOUBLE AS spend_account_to_date, (SUM(usd) OVER w)::DOUBLE AS spend_usd_to_date, (SUM(acc + ROUND(acc * p, 4)) OVER w)::DOUBLE AS account_with_fees_to_date, (SUM(usd + ROUND(usd * p, 4)) OVER w)::DOUBLE AS usd_with_fees_to_date, (SUM(impressions) OVER w)::BIGINT AS impressions_to_date, p_name AS ad_name FROM f WINDOW w AS (PARTITION BY ad_id ORDER BY day)""")
def _(t):
    raw = t.lines().join(t.part, F.col("partkey") == F.col("p_partkey")).select(
        F.col("partkey").alias("ad_id"), F.col("p_type").alias("account_id"), F.to_date("ship_date").alias("day"),
        F.when(F.col("returnflag") == "A", "EUR").when(F.col("returnflag") == "R", "USD").otherwise("XXX").alias("currency"),
        (F.col("gross") * P.MICROS).cast("long").alias("spend_micros"), F.col("qty").alias("impressions"),
    )
    rates = t.spark.sql("SELECT * FROM VALUES ('EUR', 1.25, 1.00), ('USD', 1.00, 0.80) AS v(currency, usd_rate, local_rate)")
    names = t.part.select(F.col("p_partkey").alias("ad_id"), F.col("p_name").alias("ad_name"), F.lit(1).alias("updated_at"))
    fees = [("promo%", "1996-01-01", "1999-12-31", 0.05), ("%e", "1990-01-01", "2010-01-01", 0.01)]
    out = P.platform_spend(raw, names, rates, fees, ["impressions"])
    return out.drop("account_with_fees", "usd_with_fees")


@query("d27_split_by_share", """WITH s AS (SELECT o_orderdate::DATE AS d, CAST((COUNT(*) FILTER (o_orderpriority <> '1-URGENT'))::DOUBLE / COUNT(*)::DOUBLE AS DECIMAL(18,9)) AS share FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
 x AS (SELECT o_orderkey, o_totalprice::DECIMAL(18,2) AS cost, COALESCE(share, CAST(1 AS DECIMAL(18,9))) AS share FROM orders LEFT JOIN s ON d = o_orderdate::DATE)
 SELECT o_orderkey, share::DOUBLE AS share, CAST(ROUND(cost * share, 4) AS DECIMAL(18,4))::DOUBLE AS cost_first, (cost - CAST(ROUND(cost * share, 4) AS DECIMAL(18,4)))::DOUBLE AS cost_second, ROUND(1000 * share, 0)::BIGINT AS clicks_first, (1000 - ROUND(1000 * share, 0))::BIGINT AS clicks_second FROM x""")
def _(t):
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"), money("o_totalprice").alias("cost"), F.lit(1000).cast("long").alias("clicks"))
    shares = t.orders.filter("o_orderstatus = 'F'").groupBy(F.to_date("o_orderdate").alias("d")).agg(S.ratio(F.count_if(F.col("o_orderpriority") != "1-URGENT"), row_count()).alias("share"))
    out = P.split_by_share(o, shares, ["d"], "share", "cost", ["clicks"])
    return out.select("o_orderkey", "share", "cost_first", "cost_second", "clicks_first", "clicks_second")


@query("d27_cost_share", f"SELECT orderkey, linenumber::BIGINT AS linenumber, partkey, suppkey, gross::DOUBLE / (SUM(gross) OVER (PARTITION BY orderkey))::DOUBLE AS share FROM {SQL_LINES}")
def _(t):
    return P.cost_share(t.lines(), ["orderkey"], "gross", "share").select("orderkey", "linenumber", "partkey", "suppkey", "share")


@query("d28_repaired_increments", f"""WITH d AS (SELECT p_brand || ' ' || p_type AS post, date_trunc('month', ship_date)::DATE AS m, SUM(qty) AS q, COUNT(*) FILTER (returnflag = 'R') % 3 AS r FROM {SQL_LINES} JOIN part ON p_partkey = partkey GROUP BY 1, 2),
 c AS (SELECT post, m, CASE WHEN r > 0 THEN 0 ELSE SUM(q) OVER (PARTITION BY post ORDER BY m) END AS raw FROM d), k AS (SELECT post, m - INTERVAL 0 DAY AS day, raw FROM c),
 g AS (SELECT post, unnest(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS day FROM k GROUP BY 1), f AS (SELECT g.post, g.day, COALESCE(raw, 0) AS raw, COALESCE(LAST_VALUE(NULLIF(raw, 0) IGNORE NULLS) OVER (PARTITION BY g.post ORDER BY g.day ROWS UNBOUNDED PRECEDING), 0) AS cumulative FROM g LEFT JOIN k ON k.post = g.post AND k.day = g.day)
 SELECT post, day::DATE::VARCHAR AS day, raw::BIGINT AS raw, cumulative::BIGINT AS cumulative, (cumulative - COALESCE(LAG(cumulative) OVER (PARTITION BY post ORDER BY day), 0))::BIGINT AS increment FROM f""")
def _(t):
    from tidemart.operators.scan import Scan, ordered_scan

    sold = t.lines().join(t.part, F.col("partkey") == F.col("p_partkey")).withColumn("post", F.concat_ws(" ", "p_brand", "p_type"))
    monthly = sold.groupBy("post", month_of("ship_date").alias("day")).agg(F.sum("qty").alias("q"), (F.count_if(F.col("returnflag") == "R") % 3).alias("r"))
    summed = ordered_scan(monthly, ["post"], ["day"], [Scan("upto", "sum", "q")])
    posts = summed.select("post", "day", F.when(F.col("r") > 0, F.lit(0)).otherwise(F.col("upto")).alias("metric"))
    return P.repaired_increments(posts, "post", "day", "metric")


@query("d29_impact_weights", """WITH x AS (SELECT event_type, value, AVG(value) OVER p + 3 * STDDEV_SAMP(value) OVER p AS hi, MEDIAN(value) OVER p AS md FROM events WINDOW p AS (PARTITION BY event_type)) SELECT event_type, ROUND(AVG(CASE WHEN value > hi THEN md ELSE value END), 6) AS value FROM x GROUP BY 1""")
def _(t):
    return P.impact_weights(t.events.select("event_type", "value"), ["event_type"], ["value"]).withColumn("value", F.round("value", 6))


@query("d30_calibration", "WITH r AS (SELECT l_suppkey, SUM(l_quantity::BIGINT)::DOUBLE / COUNT(*)::DOUBLE - 25 AS rate FROM lineitem GROUP BY 1) SELECT l_suppkey, ROUND(rate, 8) AS rate FROM r WHERE rate < (SELECT 3 * stddev_samp(rate) FROM r) AND rate > (SELECT -3 * stddev_samp(rate) FROM r)")
def _(t):
    r = t.lineitem.groupBy("l_suppkey").agg((F.sum(F.col("l_quantity").cast("long")) / row_count() - 25).alias("rate"))
    return P.calibrated(r, "rate").withColumn("rate", F.round("rate", 8))


@query("d30_tiered_ranking", """WITH e AS (SELECT user_id, value, date_diff('hour', ts, TIMESTAMP '2024-02-01') AS h, event_type FROM events), co AS (SELECT DISTINCT user_id FROM events WHERE user_id % 9 = 0 UNION SELECT 900000 + n_nationkey FROM nation WHERE n_nationkey < 2),
 m AS (SELECT user_id, MAX(value) AS v, MIN(h) AS h FROM e WHERE event_type = 'view' GROUP BY 1), c AS (SELECT co.user_id, -1 AS tier, COALESCE(v, 100) / (1 + POWER(COALESCE(h, 1000)::DOUBLE, 0.8)) AS score FROM co LEFT JOIN m USING (user_id) ORDER BY score DESC, user_id LIMIT 8),
 a AS (SELECT user_id, 2 AS tier, MAX(value) / (1 + POWER(MIN(h)::DOUBLE, 0.8)) AS score FROM e WHERE event_type = 'purchase' AND value > 80 AND user_id % 7 <> 3 GROUP BY 1), b AS (SELECT user_id, 3 AS tier, MAX(value) / (1 + POWER(MIN(h)::DOUBLE, 0.8)) AS score FROM e WHERE event_type = 'click' GROUP BY 1),
 i AS (SELECT user_id, 1 AS tier, 99.0::DOUBLE AS score FROM e WHERE value > 400 GROUP BY 1), u AS (SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM i UNION ALL SELECT * FROM c) QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY tier) = 1)
 SELECT user_id, tier::BIGINT AS tier, ROUND(score, 8) AS ranking_score, DENSE_RANK() OVER (PARTITION BY tier ORDER BY score DESC)::BIGINT AS tier_rank, ROW_NUMBER() OVER (ORDER BY tier, score DESC, user_id)::BIGINT AS place FROM u QUALIFY place <= 100""")
def _(t):
    e = t.events.select("user_id", "value", "event_type", S.boundaries("hour", F.col("ts"), when("2024-02-01")).alias("h"))
    kept = e.filter("value > 400").select("user_id", F.lit(99.0).alias("ranking_score")).distinct()
    tiers = [(2, e.filter("event_type = 'purchase' AND value > 80")), (3, e.filter("event_type = 'click'"))]
    newcomers = t.nation.filter("n_nationkey < 2").select((F.lit(900000) + F.col("n_nationkey")).cast("long").alias("user_id"))
    collaborators = e.filter("user_id % 9 = 0").select("user_id").unionByName(newcomers)
    calibrated = e.filter("user_id % 7 = 3").select("user_id")
    out = P.tiered_ranking(tiers, "user_id", "value", "h", 0.8, kept, 100, collaborators, e.filter("event_type = 'view'"), 8, {2: calibrated})
    return out.withColumn("ranking_score", F.round("ranking_score", 8))

