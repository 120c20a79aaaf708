"""A/B tests, funnels and conversion on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.plans import experiments as P
from tidemart.plans.members import membership_timeline
from tidemart.workload.base import money, query


# The variant comes from the JSON payload, the test from its size.
_X = "(SELECT event_id, user_id, ts, event_type, value, CASE WHEN (json_extract(props, '$.k'))::INT < 50 THEN 'a' ELSE 'b' END AS variant, CASE WHEN value > 30 THEN 'big' ELSE 'small' END AS test FROM events)"


def _events(t):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.withColumn("variant", F.when(k < 50, "a").otherwise("b")).withColumn("test", F.when(F.col("value") > 30, "big").otherwise("small"))


_FIRST = f"(SELECT user_id, test, variant, ts AS exposed_at, CASE variant WHEN 'a' THEN 'Control' ELSE 'Variant' END AS test_label FROM {_X} WHERE event_type = 'view' QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, test ORDER BY ts, event_id) = 1)"


def _first(t):
    views = _events(t).filter("event_type = 'view'")
    return P.first_exposures(views, "user_id", "test", "variant", "ts", ["event_id"], {"a": "Control", "b": "Variant"})


_MEMBER = "(SELECT user_id, event_type AS state, ts AS s, COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31') AS e FROM events WHERE event_type IN ('signup', 'error'))"


@query("d32_ab_assignment", f"""SELECT f.user_id, test, test_label, exposed_at::VARCHAR AS exposed_at, COALESCE(state, 'Prospect') AS membership_state, COALESCE(date_diff('day', s::DATE, exposed_at::DATE), 0)::BIGINT AS tenure_days
 FROM {_FIRST} f LEFT JOIN {_MEMBER} m ON m.user_id = f.user_id AND exposed_at BETWEEN s AND e""")
def _(t):
    members = membership_timeline(t.events.filter("event_type IN ('signup', 'error')"), "user_id", "ts", "event_type", ["event_id"])
    return P.exposures_with_state(_first(t), members, "user_id", "signup").drop("variant", "tenure_months")


@query("d33_ab_results", f"""WITH f AS (SELECT * FROM {_FIRST}), o AS (SELECT f.user_id, f.test, COUNT(*) AS n, SUM(value::DECIMAL(18,2)) AS v FROM f JOIN events e ON e.user_id = f.user_id AND e.event_type = 'purchase' AND e.ts >= exposed_at GROUP BY 1, 2)
 SELECT test, test_label, COUNT(*)::BIGINT AS units, COUNT(n)::BIGINT AS converted, COALESCE(SUM(n), 0)::BIGINT AS orders, COALESCE(SUM(v), 0)::DOUBLE AS revenue, COUNT(n)::DOUBLE / COUNT(*)::DOUBLE AS conversion, COALESCE(SUM(v), 0)::DOUBLE / COUNT(*)::DOUBLE AS revenue_per_unit FROM f LEFT JOIN o USING (user_id, test) GROUP BY 1, 2""")
def _(t):
    orders = t.events.filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("ordered"), money("value").alias("v"))
    return P.test_results(_first(t), orders, "user_id", "test", "ordered", "v")


@query("d33_dominant_page", """WITH c AS (SELECT lang, source, COUNT(*) AS n FROM documents GROUP BY 1, 2) SELECT lang, source, n::BIGINT AS views, n::DOUBLE / t::DOUBLE AS share FROM (SELECT *, SUM(n) OVER (PARTITION BY lang) AS t, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY n DESC, source DESC) AS r FROM c) WHERE r = 1""")
def _(t):
    return P.dominant_page(t.documents, ["lang"], "source")


@query("d34_split_groups", """WITH s AS (SELECT DISTINCT p_brand, CASE p_type WHEN 'SMALL' THEN '50/50' WHEN 'PROMO' THEN '34/33/33' ELSE '25/25/25/25' END AS split FROM part), r AS (SELECT p_brand, split, len(string_split(split, '/')) AS k, unnest(generate_series(1, len(string_split(split, '/')))) AS i FROM s)
 SELECT p_brand, k::BIGINT AS num_splits, i::BIGINT AS group_number, string_split(split, '/')[i] AS group_share, CASE WHEN i = 1 THEN 'Control' WHEN k = 2 THEN 'Variant' ELSE 'Variant ' || chr((63 + i)::INT) END AS test_group FROM r""")
def _(t):
    split = F.when(F.col("p_type") == "SMALL", "50/50").when(F.col("p_type") == "PROMO", "34/33/33").otherwise("25/25/25/25")
    return P.split_groups(t.part.select("p_brand", split.alias("split")).distinct(), "split").drop("split")


@query("d35_session_funnel", """WITH f AS (SELECT user_id, ts::DATE AS d, MAX((event_type = 'view')::INT) AS view, MAX((event_type = 'click')::INT) AS click, MAX((event_type = 'purchase')::INT) AS purchase FROM events GROUP BY 1, 2)
 SELECT d::VARCHAR AS day, COUNT(*)::BIGINT AS sessions, SUM(view)::BIGINT AS view, SUM(click)::BIGINT AS click, SUM(purchase)::BIGINT AS purchase FROM f GROUP BY 1""")
def _(t):
    e = t.events.withColumn("day", F.to_date("ts"))
    return P.session_funnel(e, ["user_id"], "event_type", ["view", "click", "purchase"], ["day"])


@query("d35_ordered_funnel", """WITH f AS (SELECT user_id, ts::DATE AS d, MIN(ts) FILTER (event_type = 'view') AS v, MIN(ts) FILTER (event_type = 'click') AS c, MIN(ts) FILTER (event_type = 'purchase') AS p FROM events GROUP BY 1, 2)
 SELECT COUNT(*)::BIGINT AS sessions, COUNT(*) FILTER (v IS NOT NULL)::BIGINT AS view, COUNT(*) FILTER (c >= v)::BIGINT AS click, COUNT(*) FILTER (c >= v AND p >= c)::BIGINT AS purchase FROM f""")
def _(t):
    e = t.events.withColumn("day", F.to_date("ts"))
    return P.ordered_funnel(e, ["user_id", "day"], "event_type", "ts", ["view", "click", "purchase"])


@query("d36_product_conversion", f"""WITH e AS (SELECT *, (json_extract(props, '$.k'))::INT // 10 AS product FROM events), m AS (SELECT user_id, event_type AS status, ts AS s, COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts), TIMESTAMP '9999-12-31') AS x FROM events WHERE event_type IN ('signup', 'error'))
 SELECT product::BIGINT AS product, ts::DATE::VARCHAR AS day, COALESCE(status, 'prospect') AS status, COUNT(*) FILTER (event_type = 'view')::BIGINT AS impressions, COUNT(*) FILTER (event_type = 'click')::BIGINT AS clicks, COUNT(*) FILTER (event_type = 'purchase')::BIGINT AS orders FROM e LEFT JOIN m ON m.user_id = e.user_id AND ts >= s AND ts < x WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2, 3""")
def _(t):
    e = t.events.withColumn("product", F.floor(F.get_json_object("props", "$.k").cast("int") / 10).cast("long"))
    kind = lambda k: e.filter(F.col("event_type") == k)
    states = t.events.filter("event_type IN ('signup', 'error')").select("user_id", F.col("ts").alias("memb_start"), F.col("event_type").alias("status"))
    out = P.product_conversion(kind("view"), kind("click"), kind("purchase"), states, "user_id", "product", "ts")
    return out.drop("click_rate", "order_rate")
