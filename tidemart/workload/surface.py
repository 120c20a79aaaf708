"""The declared function surface (dates, keys, visits, objects, URLs) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions import text as X
from tidemart.operators import reshape as R
from tidemart.operators import visits as V
from tidemart.workload.base import query


@query("u01_date_range", "SELECT o_orderkey, unnest(generate_series(o_orderdate, o_orderdate + INTERVAL 2 DAY, INTERVAL 1 DAY))::DATE::VARCHAR AS day FROM orders WHERE o_orderkey % 3 <> 0")
def _(t):
    # Every third order has its end before its start, and so no day.
    days = F.when(F.col("o_orderkey") % 3 == 0, F.lit(-2)).otherwise(F.lit(2))
    return X.date_range(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", F.date_add(F.to_date("o_orderdate"), days), "day").drop("o_orderdate")


@query("u02_date_range_zoned", "SELECT p_partkey, (timezone('UTC', timezone('America/Los_Angeles', d)))::VARCHAR AS midnight FROM part, generate_series(TIMESTAMP '2024-03-08', TIMESTAMP '2024-03-12', INTERVAL 1 DAY) g(d)")
def _(t):
    span = t.part.select("p_partkey", F.lit("2024-03-08").alias("a"), F.lit("2024-03-12").alias("b"))
    out = X.date_range_zoned(span, "a", "b", "America/Los_Angeles", "midnight")
    return out.select("p_partkey", F.col("midnight").cast("timestamp_ntz").alias("midnight"))


@query("u03_without_company", "SELECT o_orderkey, CASE WHEN right(k::VARCHAR, 2) IN ('10', '20', '30', '40') THEN COALESCE(TRY_CAST(left(k::VARCHAR, -2) AS BIGINT), -1) ELSE k END AS id FROM (SELECT o_orderkey, o_custkey AS k FROM orders)")
def _(t):
    return t.orders.select("o_orderkey", F.coalesce(X.without_company("o_custkey"), F.lit(-1)).alias("id"))


@query("u04_zoned_instant", "SELECT o_orderkey, (timezone('UTC', timezone('Europe/Berlin', o_orderdate + INTERVAL 12 HOUR)))::VARCHAR AS utc, (timezone('America/Los_Angeles', timezone('UTC', o_orderdate)))::VARCHAR AS pacific FROM orders")
def _(t):
    noon = F.timestamp_add("HOUR", F.lit(12), F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey", X.zoned_instant(noon, "Europe/Berlin").cast("timestamp_ntz").alias("utc"), X.local_time("o_orderdate", "America/Los_Angeles").cast("timestamp_ntz").alias("pacific")
    )


@query("u05_corrected_region", "SELECT c_custkey, CASE WHEN n_name IN ('NATION_1', 'NATION_2') AND r_name = 'AMERICA' THEN 'N1' ELSE upper(n_name) END AS state, CASE WHEN n_name = 'NATION_1' AND r_name = 'AMERICA' THEN 'EUROPE' WHEN n_name = 'NATION_2' AND r_name = 'AMERICA' THEN 'EUROPE' ELSE upper(r_name) END AS country FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(t):
    place = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = place.select("c_custkey", F.lower("n_name").alias("state"), F.lower("r_name").alias("country"))
    mapping = t.spark.sql("SELECT * FROM VALUES ('nation_1', 'america', 'N1', 'EUROPE'), ('nation_2', 'america', 'N1', 'EUROPE') AS v(state, country, good_state, good_country)")
    return X.corrected_region(rows, mapping, "state", "country")


@query("u06_clean_field", "SELECT page_id, regexp_replace(trim(url), '[?~%/<>&\"”\\n\\r| '']', '_', 'g') AS cleaned FROM pages")
def _(t):
    return t.pages.select("page_id", X.clean_field("url").alias("cleaned"))


@query("u07_without_repeats", "SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_brand ELSE p_brand || ' | ' || p_type END AS parts FROM part")
def _(t):
    doubled = F.concat_ws("| ", "p_brand", "p_type", "p_brand", "p_type")
    return t.part.select("p_partkey", X.without_repeats(doubled).alias("parts"))


# Visits of 12 hours, so that the provided event density gives visits of several events.
SECONDS = 43_200
_VISITS = f"""WITH RECURSIVE s(user_id, t0) AS (SELECT user_id, MIN(ts) FROM events GROUP BY 1 UNION ALL SELECT n.user_id, n.t FROM (SELECT s.user_id, (SELECT MIN(ts) FROM events e WHERE e.user_id = s.user_id AND e.ts >= s.t0 + INTERVAL {SECONDS} SECOND) AS t FROM s) n WHERE n.t IS NOT NULL),
 v AS (SELECT user_id, t0, LEAD(t0) OVER (PARTITION BY user_id ORDER BY t0) AS t1, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY t0) AS n FROM s),
 x AS (SELECT e.event_id, e.user_id, e.event_type, ts, n, t0, ROW_NUMBER() OVER (PARTITION BY e.user_id, n ORDER BY ts, event_id) AS q, FIRST_VALUE(event_id) OVER (PARTITION BY e.user_id, n ORDER BY ts, event_id) AS k, FIRST_VALUE(event_type) OVER (PARTITION BY e.user_id, n ORDER BY ts, event_id) AS c FROM events e JOIN v ON v.user_id = e.user_id AND ts >= t0 AND (t1 IS NULL OR ts < t1))"""


@query("u08_visit_count", _VISITS + " SELECT event_id, q = 1 AS is_first, n::BIGINT AS visit_count, q::BIGINT AS visit_seq, k AS start_key, t0::VARCHAR AS visit_start_datetime FROM x")
def _(t):
    out = V.visit_count(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id", visit_seconds=SECONDS)
    return out.drop("user_id", "ts")


@query("u09_visit_count_channel", _VISITS + " SELECT event_id, q = 1 AS is_first, n::BIGINT AS visit_count, c AS visit_event_type FROM x")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    out = V.visit_count(e, "user_id", "ts", "event_id", carry=["event_type"], visit_seconds=SECONDS)
    return out.select("event_id", "is_first", "visit_count", "visit_event_type")


@query("u10_visit_channel", "SELECT event_id, COALESCE(FIRST_VALUE(NULLIF(event_type, 'view') IGNORE NULLS) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), '-') AS channel FROM events")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type", F.to_date("ts").alias("visit"))
    out = V.visit_channel(e, ["user_id", "visit"], ["ts", "event_id"], "event_type", "view", "channel")
    return out.select("event_id", F.coalesce("channel", F.lit("-")).alias("channel"))


@query("u11_effective_customer", "SELECT event_id, COALESCE(CASE WHEN c IS NULL THEN LAST_VALUE(c IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) END, -1)::BIGINT AS effective FROM (SELECT *, CASE WHEN event_type IN ('signup', 'purchase') THEN event_id END AS c FROM events)")
def _(t):
    e = t.events.withColumn("c", F.when(F.col("event_type").isin("signup", "purchase"), F.col("event_id")))
    out = V.effective_customer(e, "user_id", ["ts", "event_id"], "c", "effective")
    return out.select("event_id", F.coalesce("effective", F.lit(-1)).alias("effective"))


@query("u12_decoded_url", "SELECT page_id, url AS decoded, 'x%zz' || page_id::VARCHAR AS broken FROM pages")
def _(t):
    encoded = F.regexp_replace(F.url_encode("url"), r"\+", "%20")
    return t.pages.select("page_id", X.decoded_url(encoded).alias("decoded"), X.decoded_url(F.concat(F.lit("x%zz"), F.col("page_id").cast("string"))).alias("broken"))


@query("u13_flatten_object", "SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k, i::BIGINT AS sku, value * i AS amount FROM events, LATERAL (SELECT unnest(generate_series(1, CASE WHEN (json_extract(props, '$.k'))::INT < 50 THEN 1 ELSE 2 END)) AS i) WHERE event_type = 'purchase'")
def _(t):
    k = F.get_json_object("props", "$.k").cast("int")
    item = lambda n: F.struct(F.lit(n).alias("sku"), F.struct((F.col("value") * n).alias("amount")).alias("price"))
    products = F.when(k < 50, F.array(item(1))).otherwise(F.array(item(1), item(2)))
    rows = t.events.filter("event_type = 'purchase'").select("event_id", F.struct(F.struct(k.alias("k"), products.alias("products")).alias("properties")).alias("doc"))
    flat = R.flatten_object(rows, "doc")
    return flat.select("event_id", F.col("PROPERTIES_K").alias("k"), F.col("PROPERTIES_PRODUCTS_SKU").alias("sku"), F.col("PROPERTIES_PRODUCTS_PRICE_AMOUNT").alias("amount"))


@query("u14_shards", "SELECT doc_id, 'web_' || source || '_' || CASE WHEN source = 'src3' THEN 'prod' ELSE lang END AS shard, CASE WHEN source = 'src1' THEN 'us' WHEN source = 'src3' THEN 'us' ELSE lang END AS country FROM documents")
def _(t):
    last = F.when(F.col("source") == "src3", "prod").otherwise(F.col("lang"))
    path = F.concat(F.lit("events/web_"), "source", F.lit("_"), last, F.lit("/2024/01.json"))
    docs = t.documents.select("doc_id", X.shard_of_file(path).alias("shard"))
    return docs.withColumn("country", X.country_of_shard("shard", ("src1",)))


@query("d64_calendar", "SELECT strftime(d, '%Y%m%d')::BIGINT AS date_key, d::DATE::VARCHAR AS full_date, (dayofweek(d) + 1)::BIGINT AS day_of_week, left(dayname(d), 3) AS day_name, left(monthname(d), 3) AS month_name, day(d)::BIGINT AS day_of_month, dayofyear(d)::BIGINT AS day_of_year, (d::DATE - dayofweek(d)::INT)::DATE::VARCHAR AS week_start, date_trunc('month', d)::DATE::VARCHAR AS month_start, last_day(d)::VARCHAR AS month_end, quarter(d)::BIGINT AS quarter, year(d)::BIGINT AS year FROM (SELECT unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)")
def _(t):
    span = t.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return X.calendar_columns(X.date_range(span, "a", "b", "full_date"))
