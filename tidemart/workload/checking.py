"""Validation, reconciliation and contact-data operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.operators import quality as Q
from tidemart.workload.base import SQL_SALES, query, when


@query("q01_duplicate_keys", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, COALESCE(CASE WHEN COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 THEN 'error' END, 'clean') AS quality FROM lineitem")
def _(t):
    stage = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = Q.flag_duplicates(stage, ["l_orderkey", "l_linenumber"])
    return out.select(*stage.columns, F.coalesce("meta_data_quality", F.lit("clean")).alias("quality"))


@query("q02_duplicate_events", "SELECT COUNT(*)::BIGINT AS n, COUNT(*) FILTER (c > 1)::BIGINT AS errors FROM (SELECT COUNT(*) OVER (PARTITION BY o_custkey, o_orderdate) AS c FROM orders)")
def _(t):
    out = Q.flag_duplicates(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderdate")
    return out.agg(row_count().alias("n"), F.count_if(F.col("meta_data_quality") == "error").alias("errors"))


def _stage(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"), F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    return o.unionByName(o.filter("priority = '1-URGENT'"))


_SQL_STAGE = """(WITH o AS (SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS status, NULLIF(o_orderpriority, '5-LOW') AS priority FROM orders)
 SELECT * FROM o UNION ALL SELECT * FROM o WHERE priority = '1-URGENT')"""
_SQL_FLAGGED = f"""(SELECT o_orderkey, CASE WHEN COUNT(*) OVER (PARTITION BY o_orderkey) > 1 THEN 'error' WHEN status IS NULL OR priority IS NULL THEN 'warning' END AS quality,
 CASE WHEN COUNT(*) OVER (PARTITION BY o_orderkey) > 1 THEN 'Duplicate business keys' WHEN status IS NULL AND priority IS NULL THEN 'NULL in status, priority' WHEN status IS NULL THEN 'NULL in status' WHEN priority IS NULL THEN 'NULL in priority' END AS message FROM {_SQL_STAGE})"""


def _flagged(t):
    return Q.flag_nulls(Q.flag_duplicates(_stage(t), ["o_orderkey"]), ["status", "priority"])


@query("q03_null_warnings", f"SELECT COALESCE(quality, 'clean') AS quality, COALESCE(message, '-') AS message, COUNT(*)::BIGINT AS n, (quality IS DISTINCT FROM 'error') AS loadable FROM {_SQL_FLAGGED} GROUP BY ALL")
def _(t):
    f = _flagged(t)
    counted = lambda df, ok: df.groupBy(F.coalesce("meta_data_quality", F.lit("clean")).alias("quality"), F.coalesce("excp_message", F.lit("-")).alias("message")).agg(row_count().alias("n")).withColumn("loadable", F.lit(ok))
    return counted(Q.loadable(f), True).unionByName(counted(f.filter("meta_data_quality = 'error'"), False))


@query("q04_exception_table", f"SELECT message, is_current, COUNT(*)::BIGINT AS n FROM (SELECT message, true AS is_current FROM {_SQL_FLAGGED} WHERE quality IS NOT NULL UNION ALL SELECT message, false FROM {_SQL_FLAGGED} WHERE quality = 'error') GROUP BY ALL")
def _(t):
    f = _flagged(t)
    first = Q.update_exceptions(None, f.filter("meta_data_quality = 'error'"))
    out = Q.update_exceptions(first, f)
    return out.groupBy(F.col("excp_message").alias("message"), F.col("meta_is_current_excp").alias("is_current")).agg(row_count().alias("n"))


_DAILY_A = f"(SELECT order_date::DATE AS day, SUM(net) AS net, COUNT(*) AS lines FROM {SQL_SALES} GROUP BY 1)"
_DAILY_B = f"(SELECT order_date::DATE AS day, SUM(CASE WHEN priority = '1-URGENT' AND order_date >= TIMESTAMP '2001-01-01' THEN net + 1 ELSE net END) AS net, COUNT(*) AS lines FROM {SQL_SALES} GROUP BY 1)"


def _two_daily(t):
    s = t.sales().withColumn("day", F.to_date("order_date"))
    a = s.groupBy("day").agg(F.sum("net").alias("net"), row_count().alias("lines"))
    off = F.when((F.col("priority") == "1-URGENT") & (F.col("order_date") >= when("2001-01-01")), F.col("net") + 1).otherwise(F.col("net"))
    return a, s.groupBy("day").agg(F.sum(off.cast("decimal(18,4)")).alias("net"), row_count().alias("lines"))


@query("q05_set_difference", f"SELECT day::VARCHAR AS day, net::DOUBLE AS net, 'a' AS only_in FROM (SELECT day, net FROM {_DAILY_A} EXCEPT SELECT day, net FROM {_DAILY_B}) UNION ALL SELECT day::VARCHAR, net::DOUBLE, 'b' FROM (SELECT day, net FROM {_DAILY_B} EXCEPT SELECT day, net FROM {_DAILY_A})")
def _(t):
    a, b = _two_daily(t)
    same = lambda df: df.select("day", F.col("net").cast("decimal(28,4)").alias("net"))
    return Q.set_difference(same(a), same(b), "a", "b")


@query("q06_metric_reconciliation", f"SELECT a.day::VARCHAR AS day, 'net' AS metric, a.net::DOUBLE AS a_value, b.net::DOUBLE AS b_value, ROUND(a.net::DOUBLE - b.net::DOUBLE, 4) AS difference FROM {_DAILY_A} a JOIN {_DAILY_B} b USING (day) WHERE ABS(a.net::DOUBLE - b.net::DOUBLE) / b.net::DOUBLE > 0.000001")
def _(t):
    a, b = _two_daily(t)
    out = Q.reconcile(a, b, ["day"], ["net", "lines"], 0.000001)
    return out.select("day", "metric", "a_value", "b_value", F.round("difference", 4).alias("difference"))


@query("q07_orphans", "SELECT l_orderkey, COUNT(*)::BIGINT AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW') GROUP BY 1")
def _(t):
    found = Q.orphans(t.lineitem, t.orders.filter("o_orderpriority <> '5-LOW'"), "l_orderkey", "o_orderkey")
    return found.groupBy("l_orderkey").agg(row_count().alias("n"))


@query("q07_null_counts", "SELECT COUNT(*) FILTER (o_orderstatus = 'P')::BIGINT AS null_status, COUNT(*) FILTER (o_orderpriority = '5-LOW')::BIGINT AS null_priority FROM orders")
def _(t):
    stage = t.orders.select(F.expr("nullif(o_orderstatus, 'P')").alias("status"), F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    return Q.null_counts(stage, ["status", "priority"])


@query("q08_duplicate_references", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, COUNT(*)::BIGINT AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def _(t):
    return Q.repeated(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("q09_row_threshold", "SELECT 'part' AS check_name, COUNT(*)::BIGINT AS n FROM part HAVING COUNT(*) > 100")
def _(t):
    return Q.over_threshold(t.part, 100, "part").unionByName(Q.over_threshold(t.region, 100, "region"))


@query("q10_freshness", "SELECT 'orders' AS table_name, max(o_orderdate)::DATE::VARCHAR AS newest FROM orders")
def _(t):
    return Q.stale({"orders": (t.orders, "o_orderdate"), "lines": (t.lineitem, "l_shipdate")}, F.lit("2001-10-01").cast("date"), 20)


@query("q11_share_drift", """WITH d AS (SELECT o_orderdate::DATE AS d, o_orderstatus AS s, (COUNT(*) FILTER (o_orderpriority = '1-URGENT') * 100)::DOUBLE / COUNT(*)::DOUBLE AS p FROM orders WHERE o_orderdate::DATE BETWEEN DATE '2000-04-20' AND DATE '2000-05-20' GROUP BY 1, 2), e AS (SELECT MIN(d) AS a, MAX(d) AS b FROM d)
 SELECT s AS o_orderstatus, COALESCE(MAX(p) FILTER (d = b), -1) AS previous_date, COALESCE(MAX(p) FILTER (d = a), -1) AS last_month_same_date, ROUND(AVG(p) FILTER (d > a AND d < b), 6) AS mean_percent FROM d, e GROUP BY 1""")
def _(t):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    out = Q.share_drift(t.orders, "o_orderdate", "o_orderstatus", urgent, F.lit("2000-05-21").cast("date"))
    none = lambda c: F.coalesce(c, F.lit(-1.0)).alias(c)
    return out.select("o_orderstatus", none("previous_date"), none("last_month_same_date"), F.round("mean_percent", 6).alias("mean_percent"))


@query("q12_hourly_sources", "SELECT h::VARCHAR AS hour, SUM(c)::BIGINT AS clicks, SUM(v)::BIGINT AS views FROM (SELECT date_trunc('hour', ts) AS h, (event_type = 'click')::INT AS c, (event_type = 'view')::INT AS v FROM events WHERE event_type IN ('click', 'view')) GROUP BY 1")
def _(t):
    kind = lambda k: (t.events.filter(F.col("event_type") == k), "ts")
    return Q.hourly_counts({"clicks": kind("click"), "views": kind("view")})


_HIDDEN = ("l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")


@query("q13_column_drift", " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT({c})::BIGINT AS values_hidden, 'missing in second' AS drift FROM lineitem" for c in _HIDDEN) + " UNION ALL SELECT 'extra', COUNT(*) FILTER (l_tax > 0)::BIGINT, 'missing in first' FROM lineitem")
def _(t):
    view = t.lineitem.select("L_ORDERKEY", "l_partkey", "l_tax", F.when(F.col("l_tax") > 0, 1).alias("extra"))
    return Q.drift_report(t.lineitem, view)


@query("q14_pattern_tags", "SELECT page_id, COALESCE(CASE WHEN url ILIKE '%://m.%' THEN 'mobile' WHEN url ILIKE '%blog%' OR url ILIKE '%/blog/%' THEN 'blog' WHEN url ILIKE '%.html' THEN 'static' END, 'other') AS tag FROM pages")
def _(t):
    out = Q.pattern_tags(t.pages.select("page_id", "url"), "url", {"mobile": ["%://m.%"], "blog": ["%blog%", "%/blog/%"], "static": ["%.html"]})
    return out.select("page_id", F.coalesce("tag", F.lit("other")).alias("tag"))


@query("q15_masking", "SELECT c_custkey, left(md5(c_name), length(c_name)) AS c_name, c_mktsegment FROM customer")
def _(t):
    return Q.masked_view(t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_name"])


@query("q16_contact_catalogue", """SELECT 'documents' AS table_name, 'text' AS column_name, kind, hits::BIGINT AS hits FROM (SELECT 'email' AS kind, COUNT(*) FILTER (regexp_matches(text, '[\\w.+-]+@[\\w-]+\\.[\\w.]+')) AS hits FROM documents
 UNION ALL SELECT 'phone', COUNT(*) FILTER (regexp_matches(text, '\\+?[0-9][0-9 ().-]{7,}[0-9]')) FROM documents UNION ALL SELECT 'ip', COUNT(*) FILTER (regexp_matches(text, '(?:[0-9]{1,3}\\.){3}[0-9]{1,3}')) FROM documents) WHERE hits > 0""")
def _(t):
    found = Q.contact_columns(t.documents.select("text", "lang"), "documents", 0.0)
    excluded = t.spark.createDataFrame([("documents", "lang")], "table_name string, column_name string")
    start = found.filter("kind = 'email'")
    return Q.catalogue_merge(start, found, excluded).select("table_name", "column_name", "kind", "hits")


@query("q17_contact_hashes", "SELECT c_custkey, sha256(lower(trim(c_name)) || '@example.com') AS email_hash, sha256(regexp_replace('+1 (' || c_custkey::VARCHAR || ') ' || c_nationkey::VARCHAR || '-00', '[^0-9]', '', 'g')) AS phone_hash FROM customer")
def _(t):
    mail = F.concat("c_name", F.lit("@EXAMPLE.com "))
    phone = F.concat(F.lit("+1 ("), F.col("c_custkey").cast("string"), F.lit(") "), F.col("c_nationkey").cast("string"), F.lit("-00"))
    return t.customer.select("c_custkey", Q.contact_hash(Q.normal_email(mail)).alias("email_hash"), Q.contact_hash(Q.normal_phone(phone)).alias("phone_hash"))


@query("q18_unsent_conversions", "SELECT event_id, ((ROW_NUMBER() OVER (ORDER BY ts, event_id) - 1) // 100 + 1)::BIGINT AS batch_no FROM events WHERE event_type = 'purchase' AND ts > TIMESTAMP '2024-01-10' AND event_id NOT IN (SELECT event_id FROM events WHERE value > 60)")
def _(t):
    buys = t.events.filter("event_type = 'purchase'").select("event_id", "ts")
    sent = t.events.filter("value > 60").select("event_id")
    return Q.unsent(buys, sent, "event_id", "ts", when("2024-01-10"), 100).select("event_id", "batch_no")


@query("q19_privacy_requests", "SELECT DISTINCT user_id, kind, 'u' || user_id::VARCHAR AS email, CASE WHEN user_id < 50 THEN 'v' || user_id::VARCHAR ELSE '-' END AS second_email FROM (SELECT user_id, event_type AS kind FROM events WHERE event_type IN ('signup', 'error'))")
def _(t):
    requests = t.events.filter("event_type IN ('signup', 'error')").select("user_id", F.col("event_type").alias("kind"))
    u = lambda p: F.concat(F.lit(p), F.col("user_id").cast("string"))
    contacts = t.events.select("user_id").distinct().select("user_id", u("u").alias("email"), F.when(F.col("user_id") < 50, u("v")).otherwise(u("u")).alias("second_email"))
    return Q.privacy_requests(requests, contacts, "user_id").fillna("-", ["second_email"])
