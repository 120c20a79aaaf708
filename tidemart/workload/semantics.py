"""Scalar functions (conditional, conversion, math, text, JSON, dates) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions import semantics as S
from tidemart.workload.base import money, query

O = "o_orderkey"  # noqa: E741


@query("c01_case_iff", "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END::BIGINT AS finished FROM orders")
def _(t):
    p = F.col("o_totalprice")
    return t.orders.select(
        O,
        F.when(p > 300000, "high").when(p > 100000, "mid").otherwise("low").alias("band"),
        F.expr("if(o_orderstatus = 'F', 1, 0)").alias("finished"),
    )


@query("c02_decode", "SELECT o_orderkey, CASE WHEN s IS NOT DISTINCT FROM 'F' THEN 'finished' WHEN s IS NOT DISTINCT FROM NULL THEN 'unknown' ELSE 'open' END AS label FROM (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS s FROM orders)")
def _(t):
    return t.orders.withColumn("s", F.expr("nullif(o_orderstatus, 'P')")).select(
        O, F.expr("decode(s, 'F', 'finished', NULL, 'unknown', 'open')").alias("label")
    )


@query("c03_coalesce", "SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'P'), NULLIF(o_orderpriority, '5-LOW'), 'none') AS first_set FROM orders")
def _(t):
    return t.orders.select(
        O, F.expr("coalesce(nullif(o_orderstatus, 'P'), nvl(nullif(o_orderpriority, '5-LOW'), ifnull(NULL, 'none')))").alias("first_set")
    )


@query("c04_nvl2", "SELECT o_orderkey, CASE WHEN NULLIF(o_orderstatus, 'P') IS NOT NULL THEN 'set' ELSE 'unset' END AS state FROM orders")
def _(t):
    return t.orders.select(O, F.nvl2(F.expr("nullif(o_orderstatus, 'P')"), F.lit("set"), F.lit("unset")).alias("state"))


@query("c05_zeroifnull", "SELECT c_custkey, COALESCE(NULLIF(c_nationkey, 3), 0)::BIGINT AS filled, CASE WHEN c_nationkey = 0 THEN -1 ELSE c_nationkey END::BIGINT AS emptied FROM customer")
def _(t):
    return t.customer.select(
        "c_custkey",
        F.expr("zeroifnull(nullif(c_nationkey, 3))").alias("filled"),
        F.coalesce(F.expr("nullifzero(c_nationkey)"), F.lit(-1)).alias("emptied"),
    )


@query("c06_nullif", "SELECT l_returnflag, COUNT(NULLIF(l_linestatus, 'F'))::BIGINT AS n_not_f, COUNT(*)::BIGINT AS n FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.expr("nullif(l_linestatus, 'F')")).alias("n_not_f"), F.count(F.lit(1)).alias("n")
    )


@query("c07_greatest_least", "SELECT c_custkey, CASE WHEN n IS NULL THEN '-' ELSE GREATEST(n, 7)::VARCHAR END AS hi, CASE WHEN n IS NULL THEN '-' ELSE LEAST(n, 7)::VARCHAR END AS lo FROM (SELECT c_custkey, NULLIF(c_nationkey, 3) AS n FROM customer)")
def _(t):
    c = t.customer.withColumn("n", F.expr("nullif(c_nationkey, 3)"))
    return c.select(
        "c_custkey",
        F.coalesce(S.greatest_strict("n", F.lit(7)).cast("string"), F.lit("-")).alias("hi"),
        F.coalesce(S.least_strict("n", F.lit(7)).cast("string"), F.lit("-")).alias("lo"),
    )


@query("c08_cast", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE AS price, CAST(l_quantity AS BIGINT) AS qty, CAST(l_shipdate AS DATE)::VARCHAR AS day, CAST(l_linenumber AS VARCHAR) AS line_text FROM lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", money("l_extendedprice").alias("price"), F.col("l_quantity").cast("long").alias("qty"),
        F.to_date("l_shipdate").alias("day"), F.col("l_linenumber").cast("string").alias("line_text"),
    )


@query("c09_try_cast", "SELECT page_id, COALESCE(TRY_CAST(p AS BIGINT), -1) AS num, COALESCE(CASE WHEN length(p) = 4 THEN TRY_CAST(p || '-01-01' AS DATE)::VARCHAR END, 'none') AS day FROM (SELECT page_id, regexp_extract(url, '/([^/?#.]*)[^/]*$', 1) AS p FROM pages)")
def _(t):
    p = t.pages.withColumn("p", F.regexp_extract("url", "/([^/?#.]*)[^/]*$", 1))
    day = F.when(F.length("p") == 4, F.concat("p", F.lit("-01-01"))).try_cast("date")
    return p.select(
        "page_id",
        F.coalesce(F.col("p").try_cast("long"), F.lit(-1)).alias("num"),
        F.coalesce(day.cast("string"), F.lit("none")).alias("day"),
    )


@query("c10_to_number", "SELECT o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS DECIMAL(10,2))::DOUBLE AS rank_number, CAST(o_totalprice AS DECIMAL(18,0))::DOUBLE AS whole FROM orders")
def _(t):
    return t.orders.select(
        O,
        S.split_part("o_orderpriority", "-", 1).cast("decimal(10,2)").alias("rank_number"),
        F.col("o_totalprice").cast("decimal(18,0)").alias("whole"),
    )


@query("c11_type_tests", "SELECT event_id, (json_type(props, '$.k') IN ('UBIGINT', 'BIGINT')) AS is_integer FROM events")
def _(t):
    k = F.variant_get(F.parse_json("props"), "$.k", "string")
    kind = F.schema_of_variant(F.expr("variant_get(parse_json(props), '$.k', 'variant')"))
    return t.events.select("event_id", ((kind == "BIGINT") & k.try_cast("long").isNotNull()).alias("is_integer"))


@query("c12_round_abs_trunc_mod", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 0)::DOUBLE AS r, ABS(-l_linenumber)::BIGINT AS a, TRUNC(l_extendedprice - 30000)::DOUBLE AS tr, (CASE WHEN l_extendedprice < 30000 THEN CEIL((l_extendedprice::DECIMAL(18,2) - 30000) * 10) ELSE FLOOR((l_extendedprice::DECIMAL(18,2) - 30000) * 10) END / 10)::DOUBLE AS tr1, (l_orderkey % 7)::BIGINT AS m FROM lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.round(money("l_extendedprice"), 0).alias("r"),
        F.abs(-F.col("l_linenumber")).alias("a"), S.truncated(F.col("l_extendedprice") - 30000).cast("double").alias("tr"), S.truncated(money("l_extendedprice") - 30000, 1).cast("double").alias("tr1"), (F.col("l_orderkey") % 7).alias("m"),
    )


@query("c13_power", "SELECT p_partkey, POWER(p_size, 2)::DOUBLE AS squared, ROUND(POWER(p_size, 0.5), 6)::DOUBLE AS root FROM part")
def _(t):
    return t.part.select("p_partkey", F.pow("p_size", F.lit(2)).alias("squared"), F.round(F.pow("p_size", F.lit(0.5)), 6).alias("root"))


@query("c14_sin_cos_acos", "SELECT n_nationkey::BIGINT AS n_nationkey, ROUND(SIN(n_nationkey / 57.2958::DOUBLE), 9) AS s, ROUND(COS(n_nationkey / 57.2958::DOUBLE), 9) AS c, ROUND(ACOS(LEAST(1.0::DOUBLE, COS(n_nationkey / 57.2958::DOUBLE))), 6) AS a FROM nation")
def _(t):
    x = F.col("n_nationkey") / F.lit(57.2958)
    return t.nation.select(
        "n_nationkey", F.round(F.sin(x), 9).alias("s"), F.round(F.cos(x), 9).alias("c"),
        F.round(F.acos(F.least(F.lit(1.0), F.cos(x))), 6).alias("a"),
    )


@query("c15_div0", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE l_quantity / l_discount END::DOUBLE AS d, CASE WHEN COALESCE(NULLIF(l_discount, 0.05), 0) = 0 THEN 0.0::DOUBLE ELSE l_quantity / NULLIF(l_discount, 0.05) END::DOUBLE AS dn FROM lineitem")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", S.div0("l_quantity", "l_discount").alias("d"),
        S.div0_null("l_quantity", F.expr("nullif(l_discount, 0.05D)")).alias("dn"),
    )


@query("c16_row_hash", "SELECT COUNT(DISTINCT (p_brand, p_type))::BIGINT AS distinct_contents, SUM(CASE WHEN p_brand IS DISTINCT FROM p_type THEN 1 ELSE 0 END)::BIGINT AS position_matters, COUNT(*)::BIGINT AS null_moves FROM (SELECT NULLIF(p_brand, 'Brand#1') AS p_brand, NULLIF(p_type, 'SMALL') AS p_type FROM part)")
def _(t):
    p = t.part.select(F.expr("nullif(p_brand, 'Brand#1')").alias("b"), F.expr("nullif(p_type, 'SMALL')").alias("k"))
    return p.select(
        S.row_hash("b", "k").alias("h"),
        (S.row_hash("b", "k") != S.row_hash("k", "b")).cast("int").alias("moved"),
        (S.row_hash(F.lit("x"), F.lit(None)) != S.row_hash(F.lit(None), F.lit("x"))).cast("int").alias("nulls"),
    ).agg(
        F.count_distinct("h").alias("distinct_contents"), F.sum("moved").alias("position_matters"), F.sum("nulls").alias("null_moves")
    )


@query("c17_md5_sha2", "SELECT c_custkey, md5(c_name) AS m, sha256(c_name) AS s FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.md5("c_name").alias("m"), F.sha2("c_name", 256).alias("s"))


@query("t01_case_functions", "SELECT p_partkey, lower(p_type) AS lo, upper(p_name) AS up, list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS ic, upper(replace(p_type, 'O', 'é')[1]) || lower(replace(p_type, 'O', 'é')[2:]) || '-' || 'Élan' AS accented FROM part")
def _(t):
    return t.part.select("p_partkey", F.lower("p_type").alias("lo"), F.upper("p_name").alias("up"), S.initcap_any("p_name").alias("ic"), S.initcap_any(F.concat(F.replace("p_type", F.lit("O"), F.lit("é")), F.lit("-éLAN"))).alias("accented"))


@query("t02_trim", "SELECT c_custkey, ltrim(replace(c_name, 'Customer#', ''), '0') AS l, rtrim(c_name, '0') AS r, trim('  ' || c_mktsegment || ' ') AS b FROM customer")
def _(t):
    return t.customer.select(
        "c_custkey",
        F.expr("trim(LEADING '0' FROM replace(c_name, 'Customer#', ''))").alias("l"),
        F.expr("trim(TRAILING '0' FROM c_name)").alias("r"),
        F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("b"),
    )


@query("t03_substr_left_right", "SELECT c_custkey, substr(c_name, 3, 4) AS s, left(c_name, 8) AS l, right(c_name, 4) AS r FROM customer")
def _(t):
    return t.customer.select(
        "c_custkey", F.substring("c_name", 3, 4).alias("s"), F.left("c_name", F.lit(8)).alias("l"), F.right("c_name", F.lit(4)).alias("r")
    )


@query("t04_split_part", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS zero, split_part(o_orderpriority, '-', 2) AS two, split_part(o_orderpriority, '-', 3) AS three, len(string_split(o_orderpriority, '-'))::BIGINT AS parts FROM orders")
def _(t):
    p = "o_orderpriority"
    return t.orders.select(
        O, S.split_part(p, "-", 0).alias("zero"), S.split_part(p, "-", 2).alias("two"), S.split_part(p, "-", 3).alias("three"),
        F.size(F.split(p, "-")).alias("parts"),
    )


@query("t05_charindex", "SELECT c_custkey, instr(c_name, '0')::BIGINT AS first_zero, CASE WHEN instr(substr(c_name, 14), '0') = 0 THEN 0 ELSE instr(substr(c_name, 14), '0') + 13 END::BIGINT AS from_14 FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.locate("0", F.col("c_name")).alias("first_zero"), F.locate("0", F.col("c_name"), 14).alias("from_14"))


@query("t06_replace_concat", "SELECT p_partkey, replace(p_name, ' ', '_') AS r, p_brand || '/' || p_type AS c, concat_ws('-', p_brand, NULLIF(p_type, 'SMALL'), p_name) AS w FROM part")
def _(t):
    return t.part.select(
        "p_partkey", F.replace("p_name", F.lit(" "), F.lit("_")).alias("r"), F.concat("p_brand", F.lit("/"), "p_type").alias("c"),
        F.concat_ws("-", "p_brand", F.expr("nullif(p_type, 'SMALL')"), "p_name").alias("w"),
    )


@query("t07_len_reverse_ascii", "SELECT doc_id, length(text)::BIGINT AS n, reverse(lang) AS r, ascii(lang)::BIGINT AS a, chr(ascii(lang)) AS c FROM documents")
def _(t):
    return t.documents.select(
        "doc_id", F.length("text").alias("n"), F.reverse("lang").alias("r"), F.ascii("lang").alias("a"), F.char(F.ascii("lang")).alias("c")
    )


@query("t08_like_any", "SELECT page_id, (url ILIKE '%EXAMPLE.COM%') AS com, (url LIKE 'https://%') AS secure, (lower(url) LIKE '%/blog.%' OR lower(url) LIKE '%/shop.%') AS sub FROM pages")
def _(t):
    u = F.col("url")
    return t.pages.select(
        "page_id", u.ilike("%EXAMPLE.COM%").alias("com"), u.like("https://%").alias("secure"), F.expr("url ilike any ('%/BLOG.%', '%/SHOP.%')").alias("sub")
    )


@query("t09_contains_startswith", "SELECT page_id, contains(url, 'ref=') AS has_ref, starts_with(url, 'https') AS secure, ends_with(url, '.html') AS html_page FROM pages")
def _(t):
    u = F.col("url")
    return t.pages.select("page_id", u.contains("ref=").alias("has_ref"), u.startswith("https").alias("secure"), u.endswith(".html").alias("html_page"))


@query("t10_regexp", "SELECT page_id, regexp_replace(url, '[0-9]+', '#', 'g') AS masked, regexp_extract(url, '[a-z]+\\.example') AS host, len(regexp_extract_all(url, '[0-9]'))::BIGINT AS digits, regexp_full_match(url, 'https?://[a-z.]+/.*') AS whole FROM pages")
def _(t):
    return t.pages.select(
        "page_id",
        F.regexp_replace("url", "[0-9]+", "#").alias("masked"),
        F.coalesce(F.regexp_substr("url", F.lit(r"[a-z]+\.example")), F.lit("")).alias("host"),
        F.regexp_count("url", F.lit("[0-9]")).alias("digits"),
        S.full_match("url", "https?://[a-z.]+/.*").alias("whole"),
    )


@query("t11_parse_url", "SELECT page_id, split_part(url, '://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref FROM pages")
def _(t):
    part = lambda *a: F.coalesce(F.try_parse_url("url", *[F.lit(x) for x in a]), F.lit(""))
    return t.pages.select(
        "page_id", part("PROTOCOL").alias("scheme"), part("HOST").alias("host"), part("PATH").alias("path"), part("QUERY", "ref").alias("ref")
    )


@query("t12_parse_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, (TRY_CAST(event_type AS JSON) IS NULL) AS not_json FROM events")
def _(t):
    return t.events.select(
        "event_id", F.variant_get(F.parse_json("props"), "$.k", "long").alias("k"), F.try_parse_json("event_type").isNull().alias("not_json")
    )


@query("t13_json_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text, COALESCE(json_extract_string(props, '$.absent.x'), 'none') AS missing FROM events")
def _(t):
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.get_json_object("props", "$.k").alias("k_text"),
        F.coalesce(F.get_json_object("props", "$.absent.x"), F.lit("none")).alias("missing"),
    )


@query("t14_arrays", "SELECT p_partkey, len(a)::BIGINT AS n, list_contains(a, 'bolt') AS has_bolt, array_to_string(a[1:1], '+') AS head, array_to_string(a, ',') AS joined FROM (SELECT p_partkey, string_split(p_name, ' ') AS a FROM part)")
def _(t):
    p = t.part.withColumn("a", F.split("p_name", " "))
    return p.select(
        "p_partkey", F.array_size("a").alias("n"), F.array_contains("a", "bolt").alias("has_bolt"),
        F.array_join(F.slice("a", 1, 1), "+").alias("head"), F.array_join("a", ",").alias("joined"),
    )


@query("t15_xmlget", "SELECT p_partkey, p_name AS name_text, p_size::BIGINT AS size_number FROM part")
def _(t):
    doc = F.concat(F.lit("<part><name>"), "p_name", F.lit("</name><size>"), F.col("p_size").cast("string"), F.lit("</size></part>"))
    return t.part.withColumn("x", doc).select(
        "p_partkey", F.xpath_string("x", F.lit("part/name")).alias("name_text"), F.xpath_long("x", F.lit("part/size")).alias("size_number")
    )


@query("t16_as_of_date", "SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2001-12-31')::BIGINT AS age_days FROM orders")
def _(t):
    return t.orders.select(O, S.boundaries("day", "o_orderdate", F.lit("2001-12-31").cast("date")).alias("age_days"))


@query("t17_dateadd", "SELECT o_orderkey, (o_orderdate + INTERVAL 1 MONTH)::VARCHAR AS m, (o_orderdate - INTERVAL 10 DAY)::VARCHAR AS d, (o_orderdate + INTERVAL 90 MINUTE)::VARCHAR AS mi, (o_orderdate + INTERVAL 1 YEAR)::VARCHAR AS y FROM orders")
def _(t):
    add = lambda part, n: F.timestamp_add(part, F.lit(n), F.col("o_orderdate"))
    return t.orders.select(O, add("MONTH", 1).alias("m"), add("DAY", -10).alias("d"), add("MINUTE", 90).alias("mi"), add("YEAR", 1).alias("y"))


_PARTS = ("year", "quarter", "month", "week", "day", "hour")


@query("t18_datediff", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, " + ", ".join(f"date_diff('{p}', o_orderdate, l_shipdate)::BIGINT AS n_{p}" for p in _PARTS if p != "week") + ", ((date_trunc('week', l_shipdate)::DATE - date_trunc('week', o_orderdate)::DATE) // 7)::BIGINT AS n_week" + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(t):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[S.boundaries(p, "o_orderdate", "l_shipdate").alias(f"n_{p}") for p in _PARTS]
    )


@query("t19_date_trunc", "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE::VARCHAR AS m, date_trunc('quarter', o_orderdate)::DATE::VARCHAR AS q, last_day(o_orderdate)::VARCHAR AS l, (date_trunc('month', o_orderdate)::DATE + INTERVAL 2 MONTH)::DATE::VARCHAR AS a FROM orders")
def _(t):
    trunc = lambda p: F.to_date(F.date_trunc(p, "o_orderdate"))
    return t.orders.select(
        O, trunc("month").alias("m"), trunc("quarter").alias("q"), F.last_day("o_orderdate").alias("l"), F.add_months(trunc("month"), 2).alias("a")
    )


@query("t20_date_parts", "SELECT o_orderkey, year(o_orderdate)::BIGINT AS y, month(o_orderdate)::BIGINT AS m, day(o_orderdate)::BIGINT AS d, (dayofweek(o_orderdate) + 1)::BIGINT AS dow, weekofyear(o_orderdate)::BIGINT AS w, left(dayname(o_orderdate), 3) AS dn, left(monthname(o_orderdate), 3) AS mn, (o_orderdate::DATE - dayofweek(o_orderdate)::INT)::DATE::VARCHAR AS sunday FROM orders")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        O, F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"), F.dayofweek(d).alias("dow"), F.weekofyear(d).alias("w"),
        F.date_format(d, "EEE").alias("dn"), F.date_format(d, "MMM").alias("mn"), S.week_start_sunday(d).alias("sunday"),
    )


@query("t21_convert_timezone", "SELECT event_id, timezone('America/Los_Angeles', timezone('UTC', ts))::VARCHAR AS pacific FROM events")
def _(t):
    return t.events.select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), "ts").alias("pacific"))


@query("t22_time_slice", "SELECT time_bucket(INTERVAL 30 MINUTE, ts)::VARCHAR AS slot, event_type, COUNT(*)::BIGINT AS n, SUM(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1, 2")
def _(t):
    return (
        t.events.groupBy(S.time_slice("ts", 30).alias("slot"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))
    )


@query("t23_to_date_char", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS c, strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')::DATE::VARCHAR AS back, strptime(strftime(o_orderdate, '%Y-%m-%d') || ' 13:45', '%Y-%m-%d %H:%M')::VARCHAR AS ts FROM orders")
def _(t):
    f = lambda p: F.date_format("o_orderdate", p)
    return t.orders.select(
        O, f("yyyyMMdd").alias("c"), F.to_date(f("dd/MM/yyyy"), "dd/MM/yyyy").alias("back"),
        F.to_timestamp(F.concat(f("yyyy-MM-dd"), F.lit(" 13:45")), "yyyy-MM-dd HH:mm").alias("ts"),
    )


@query("t24_from_parts", "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1)::VARCHAR AS d, make_timestamp(year(o_orderdate), month(o_orderdate), 1, 6, 30, 0)::VARCHAR AS ts FROM orders")
def _(t):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return t.orders.select(
        O, F.make_date(y, m, F.lit(1)).alias("d"), F.make_timestamp_ntz(y, m, F.lit(1), F.lit(6), F.lit(30), F.lit(0)).alias("ts")
    )


@query("t25_interval", "SELECT o_orderkey, (o_orderdate + INTERVAL 36 HOUR)::VARCHAR AS later, (o_orderdate - INTERVAL 2 MONTH)::VARCHAR AS earlier FROM orders")
def _(t):
    return t.orders.select(
        O, F.expr("o_orderdate + INTERVAL '36' HOUR").alias("later"), F.expr("o_orderdate - INTERVAL '2' MONTH").alias("earlier")
    )
