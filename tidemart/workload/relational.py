"""Joins, set operations, pivots, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.functions import semantics as S
from tidemart.functions import text as X
from tidemart.operators import joins as J
from tidemart.operators import reshape as R
from tidemart.operators.scan import Scan, key_tiles, ordered_scan
from tidemart.workload.base import SQL_LINES, SQL_SALES, money, query, when


@query("r01_projection", f"SELECT orderkey, linenumber::BIGINT AS linenumber, net::DOUBLE AS net, (net * 2)::DOUBLE AS doubled, (gross - net)::DOUBLE AS rebate FROM {SQL_LINES}")
def _(t):
    return t.lines().select("orderkey", "linenumber", "net", (F.col("net") * 2).alias("doubled"), (F.col("gross") - F.col("net")).alias("rebate"))


@query("r02_filter", "SELECT o_orderkey, o_totalprice FROM orders WHERE CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 400000 ELSE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-06-30' END")
def _(t):
    day = F.col("o_orderdate")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & day.between(when("1996-01-01"), when("1996-06-30"))
    return t.orders.filter(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") > 400000).otherwise(urgent)).select("o_orderkey", "o_totalprice")


@query("r03_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


@query("r04_cte", "WITH big AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) > 12) SELECT c_mktsegment, COUNT(*)::BIGINT AS customers, SUM(n)::BIGINT AS orders_n FROM big JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def _(t):
    big = t.orders.groupBy("o_custkey").agg(row_count().alias("n")).filter("n > 12")
    return big.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(row_count().alias("customers"), F.sum("n").alias("orders_n"))


@query("r05_recursive_series", "WITH RECURSIVE d(day, last) AS (SELECT min(o_orderdate)::DATE, max(o_orderdate)::DATE FROM orders UNION ALL SELECT (day + INTERVAL 1 DAY)::DATE, last FROM d WHERE day < last) SELECT day::VARCHAR AS day, COUNT(o_orderkey)::BIGINT AS n FROM d LEFT JOIN orders ON o_orderdate::DATE = day GROUP BY 1")
def _(t):
    span = t.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    days = X.date_range(span, "a", "b", "day").select("day")
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(row_count().alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("r06_step_tables", f"""WITH o AS (SELECT orderkey, priority, SUM(net) AS total, COUNT(*) AS lines FROM {SQL_SALES} GROUP BY 1, 2), l AS (SELECT * FROM o WHERE total > 100000)
 SELECT l.priority, COUNT(*)::BIGINT AS n, SUM(l.total)::DOUBLE AS total, MAX(p.lines)::BIGINT AS lines, MAX(p.n)::BIGINT AS all_orders FROM l JOIN (SELECT priority, SUM(lines) AS lines, COUNT(*) AS n FROM o GROUP BY 1) p USING (priority) GROUP BY 1""")
def _(t):
    """Each step is a table of its own; the first is read by two later ones."""
    per_order = t.stored(t.sales().groupBy("orderkey", "priority").agg(F.sum("net").alias("total"), row_count().alias("lines")), "r06-orders")
    large = t.stored(per_order.filter("total > 100000"), "r06-large")
    per_priority = t.stored(per_order.groupBy("priority").agg(F.sum("lines").alias("lines"), row_count().alias("all_orders")), "r06-priorities")
    return large.groupBy("priority").agg(row_count().alias("n"), F.sum("total").alias("total")).join(per_priority, "priority")


@query("r07_view_and_insert", "SELECT n_name, COUNT(*)::BIGINT AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY 1")
def _(t):
    path = t.scratch("r07")
    rich = t.customer.filter("c_acctbal > 0").select("c_custkey", "c_nationkey")
    rich.filter("c_nationkey < 10").write.mode("append").parquet(path)
    rich.filter("c_nationkey >= 10").write.mode("append").parquet(path)
    stored = t.spark.read.parquet(path)
    return stored.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(row_count().alias("customers"))


@query("r08_inline_values", "SELECT label, COUNT(*)::BIGINT AS n FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(s, label) ON o_orderstatus = s GROUP BY 1")
def _(t):
    v = t.spark.createDataFrame([("F", "finished"), ("O", "open")], "o_orderstatus string, label string")
    return t.orders.join(v, "o_orderstatus").groupBy("label").agg(row_count().alias("n"))


@query("r09_row_generator", "SELECT p_partkey, s::BIGINT AS step FROM part, LATERAL (SELECT unnest(generate_series(1, p_size)) AS s)")
def _(t):
    return t.part.select("p_partkey", F.explode(F.sequence(F.lit(1), F.col("p_size"))).alias("step"))


@query("r10_session_variable", "SELECT COUNT(*)::BIGINT AS n FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 90 DAY FROM orders)")
def _(t):
    newest = t.orders.agg(F.max("o_orderdate")).first()[0]
    low = F.timestamp_add("DAY", F.lit(-90), F.lit(str(newest)).cast("timestamp_ntz"))
    return t.orders.filter(F.col("o_orderdate") > low).agg(row_count().alias("n"))


@query("r11_scalar_subquery", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice::DECIMAL(18,2) > (SELECT max(o_totalprice::DECIMAL(18,2)) FROM orders) * 0.99")
def _(t):
    top = t.orders.agg(F.max(money("o_totalprice"))).scalar()
    return t.orders.filter(money("o_totalprice") > top * F.lit(0.99).cast("decimal(3,2)")).select("o_orderkey", "o_totalprice")


@query("r12_order_by", "SELECT p_partkey, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY s ASC NULLS LAST, p_partkey)::BIGINT AS up, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY s DESC NULLS FIRST, p_partkey)::BIGINT AS down FROM (SELECT *, NULLIF(p_size, 7) AS s FROM part)")
def _(t):
    p = t.part.withColumn("s", F.expr("nullif(p_size, 7)"))
    # NULL order is spelled out; brands are few but wide, so the ranks run over the distributed scan.
    up = p.withColumn("_n", F.col("s").isNull())
    scanned = ordered_scan(up, ["p_brand"], ["_n", "s", "p_partkey"], [Scan("up", "number")])
    flipped = scanned.withColumn("_m", F.col("s").isNotNull()).withColumn("_d", -F.col("s"))
    return ordered_scan(flipped, ["p_brand"], ["_m", "_d", "p_partkey"], [Scan("down", "number")]).select("p_partkey", "up", "down")


@query("r13_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(S.descending("o_totalprice"), "o_orderkey").limit(10)


@query("r14_qualify", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(t):
    return S.latest_by(t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("j01_inner", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def _(t):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )


_LINES_PER_ORDER = "(SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY 1)"


@query("j02_left_outer", f"SELECT o_orderkey, COALESCE(n, 0)::BIGINT AS lines FROM orders LEFT JOIN {_LINES_PER_ORDER} ON o_orderkey = l_orderkey")
def _(t):
    per = t.lineitem.groupBy("l_orderkey").agg(row_count().alias("n"))
    return t.orders.join(per, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("n", F.lit(0)).alias("lines"))


@query("j03_right_outer", "SELECT p_partkey, COALESCE(n, 0)::BIGINT AS big_lines FROM (SELECT l_partkey, COUNT(*) AS n FROM lineitem WHERE l_quantity > 49 GROUP BY 1) RIGHT JOIN part ON l_partkey = p_partkey")
def _(t):
    per = t.lineitem.filter("l_quantity > 49").groupBy("l_partkey").agg(row_count().alias("n"))
    return per.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "right").select("p_partkey", F.coalesce("n", F.lit(0)).alias("big_lines"))


@query("j04_full_outer", "SELECT COALESCE(a.n, b.n)::BIGINT AS nationkey, COALESCE(customers, 0)::BIGINT AS customers, COALESCE(suppliers, 0)::BIGINT AS suppliers FROM (SELECT c_nationkey AS n, COUNT(*) AS customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS n, COUNT(*) AS suppliers FROM supplier GROUP BY 1) b ON a.n = b.n")
def _(t):
    a = t.customer.filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nationkey")).agg(row_count().alias("customers"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(row_count().alias("suppliers"))
    return a.join(b, "nationkey", "full").fillna(0, ["customers", "suppliers"])


@query("j05_scaffold", "SELECT m::DATE::VARCHAR AS month, c_mktsegment, COUNT(o_orderkey)::BIGINT AS n FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders) CROSS JOIN (SELECT DISTINCT c_mktsegment FROM customer) s LEFT JOIN (SELECT o_orderkey, date_trunc('month', o_orderdate) AS om, c_mktsegment AS seg FROM orders JOIN customer ON o_custkey = c_custkey) o ON om = m AND seg = c_mktsegment GROUP BY 1, 2")
def _(t):
    # The scaffold is built by exploding one month sequence per segment, not by a cross join.
    span = t.orders.agg(F.struct(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))).scalar()
    segments = t.customer.select("c_mktsegment").distinct().withColumn("s", span)
    grid = X.month_range(segments, "s.a", "s.b", "month").select("month", "c_mktsegment")
    sold = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), "c_mktsegment"
    ).agg(row_count().alias("n"))
    return grid.join(sold, ["month", "c_mktsegment"], "left").fillna(0, ["n"])


@query("j06_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def _(t):
    big = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey")


@query("j07_anti", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def _(t):
    return t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


@query("j08_not_in", "SELECT (SELECT COUNT(*) FROM part WHERE p_size NOT IN (SELECT NULLIF(c_nationkey, 3) FROM customer))::BIGINT AS with_null, (SELECT COUNT(*) FROM part WHERE p_size NOT IN (SELECT c_nationkey FROM customer))::BIGINT AS without_null")
def _(t):
    t.part.select("p_size").createOrReplaceTempView("j08_part")
    t.customer.groupBy("c_nationkey").agg(F.lit(1).alias("one")).createOrReplaceTempView("j08_nations")
    return t.spark.sql(
        "SELECT (SELECT count(*) FROM j08_part WHERE p_size NOT IN (SELECT nullif(c_nationkey, 3) FROM j08_nations)) AS with_null,"
        " (SELECT count(*) FROM j08_part WHERE p_size NOT IN (SELECT c_nationkey FROM j08_nations)) AS without_null"
    )


@query("j09_null_safe", "SELECT COALESCE(a.k, -1)::BIGINT AS k, customers::BIGINT AS customers, suppliers::BIGINT AS suppliers FROM (SELECT NULLIF(c_nationkey, 3) AS k, COUNT(*) AS customers FROM customer GROUP BY 1) a JOIN (SELECT NULLIF(s_nationkey, 3) AS k, COUNT(*) AS suppliers FROM supplier GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k")
def _(t):
    a = t.customer.groupBy(F.expr("nullif(c_nationkey, 3)").alias("k")).agg(row_count().alias("customers"))
    b = t.supplier.groupBy(F.expr("nullif(s_nationkey, 3)").alias("k2")).agg(row_count().alias("suppliers"))
    return a.join(b, F.col("k").eqNullSafe(F.col("k2"))).select(F.coalesce("k", F.lit(-1)).alias("k"), "customers", "suppliers")


# Price versions of a part: its own order prices per quarter, valid until the next one.
_VERSIONS = """(SELECT partkey, q AS start_at, LEAD(q) OVER (PARTITION BY partkey ORDER BY q) AS end_at, price FROM (
  SELECT partkey, date_trunc('quarter', ship_date) AS q, max(gross) AS price FROM """ + SQL_LINES + """ GROUP BY 1, 2))"""


def _price_versions(t):
    per = t.lines().groupBy("partkey", F.date_trunc("quarter", "ship_date").cast("timestamp_ntz").alias("start_at")).agg(F.max("gross").alias("price"))
    scanned = ordered_scan(per, ["partkey"], ["start_at"], [Scan("end_at", "lead", "start_at")])
    return scanned.withColumn("end_at", F.coalesce("end_at", when("9999-12-31")))


@query("j10_effective_range", f"SELECT l.orderkey, l.linenumber::BIGINT AS linenumber, l.partkey, l.suppkey, price::DOUBLE AS price FROM {SQL_LINES} l LEFT JOIN {_VERSIONS} v ON l.partkey = v.partkey AND l.ship_date >= start_at AND l.ship_date < COALESCE(end_at, TIMESTAMP '9999-12-31')")
def _(t):
    hit = J.effective_lookup(
        t.lines().select("orderkey", "linenumber", "partkey", "suppkey", "ship_date"), _price_versions(t),
        ["partkey"], "ship_date", "start_at", "end_at", ["price"], half_open=True, strategy="scan",
    )
    return hit.drop("ship_date")


# Ranges that overlap and nest: one long version per part, and one per year that lasts one to three years.
_OVERLAPS = "(SELECT p_partkey AS partkey, TIMESTAMP '1990-01-01' AS s, TIMESTAMP '2000-06-01' AS e, 0 AS v FROM part UNION ALL SELECT p_partkey, make_timestamp(y, 1 + p_partkey % 12, 1, 0, 0, 0), make_timestamp(y + 1 + (p_partkey + y) % 3, 1, 1, 0, 0, 0), y FROM part, range(1994, 2000, 2) r(y))"


def _overlapping_versions(t):
    long = t.part.select(F.col("p_partkey").alias("partkey"), when("1990-01-01").alias("s"), when("2000-06-01").alias("e"), F.lit(0).alias("v"))
    y = t.part.select(F.col("p_partkey").alias("partkey"), F.explode(F.array(F.lit(1994), F.lit(1996), F.lit(1998))).alias("v"))
    zero = F.lit(0)
    begins = F.make_timestamp_ntz(F.col("v"), (F.col("partkey") % 12 + 1).cast("int"), F.lit(1), zero, zero, zero)
    ends = F.make_timestamp_ntz(F.col("v") + 1 + ((F.col("partkey") + F.col("v")) % 3).cast("int"), F.lit(1), F.lit(1), zero, zero, zero)
    return long.unionByName(y.select("partkey", begins.alias("s"), ends.alias("e"), "v"))


@query("j10_overlapping_ranges", f"SELECT plan, orderkey, linenumber::BIGINT AS linenumber, l.partkey, suppkey, v::BIGINT AS v FROM (VALUES ('range'), ('scan'), ('auto')) p(plan) CROSS JOIN (SELECT orderkey, linenumber, partkey, suppkey, (SELECT arg_max(v, epoch(s)) FROM {_OVERLAPS} o WHERE o.partkey = x.partkey AND ship_date >= s AND ship_date < e) AS v FROM {SQL_LINES} x) l")
def _(t):
    lines, versions = t.lines().select("orderkey", "linenumber", "partkey", "suppkey", "ship_date"), _overlapping_versions(t)
    found = [
        J.effective_lookup(lines, versions, ["partkey"], "ship_date", "s", "e", ["v"], half_open=True, strategy=plan).withColumn("plan", F.lit(plan))
        for plan in ("range", "scan", "auto")
    ]
    return found[0].unionByName(found[1]).unionByName(found[2]).drop("ship_date")


@query("j11_day_count_theta", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, (SELECT COUNT(*) FROM generate_series(1, date_diff('day', o_orderdate, l_shipdate)) g(i) WHERE dayofweek(o_orderdate::DATE + i::INT) NOT IN (0, 6))::BIGINT AS work_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(t):
    from tidemart.plans.logistics import business_days

    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.greatest(business_days(F.to_date("o_orderdate"), F.to_date("l_shipdate")), F.lit(0)).alias("work_days"))


_NEAREST = """WITH c AS (SELECT event_id AS click_id, user_id, ts AS ct FROM events WHERE event_type = 'click'),
 p AS (SELECT event_id AS buy_id, user_id, ts AS pt FROM events WHERE event_type = 'purchase'),
 pairs AS (SELECT c.user_id, click_id, buy_id, ABS(epoch_us(ct) - epoch_us(pt)) AS gap, ct, pt FROM c JOIN p ON c.user_id = p.user_id AND ABS(epoch_us(ct) - epoch_us(pt)) <= 7200000000)
 SELECT user_id, click_id, buy_id, gap / 1e6::DOUBLE AS gap_seconds FROM pairs
 QUALIFY ROW_NUMBER() OVER (PARTITION BY click_id ORDER BY gap, pt, buy_id) = 1 AND ROW_NUMBER() OVER (PARTITION BY buy_id ORDER BY gap, ct, click_id) = 1"""


@query("j12_nearest_in_time", _NEAREST)
def _(t):
    kind = lambda k, i, ts: t.events.filter(F.col("event_type") == k).select("user_id", F.col("event_id").alias(i), F.col("ts").alias(ts))
    return J.nearest_in_time(kind("click", "click_id", "ct"), kind("purchase", "buy_id", "pt"), ["user_id"], "click_id", "buy_id", "ct", "pt", 7200)


@query("j13_state_at_period_start", "SELECT user_id, d::DATE::VARCHAR AS day, event_type AS state FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-29', INTERVAL 7 DAY)) AS d) JOIN LATERAL (SELECT event_type FROM events e WHERE e.user_id = u.user_id AND e.ts <= d ORDER BY ts DESC, event_id DESC LIMIT 1) s ON true")
def _(t):
    starts = F.sequence(when("2024-01-08"), when("2024-01-29"), F.expr("INTERVAL 7 DAY"))
    grid = t.events.select("user_id").distinct().select("user_id", F.explode(starts).alias("at"))
    hit = J.as_of(grid, t.events, ["user_id"], "at", "ts", ["event_type"], tie=["event_id"])
    return hit.filter("event_type IS NOT NULL").select("user_id", F.to_date("at").alias("day"), F.col("event_type").alias("state"))


@query("j14_expression_key", "SELECT grp, COUNT(*)::BIGINT AS n FROM orders JOIN (VALUES ('TOP', 1), ('REST', 2)) v(grp, g) ON v.grp = CASE WHEN upper(left(o_orderpriority, 1)) IN ('1', '2') THEN 'TOP' ELSE 'REST' END GROUP BY 1")
def _(t):
    v = t.spark.createDataFrame([("TOP", 1), ("REST", 2)], "grp string, g int")
    keyed = t.orders.withColumn("grp", F.when(F.upper(F.left("o_orderpriority", F.lit(1))).isin("1", "2"), "TOP").otherwise("REST"))
    return keyed.join(v, "grp").groupBy("grp").agg(row_count().alias("n"))


@query("j15_co_occurrence", "WITH b AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) SELECT x.p_brand AS item_a, y.p_brand AS item_b, COUNT(*)::BIGINT AS baskets FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY 1, 2")
def _(t):
    from tidemart.plans.products import co_occurrence

    items = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    return co_occurrence(items, "l_orderkey", "p_brand")


@query("j16_flatten", "SELECT doc_id, word, COUNT(*)::BIGINT AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY 1, 2")
def _(t):
    words = t.documents.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    return words.groupBy("doc_id", "word").agg(row_count().alias("n"))


@query("j17_flatten_outer", "SELECT page_id, COALESCE(d, 'none') AS d FROM pages LEFT JOIN LATERAL (SELECT unnest(regexp_extract_all(url, 'ref=[a-z]+')) AS d) ON true")
def _(t):
    found = F.regexp_extract_all("url", F.lit("ref=[a-z]+"), F.lit(0))
    return t.pages.select("page_id", F.explode_outer(found).alias("d")).fillna("none", ["d"])


@query("j18_split_rows", "SELECT o_orderkey, i::BIGINT AS part_index, string_split(o_orderpriority, '-')[i] AS part FROM orders, LATERAL (SELECT unnest(generate_series(1, len(string_split(o_orderpriority, '-')))) AS i)")
def _(t):
    return R.split_rows(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "-", "part").drop("o_orderpriority")


@query("j19_url_parameters", "SELECT page_id, split_part(p, '=', 1) AS parameter, split_part(p, '=', 2) AS parameter_value FROM (SELECT page_id, unnest(string_split(regexp_extract(url, '[?]([^#]*)', 1), '&')) AS p FROM pages) WHERE p <> ''")
def _(t):
    return R.url_parameters(t.pages.select("page_id", "url"), "url").drop("url")


@query("u1_union_all", "SELECT k, COUNT(*)::BIGINT AS n FROM (SELECT c_nationkey::BIGINT AS k FROM customer UNION ALL SELECT s_nationkey::BIGINT FROM supplier) GROUP BY 1")
def _(t):
    both = t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k")))
    return both.groupBy("k").agg(row_count().alias("n"))


@query("u2_union_distinct", "SELECT c_nationkey::BIGINT AS k FROM customer WHERE c_acctbal > 5000 UNION SELECT s_nationkey FROM supplier")
def _(t):
    return t.customer.filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k"))).distinct()


@query("u3_except", "SELECT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def _(t):
    return t.orders.select("o_custkey").subtract(t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"))


@query("u4_intersect", "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'")
def _(t):
    of = lambda flag: t.lineitem.filter(F.col("l_returnflag") == flag).select("l_partkey")
    return of("R").intersect(of("A"))


@query("p01_pivot", "SELECT o_custkey, SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice::DECIMAL(18,2) END)::DOUBLE AS f, SUM(CASE WHEN o_orderstatus = 'O' THEN o_totalprice::DECIMAL(18,2) END)::DOUBLE AS o, SUM(CASE WHEN o_orderstatus = 'P' THEN o_totalprice::DECIMAL(18,2) END)::DOUBLE AS p FROM orders GROUP BY 1")
def _(t):
    o = t.orders.select("o_custkey", F.lower("o_orderstatus").alias("s"), money("o_totalprice").alias("v"))
    return R.pivot_sum(o, ["o_custkey"], "s", ["f", "o", "p"], "v")


@query("p02_dynamic_pivot", "SELECT user_id, " + ", ".join(f"MIN(CASE WHEN event_type = '{k}' THEN value END) AS \"{k}\"" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY 1")
def _(t):
    return R.pivot_all(t.events, ["user_id"], "event_type", "value")


@query("p03_unpivot", "SELECT c_custkey, 'balance' AS metric, c_acctbal AS amount FROM customer WHERE c_acctbal IS NOT NULL UNION ALL SELECT c_custkey, 'nation', NULLIF(c_nationkey, 3)::DOUBLE FROM customer WHERE NULLIF(c_nationkey, 3) IS NOT NULL")
def _(t):
    c = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"), F.expr("nullif(c_nationkey, 3)").cast("double").alias("nation"))
    return R.unpivot(c, ["c_custkey"], ["balance", "nation"], "metric", "amount")


@query("a01_group_by", "SELECT l_returnflag, l_linestatus, SUM(CAST(l_quantity AS BIGINT))::BIGINT AS qty, SUM(net)::DOUBLE AS revenue, COUNT(*)::BIGINT AS n FROM (SELECT l_returnflag, l_linestatus, l_quantity, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net FROM lineitem) GROUP BY 1, 2")
def _(t):
    from tidemart.workload.base import net_price

    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"), F.sum(net_price()).alias("revenue"), row_count().alias("n"))


@query("a02_group_by_ordinal", "SELECT year(o_orderdate)::BIGINT AS y, o_orderstatus, COUNT(*)::BIGINT AS n FROM orders GROUP BY 1, 2")
def _(t):
    t.orders.createOrReplaceTempView("a02_orders")
    return t.spark.sql("SELECT year(o_orderdate) AS y, o_orderstatus, count(*) AS n FROM a02_orders GROUP BY 1, 2")


@query("a03_group_by_all", "SELECT o_orderpriority, o_orderstatus, MAX(o_totalprice) AS top FROM orders GROUP BY ALL")
def _(t):
    t.orders.createOrReplaceTempView("a03_orders")
    return t.spark.sql("SELECT o_orderpriority, o_orderstatus, max(o_totalprice) AS top FROM a03_orders GROUP BY ALL")


@query("a04_having", "SELECT l_partkey, COUNT(*)::BIGINT AS n FROM lineitem GROUP BY 1 HAVING COUNT(*) > 35")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(row_count().alias("n")).filter("n > 35")


@query("a05_count_distinct", "SELECT l_suppkey, COUNT(DISTINCT l_partkey)::BIGINT AS parts, COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END)::BIGINT AS returned_orders FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("returned_orders")
    )


@query("a06_conditional_aggregate", f"SELECT partkey, SUM(CASE WHEN returnflag = 'R' THEN net ELSE 0 END)::DOUBLE AS returned, COUNT_IF(qty > 40)::BIGINT AS large FROM {SQL_LINES} GROUP BY 1")
def _(t):
    return t.lines().groupBy("partkey").agg(F.sum(F.when(F.col("returnflag") == "R", F.col("net")).otherwise(0)).alias("returned"), F.count_if(F.col("qty") > 40).alias("large"))


@query("a07_listagg", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def _(t):
    return R.ordered_list(t.orders, ["o_custkey"], "o_orderpriority", ", ", "priorities")


@query("a08_array_agg", "SELECT p_brand, array_to_string(list_sort(array_agg(DISTINCT p_type)), '|') AS types, COUNT(DISTINCT p_type)::BIGINT AS n FROM part GROUP BY 1")
def _(t):
    # Distinct first, so that the collected lists are bounded by the number of types.
    listed = t.part.select("p_brand", "p_type").distinct().groupBy("p_brand").agg(F.array_agg("p_type").alias("a"))
    return listed.select("p_brand", F.array_join(F.array_sort("a"), "|").alias("types"), F.array_size("a").alias("n"))


@query("a09_median_percentile", "SELECT o_orderpriority, MEDIAN(o_totalprice)::DOUBLE AS median_price, ROUND(quantile_cont(o_totalprice, 0.9), 6)::DOUBLE AS p90 FROM orders GROUP BY 1")
def _(t):
    half = R.exact_percentile(t.orders, ["o_orderpriority"], "o_totalprice", 0.5, "median_price")
    top = R.exact_percentile(t.orders, ["o_orderpriority"], "o_totalprice", 0.9, "p90")
    return half.join(top, "o_orderpriority").withColumn("p90", F.round("p90", 6))


@query("a10_stddev", "SELECT c_mktsegment, ROUND(stddev_samp(c_acctbal), 4)::DOUBLE AS spread FROM customer GROUP BY 1")
def _(t):
    return t.customer.groupBy("c_mktsegment").agg(F.round(F.stddev("c_acctbal"), 4).alias("spread"))


@query("a11_any_value", "SELECT c_nationkey::BIGINT AS c_nationkey, ANY_VALUE(n_name) AS n_name, COUNT(*)::BIGINT AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("c_nationkey").agg(F.any_value("n_name").alias("n_name"), row_count().alias("n"))


@query("a12_percent_of_total", "SELECT r, b, total / SUM(total) OVER (PARTITION BY r) AS share FROM (SELECT n_regionkey::BIGINT AS r, c_mktsegment AS b, COUNT(*)::DOUBLE AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)")
def _(t):
    by = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("r"), F.col("c_mktsegment").alias("b")).agg(row_count().alias("total"))
    return R.share_of_total(by, ["r"], "total", "share").drop("total")


@query("a13_totals_by_grain", "SELECT COALESCE(o_orderstatus, 'All') AS status, COALESCE(o_orderpriority, 'All') AS priority, COUNT(*)::BIGINT AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def _(t):
    rolled = t.orders.rollup("o_orderstatus", "o_orderpriority").agg(row_count().alias("n"), F.grouping_id().alias("g"))
    return rolled.select(
        F.when(F.col("g").bitwiseAND(2) > 0, "All").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("g").bitwiseAND(1) > 0, "All").otherwise(F.col("o_orderpriority")).alias("priority"),
        "n",
    )


@query("a14_cube", "SELECT COALESCE(l_returnflag, 'All') AS flag, COALESCE(l_linestatus, 'All') AS status, SUM(l_quantity::BIGINT)::BIGINT AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def _(t):
    cubed = t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    return cubed.select(F.coalesce("l_returnflag", F.lit("All")).alias("flag"), F.coalesce("l_linestatus", F.lit("All")).alias("status"), "qty")


_BY_CUST = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


@query("n01_row_number", f"SELECT o_orderkey, ROW_NUMBER() OVER {_BY_CUST}::BIGINT AS order_number FROM orders")
def _(t):
    return ordered_scan(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], [Scan("order_number", "number")]).select("o_orderkey", "order_number")


_PER_BRAND = "(SELECT p_brand, p_type, COUNT(*) AS n FROM part GROUP BY 1, 2)"


def _brand_types(t):
    return t.part.groupBy("p_brand", "p_type").agg(row_count().alias("n"))


@query("n02_rank", f"SELECT p_brand, p_type, RANK() OVER (PARTITION BY p_brand ORDER BY n DESC)::BIGINT AS rnk FROM {_PER_BRAND}")
def _(t):
    return _brand_types(t).select("p_brand", "p_type", F.rank().over(W.partitionBy("p_brand").orderBy(S.descending("n"))).alias("rnk"))


@query("n03_dense_rank", f"SELECT p_brand, p_type, DENSE_RANK() OVER (PARTITION BY p_brand ORDER BY n DESC)::BIGINT AS rnk FROM {_PER_BRAND}")
def _(t):
    return _brand_types(t).select("p_brand", "p_type", F.dense_rank().over(W.partitionBy("p_brand").orderBy(S.descending("n"))).alias("rnk"))


@query("n04_ntile", "SELECT c_custkey, NTILE(10) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey)::BIGINT AS decile FROM customer")
def _(t):
    return key_tiles(t.customer, ["c_mktsegment"], ["c_acctbal", "c_custkey"], 10, "decile").select("c_custkey", "decile")


@query("n05_percent_rank", f"SELECT p_brand, p_type, PERCENT_RANK() OVER (PARTITION BY p_type ORDER BY n)::DOUBLE AS pr FROM {_PER_BRAND}")
def _(t):
    return _brand_types(t).select("p_brand", "p_type", F.percent_rank().over(W.partitionBy("p_type").orderBy(S.ascending("n"))).alias("pr"))


@query("n06_lag_lead", f"SELECT o_orderkey, COALESCE(LAG(o_orderkey) OVER {_BY_CUST}, -1)::BIGINT AS previous, COALESCE(LEAD(o_orderkey) OVER {_BY_CUST}, -1)::BIGINT AS following FROM orders")
def _(t):
    scanned = ordered_scan(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], [Scan("p", "lag", "o_orderkey"), Scan("f", "lead", "o_orderkey")])
    return scanned.select("o_orderkey", F.coalesce("p", F.lit(-1)).alias("previous"), F.coalesce("f", F.lit(-1)).alias("following"))


@query("n07_ignore_nulls_fill", "SELECT event_id, COALESCE(LAST_VALUE(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), -1)::BIGINT AS last_purchase FROM events")
def _(t):
    e = t.events.withColumn("p", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return ordered_scan(e, ["user_id"], ["ts", "event_id"], [Scan("q", "fill", "p")]).select("event_id", F.coalesce("q", F.lit(-1)).alias("last_purchase"))


@query("n08_first_last_value", "SELECT o_orderkey, FIRST_VALUE(o_orderkey) OVER w::BIGINT AS first_order, LAST_VALUE(o_orderkey) OVER w::BIGINT AS last_order, COALESCE(NTH_VALUE(o_orderkey, 2) OVER w, -1)::BIGINT AS second_order FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
def _(t):
    # Whole-group ends come from one pre-aggregated row per customer joined back.
    ranked = ordered_scan(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], [Scan("rn", "number")])
    ends = ranked.groupBy("o_custkey").agg(
        F.min_by("o_orderkey", "rn").alias("first_order"), F.max_by("o_orderkey", "rn").alias("last_order"),
        F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("o_orderkey"))), F.lit(-1)).alias("second_order"),
    )
    return t.orders.select("o_custkey", "o_orderkey").join(ends, "o_custkey").drop("o_custkey")


@query("n09_running_total", f"SELECT o_orderkey, SUM(o_totalprice::DECIMAL(18,2)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)::DOUBLE AS spent FROM orders")
def _(t):
    o = t.orders.withColumn("v", money("o_totalprice"))
    return ordered_scan(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], [Scan("spent", "sum", "v")]).select("o_orderkey", "spent")


@query("n10_moving_window", f"SELECT day::VARCHAR AS day, SUM(v) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)::DOUBLE AS week, COALESCE(SUM(v) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS prior_six FROM (SELECT order_date::DATE AS day, SUM(net) AS v FROM {SQL_SALES} GROUP BY 1)")
def _(t):
    daily = t.sales().groupBy(F.to_date("order_date").alias("day")).agg(F.sum("net").alias("v"))
    # One row per calendar day: the window input is bounded by the calendar, not by the data.
    w = W.orderBy("day")
    return daily.select("day", F.sum("v").over(w.rowsBetween(-6, 0)).alias("week"), F.coalesce(F.sum("v").over(w.rowsBetween(-6, -1)), F.lit(0)).alias("prior_six"))


@query("n11_whole_partition", "SELECT o_orderkey, COUNT(*) OVER p::BIGINT AS orders_n, MAX(o_totalprice) OVER p AS top, SUM(o_totalprice::DECIMAL(18,2)) OVER p::DOUBLE AS total FROM orders WINDOW p AS (PARTITION BY o_custkey)")
def _(t):
    per = t.orders.groupBy("o_custkey").agg(row_count().alias("orders_n"), F.max("o_totalprice").alias("top"), F.sum(money("o_totalprice")).alias("total"))
    return t.orders.select("o_custkey", "o_orderkey").join(per, "o_custkey").drop("o_custkey")


@query("n12_double_dedupe", "WITH x AS (SELECT l_partkey, l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_partkey, l_suppkey, n::BIGINT AS n FROM x QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) = 1 AND ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) = 1")
def _(t):
    x = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(row_count().alias("n"))
    by_part = S.latest_by(x, ["l_partkey"], ["n", -F.col("l_suppkey")])
    by_supp = S.latest_by(x, ["l_suppkey"], ["n", -F.col("l_partkey")]).select("l_partkey", "l_suppkey")
    return by_part.join(by_supp, ["l_partkey", "l_suppkey"])


@query("n13_range_frame", "SELECT day::VARCHAR AS day, SUM(n) OVER (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)::BIGINT AS n8 FROM (SELECT o_orderdate::DATE AS day, COUNT(*) AS n FROM orders GROUP BY 1)")
def _(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(row_count().alias("n"))
    w = W.orderBy(F.unix_date("day")).rangeBetween(-7, 0)
    return daily.select("day", F.sum("n").over(w).alias("n8"))


@query("x12_distinct_over", "SELECT o_orderkey, n FROM orders JOIN (SELECT o_custkey AS c, COUNT(DISTINCT o_orderpriority)::BIGINT AS n FROM orders GROUP BY 1) ON c = o_custkey")
def _(t):
    return R.distinct_over(t.orders, ["o_custkey"], "o_orderpriority", "n").select("o_orderkey", "n")
