"""Merge, history and consolidation operators on batches cut from the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from tidemart.functions.semantics import row_count

from tidemart.functions import semantics as S
from tidemart.operators import history as H
from tidemart.operators import joins as J
from tidemart.operators import merge as M
from tidemart.operators import scd as D
from tidemart.operators.scan import Scan, ordered_scan
from tidemart.operators.watermark import adaptive_look_back
from tidemart.sources.tables import BucketedTable, VersionedTable
from tidemart.workload.base import SQL_LINES, SQL_SALES, money, query, when

T1, T2 = "2002-01-01 00:00:00", "2002-01-02 00:00:00"


def _orders(t):
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", money("o_totalprice").alias("total"), F.col("o_orderdate").alias("version")
    )


def _shift(df, days, plus):
    return df.withColumn("version", F.timestamp_add("DAY", F.lit(days), F.col("version"))).withColumn(
        "total", (F.col("total") + F.lit(plus)).cast("decimal(18,2)")
    )


def _order_batch(t):
    """Urgent orders changed (with an older copy beside), high ones changed without a newer version, rest unchanged."""
    o = _orders(t)
    urgent = o.filter("o_orderpriority = '1-URGENT'")
    high = o.filter("o_orderpriority = '2-HIGH'")
    rest = o.filter("o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
    return _shift(urgent, 1, 10).unionByName(_shift(urgent, -2, 5)).unionByName(_shift(high, 0, 7)).unionByName(rest)


_SQL_O = "(SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderdate AS version FROM orders)"
_SQL_BATCH = f"""(SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(total + 10 AS DECIMAL(18,2)) AS total, version + INTERVAL 1 DAY AS version FROM {_SQL_O} WHERE o_orderpriority = '1-URGENT'
 UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, total + 5, version - INTERVAL 2 DAY FROM {_SQL_O} WHERE o_orderpriority = '1-URGENT'
 UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, total + 7, version FROM {_SQL_O} WHERE o_orderpriority = '2-HIGH'
 UNION ALL SELECT * FROM {_SQL_O} WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))"""
_M01 = f"""WITH tgt AS (SELECT * FROM {_SQL_O} WHERE version < TIMESTAMP '1999-01-01'),
 src AS (SELECT * FROM {_SQL_BATCH} QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1),
 j AS (SELECT t.o_orderkey IS NULL AS is_new, s.version > t.version AND s.total <> t.total AS upd, COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
   t.total AS tt, s.total AS st, t.version AS tv, s.version AS sv FROM tgt t FULL JOIN src s ON t.o_orderkey = s.o_orderkey)
 SELECT o_orderkey, (CASE WHEN is_new OR upd THEN st ELSE tt END)::DOUBLE AS total, (CASE WHEN is_new OR upd THEN sv ELSE tv END)::VARCHAR AS version,
   CASE WHEN is_new THEN '{T2}' ELSE '{T1}' END AS created, CASE WHEN is_new OR upd THEN '{T2}' ELSE '{T1}' END AS updated FROM j"""


def _m01(t, strategy):
    keys, delta = ["o_orderkey"], ["version"]
    first = _orders(t).filter(F.col("version") < when("1999-01-01"))
    target = t.stored(M.insert_update(None, first, keys, delta, when(T1)), "orders")
    merged = M.insert_update(target, _order_batch(t), keys, delta, when(T2), strategy=strategy)
    return merged.select(
        "o_orderkey", "total", "version", F.col("meta_create_datetime").alias("created"), F.col("meta_update_datetime").alias("updated")
    )


@query("m01_insert_update", _M01)
def _(t):
    return _m01(t, "full")


@query("m01_insert_update_small_batch", _M01)
def _(t):
    return _m01(t, "lookup")


@query("m01_insert_update_buckets", _M01)
def _(t):
    """The merge into a table that rewrites the touched buckets only."""
    keys, delta = ["o_orderkey"], ["version"]
    table = BucketedTable(t.spark, t.scratch("orders-buckets"), keys, buckets=16)
    load = lambda now: lambda target, source: M.insert_update(target, source, keys, delta, when(now))
    table.merge(_orders(t).filter(F.col("version") < when("1999-01-01")), load(T1))
    table.merge(_order_batch(t), load(T2))
    return table.read().select(
        "o_orderkey", "total", "version", F.col("meta_create_datetime").alias("created"), F.col("meta_update_datetime").alias("updated")
    )


def _parts(t):
    return t.part.select("p_partkey", "p_type", "p_size", money("p_retailprice").alias("price"))


_M02 = f"SELECT p_partkey, (CASE WHEN p_size > 10 AND p_type = 'PROMO' THEN p_retailprice::DECIMAL(18,2) + 1 ELSE p_retailprice::DECIMAL(18,2) END)::DOUBLE AS price, p_size <= 5 AS is_deleted, CASE WHEN p_size <= 5 THEN '{T2}' WHEN p_size <= 10 THEN '2002-01-03 00:00:00' WHEN p_type = 'PROMO' THEN '{T2}' ELSE '{T1}' END AS last_change FROM part"


def _width(df, key, ranges):
    """Numbers per range, for so many ranges of the keys there are."""
    return (df.agg(F.max(key)).first()[0] or 0) // ranges + 1


@query("m02_insert_update_delete", _M02)
def _(t):
    p, now1, now2, now3 = _parts(t), when(T1), when(T2), when("2002-01-03 00:00:00")
    raised = p.withColumn("price", F.when(F.col("p_type") == "PROMO", F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)"))
    first = t.stored(M.insert_update_delete(None, p, ["p_partkey"], now1), "parts")
    second = t.stored(M.insert_update_delete(first, raised.filter("p_size > 10"), ["p_partkey"], now2), "parts")
    # The third feed brings back sizes 6 to 10; a one-row feed after it must delete nothing.
    third_feed = raised.filter("p_size > 10").unionByName(p.filter("p_size BETWEEN 6 AND 10"))
    third = t.stored(M.insert_update_delete(second, third_feed, ["p_partkey"], now3), "parts")
    fourth = M.insert_update_delete(third, third_feed.orderBy("p_partkey").limit(1), ["p_partkey"], now3)
    return fourth.select("p_partkey", "price", F.col("meta_is_deleted").alias("is_deleted"), F.col("meta_update_datetime").alias("last_change"))


@query("m02_full_feed_buckets", _M02)
def _(t):
    """Full feeds into key ranges; ranges whose digest agrees with the feed's are not rewritten."""
    p = _parts(t)
    raised = p.withColumn("price", F.when(F.col("p_type") == "PROMO", F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)"))
    third_feed = raised.filter("p_size > 10").unionByName(p.filter("p_size BETWEEN 6 AND 10"))
    table = BucketedTable(t.spark, t.scratch("parts-ranges"), ["p_partkey"], width=_width(p, "p_partkey", 12))
    M.merge_feed(table, p, when(T1))
    M.merge_feed(table, raised.filter("p_size > 10"), when(T2))
    M.merge_feed(table, third_feed, when("2002-01-03 00:00:00"))
    M.merge_feed(table, third_feed.orderBy("p_partkey").limit(1), when("2002-01-03 00:00:00"))
    return table.read().select("p_partkey", "price", F.col("meta_is_deleted").alias("is_deleted"), F.col("meta_update_datetime").alias("last_change"))


_LINE_KEY = "PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC"


@query("m03_truncate_load", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate::VARCHAR AS l_shipdate FROM lineitem QUALIFY ROW_NUMBER() OVER ({_LINE_KEY}) = 1")
def _(t):
    stage = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return M.truncate_load(stage, ["l_orderkey", "l_linenumber"], ["l_shipdate"], when(T1)).select(*stage.columns)


@query("m04_insert_absent", f"SELECT p_brand, p_type, MIN(CASE WHEN p_size <= 2 THEN '{T1}' ELSE '{T2}' END) AS created FROM part GROUP BY 1, 2")
def _(t):
    p = t.part
    start = M.with_meta(p.filter("p_size <= 2").select("p_brand", "p_type").distinct(), when(T1), ["p_brand", "p_type"])
    out = M.insert_absent(start, p.select("p_brand", "p_type"), when(T2))
    return out.select("p_brand", "p_type", F.col("meta_create_datetime").alias("created"))


@query("m05_brand_merge", "SELECT c_custkey, (CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN c_acctbal::DECIMAL(18,2) + 1 ELSE c_acctbal::DECIMAL(18,2) END)::DOUBLE AS balance, CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN c_mktsegment ELSE 'seed' END AS source FROM customer WHERE c_acctbal > 0 OR c_mktsegment IN ('MACHINERY', 'FURNITURE')")
def _(t):
    c = t.customer.select("c_custkey", money("c_acctbal").alias("balance"), "c_mktsegment")
    seed = c.filter("balance > 0").select(
        "c_custkey", "balance", F.lit(0).alias("hvr_is_deleted"), when(T1).alias("hvr_change_time"), F.lit("seed").alias("meta_row_source")
    )
    stage = lambda s: c.filter(F.col("c_mktsegment") == s).select("c_custkey", (F.col("balance") + 1).cast("decimal(18,2)").alias("balance"))
    out = M.brand_merge(seed, {s: stage(s) for s in ("MACHINERY", "FURNITURE")}, ["c_custkey"], when(T2))
    return out.select("c_custkey", "balance", F.col("meta_row_source").alias("source"))


_SPEC = D.ScdSpec(keys=("user_id",), type_1=("level",), type_2=("state",), event="ts")
_SQL_EV = "(SELECT event_id, user_id, ts, event_type AS state, CASE WHEN value > 30 THEN 'high' ELSE 'low' END AS level FROM events)"
_SCD_HASHES = {"meta_type_1_hash": _SPEC.type_1, "meta_type_2_hash": _SPEC.type_2}
CUT = "2024-01-16 00:00:00"


def _events(t):
    level = F.when(F.col("value") > 30, "high").otherwise("low")
    return t.events.select("event_id", "user_id", "ts", F.col("event_type").alias("state"), level.alias("level"))


def _before(df):
    return df.filter(F.col("ts") < when(CUT))


def _after(df):
    return df.filter(F.col("ts") >= when(CUT))


_M06 = f"""WITH b1 AS (SELECT user_id, arg_max(state, ts) AS state, arg_max(level, ts) AS level, max(ts) AS ts FROM {_SQL_EV} WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1),
 b2 AS (SELECT user_id, arg_max(state, ts) AS state, arg_max(level, ts) AS level, max(ts) AS ts FROM {_SQL_EV} WHERE ts >= TIMESTAMP '{CUT}' GROUP BY 1)
 SELECT a.user_id, a.state, CASE WHEN b.level <> a.level THEN b.level ELSE a.level END AS level, '{D.LOAD_FIRST_START}' AS from_at, CASE WHEN b.state <> a.state THEN b.ts::VARCHAR ELSE '{D.LOAD_OPEN_END}' END AS to_at, COALESCE(b.state = a.state, true) AS is_current FROM b1 a LEFT JOIN b2 b USING (user_id)
 UNION ALL SELECT b.user_id, b.state, b.level, CASE WHEN a.user_id IS NULL THEN '{D.LOAD_FIRST_START}' ELSE b.ts::VARCHAR END, '{D.LOAD_OPEN_END}', true FROM b2 b LEFT JOIN b1 a USING (user_id) WHERE a.user_id IS NULL OR a.state <> b.state"""


@query("m06_scd_load", _M06)
def _(t):
    e = _events(t)
    first = t.stored(D.scd_load(None, _before(e), _SPEC, when(T1)), "scd")
    out = D.scd_load(first, _after(e), _SPEC, when(T2))
    return out.select("user_id", "state", "level", F.col("meta_from_datetime").alias("from_at"), F.col("meta_to_datetime").alias("to_at"), F.col("meta_is_current").alias("is_current"))


@query("m06_scd_load_buckets", _M06)
def _(t):
    """The dimension in buckets; those whose current versions already agree with the batch stay as they are."""
    e = _events(t)
    table = BucketedTable(t.spark, t.scratch("scd-buckets"), list(_SPEC.keys), buckets=16)
    load = lambda now: lambda target, stage: D.scd_load(target, stage, _SPEC, when(now))
    for batch, now in ((_before(e), T1), (_after(e), T2), (_after(e), "2002-01-03 00:00:00")):
        M.merge_changed(table, batch, load(now), _SCD_HASHES, among=F.col("meta_is_current"))
    return table.read().select("user_id", "state", "level", F.col("meta_from_datetime").alias("from_at"), F.col("meta_to_datetime").alias("to_at"), F.col("meta_is_current").alias("is_current"))


def _sql_scd_batch(name, events, current):
    """One batch of the event dimension as SQL: lag over the batch, first row against the current version."""
    return f"""{name}_d AS (SELECT s.*, CASE WHEN t.user_id IS NULL AND s.rn = 1 THEN 'new'
   WHEN s.ts <= COALESCE(s.pts, t.ts) THEN 'ignore'
   WHEN s.level <> COALESCE(s.plevel, t.level) AND s.state <> COALESCE(s.pstate, t.state) THEN 'both'
   WHEN s.level <> COALESCE(s.plevel, t.level) THEN 'type 1' WHEN s.state <> COALESCE(s.pstate, t.state) THEN 'type 2' ELSE 'ignore' END AS status
  FROM (SELECT s.*, ROW_NUMBER() OVER w AS rn, LAG(s.ts) OVER w AS pts, LAG(s.level) OVER w AS plevel, LAG(s.state) OVER w AS pstate
        FROM {events} s LEFT JOIN {current} t ON s.user_id = t.user_id WHERE t.user_id IS NULL OR t.ts < s.ts
        WINDOW w AS (PARTITION BY s.user_id ORDER BY s.ts)) s LEFT JOIN {current} t ON s.user_id = t.user_id),
 {name}_c AS (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nts, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) AS seq FROM {name}_d WHERE status IN ('new', 'type 2', 'both')),
 {name}_1 AS (SELECT user_id, arg_max(level, ts) AS level FROM {name}_d WHERE status IN ('type 1', 'both') GROUP BY 1)"""


_M07 = f"""WITH e1 AS (SELECT user_id, ts, state, level FROM {_SQL_EV} WHERE ts < TIMESTAMP '{CUT}'), e2 AS (SELECT user_id, ts, state, level FROM {_SQL_EV} WHERE ts >= TIMESTAMP '{CUT}'),
 none AS (SELECT * FROM e1 WHERE false), {_sql_scd_batch("a", "e1", "none")},
 v1 AS (SELECT c.user_id, c.state, COALESCE(u.level, c.level) AS level, CASE WHEN status = 'new' THEN TIMESTAMP '1900-01-01' ELSE c.ts END AS ts, COALESCE(nts - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31') AS e, nts IS NULL AS cur FROM a_c c LEFT JOIN a_1 u USING (user_id)),
 cur AS (SELECT user_id, ts, state, level FROM v1 WHERE cur), {_sql_scd_batch("b", "e2", "cur")},
 closed AS (SELECT v.user_id, v.state, v.level, v.ts, CASE WHEN v.cur AND x.user_id IS NOT NULL THEN x.ts - INTERVAL 1 MILLISECOND ELSE v.e END AS e, v.cur AND x.user_id IS NULL AS cur FROM v1 v LEFT JOIN (SELECT * FROM b_c WHERE seq = 1 AND status IN ('both', 'type 2')) x ON v.user_id = x.user_id),
 allv AS (SELECT * FROM closed UNION ALL SELECT user_id, state, level, CASE WHEN status = 'new' THEN TIMESTAMP '1900-01-01' ELSE ts END, COALESCE(nts - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31'), nts IS NULL FROM b_c)
 SELECT a.user_id, a.state, COALESCE(u.level, a.level) AS level, a.ts::VARCHAR AS start_at, a.e::VARCHAR AS end_at, a.cur AS is_current FROM allv a LEFT JOIN b_1 u USING (user_id)"""


def _scd_history(t):
    e = _events(t)
    first = t.stored(D.scd_mart(None, _before(e), _SPEC, when(T1)), "scd")
    return D.scd_mart(first, _after(e), _SPEC, when(T2))


@query("m07_scd_mart", _M07)
def _(t):
    return _scd_history(t).select("user_id", "state", "level", F.col("effective_start_datetime").alias("start_at"), F.col("effective_end_datetime").alias("end_at"), "is_current")


@query("m07_scd_mart_buckets", _M07)
def _(t):
    e = _events(t)
    table = BucketedTable(t.spark, t.scratch("scd-mart-buckets"), list(_SPEC.keys), buckets=16)
    load = lambda now: lambda target, stage: D.scd_mart(target, stage, _SPEC, when(now))
    for batch, now in ((_before(e), T1), (_after(e), T2)):
        M.merge_changed(table, batch, load(now), _SCD_HASHES, among=F.col("is_current"))
    return table.read().select("user_id", "state", "level", F.col("effective_start_datetime").alias("start_at"), F.col("effective_end_datetime").alias("end_at"), "is_current")


@query("m08_mart_dim", f"SELECT s_suppkey, s_name, (CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal::DECIMAL(18,2) END)::DOUBLE AS balance, CASE WHEN s_acctbal < 0 THEN '{T2}' ELSE '{T1}' END AS updated, '9999-12-31 00:00:00' AS end_at, true AS is_current FROM supplier")
def _(t):
    s = t.supplier.select("s_suppkey", "s_name", money("s_acctbal").alias("balance"))
    first = t.stored(D.mart_upsert(None, s, ["s_suppkey"], when(T1), is_dim=True), "dim")
    fixed = s.withColumn("balance", F.greatest("balance", F.lit(0)).cast("decimal(18,2)"))
    out = D.mart_upsert(first, fixed, ["s_suppkey"], when(T2), is_dim=True)
    return out.select("s_suppkey", "s_name", "balance", F.col("meta_update_datetime").alias("updated"), F.col("effective_end_datetime").alias("end_at"), "is_current")


_M09 = f"""WITH f AS (SELECT orderkey, MAX(ship_date) AS last_ship, SUM(net) AS net, COUNT(*) AS lines FROM {SQL_LINES} GROUP BY 1),
 a AS (SELECT orderkey, SUM(net) AS net FROM {SQL_LINES} WHERE ship_date < TIMESTAMP '1999-01-01' GROUP BY 1)
 SELECT f.orderkey, f.net::DOUBLE AS net, f.lines::BIGINT AS lines, CASE WHEN a.orderkey IS NULL OR f.last_ship >= TIMESTAMP '1999-01-01' THEN '{T2}' ELSE '{T1}' END AS updated FROM f LEFT JOIN a USING (orderkey)"""


@query("m09_mart_fact", _M09)
def _(t):
    fact = lambda df: df.groupBy("orderkey").agg(F.max("ship_date").alias("last_ship"), F.sum("net").alias("net"), row_count().alias("lines"))
    early = t.lines().filter(F.col("ship_date") < when("1999-01-01"))
    first = t.stored(D.mart_upsert(None, fact(early), ["orderkey"], when(T1)), "fact")
    out = D.mart_upsert(first, fact(t.lines()), ["orderkey"], when(T2), newer_by="last_ship")
    return out.select("orderkey", "net", "lines", F.col("meta_update_datetime").alias("updated"))


@query("m09_mart_fact_ranges", _M09)
def _(t):
    """The fact in ranges of order numbers: the whole mart is delivered again, ranges without a new or changed order are not rewritten."""
    fact = lambda df: df.groupBy("orderkey").agg(F.max("ship_date").alias("last_ship"), F.sum("net").alias("net"), row_count().alias("lines"))
    rows = t.stored(fact(t.lines()), "mart-delta")
    table = BucketedTable(t.spark, t.scratch("fact-ranges"), ["orderkey"], width=_width(rows, "orderkey", 16))
    load = lambda now, newer_by=None: lambda target, delta: D.mart_upsert(target, delta, ["orderkey"], when(now), newer_by=newer_by)
    hashes = {"meta_row_hash": ["last_ship", "net", "lines"]}
    M.merge_changed(table, fact(t.lines().filter(F.col("ship_date") < when("1999-01-01"))), load(T1), hashes)
    M.merge_changed(table, rows, load(T2, "last_ship"), hashes)
    return table.read().select("orderkey", "net", "lines", F.col("meta_update_datetime").alias("updated"))


_SQL_PRICE_DIM = f"""(SELECT partkey, q AS s, COALESCE(LEAD(q) OVER (PARTITION BY partkey ORDER BY q) - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31') AS e,
  partkey * 1000 + date_diff('month', TIMESTAMP '1990-01-01', q) AS k FROM (SELECT DISTINCT partkey, date_trunc('year', ship_date) AS q FROM {SQL_LINES}))"""


def _price_dim(t):
    years = t.lines().select("partkey", F.date_trunc("year", "ship_date").cast("timestamp_ntz").alias("s")).distinct()
    ranged = ordered_scan(years, ["partkey"], ["s"], [Scan("n", "lead", "s")])
    return ranged.select(
        "partkey",
        F.col("s").alias("effective_start_datetime"),
        F.coalesce(S.millis_before(F.col("n")), when("9999-12-31")).alias("effective_end_datetime"),
        (F.col("partkey") * 1000 + S.boundaries("month", when("1990-01-01"), F.col("s"))).alias("price_key"),
    )


@query("m10_key_lookup", f"SELECT l.orderkey, l.linenumber::BIGINT AS linenumber, l.partkey, l.suppkey, COALESCE(d.k, -1)::BIGINT AS price_key FROM {SQL_SALES} l LEFT JOIN {_SQL_PRICE_DIM} d ON l.partkey = d.partkey AND l.order_date BETWEEN d.s AND d.e")
def _(t):
    stage = t.sales().select("orderkey", "linenumber", "partkey", "suppkey", "order_date")
    return J.key_lookup(stage, _price_dim(t), {"partkey": "partkey"}, "price_key", "price_key", "order_date", when(T1)).drop("order_date")


@query("m10_key_lookup_large_dim", f"SELECT l.orderkey, l.linenumber::BIGINT AS linenumber, l.partkey, l.suppkey, COALESCE(d.k, -1)::BIGINT AS price_key FROM {SQL_SALES} l LEFT JOIN {_SQL_PRICE_DIM} d ON l.partkey = d.partkey AND l.order_date BETWEEN d.s AND d.e")
def _(t):
    stage = t.sales().select("orderkey", "linenumber", "partkey", "suppkey", "order_date")
    return J.key_lookup(stage, _price_dim(t), {"partkey": "partkey"}, "price_key", "price_key", "order_date", when(T1), strategy="scan").drop("order_date")


@query("m11_unknown_member", "SELECT s_suppkey AS supplier_key, s_name AS supplier_name, '1900-01-01 00:00:00' AS start_at, true AS is_current FROM supplier UNION ALL SELECT -1, 'Unknown', '1900-01-01 00:00:00', true")
def _(t):
    dim = t.supplier.select(
        F.col("s_suppkey").alias("supplier_key"), F.col("s_name").alias("supplier_name"),
        when(S.FIRST_START).alias("effective_start_datetime"), F.lit(True).alias("is_current"),
    )
    once = D.unknown_member(dim, "supplier_key")
    return D.unknown_member(once, "supplier_key").withColumnRenamed("effective_start_datetime", "start_at")


@query("m11_surrogate_keys", "SELECT c_custkey, (ROW_NUMBER() OVER (ORDER BY c_custkey) + 100)::BIGINT AS customer_key FROM customer WHERE c_acctbal > 0")
def _(t):
    return D.surrogate_keys(t.customer.filter("c_acctbal > 0").select("c_custkey"), ["c_custkey"], "customer_key", 100)


def _history_feed(t):
    e = _events(t)
    archive = e.filter("state <> 'error'").select("user_id", "ts", "state", "level")
    log = e.filter("state = 'error'").select("user_id", F.col("ts").alias("datetime_deleted"))
    return archive, log


def _change_history(t):
    archive, log = _history_feed(t)
    shaped = H.delete_rows(log, ["user_id"], "ts", "deleted", archive)
    first = t.stored(H.change_history(None, _before(archive), _before(shaped), ["user_id"], "ts", None, when(T1)), "history")
    return H.change_history(first, _after(archive), _after(shaped), ["user_id"], "ts", None, when(T2))


_SQL_M12 = f"""WITH r AS (SELECT user_id, ts, state = 'error' AS del, CASE WHEN state = 'error' THEN NULL ELSE state END AS state, CASE WHEN state = 'error' THEN NULL ELSE level END AS level FROM {_SQL_EV}),
 k AS (SELECT *, LAG((del, state, level)) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM r QUALIFY p IS DISTINCT FROM (del, state, level) OR ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts) = 1),
 f AS (SELECT user_id, ts, del, LEAD(ts) OVER w AS nts, LAST_VALUE(state IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS state, LAST_VALUE(level IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS level FROM k WINDOW w AS (PARTITION BY user_id ORDER BY ts))
 SELECT user_id, COALESCE(state, '-') AS state, COALESCE(level, '-') AS level, del AS is_deleted, ts::VARCHAR AS start_at, COALESCE(nts - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31')::VARCHAR AS end_at, nts IS NULL AS is_current FROM f"""


@query("m12_change_history", _SQL_M12)
def _(t):
    return _change_history(t).select(
        "user_id", F.coalesce("state", F.lit("-")).alias("state"), F.coalesce("level", F.lit("-")).alias("level"),
        F.col("meta_row_is_deleted").alias("is_deleted"), F.col("effective_start_datetime").alias("start_at"),
        F.col("effective_end_datetime").alias("end_at"), "is_current",
    )


@query("m13_rebuild_history", "SELECT user_id, event_id, ts::VARCHAR AS start_at, COALESCE(LEAD(ts) OVER w, TIMESTAMP '9999-12-31')::VARCHAR AS end_at, LEAD(ts) OVER w IS NULL AS is_current FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def _(t):
    out = H.rebuild_history(t.events.select("user_id", "event_id", "ts"), ["user_id"], "ts")
    return out.select("user_id", "event_id", F.col("effective_start_datetime").alias("start_at"), F.col("effective_end_datetime").alias("end_at"), "is_current")


_SQL_ORDER_HIST = "(SELECT o_custkey, o_orderdate, MAX(o_totalprice) AS top FROM orders GROUP BY 1, 2)"


def _order_history(t):
    return t.orders.groupBy("o_custkey", F.col("o_orderdate").alias("effective_start_datetime")).agg(F.max("o_totalprice").alias("top"))


@query("m14_brand_split", f"SELECT o_custkey, o_orderdate::VARCHAR AS start_at, top FROM {_SQL_ORDER_HIST} JOIN customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2")
def _(t):
    hist = _order_history(t)
    owners = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("n_regionkey").alias("company_id"))
    start = hist.filter(F.col("effective_start_datetime") < when("1996-01-01")).join(owners.filter("company_id = 2"), "o_custkey", "left_semi")
    return H.brand_split(start, hist, owners, "o_custkey", ["o_custkey"], 2).withColumnRenamed("effective_start_datetime", "start_at")


# Three sources by market segment; the company comes from the nation's region, some nations are unknown.
_SOURCES = ((10, ("AUTOMOBILE", "BUILDING"), (10, 40)), (20, ("FURNITURE", "HOUSEHOLD"), (20, 30)), (30, ("MACHINERY",), (40,)))
LOW = "2024-01-01 10:00:00"


def _sql_source(i, segments, companies):
    listed = ", ".join(f"'{s}'" for s in segments)
    return f"""SELECT {i} AS source_id, company, CASE WHEN c_custkey = 0 THEN NULL ELSE (c_custkey::VARCHAR || company::VARCHAR)::BIGINT END AS k, c_custkey AS original, c_acctbal::DECIMAL(18,2) AS balance, chg FROM
  (SELECT *, CASE WHEN n_regionkey IN (1, 2, 3) THEN n_regionkey * 10 ELSE 40 END AS company, TIMESTAMP '2024-01-01' + INTERVAL 1 HOUR * c_nationkey AS chg FROM customer JOIN nation ON c_nationkey = n_nationkey)
  WHERE c_mktsegment IN ({listed}) AND chg >= TIMESTAMP '{LOW}' - INTERVAL 5 MINUTE AND company IN ({", ".join(map(str, companies))})"""


_M15_SRC = " UNION ALL ".join(_sql_source(*s) for s in _SOURCES)


def _consolidated_deltas(t, low):
    changed = F.timestamp_add("HOUR", F.col("c_nationkey"), when("2024-01-01"))
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", money("c_acctbal").alias("balance"), changed.alias("chg"))
    company = t.nation.filter("n_regionkey IN (1, 2, 3)").select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_regionkey") * 10).alias("company_id"))
    return [
        H.consolidate_delta(c.filter(F.col("c_mktsegment").isin(*seg)).drop("c_mktsegment"), i, companies, "c_custkey", [], "chg", low, company, "c_nationkey")
        for i, seg, companies in _SOURCES
    ]


@query("m15_consolidate", f"SELECT source_id::BIGINT AS source_id, company::BIGINT AS company, k::BIGINT AS k, original, (balance + CASE WHEN chg > TIMESTAMP '2024-01-01 20:00:00' THEN 1 ELSE 0 END)::DOUBLE AS balance FROM ({_M15_SRC}) UNION ALL SELECT source_id + 1, company, k, original, 0 FROM ({_M15_SRC})")
def _(t):
    first = t.stored(H.consolidate(None, _consolidated_deltas(t, when(LOW)), ["c_custkey"], "chg"), "consolidated")
    # Every key stands once more under another source, with rows of its own; key 0 has no tagged key at all.
    twins = first.withColumn("data_source_id", F.col("data_source_id") + 1).withColumn("balance", F.lit(0).cast("decimal(18,2)"))
    both = t.stored(H.consolidate(first, [twins], ["c_custkey"], "chg"), "consolidated-twins")
    # A second delivery is newer only for the customers that changed after 20:00; repeating it changes nothing.
    newer = F.col("chg") > when("2024-01-01 20:00:00")
    again = first.withColumn("balance", (F.col("balance") + 1).cast("decimal(18,2)")).withColumn(
        "chg", F.when(newer, F.timestamp_add("DAY", F.lit(1), F.col("chg"))).otherwise(F.col("chg"))
    )
    once = t.stored(H.consolidate(both, [again], ["c_custkey"], "chg"), "consolidated-once")
    out = H.consolidate(once, [again], ["c_custkey"], "chg")
    return out.select(F.col("data_source_id").alias("source_id"), F.col("company_id").alias("company"), F.col("c_custkey").alias("k"), F.col("meta_original_c_custkey").alias("original"), "balance")


_M16_KEYS = f"""(SELECT src AS data_source_id, CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN 0 ELSE o_custkey END AS original, o_orderdate FROM {_SQL_ORDER_HIST} CROSS JOIN (VALUES (1), (2)) v(src))"""


@query("m16_consolidated_history", f"SELECT data_source_id::BIGINT AS data_source_id, original AS meta_original_o_custkey, o_orderdate::VARCHAR AS start_at, COALESCE(LEAD(o_orderdate) OVER w - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31')::VARCHAR AS end_at, LEAD(o_orderdate) OVER w IS NULL AS is_current FROM (SELECT DISTINCT * FROM {_M16_KEYS}) WINDOW w AS (PARTITION BY data_source_id, original ORDER BY o_orderdate)")
def _(t):
    # Two sources with the same keys; many rows have the key NULL or 0, which are keys of a source like others.
    k = F.when(F.col("o_custkey") % 5 == 0, F.lit(None)).when(F.col("o_custkey") % 5 == 1, F.lit(0)).otherwise(F.col("o_custkey")).cast("long")
    v = _order_history(t).select(k.alias("meta_original_o_custkey"), "effective_start_datetime").distinct()
    v = v.withColumn("data_source_id", F.explode(F.array(F.lit(1), F.lit(2))))
    late = F.col("effective_start_datetime").between(when("1997-01-01"), when("1999-06-30"))
    scanned = ordered_scan(v.filter(~late), ["data_source_id", "meta_original_o_custkey"], ["effective_start_datetime"], [Scan("n", "lead", "effective_start_datetime")])
    ended = lambda df, nxt: df.withColumn("effective_end_datetime", F.coalesce(S.millis_before(nxt), when("9999-12-31"))).withColumn("is_current", nxt.isNull())
    target = ended(scanned, F.col("n")).drop("n")
    delta = ended(v.filter(late), F.lit(None).cast("timestamp_ntz"))
    out = H.consolidate_history(target, [delta], ["o_custkey"])
    out = H.consolidate_history(out, [delta], ["o_custkey"])  # delivered twice
    return out.withColumnsRenamed({"effective_start_datetime": "start_at", "effective_end_datetime": "end_at"})


@query("m17_adaptive_look_back", "SELECT o_orderkey, LEAST(COALESCE(CASE WHEN age < 60 THEN loaded - INTERVAL 180 MINUTE WHEN age >= 360 THEN loaded - INTERVAL 1 MINUTE * (age + 1080) ELSE loaded - INTERVAL 1 MINUTE * (3 * age) END, TIMESTAMP '1900-01-01'), newest)::VARCHAR AS low FROM (SELECT o_orderkey, o_custkey % 600 AS age, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS loaded, o_orderdate - INTERVAL 1 MINUTE * (o_custkey % 900) AS newest FROM orders)")
def _(t):
    # The last load is up to ten hours ago, or there was none; the source's newest row lies before or after the look-back.
    o, k = t.orders, F.col("o_custkey").cast("int")
    loaded = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate"))
    now, newest = F.timestamp_add("MINUTE", k % 600, F.col("o_orderdate")), F.timestamp_add("MINUTE", -(k % 900), F.col("o_orderdate"))
    return o.select("o_orderkey", adaptive_look_back(loaded, now, newest).alias("low"))


@query("m18_archive_merge", f"SELECT o_orderkey, version::VARCHAR AS version, CASE WHEN version < TIMESTAMP '1998-01-01' THEN 0 ELSE total END::DOUBLE AS total FROM {_SQL_O}")
def _(t):
    o = _orders(t).select("o_orderkey", "version", "total")
    archive = o.filter(F.col("version") >= when("1998-01-01"))
    old = o.filter(F.col("version") < when("1998-06-01")).select("o_orderkey", "version")
    doubled = old.unionByName(old)
    return H.archive_merge(archive, doubled, ["o_orderkey"], "version").fillna(0, ["total"])


@query("m19_dedupe_archive", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_shipdate::VARCHAR AS l_shipdate, COUNT(*)::BIGINT AS one FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem) GROUP BY 1, 2, 3")
def _(t):
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    early = H.dedupe_archive(a.filter(F.col("l_shipdate") < when("1998-01-01")), ["l_orderkey", "l_linenumber"], "l_shipdate")
    lake = H.dedupe_archive(a, ["l_orderkey", "l_linenumber"], "l_shipdate")
    out = H.lake_into_archive(early, lake, ["l_orderkey", "l_linenumber"], "l_shipdate")
    return out.select("l_orderkey", "l_linenumber", "l_shipdate", F.lit(1).alias("one"))


@query("m20_merge_with_delete", "SELECT p_partkey, (p_retailprice::DECIMAL(18,2) + CASE WHEN p_size > 20 THEN 1 ELSE 0 END)::DOUBLE AS price FROM part WHERE p_type <> 'SMALL'")
def _(t):
    p = _parts(t)
    source = p.filter("p_size > 20 OR p_type = 'SMALL'").select(
        "p_partkey", "p_type", "p_size", (F.col("price") + 1).cast("decimal(18,2)").alias("price"), (F.col("p_type") == "SMALL").alias("is_duplicate")
    )
    return M.merge_with_delete(p, source, ["p_partkey"], "is_duplicate", ["price"]).select("p_partkey", "price")


@query("m21_update_from", "SELECT c_custkey, (CASE WHEN n > 10 THEN c_acctbal::DECIMAL(18,2) + n ELSE c_acctbal::DECIMAL(18,2) END)::DOUBLE AS balance FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def _(t):
    c = t.customer.select("c_custkey", money("c_acctbal").alias("balance"))
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(row_count().alias("n"))
    return M.update_from(c, counts, ["c_custkey"], {"balance": lambda t_, s: (t_("balance") + s("n")).cast("decimal(18,2)")}, lambda t_, s: s("n") > 10)


_DAILY = f"(SELECT order_date::DATE AS day, SUM(net) AS v FROM {SQL_SALES} GROUP BY 1)"


@query("m22_restate_window", f"SELECT day::VARCHAR AS day, (CASE WHEN day >= DATE '2001-06-01' THEN v ELSE v + 1 END)::DOUBLE AS v FROM {_DAILY}")
def _(t):
    daily = t.sales().groupBy(F.to_date("order_date").alias("day")).agg(F.sum("net").alias("v"))
    stale = daily.withColumn("v", (F.col("v") + 1).cast(dict(daily.dtypes)["v"]))
    return M.restate_window(stale, daily, "day", F.lit("2001-07-31").cast("date"), 60)


@query("m22_delete_where", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT COALESCE(NULLIF(o_orderstatus, 'P') = 'F', false)")
def _(t):
    return M.delete_where(t.orders, F.expr("nullif(o_orderstatus, 'P') = 'F'")).select("o_orderkey", "o_totalprice")


@query("m23_overwrite", "SELECT n_nationkey::BIGINT AS n_nationkey, COUNT(*)::BIGINT AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    table = VersionedTable(t.spark, t.scratch("m23"))
    per = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(row_count().alias("customers"))
    table.publish(per.withColumn("customers", F.lit(0).cast("long")))
    table.publish(per)
    return table.read()


@query("m24_insert_all", "SELECT 'report' AS target, COUNT(*)::BIGINT AS n, SUM(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'snapshot', COUNT(*), SUM(o_totalprice::DECIMAL(18,2))::DOUBLE FROM orders")
def _(t):
    # One pass writes both targets: the report is a partition of the snapshot.
    path = t.scratch("m24")
    source = t.orders.select("o_orderkey", money("o_totalprice").alias("v"), (F.col("o_orderstatus") == "F").cast("int").alias("in_report"))
    source.write.mode("overwrite").partitionBy("in_report").parquet(path)
    stored = t.spark.read.parquet(path)
    total = lambda name, df: df.agg(F.lit(name).alias("target"), row_count().alias("n"), F.sum("v").alias("total"))
    return total("report", stored.filter("in_report = 1")).unionByName(total("snapshot", stored))


@query("m25_replace_groups", "SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'system') UNION ALL SELECT conv_id, turn, role FROM conversations WHERE role = 'system'")
def _(t):
    c = t.conversations.select("conv_id", "turn", "role")
    delta = c.filter("role = 'system'")
    return M.replace_groups(c, delta, ["conv_id"]).unionByName(delta)


@query("m26_sql_target_merge", "SELECT COALESCE(k, -1)::BIGINT AS k, n::BIGINT AS n FROM (SELECT NULLIF(c_nationkey, 3) AS k, COUNT(*) AS n FROM customer GROUP BY 1)")
def _(t):
    k = F.expr("nullif(c_nationkey, 3)").alias("k")
    target = t.customer.filter("c_acctbal > 0").groupBy(k).agg(row_count().alias("n"))
    source = t.customer.groupBy(k).agg(row_count().alias("n"))
    return M.sql_target_merge(target, source, ["k"]).select(F.coalesce("k", F.lit(-1)).alias("k"), "n")


@query("m27_effective_rates", f"SELECT partkey, v::DOUBLE AS rate, CASE WHEN ROW_NUMBER() OVER w = 1 THEN '1900-01-01 00:00:00' ELSE q::VARCHAR END AS start_at, COALESCE(LEAD(q) OVER w - INTERVAL 1 MILLISECOND, TIMESTAMP '9999-12-31')::VARCHAR AS end_at, LEAD(q) OVER w IS NULL AS is_current FROM (SELECT partkey, date_trunc('year', ship_date) AS q, MAX(gross) AS v FROM {SQL_LINES} GROUP BY 1, 2) WINDOW w AS (PARTITION BY partkey ORDER BY q)")
def _(t):
    rates = t.lines().groupBy("partkey", F.date_trunc("year", "ship_date").cast("timestamp_ntz").alias("q")).agg(F.max("gross").alias("rate"))
    out = M.effective_rates(rates, ["partkey"], "q").drop("q")
    return out.withColumnsRenamed({"effective_start": "start_at", "effective_end": "end_at"})


@query("m28_schema_evolution", "SELECT event_id, COALESCE(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value END, -1) AS value, COALESCE(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END, '-') AS new_column FROM events")
def _(t):
    old = t.events.filter(F.col("ts") < when(CUT)).select("event_id", "value")
    new = t.events.filter(F.col("ts") >= when(CUT)).select("event_id", F.col("event_type").alias("new_column"))
    return M.evolve(old, new).select("event_id", F.coalesce("value", F.lit(-1.0)).alias("value"), F.coalesce("new_column", F.lit("-")).alias("new_column"))


@query("m28_rescued_data", "SELECT c_custkey, COALESCE(TRY_CAST(CASE WHEN c_acctbal < 0 THEN 'owing' ELSE c_nationkey::VARCHAR END AS BIGINT), -1) AS nation, CASE WHEN c_acctbal < 0 THEN '{\"nation\":\"owing\",\"segment\":\"' ELSE '{\"segment\":\"' END || c_mktsegment || '\"}' AS rescued FROM customer")
def _(t):
    raw = t.customer.select(
        F.col("c_custkey").cast("string"), F.when(F.col("c_acctbal") < 0, "owing").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    out = M.rescue(raw, {"c_custkey": "long", "nation": "long"}, "rescued")
    return out.withColumn("nation", F.coalesce("nation", F.lit(-1)))


@query("d72_close_versions", f"SELECT o_custkey, o_orderdate::VARCHAR AS start_at, CASE WHEN c_acctbal < 0 AND LEAD(o_orderdate) OVER w IS NULL THEN '2002-01-01 00:00:00' ELSE COALESCE(LEAD(o_orderdate) OVER w, TIMESTAMP '9999-12-31')::VARCHAR END AS end_at, c_acctbal >= 0 AND LEAD(o_orderdate) OVER w IS NULL AS is_current FROM {_SQL_ORDER_HIST} JOIN customer ON c_custkey = o_custkey WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)")
def _(t):
    hist = H.rebuild_history(_order_history(t).withColumnRenamed("effective_start_datetime", "at"), ["o_custkey"], "at")
    doomed = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    out = H.close_versions(hist, doomed, ["o_custkey"], when(T1))
    return out.select("o_custkey", F.col("effective_start_datetime").alias("start_at"), F.col("effective_end_datetime").alias("end_at"), "is_current")
