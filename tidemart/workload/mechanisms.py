"""Sweeps, incremental views, finite-state scans, tiled pairs, bitmaps, digests, rule tables, quantiles, streams and chunked sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators import digests as G
from tidemart.operators import distinct as D
from tidemart.operators.machines import state_scan
from tidemart.operators.quantiles import narrowed_quantiles
from tidemart.operators.rules import classify
from tidemart.operators.scan import key_plan
from tidemart.operators.sweep import HOT_BOUNDS, held_versions
from tidemart.operators.views import StoredView, View, signed
from tidemart.plans.products import co_occurrence
from tidemart.sources import chunked as C
from tidemart.streaming import state as ST
from tidemart.workload.base import SQL_LINES, SQL_SALES, money, query

_RANGES = f"(SELECT DISTINCT partkey, ship_date AS s, ship_date + qty * INTERVAL 1 DAY AS e FROM {SQL_LINES} WHERE qty > 0)"


@query("j10_stack_sweep", f"""WITH v AS {_RANGES}, b AS (SELECT partkey, s AS t FROM v UNION SELECT partkey, e FROM v),
 h AS (SELECT b.partkey, t, (SELECT MAX((s, e)) FROM v WHERE v.partkey = b.partkey AND s <= t AND t < e) AS held FROM b),
 c AS (SELECT * FROM h QUALIFY held IS DISTINCT FROM LAG(held) OVER (PARTITION BY partkey ORDER BY t)),
 u AS (SELECT *, LEAD(t) OVER (PARTITION BY partkey ORDER BY t) AS until FROM c)
 SELECT partkey, held[1]::VARCHAR AS started, held[2]::VARCHAR AS stopped, t::VARCHAR AS held_from, until::VARCHAR AS held_until FROM u WHERE held IS NOT NULL""")
def _(t):
    stop = F.timestamp_add("DAY", F.col("qty").cast("int"), F.col("ship_date"))
    ranges = t.lines().filter("qty > 0").select("partkey", F.col("ship_date").alias("s"), stop.alias("e"))
    held = held_versions(ranges, ["partkey"], "s", "e")
    return held.select("partkey", F.col("s").alias("started"), F.col("e").alias("stopped"), F.col("_at").alias("held_from"), F.col("_until").alias("held_until"))


_CHANGED = """(SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 1 ELSE o_custkey END AS member, o_orderstatus AS status,
  o_totalprice::DECIMAL(18,2) + CASE WHEN o_orderkey % 7 = 0 THEN 10 ELSE 0 END AS price, o_orderdate AS day FROM orders WHERE o_orderkey % 11 <> 0)"""


def _view_changes(t):
    """All orders, then the rows that change: some cost more, some move to another member, some go."""
    key = F.col("o_orderkey")
    first = t.orders.select("o_orderkey", F.col("o_custkey").alias("member"), F.col("o_orderstatus").alias("status"), money("o_totalprice").alias("price"), F.col("o_orderdate").alias("day"))
    old = first.filter((key % 7 == 0) | (key % 11 == 0) | (key % 13 == 0))
    new = old.filter(key % 11 != 0).withColumns({
        "member": F.when(key % 13 == 0, F.col("member") + 1).otherwise(F.col("member")),
        "price": (F.col("price") + F.when(key % 7 == 0, 10).otherwise(0)).cast("decimal(18,2)"),
    })
    return first, signed(old, new)


@query("s04_incremental_view", f"SELECT member, COUNT(*)::BIGINT AS orders, SUM(price)::DOUBLE AS total, MIN(price)::DOUBLE AS cheapest, MAX(price)::DOUBLE AS dearest, MIN(day)::VARCHAR AS first_day FROM {_CHANGED} GROUP BY 1")
def _(t):
    first, changes = _view_changes(t)
    view = View(["member"], sums={"total": "price"}, lows={"cheapest": "price", "first_day": "day"}, highs={"dearest": "price"}, rows="orders")
    stored = StoredView(t.spark, t.scratch("s04-view"), view, 8)
    stored.refresh(signed(None, first), 1)
    stored.refresh(changes, 2)
    return stored.read()


@query("s05_view_on_view", f"SELECT status, COUNT(*)::BIGINT AS members, SUM(total)::DOUBLE AS total, MAX(orders)::BIGINT AS most_orders FROM (SELECT member, status, COUNT(*) AS orders, SUM(price) AS total FROM {_CHANGED} GROUP BY 1, 2) GROUP BY 1")
def _(t):
    first, changes = _view_changes(t)
    per_member = StoredView(t.spark, t.scratch("s05-low"), View(["member", "status"], sums={"total": "price"}, rows="orders"), 8)
    per_status = StoredView(t.spark, t.scratch("s05-top"), View(["status"], sums={"total": "total"}, highs={"most_orders": "orders"}, rows="members"), 2)
    for batch, part in enumerate((signed(None, first), changes), 1):
        per_status.refresh(per_member.refresh_with_changes(part, batch), batch)
    return per_status.read()


# States: new, looking, buying, blocked. What each event does to each of them.
_MOVES = {"view": [1, 1, 2, 3], "click": [1, 2, 2, 3], "purchase": [2, 2, 2, 1], "error": [3, 0, 1, 3]}
_SYMBOL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(_MOVES)) + " ELSE 4 END"
_TABLE = [s for row in [*_MOVES.values(), [0, 1, 2, 3]] for s in row]


@query("d31_state_scan", f"SELECT event_id, user_id, list_reduce(list_prepend(0, list({_SYMBOL}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)), lambda s, x: ({_TABLE})[x * 4 + s + 1])::BIGINT AS state FROM events")
def _(t):
    symbol = F.lit(None).cast("int")
    for i, kind in enumerate(_MOVES):
        symbol = F.when(F.col("event_type") == kind, F.lit(i)).otherwise(symbol)
    events = t.events.select("event_id", "user_id", "ts", "event_type")
    return state_scan(events, ["user_id"], ["ts", "event_id"], symbol, list(_MOVES.values()), 0, "state").select("event_id", "user_id", "state")


@query("d51_large_baskets", "WITH b AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) SELECT x.l_partkey AS item_a, y.l_partkey AS item_b, COUNT(*)::BIGINT AS baskets FROM b x JOIN b y ON x.l_suppkey = y.l_suppkey AND x.l_partkey < y.l_partkey GROUP BY 1, 2 HAVING COUNT(*) >= 13")
def _(t):
    return co_occurrence(t.lineitem.select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey", min_baskets=13, block=128)


@query("a14_distinct_cube", "SELECT GROUPING(o_orderstatus, o_orderpriority)::BIGINT AS grouping_set, o_orderstatus, o_orderpriority, COUNT(DISTINCT o_custkey)::BIGINT AS customers FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def _(t):
    base = D.base_bitmaps(t.orders, ["o_orderstatus", "o_orderpriority"], "o_custkey")
    return D.cubed(base, ["o_orderstatus", "o_orderpriority"], "customers").withColumnRenamed("_set", "grouping_set")


@query("d11_distinct_periods", " UNION ALL ".join(f"SELECT '{p}' AS period, date_trunc('{p}', o_orderdate)::DATE::VARCHAR AS start_at, COUNT(DISTINCT o_custkey)::BIGINT AS customers FROM orders GROUP BY 1, 2" for p in ("month", "quarter", "year")))
def _(t):
    months = t.orders.select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("mo"), "o_custkey")
    base = t.stored(D.base_bitmaps(months, ["mo"], "o_custkey"), "d11-months")
    parts = [D.rolled_up(base, [F.to_date(F.date_trunc(p, F.col("mo"))).alias("start_at")], "customers").select(F.lit(p).alias("period"), "start_at", "customers") for p in ("month", "quarter", "year")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_OTHER = "(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 997 = 3 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice + CASE WHEN o_orderkey % 1009 = 5 THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderkey % 1013 <> 8)"
_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"


@query("q05_digest_difference", f"SELECT *, 1::BIGINT AS copies FROM (SELECT {_COLUMNS} FROM orders EXCEPT ALL SELECT {_COLUMNS} FROM {_OTHER}) UNION ALL SELECT *, -1 FROM (SELECT {_COLUMNS} FROM {_OTHER} EXCEPT ALL SELECT {_COLUMNS} FROM orders)")
def _(t):
    key = F.col("o_orderkey")
    a = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    b = a.filter(key % 1013 != 8).withColumns({
        "o_orderstatus": F.when(key % 997 != 3, F.col("o_orderstatus")), "o_totalprice": F.col("o_totalprice") + F.when(key % 1009 == 5, 1).otherwise(0),
    })
    return G.table_difference(a, b, ["o_orderkey"], leaf_rows=100).rows


_HOSTS = "(SELECT DISTINCT lower(regexp_extract(url, '://(?:www[.]|m[.]|blog[.])?([a-z]+)', 1)) AS word FROM pages WHERE regexp_matches(url, '://(?:www[.]|m[.]|blog[.])?[a-z]+'))"


@query("d18_rule_table", f"""WITH r AS (SELECT word, left(word, 5) AS piece FROM {_HOSTS}), m AS (SELECT page_id, arg_min(word, (-length(word), word)) AS label FROM pages JOIN r ON contains(lower(url), piece) AND starts_with(lower(url), 'http') GROUP BY 1)
 SELECT page_id, COALESCE(label, 'none') AS label FROM pages LEFT JOIN m USING (page_id)""")
def _(t):
    word = F.lower(F.regexp_extract("url", "://(?:www[.]|m[.]|blog[.])?([a-z]+)", 1))
    words = t.pages.select(word.alias("rule")).filter("rule <> ''").distinct()
    rules = words.select("rule", (-F.length("rule")).alias("rank"), F.col("rule").alias("label"))
    part = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    parts = words.select("rule", F.lit("url").alias("field"), F.explode(F.array(part("contains", F.left("rule", F.lit(5))), part("starts", F.lit("HTTP")))).alias("p"))
    return classify(t.pages.select("page_id", "url"), ["url"], rules, parts.select("rule", "field", "p.kind", "p.text"), "label", "none").select("page_id", "label")


@query("a09_narrowed_quantiles", " UNION ALL ".join(f"SELECT COALESCE(NULLIF(l_returnflag, 'N'), 'none') AS flag, '{s}' AS share, ROUND(quantile_cont(l_extendedprice, {s}), 6)::DOUBLE AS price FROM lineitem GROUP BY 1" for s in ("0.1", "0.5", "0.99")))
def _(t):
    lines = t.lineitem.select(F.expr("nullif(l_returnflag, 'N')").alias("flag"), "l_extendedprice")
    every = narrowed_quantiles(lines, ["flag"], "l_extendedprice", (0.1, 0.5, 0.99), "price")
    return every.select(F.coalesce("flag", F.lit("none")).alias("flag"), F.col("_share").cast("string").alias("share"), F.round("price", 6).alias("price"))


_PERIODS = """WITH e AS (SELECT user_id, ts, event_type, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id::VARCHAR) AS nxt FROM events)
 SELECT user_id, event_type AS status, ts::VARCHAR AS start_at, LEAST(COALESCE(nxt, ts + INTERVAL 1 DAY), ts + INTERVAL 1 DAY)::VARCHAR AS end_at FROM e WHERE nxt IS NULL OR nxt > ts
 UNION ALL SELECT user_id, 'lapsed', (ts + INTERVAL 1 DAY)::VARCHAR, nxt::VARCHAR FROM e WHERE nxt > ts + INTERVAL 1 DAY"""


@query("d08_stream_timeline", _PERIODS)
def _(t):
    """The events arrive in three deliveries that overlap, a fifth of them twice; a heartbeat far behind closes what is open."""
    src, out, ckpt = t.scratch("d08-in"), t.scratch("d08-out"), t.scratch("d08-ckpt")
    events = t.events.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    late = F.unix_micros("ts") + (F.col("event_id") % 7) * 3_600_000_000
    third = (last - first).total_seconds() * 1e6 / 3 + 1
    place = F.least(F.lit(2), F.floor((late - F.unix_micros(F.lit(first))) / third))
    repeated = F.explode(F.when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    dealt = events.withColumn("place", place).withColumn("copy", repeated)
    schema = events.schema

    def run():
        periods = ST.timeline(t.spark.readStream.schema(schema).parquet(src), "user_id", "ts", "event_type", "event_id", "8 hours", 1)
        ST.run_timeline(periods, out, ckpt).awaitTermination()

    for k in range(3):
        dealt.filter(F.col("place") == k).select(*events.columns).write.mode("append").parquet(src)
        run()
    beat = events.limit(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit(None).cast("long").alias("user_id"), F.lit("2030-01-01").cast("timestamp").alias("ts"), F.lit(None).cast("string").alias("event_type"))
    for k in (1, 2):
        beat.withColumn("event_id", F.lit(-k).cast("long")).write.mode("append").parquet(src)
        run()
    return t.spark.read.parquet(out).select("user_id", "status", F.col("start_at").cast("timestamp_ntz").alias("start_at"), F.col("end_at").cast("timestamp_ntz").alias("end_at"))


@query("l21_partitioned_source", "SELECT o_orderkey, o_custkey, o_orderdate::VARCHAR AS o_orderdate, o_totalprice FROM orders")
def _(t):
    path = t.scratch("l21-landed")
    t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").write.parquet(path)
    return C.read_chunked(t.spark, path, "o_orderdate", 300)


@query("l22_change_stream", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    src, out, ckpt = t.scratch("l22-in"), t.scratch("l22-out"), t.scratch("l22-ckpt")
    events = t.events.select("event_id", "user_id", "event_type")
    half = events.agg(F.max("event_id") / 2).first()[0]
    for part in (events.filter(F.col("event_id") <= half), events.filter(F.col("event_id") > half)):
        part.write.mode("append").parquet(src)
        C.land_changes(C.stream_changes(t.spark, src, "event_id", 4_000, events.schema), out, ckpt).awaitTermination()
    return t.spark.read.parquet(out)


@query("j15_min_support", f"WITH b AS (SELECT DISTINCT orderkey, suppkey FROM {SQL_SALES}) SELECT x.suppkey AS item_a, y.suppkey AS item_b, COUNT(*)::BIGINT AS baskets FROM b x JOIN b y ON x.orderkey = y.orderkey AND x.suppkey < y.suppkey GROUP BY 1, 2 HAVING COUNT(*) >= 15")
def _(t):
    return co_occurrence(t.sales(), "orderkey", "suppkey", min_baskets=15)


@query("m10_overlapping_versions", f"""WITH v AS {_RANGES} SELECT l.orderkey, l.linenumber::BIGINT AS linenumber, l.suppkey, l.partkey, (SELECT MAX((s, e))[2] FROM v WHERE v.partkey = l.partkey AND s <= l.ship_date AND l.ship_date < e)::VARCHAR AS valid_until FROM {SQL_LINES} l""")
def _(t):
    from tidemart.operators.joins import disjoint_versions, effective_lookup

    lines = t.lines()
    # Lines are a plain read, so their keys are counted there, and neither versions nor lookups need be settled for it.
    plan = key_plan(lines, ["partkey"], HOT_BOUNDS // 2)
    stop = F.timestamp_add("DAY", F.col("qty").cast("int"), F.col("ship_date"))
    ranges = lines.filter("qty > 0").select("partkey", F.col("ship_date").alias("s"), stop.alias("e"), stop.alias("valid_until")).distinct()
    # Overlaps are resolved once, when the dimension is published; its lookups need not look for them again.
    published = t.stored(disjoint_versions(ranges, ["partkey"], "s", "e", half_open=True, plan=plan), "m10-dim")
    hit = effective_lookup(lines.select("orderkey", "linenumber", "suppkey", "partkey", "ship_date"), published, ["partkey"], "ship_date", "s", "e", ["valid_until"], half_open=True, disjoint=True, plan=plan)
    return hit.select("orderkey", "linenumber", "suppkey", "partkey", "valid_until")


