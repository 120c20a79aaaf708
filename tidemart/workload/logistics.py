"""Lead times, milestones, conversations, slots and usage cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.operators.merge import apply_merge
from tidemart.plans import logistics as P
from tidemart.streaming.jobs import slot_totals
from tidemart.workload.base import SQL_SALES, money, query


@query("d47_lead_times", f"""SELECT orderkey, linenumber::BIGINT AS linenumber, partkey, suppkey, CASE WHEN ship_date >= order_date THEN ship_date::DATE - order_date::DATE ELSE -1 END::BIGINT AS ship_days,
 CASE WHEN ship_date >= order_date THEN (SELECT COUNT(*) FROM generate_series(0, ship_date::DATE - order_date::DATE) g(i) WHERE dayofweek(order_date::DATE + i::INT) NOT IN (0, 6)) - CASE WHEN dayofweek(order_date) IN (0, 6) THEN 0 ELSE 1 END ELSE -1 END::BIGINT AS ship_work_days FROM {SQL_SALES}""")
def _(t):
    s = t.sales().select("orderkey", "linenumber", "partkey", "suppkey", "order_date", "ship_date")
    out = P.lead_times(s, {"ship": ("order_date", "ship_date")}).drop("order_date", "ship_date")
    return out.fillna(-1, ["ship_days", "ship_work_days"])


@query("d48_milestone_pivot", "SELECT user_id, " + ", ".join(f"COALESCE(MIN(ts) FILTER (event_type = '{k}')::VARCHAR, '-') AS \"{k}\"" for k in ("signup", "view", "click", "purchase")) + " FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 4 DAY FROM events) GROUP BY 1")
def _(t):
    low = P.milestone_low([(t.events, "ts")], 4)[0].scalar()
    kinds = ["signup", "view", "click", "purchase"]
    wide = P.milestone_pivot(t.events.filter(F.col("ts") >= low), ["user_id"], "event_type", "ts", kinds)
    return wide.select("user_id", *[F.coalesce(F.col(k).cast("string"), F.lit("-")).alias(k) for k in kinds])


_SEG = "(SELECT conv_id, role AS participant, turn, length(text) AS chars FROM conversations)"


@query("d49_conversation_segments", "SELECT conv_id::VARCHAR AS conversation_id, role AS participant_id, turn AS segment, length(text)::BIGINT AS chars FROM conversations")
def _(t):
    # Turns as nested documents: one participant with one session and its segment each.
    segment = F.struct(F.col("turn").alias("segment"), F.length("text").cast("long").alias("chars"))
    session = F.struct(F.concat_ws("-", F.col("conv_id").cast("string"), "role").alias("sessionId"), F.array(segment).alias("segments"))
    participant = F.struct(F.col("role").alias("participantId"), F.array(session).alias("sessions"))
    json = t.conversations.select(F.to_json(F.struct(F.col("conv_id").cast("string").alias("conversationId"), F.array(participant).alias("participants"))).alias("doc"))
    schema = "conversationId string, participants array<struct<participantId: string, sessions: array<struct<sessionId: string, segments: array<struct<segment: bigint, chars: bigint>>>>>>"
    return P.conversation_rows(json.select(F.from_json("doc", schema).alias("conversation"))).drop("session_id")


@query("d49_latest_segment_merge", "SELECT conv_id, role, MAX(turn)::BIGINT AS turn FROM conversations GROUP BY 1, 2")
def _(t):
    c = t.conversations.select("conv_id", "role", "turn")
    early = P.latest_segments(c.filter("turn <= 1"), ["conv_id", "role"], ["turn"])
    late = P.latest_segments(c, ["conv_id", "role"], ["turn"])
    return apply_merge(early, late, ["conv_id", "role"], lambda t_, s: {"turn": s("turn")}, update_when=lambda t_, s: s("turn") > t_("turn"))


@query("d50_case_tags", """WITH f AS (SELECT user_id AS number, event_id // 3 AS case_id, event_type, ts, event_id FROM events), o AS (SELECT number, arg_min(event_id, (ts, event_id)) AS owner, COUNT(DISTINCT case_id)::BIGINT AS case_count FROM f GROUP BY 1)
 SELECT number, ROW_NUMBER() OVER (PARTITION BY number ORDER BY ts, event_id)::BIGINT AS position, event_type AS tag, owner, case_count FROM f JOIN o USING (number)""")
def _(t):
    e = t.events.select(F.col("user_id").alias("number"), F.floor(F.col("event_id") / 3).alias("case_id"), F.col("event_type").alias("tag"), "ts", "event_id", F.col("event_id").alias("owner"))
    return P.case_labels(e, "number", "case_id", "owner", "tag", ["ts", "event_id"])


@query("d50_distinct_tags", """WITH f AS (SELECT user_id, event_type, MIN((ts, event_id)) AS m FROM events GROUP BY 1, 2) SELECT user_id AS number, string_agg(event_type, ', ' ORDER BY m) AS tags, (SELECT COUNT(DISTINCT event_id // 3) FROM events e WHERE e.user_id = f.user_id)::BIGINT AS case_count, (SELECT arg_min(event_id, (ts, event_id)) FROM events e WHERE e.user_id = f.user_id) AS owner FROM f GROUP BY user_id""")
def _(t):
    e = t.events.withColumns({"owner": F.col("event_id"), "number": F.col("user_id"), "case_id": F.floor(F.col("event_id") / 3)})
    return P.case_tags(e, "number", "case_id", "owner", "event_type", ["ts", "event_id"], repeats=False)


@query("d60_realtime_slots", "SELECT time_bucket(INTERVAL 30 MINUTE, ts)::VARCHAR AS slot_start, event_type, COUNT(*)::BIGINT AS n, SUM(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1, 2")
def _(t):
    return slot_totals(t.events.select("ts", "event_type", money("value").alias("v")), "ts", ["event_type"], "v")


@query("d65_usage_cost", """WITH u AS (SELECT event_id, user_id % 7 AS w, (event_id % 50) * 1000 AS b, ts AS s, ts + INTERVAL 1 SECOND * (1 + (value * 60)::BIGINT) AS e FROM events), h AS (SELECT *, unnest(generate_series(date_trunc('hour', s), date_trunc('hour', e), INTERVAL 1 HOUR)) AS h FROM u),
 p AS (SELECT *, (epoch_us(LEAST(e, h + INTERVAL 1 HOUR)) - epoch_us(GREATEST(s, h)))::HUGEINT AS us FROM h), q AS (SELECT *, CAST(b * (us::DOUBLE / 1000000) / ((epoch_us(e) - epoch_us(s))::DOUBLE / 1000000) AS DECIMAL(28,6)) AS by_ FROM p WHERE us > 0), t AS (SELECT w, h, SUM(us) AS total, SUM(by_) AS all_ FROM q GROUP BY 1, 2),
 x AS (SELECT event_id, (us::DOUBLE / total::DOUBLE) * (1 + hour(h) + w) AS c, COALESCE(by_::DOUBLE / NULLIF(all_::DOUBLE, 0), 0) * (w + 0.5::DOUBLE) AS f, (2 + day(s) / 10.0::DOUBLE) AS rate FROM q JOIN t USING (w, h))
 SELECT event_id, ROUND(SUM(CAST(c * rate AS DECIMAL(28,12)))::DOUBLE, 4) AS cost, ROUND(SUM(CAST(c AS DECIMAL(28,12)))::DOUBLE, 4) AS compute_credits, ROUND(SUM(CAST(f * rate AS DECIMAL(28,12)))::DOUBLE, 4) AS acceleration_cost, ROUND(SUM(CAST(f AS DECIMAL(28,12)))::DOUBLE, 4) AS acceleration_credits FROM x GROUP BY 1""")
def _(t):
    end = F.timestamp_add("SECOND", F.round(F.col("value") * 60).cast("int") + 1, F.col("ts"))
    usage = t.events.select("event_id", (F.col("user_id") % 7).alias("warehouse_id"), ((F.col("event_id") % 50) * 1000).alias("scanned_bytes"), F.col("ts").alias("s"), end.alias("e"))
    hours = P.split_by_hour(usage, "s", "e").select("warehouse_id", "hour").distinct()
    credits = hours.select("warehouse_id", "hour", (F.hour("hour") + 1 + F.col("warehouse_id")).alias("credits"), (F.col("warehouse_id") + F.lit(0.5)).alias("acceleration_credits"))
    rates = usage.select(F.to_date("s").alias("day")).distinct().withColumn("rate", F.lit(2) + F.dayofmonth("day") / F.lit(10.0))
    out = P.usage_cost(usage, credits, rates, ["event_id"], "s", "e")
    four = lambda c, name: F.round(F.col(c).cast("double"), 4).alias(name)
    return out.select("event_id", four("cost", "cost"), four("compute_credits", "compute_credits"), four("acceleration_cost", "acceleration_cost"), four("acceleration_credits_used", "acceleration_credits"))

