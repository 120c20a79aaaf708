"""Lead times, shipment milestones, intervals and conversations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import boundaries, join_keys, latest_by
from tidemart.operators.scan import Scan, ordered_scan


def business_days(start: Column, end: Column) -> Column:
    """Weekdays after the start day up to and including the end day, in closed form; negative when reversed.

    Counts weekdays since a fixed Monday on both sides: five per full week plus the days of the open week.
    """

    def weekdays_until(d: Column) -> Column:
        days = F.datediff(d, F.lit("1900-01-01").cast("date"))  # a Monday
        return F.floor(days / F.lit(7)) * 5 + F.least(F.pmod(days, F.lit(7)) + 1, F.lit(5))

    return (weekdays_until(end) - weekdays_until(start)).cast("long")


def calendar_days(start: Column, end: Column) -> Column:
    return boundaries("day", start, end)


def milestone_pivot(
    scans: DataFrame, key: Sequence[str], status: str, moment: str, statuses: Sequence[str]
) -> DataFrame:
    """First scan of every status as a column, one row per shipment."""
    return scans.groupBy(*key).pivot(status, list(statuses)).agg(F.min(moment))


def milestone_low(tables: Sequence[tuple[DataFrame, str]], look_back_days: int) -> list[DataFrame]:
    """Newest moment of each feed; the increment starts a few days before the oldest of them."""
    return [df.agg(F.timestamp_add("DAY", F.lit(-look_back_days), F.max(c)).alias("low")) for df, c in tables]


def lead_times(df: DataFrame, legs: dict[str, tuple[str, str]]) -> DataFrame:
    """Calendar and business days of each leg between two milestones; NULL while one is missing or they are reversed."""
    out = []
    for name, (a, b) in legs.items():
        start, end = F.to_date(a), F.to_date(b)
        forward = end >= start
        out += [
            F.when(forward, calendar_days(start, end)).alias(f"{name}_days"),
            F.when(forward, business_days(start, end)).alias(f"{name}_work_days"),
        ]
    return df.select("*", *out)


def split_by_hour(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per clock hour an interval touches, with the seconds spent in it."""
    hours = F.sequence(F.date_trunc("hour", start), F.date_trunc("hour", end), F.expr("INTERVAL 1 HOUR"))
    rows = df.select("*", F.explode(hours).alias("hour"))
    upto = F.least(F.col(end).cast("timestamp"), F.col("hour").cast("timestamp") + F.expr("INTERVAL 1 HOUR"))
    since = F.greatest(F.col(start).cast("timestamp"), F.col("hour").cast("timestamp"))
    seconds = (F.unix_micros(upto) - F.unix_micros(since)) / F.lit(1_000_000)
    return rows.withColumn("seconds", seconds).filter("seconds > 0")


def usage_cost(
    usage: DataFrame, credits: DataFrame, rates: DataFrame, keys: Sequence[str], start: str, end: str,
    warehouse: str = "warehouse_id", scanned: str = "scanned_bytes",
) -> DataFrame:
    """Cost and credits of each usage interval, hour by hour of its warehouse.

    Compute credits of an hour are shared by the seconds in it, acceleration credits by the bytes the interval had scanned per
    hour of its time; both are priced at the rate of the day the interval began.
    """
    parts = split_by_hour(usage.withColumn("day", F.to_date(start)), start, end)
    length = (F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))) / F.lit(1_000_000)
    parts = parts.withColumn("bytes", (F.col(scanned) * F.col("seconds") / length).cast("decimal(28,6)"))
    exact = F.col("seconds").cast("decimal(24,6)")
    per_hour = parts.groupBy(warehouse, "hour").agg(F.sum(exact).alias("hour_seconds"), F.sum("bytes").alias("hour_bytes"))
    compute = F.col("seconds") / F.col("hour_seconds").cast("double") * F.col("credits")
    fast = F.coalesce(F.col("bytes").cast("double") / F.nullif(F.col("hour_bytes").cast("double"), F.lit(0.0)), F.lit(0.0)) * F.col("acceleration_credits")
    total = lambda c, name: F.sum(c.cast("decimal(28,12)")).alias(name)
    met = join_keys(join_keys(parts, per_hour, [warehouse, "hour"]), credits, [warehouse, "hour"]).join(rates, "day")
    return met.groupBy(*keys).agg(
        total(compute * F.col("rate"), "cost"), total(compute, "compute_credits"), total(fast * F.col("rate"), "acceleration_cost"), total(fast, "acceleration_credits_used")
    )


def conversation_rows(df: DataFrame, conversation: str = "conversation") -> DataFrame:
    """Conversation documents as one row per segment: participants, their sessions, their segments."""
    c = F.col(conversation)
    participants = df.select(c["conversationId"].alias("conversation_id"), F.explode_outer(c["participants"]).alias("p"))
    sessions = participants.select(
        "conversation_id", F.col("p.participantId").alias("participant_id"), F.explode_outer("p.sessions").alias("s")
    )
    segments = sessions.select(
        "conversation_id", "participant_id", F.col("s.sessionId").alias("session_id"), F.explode_outer("s.segments").alias("g")
    )
    return segments.select("conversation_id", "participant_id", "session_id", "g.*")


def latest_segments(segments: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_by(segments, keys, order)


def case_tags(
    events: DataFrame, number: str, case: str, customer: str, label: str, order: Sequence[str], repeats: bool = True
) -> DataFrame:
    """Labels of a case number in time order as one text, how many cases share the number, and the customer of the first event.

    A label stands at every moment it was set; the text of a number is as long as its own history. ``repeats=False`` keeps a label's
    first place only, which bounds the text by the label vocabulary.
    """
    moment = F.struct(*order)
    if repeats:
        placed = events.select(number, label, moment.alias("m")).distinct()
    else:
        placed = events.groupBy(number, label).agg(F.min(moment).alias("m"))
    listed = F.array_sort(F.collect_list(F.struct("m", label)))
    tags = placed.groupBy(number).agg(F.array_join(F.transform(listed, lambda x: x[label]), ", ").alias("tags"))
    owner = events.groupBy(number).agg(F.min_by(customer, moment).alias(customer), F.count_distinct(case).alias("case_count"))
    return join_keys(tags, owner, [number])


def case_labels(events: DataFrame, number: str, case: str, customer: str, label: str, order: Sequence[str], **limits: int) -> DataFrame:
    """The labels of a case number in time order as rows (number, position, label), with how many cases share the number and the customer of its first event.

    A label stands at every moment it was set, once a moment. A number with a long history is many rows, numbered in slices, and never one list.
    """
    moment = F.struct(*order)
    placed = events.select(number, label, *order).distinct()
    ranked = ordered_scan(placed, [number], [*order, label], [Scan("position", "number")], **limits)
    owner = events.groupBy(number).agg(F.min_by(customer, moment).alias(customer), F.count_distinct(case).alias("case_count"))
    return join_keys(ranked.select(number, "position", label), owner, [number])
