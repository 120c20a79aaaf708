"""Keyed state along a stream: each event once, and a timeline of periods with timers.

Events may come late, twice and out of order, as long as they are within ``delay`` of the stream's clock; later ones are dropped. Copies of an
event are dropped by its id within that time. A member's events wait until the clock has passed them, so they are taken in the order
of their moments; each closes the period before it. A member that stays silent lapses after ``lapse_days``: a timer closes the period
then, without a further event. The state of a member is its waiting events and the open period. Members share a fixed number of
buckets, whose states are called for one by one: a call costs milliseconds whatever it holds, so there is not one for each member.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemart.operators.scan import Scan, ordered_scan

LAPSED = "lapsed"
DAY = 86_400_000_000
STATE = "waiting array<struct<at: bigint, id: string, member: string, status: string>>, opened array<struct<member: string, since: bigint, status: string>>"
BUCKETS = 4096


def timeline(stream: DataFrame, member: str, at: str, status: str, event: str, delay: str, lapse_days: int, buckets: int = BUCKETS) -> DataFrame:
    """member, status, start_at, end_at of all closed periods of a stream; at is a timestamp, the member a text or number.

    A null member carries the clock only (a heartbeat) and has no periods; an event without a moment has none either. ``buckets`` stays the
    same as long as a checkpoint is used.
    """
    once = stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([event])
    kind = stream.schema[member].dataType.simpleString()
    # A member is a text in the state: numbers beside NULLs would become floats in pandas.
    given = once.select(
        F.when(F.col(member).isNotNull() & F.col(at).isNotNull(), F.pmod(F.xxhash64(member), F.lit(buckets))).alias("bucket"), F.col(member).cast("string").alias("member"),
        at, F.unix_micros(at).alias("micros"), F.col(event).cast("string").alias("event"), F.col(status).alias("status"),
    )
    limit = lapse_days * DAY

    def follow(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if pd.isna(key[0]):
            return
        waiting, held = state.get if state.exists else ([], [])
        waiting = [tuple(w) for w in waiting]
        opened = {m: (since, now) for m, since, now in held}
        if not state.hasTimedOut:
            for pdf in frames:
                waiting += zip(pdf["micros"].tolist(), pdf["event"].tolist(), pdf["member"].tolist(), pdf["status"].tolist(), strict=True)
        clock = state.getCurrentWatermarkMs() * 1000
        waiting.sort()
        out = []

        def close(who: str, end: int) -> None:
            """The open period of a member up to ``end``, with the lapse in between."""
            since, now = opened.pop(who, (end, None))
            if now is not None and now != LAPSED and since + limit < end:
                out.append((who, now, since, since + limit))
                since, now = since + limit, LAPSED
            if now is not None and end > since:
                out.append((who, now, since, end))

        due = bisect_left(waiting, clock, key=itemgetter(0))
        for moment, _, who, name in waiting[:due]:
            close(who, moment)
            if name is not None:
                opened[who] = (moment, name)
        for who, (since, now) in opened.items():
            if now != LAPSED and since + limit < clock:
                out.append((who, now, since, since + limit))
                opened[who] = (since + limit, LAPSED)
        waiting = waiting[due:]
        state.update((waiting, [(who, *period) for who, period in opened.items()]))
        timers = [since + limit for since, now in opened.values() if now != LAPSED] + [w[0] for w in waiting[:1]]
        if timers:
            state.setTimeoutTimestamp(max(min(timers) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=["member", "status", "a", "b"])

    periods = given.groupBy("bucket").applyInPandasWithState(
        follow, "member string, status string, a bigint, b bigint", STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    moment = lambda c: F.timestamp_micros(c)
    return periods.select(F.col("member").cast(kind).alias(member), "status", moment("a").alias("start_at"), moment("b").alias("end_at"))


def run_timeline(periods: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append closed periods; goes on from its checkpoint, with the state of all members."""
    writer = periods.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def batch_timeline(events: DataFrame, member: str, at: str, status: str, event: str, until: Column, lapse_days: int) -> DataFrame:
    """The same periods of a whole table, as far as a clock at ``until`` has closed them."""
    once = events.groupBy(event).agg(F.min_by(F.struct(member, at, status), at).alias("e")).select(F.col(event).cast("string").alias("_id"), "e.*")
    known = once.filter(F.col(member).isNotNull() & (F.col(at) < until))
    led = ordered_scan(known, [member], [at, "_id"], [Scan("_next", "lead", at)])
    lapse = F.timestamp_add("DAY", F.lit(lapse_days), F.col(at))
    end = F.coalesce("_next", until)
    own = F.struct(F.col(status).alias("status"), F.col(at).alias("start_at"), F.when((lapse < end) | F.col("_next").isNotNull(), F.least(lapse, end)).alias("end_at"))
    gone = F.struct(F.lit(LAPSED).alias("status"), lapse.alias("start_at"), F.when(F.col("_next") > lapse, F.col("_next")).alias("end_at"))
    both = led.select(member, F.explode(F.array(own, gone)).alias("p")).select(member, "p.*")
    return both.filter(F.col("end_at").isNotNull() & (F.col("end_at") > F.col("start_at")))
