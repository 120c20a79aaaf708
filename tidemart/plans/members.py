"""Customers over time: cohorts, lifetime value, membership states, billing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.semantics import boundaries, join_keys, latest_by, millis_before, ntz, OPEN_END, ratio, row_count
from tidemart.operators.joins import effective_lookup
from tidemart.operators.scan import KeyPlan, Scan, key_tiles, ordered_scan
from tidemart.session import reused


def month_of(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("month", F.col(c) if isinstance(c, str) else c))


def customer_months(
    activity: DataFrame, customer: str, moment: str, amount: str, dims: Sequence[str] = ()
) -> DataFrame:
    """Activity reduced to one row per customer, month and dimension, with the first and last month of the customer.

    The window runs over the reduced rows, of which a customer has no more than months and dimension values.
    """
    monthly = activity.groupBy(customer, month_of(moment).alias("activity_month"), *dims).agg(
        row_count().alias("orders"), F.sum(amount).alias("revenue")
    )
    whole = W.partitionBy(customer)
    return monthly.select(
        "*",
        F.min("activity_month").over(whole).alias("cohort_month"),
        F.max("activity_month").over(whole).alias("last_month"),
    )


def cohort_waterfall(
    activity: DataFrame, customer: str, moment: str, amount: str, dims: Sequence[str] = ()
) -> DataFrame:
    """Cohort month x activity month: active customers, activations, final months, customers carried in (BOP).

    ``dims`` are attributes of the customer. Carried in are the members of the cohort whose last month is not before
    the activity month.
    """
    by_customer = customer_months(activity, customer, moment, amount, dims)
    cells = by_customer.groupBy("cohort_month", "activity_month", *dims).agg(
        row_count().alias("customers"),
        F.count_if(F.col("activity_month") == F.col("cohort_month")).alias("activations"),
        F.count_if(F.col("activity_month") == F.col("last_month")).alias("final_months"),
        F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
    )
    # The windows run over cells, of which a cohort has one per month.
    cohort = W.partitionBy("cohort_month", *dims)
    left_before = F.sum("final_months").over(cohort.orderBy("activity_month").rowsBetween(W.unboundedPreceding, -1))
    carried = F.sum("final_months").over(cohort) - F.coalesce(left_before, F.lit(0))
    return cells.select(
        "*",
        F.when(F.col("activity_month") == F.col("cohort_month"), F.lit(0)).otherwise(carried).alias("bop"),
        boundaries("month", "cohort_month", "activity_month").alias("month_number"),
    )


def fill_months(monthly: DataFrame, customer: str, month: str, until: Column) -> DataFrame:
    """Gapless months per customer (one row each, so no customer is large) up to ``until``: every row is repeated up to the month before the customer's next
    row, ``_own`` marks the month that really has the row. No scaffold, no join."""
    ahead = ordered_scan(monthly, [customer], [month], [Scan("_next", "lead", month)], plan=KeyPlan())
    last = F.coalesce(F.add_months("_next", -1), F.to_date(F.date_trunc("month", until)))
    months = F.sequence(F.col(month), F.greatest(last, F.col(month)), F.expr("INTERVAL 1 MONTH"))
    rows = ahead.select("*", F.explode(months).alias("_month"))
    return rows.select(
        *[F.col("_month").alias(month) if c == month else F.col(c) for c in monthly.columns],
        (F.col("_month") == F.col(month)).alias("_own"),
    )


def tenure_bucket(months: Column, cap: Column) -> Column:
    """'M1', 'M2', ... from the number of month boundaries; everything from the cap on shares one open bucket."""
    number = months + 1
    return F.when(number >= cap, F.concat(F.lit("M"), cap.cast("string"), F.lit("+"))).otherwise(
        F.concat(F.lit("M"), number.cast("string"))
    )


def lead_waterfall(
    leads: DataFrame, lead_at: str, converted_at: str, segment: str, caps: dict[str, int], default_cap: int = 14
) -> DataFrame:
    """Leads by month, and their conversions by month and tenure bucket; the bucket edge depends on the segment."""
    cap = F.lit(default_cap)
    for name, edge in caps.items():
        cap = F.when(F.col(segment) == name, F.lit(edge)).otherwise(cap)
    registered = leads.groupBy(segment, month_of(lead_at).alias("month")).agg(row_count().alias("people")).select(
        F.lit("lead").alias("population"), segment, "month", F.lit("M0").alias("tenure"), "people"
    )
    bucket = tenure_bucket(boundaries("month", lead_at, converted_at), cap)
    converted = (
        leads.filter(F.col(converted_at).isNotNull())
        .groupBy(segment, month_of(converted_at).alias("month"), bucket.alias("tenure"))
        .agg(row_count().alias("people"))
        .select(F.lit("conversion").alias("population"), segment, "month", "tenure", "people")
    )
    return registered.unionByName(converted)


def event_waterfall(
    orders: DataFrame, events: DataFrame, order: str, order_at: str, order_amount: str, event_at: str, event_amount: str
) -> DataFrame:
    """Refunds or chargebacks by order month and month offset, with the order total of the month.

    Order amounts are summed from the order table, so an order with several events counts once.
    """
    totals = orders.groupBy(month_of(order_at).alias("order_month")).agg(F.sum(order_amount).alias("order_total"))
    hits = events.join(orders.select(order, order_at), order)
    cells = hits.groupBy(
        month_of(order_at).alias("order_month"), boundaries("month", order_at, event_at).alias("month_offset")
    ).agg(F.sum(event_amount).alias("event_total"), F.count_distinct(order).alias("event_orders"))
    return cells.join(totals, "order_month").withColumn("share", ratio("event_total", "order_total"))


def period_counts(intervals: DataFrame, start: str, end: str, dims: Sequence[str] = ()) -> DataFrame:
    """Members at the begin (state just before the day) and end of each day, from membership intervals.

    Intervals become +1/-1 on days and a running sum over the calendar: no row per member and day.
    """
    # A start or end during a day counts from the begin of the next day on.
    closed = F.col(end) < ntz(OPEN_END)
    steps = F.array(
        F.struct(F.date_add(F.to_date(start), 1).alias("day"), F.lit(1).alias("step")),
        F.struct(F.when(closed, F.date_add(F.to_date(end), 1)).alias("day"), F.lit(-1).alias("step")),
    )
    moves = reused(
        intervals.select(*dims, F.explode(steps).alias("_m"))
        .filter("_m.day IS NOT NULL")
        .groupBy(*dims, F.col("_m.day").alias("day"))
        .agg(F.sum("_m.step").alias("step"))
    )
    span = moves.groupBy(*dims).agg(F.date_add(F.min("day"), -1).alias("a"), F.max("day").alias("b"))
    days = span.select(*dims, F.explode(F.sequence("a", "b")).alias("day"))
    filled = join_keys(days, moves, [*dims, "day"], "left").fillna(0, ["step"])
    bop = ordered_scan(filled, list(dims), ["day"], [Scan("bop", "sum", "step")], plan=KeyPlan())
    ends = ordered_scan(bop, list(dims), ["day"], [Scan("_next", "lead", "bop")], plan=KeyPlan())
    return ends.select(*dims, "day", "bop", F.coalesce("_next", "bop").alias("eop"))


def lifetime_monthly(
    activity: DataFrame, customer: str, moment: str, amount: str, until: Column, tiles: int = 10
) -> DataFrame:
    """Customer x month from the first month on: measures, cumulative totals, value tile within the month."""
    monthly = activity.groupBy(customer, month_of(moment).alias("month")).agg(
        row_count().alias("orders"), F.sum(amount).alias("margin")
    )
    summed = ordered_scan(
        monthly,
        [customer],
        ["month"],
        [Scan("orders_to_date", "sum", "orders"), Scan("margin_to_date", "sum", "margin")],
        plan=KeyPlan(),
    )
    filled = fill_months(summed, customer, "month", until)
    own = lambda c: F.when(F.col("_own"), F.col(c)).otherwise(F.lit(0)).alias(c)
    grid = filled.select(customer, "month", own("orders"), own("margin"), "orders_to_date", "margin_to_date")
    return key_tiles(grid, ["month"], ["margin_to_date", customer], tiles, "value_tile")


def lifetime_to_date(
    activity: DataFrame, customer: str, moment: str, amount: str, spend: DataFrame, dims: Sequence[str] = ()
) -> DataFrame:
    """Value to date per cohort with the media spend of the cohort month per acquired customer."""
    per_customer = activity.groupBy(customer, *dims).agg(
        month_of(F.min(moment)).alias("cohort_month"), F.sum(amount).alias("value")
    )
    cohort = per_customer.groupBy("cohort_month", *dims).agg(row_count().alias("customers"), F.sum("value").alias("value"))
    return join_keys(cohort, spend, ["cohort_month", *dims], "left").select(
        "cohort_month",
        *dims,
        "customers",
        "value",
        F.coalesce("spend", F.lit(0)).alias("spend"),
        ratio("value", "customers").alias("value_per_customer"),
        ratio(F.coalesce("spend", F.lit(0)), "customers").alias("spend_per_customer"),
    )


def lifetime_by_channel(
    activity: DataFrame, customer: str, moment: str, amount: str, channels: DataFrame, channel: str
) -> DataFrame:
    """Value by acquisition channel, cohort month and months since acquisition."""
    monthly = customer_months(activity, customer, moment, amount)
    return (
        monthly.join(channels, customer, "left")
        .withColumn("tenure", boundaries("month", "cohort_month", "activity_month"))
        .groupBy(F.coalesce(channel, F.lit("unknown")).alias(channel), "cohort_month", "tenure")
        .agg(F.count_distinct(customer).alias("customers"), F.sum("revenue").alias("revenue"))
    )


def membership_timeline(events: DataFrame, customer: str, moment: str, kind: str, tie: Sequence[str]) -> DataFrame:
    """Membership events as states with ranges: one event per (customer, start), ended 1 ms before the next."""
    one = latest_by(events, [customer, moment], list(tie))
    scanned = ordered_scan(one, [customer], [moment], [Scan("_next", "lead", moment)])
    return scanned.select(
        customer,
        F.col(kind).alias("state"),
        F.col(moment).alias("start_at"),
        F.coalesce(millis_before(F.col("_next")), ntz(OPEN_END)).alias("end_at"),
        F.col("_next").isNull().alias("is_current"),
    )


def state_at_event(
    events: DataFrame, timeline: DataFrame, customer: str, moment: str, paying: str, prospect: str = "Prospect"
) -> DataFrame:
    """State a customer is in at each event, with tenure: days since the state began, months when it is paying."""
    ranges = timeline.select(customer, "state", "start_at", (F.col("end_at")).alias("end_at"))
    hit = effective_lookup(events, ranges, [customer], moment, "start_at", "end_at", ["state", "start_at"], strategy="scan")
    return hit.select(
        *events.columns,
        F.coalesce("state", F.lit(prospect)).alias("membership_state"),
        F.coalesce(boundaries("day", "start_at", moment), F.lit(0)).alias("tenure_days"),
        F.when(F.col("state") == paying, boundaries("month", "start_at", moment) + 1).otherwise(F.lit(0)).alias("tenure_months"),
    )


def action_periods(
    actions: DataFrame, customer: str, moment: str, kind: str, kinds: Sequence[str], until: Column, filler: str = "No Action"
) -> DataFrame:
    """Customer x month with one flag per kind of action; months without any carry the filler flag."""
    names = {k: k.lower().replace(" ", "_") for k in kinds}
    done = actions.groupBy(customer, month_of(moment).alias("month")).agg(
        *[F.max((F.col(kind) == k).cast("int")).alias(n) for k, n in names.items()], row_count().alias("actions")
    )
    filled = fill_months(done, customer, "month", until)
    own = lambda c: F.when(F.col("_own"), F.col(c)).otherwise(F.lit(0)).alias(c)
    idle = (~F.col("_own")).cast("int").alias(filler.lower().replace(" ", "_"))
    return filled.select(customer, "month", *[own(n) for n in names.values()], idle, own("actions"))


def billing_cycle_rates(
    members: DataFrame,
    actions: DataFrame,
    customer: str,
    moment: str,
    kind: str,
    priority: Sequence[str],
    days: int,
    blocking: Sequence[str],
    early_blocking: Sequence[str],
    early: Column,
    dims: Sequence[str] = (),
) -> DataFrame:
    """Behaviour of the members of a month up to each of the first days of the cycle.

    Per kind: members who did it (``_unique``), and members whose decisive behaviour it is (``_only``: the first kind of
    the priority list wins, so these are disjoint). Eligible to be billed are members without a blocking kind; where
    ``early`` holds (by segment and month) the list is ``early_blocking``. ``members``: customer, month, dims, one row each.
    """
    # The first day of each kind decides all later days, so one row per member and month is enough.
    firsts = actions.filter(F.col(kind).isin(list(priority))).groupBy(customer, month_of(moment).alias("month")).agg(
        *[F.min(F.when(F.col(kind) == k, F.dayofmonth(moment))).alias(f"_{k}") for k in priority]
    )
    grid = members.join(firsts, [customer, "month"], "left").withColumn(
        "day", F.explode(F.sequence(F.lit(1), F.lit(days)))
    )
    did = {k: F.coalesce(F.col(f"_{k}") <= F.col("day"), F.lit(False)) for k in priority}
    some = lambda kinds: reduce(lambda a, b: a | b, [did[k] for k in kinds], F.lit(False))
    only = {k: did[k] & ~some(priority[:i]) for i, k in enumerate(priority)}
    eligible = F.when(early, ~some(early_blocking)).otherwise(~some(blocking))
    return grid.groupBy("month", "day", *dims).agg(
        row_count().alias("members"),
        *[F.count_if(did[k]).alias(f"{k}_unique") for k in priority],
        *[F.count_if(only[k]).alias(f"{k}_only") for k in priority],
        F.count_if(~some(priority)).alias("none"),
        F.count_if(eligible).alias("eligible"),
    )


def billing_estimate(
    attempts: DataFrame, store: str, moment: str, ok: str, retry: str, amount: str, as_of: Column, window_days: int = 5,
    budget: DataFrame | None = None,
) -> DataFrame:
    """Estimate of a day's billing per store: attempts, successes and amount of the day, and the rates of the days before it.

    First-time successes count against all attempts, retry successes against retries, each over ``window_days``; a rate without a
    success or without an attempt is unknown. ``budget`` (store, budget, forecast) is set beside the amount.
    """
    day = F.to_date(as_of)
    marked = attempts.withColumn("_d", F.to_date(moment)).filter(
        (F.col("_d") <= day) & (F.col("_d") >= F.date_sub(day, window_days))
    )
    today, good, again = F.col("_d") == day, F.col(ok), F.col(retry)
    totals = marked.groupBy(store).agg(
        F.count_if(today).alias("attempted"),
        F.count_if(today & good).alias("succeeded"),
        F.count_if(today & good & again).alias("retry_successes"),
        F.coalesce(F.sum(F.when(today & good, F.col(amount))), F.lit(0)).alias("billed"),
        F.count_if(~today).alias("_all"),
        F.count_if(~today & good & ~again).alias("_first"),
        F.count_if(~today & again).alias("_retries"),
        F.count_if(~today & good & again).alias("_retried"),
    )
    rate = lambda n, d: ratio(F.nullif(F.col(n), F.lit(0)), d)
    out = totals.select(
        day.alias("estimate_day"), store, "attempted", "succeeded", "retry_successes", "billed",
        rate("_first", "_all").alias("first_time_success_rate"), rate("_retried", "_retries").alias("retry_success_rate"),
        F.round(F.col("attempted") * (rate("_first", "_all") + rate("_retried", "_all")), 4).alias("expected_successes"),
    )
    if budget is None:
        return out
    return join_keys(out, budget.select(store, "budget", "forecast"), [store], "left").withColumns(
        {"to_budget": ratio("billed", "budget"), "to_forecast": ratio("billed", "forecast")}
    )


def append_estimate(estimates: DataFrame | None, new: DataFrame, run_ts: Column) -> DataFrame:
    """Estimates are kept: each run adds its rows with the moment it was made."""
    stamped = new.withColumn("estimate_created", run_ts)
    return stamped if estimates is None else estimates.unionByName(stamped)

