"""Sessions, channels, clicks, media spend and influencer scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.semantics import boundaries, join_keys, latest_by, ratio
from tidemart.operators.reshape import exact_percentile, first_match
from tidemart.operators.scan import KeyPlan, Scan, dense_ranks, key_plan, ordered_scan
from tidemart.session import dealt, packed


def fill_known(df: DataFrame, key: str, order: Sequence[str], source: str, out: str) -> DataFrame:
    """Last non-NULL value per key; rows without a key get none and never meet in one group."""
    known = ordered_scan(df.filter(F.col(key).isNotNull()), [key], order, [Scan(out, "fill", source)])
    blank = df.filter(F.col(key).isNull()).withColumn(out, F.lit(None).cast(dict(df.dtypes)[source]))
    return known.unionByName(blank)


def last_channel(
    sessions: DataFrame, customer: str, visitor: str, order: Sequence[str], channel: str, direct: Sequence[str], out: str
) -> DataFrame:
    """Channel of the session, or for a direct one the last other channel of the customer, else of the visitor."""
    named = sessions.withColumn("_c", F.when(~F.col(channel).isin(list(direct)), F.col(channel)))
    by_customer = fill_known(named, customer, order, "_c", "_of_customer")
    by_visitor = fill_known(by_customer, visitor, order, "_c", "_of_visitor")
    return by_visitor.select(
        *sessions.columns, F.coalesce("_c", "_of_customer", "_of_visitor", F.col(channel)).alias(out)
    )


def channel_of(df: DataFrame, rules: Sequence[tuple[Column, str]], default: str = "unclassified>unclassified") -> DataFrame:
    """First matching rule gives 'channel>subchannel>vendor'; missing parts repeat as 'none'."""
    labelled = first_match(df, rules, "_path", default)
    part = lambda i: F.coalesce(F.nullif(F.split_part("_path", F.lit(">"), F.lit(i)), F.lit("")), F.lit("none"))
    return labelled.select(*df.columns, part(1).alias("channel"), part(2).alias("subchannel"), part(3).alias("vendor"))


# Name patterns of automated clients, first match decides.
BOT_RULES = (
    ("%googlebot%", "search engine"), ("%bingbot%", "search engine"), ("%crawler%", "crawler"), ("%spider%", "crawler"),
    ("%headless%", "headless browser"), ("%phantomjs%", "headless browser"), ("%curl%", "script"), ("%python%", "script"),
)


def bot_class(df: DataFrame, agent: str, rules: Sequence[tuple[str, str]] = BOT_RULES, out: str = "bot_class") -> DataFrame:
    return first_match(df, [(F.col(agent).ilike(p), label) for p, label in rules], out, "human")


def neighbours(sessions: DataFrame, key: str, order: Sequence[str], moment: str, ident: str, prefix: str) -> DataFrame:
    """Moment and id of the previous and next session of a customer or visitor; none where the key is NULL."""
    scans = [
        Scan(f"previous_{prefix}_id", "lag", ident),
        Scan(f"previous_{prefix}_at", "lag", moment),
        Scan(f"next_{prefix}_id", "lead", ident),
        Scan(f"next_{prefix}_at", "lead", moment),
    ]
    known = ordered_scan(sessions.filter(F.col(key).isNotNull()), [key], order, scans)
    return known.unionByName(sessions.filter(F.col(key).isNull()), allowMissingColumns=True)


def click_attribution(
    sessions: DataFrame,
    leads: DataFrame,
    conversions: DataFrame,
    dims: Sequence[str],
    shift_days: int,
    within_days: int = 7,
) -> DataFrame:
    """Sessions, leads, conversions within days of the lead (on the lead's day) and same-session conversions per day.

    sessions: session_id, at, dims; leads and conversions: customer, session_id, at (one row per customer). The
    measures are stacked and summed once, so no chain of joins on a key scaffold is needed. ``previous_`` columns hold
    the same day shifted (a year, a week).
    """
    measures = ("sessions", "leads", "conversions_from_leads", "same_session_conversions")

    def counted(day: Column, name: str) -> Column:
        return F.struct(F.to_date(day).alias("day"), *[F.lit(1 if m == name else 0).cast("long").alias(m) for m in measures])

    unique = sessions.select("session_id", "at", *dims).dropDuplicates(["session_id"])
    # A lead meets its customer's conversion and its own session once; a conversion in the lead's session has that session's dimensions.
    won = conversions.select("customer", F.col("session_id").alias("c_session"), F.col("at").alias("c_at"))
    lead_rows = leads.select("customer", "session_id", "at").join(won, "customer", "left").join(unique.select("session_id", *dims), "session_id")
    delay = boundaries("day", "at", "c_at")
    hits = F.array_compact(F.array(
        counted(F.col("at"), "leads"),
        F.when((delay >= 0) & (delay < within_days), counted(F.col("at"), "conversions_from_leads")),
        F.when(F.col("c_session") == F.col("session_id"), counted(F.col("c_at"), "same_session_conversions")),
    ))
    rows = lead_rows.select(*dims, F.explode(hits).alias("_m")).unionByName(unique.select(*dims, counted(F.col("at"), "sessions").alias("_m")))
    current = rows.select(*dims, "_m.*")
    daily = current.groupBy("day", *dims).agg(*[F.sum(m).alias(m) for m in measures])
    # Each day counts for itself and, shifted, as the earlier day of a later one.
    twice = daily.withColumn("_shift", F.explode(F.array(F.lit(0), F.lit(shift_days))))
    here = F.col("_shift") == 0
    return twice.groupBy(F.date_add("day", F.col("_shift")).alias("day"), *dims).agg(
        *[F.sum(F.when(here, F.col(m)).otherwise(0)).alias(m) for m in measures],
        *[F.sum(F.when(~here, F.col(m)).otherwise(0)).alias(f"previous_{m}") for m in measures],
    )


def rolling_cohorts(monthly: DataFrame, dims: Sequence[str], month: str, leads: str, months: int = 12) -> DataFrame:
    """Leads of the month (m1) and of the months before it (m2 ... m12), 0 where there is none.

    The input is one row per dimension and month, so a group is bounded by the calendar.
    """
    w = W.partitionBy(*dims).orderBy(month)
    return monthly.select(
        *dims,
        month,
        F.col(leads).alias("m1"),
        *[F.coalesce(F.lag(leads, k).over(w), F.lit(0)).alias(f"m{k + 1}") for k in range(1, months)],
    )


def cost_per_lead(spend: DataFrame, leads: DataFrame, on: Sequence[str]) -> DataFrame:
    """Spend and leads side by side with the guarded cost per lead."""
    return spend.join(leads, list(on), "full").fillna(0, ["spend", "leads"]).withColumn("cac", ratio("spend", "leads"))


def scaled_targets(daily: DataFrame, dims: Sequence[str], day: str, spend: str, conversions: str, target: str, rows: int = 11) -> DataFrame:
    """Moving average of the cost per conversion over ``rows`` rows, its ratio to the target, and the scaled target."""
    costed = daily.withColumn("cac", ratio(spend, conversions))
    w = W.partitionBy(*dims).orderBy(day).rowsBetween(-(rows - 1), 0)
    moving = costed.withColumn("moving_cac", F.avg("cac").over(w))
    return moving.withColumn("scaling", ratio(target, "moving_cac")).withColumn(
        "adjusted_target", F.col(target).cast("double") * F.col("scaling")
    )


def late_syncs(syncs: DataFrame, account: str, synced: str, as_of: Column, sla_hours: int) -> DataFrame:
    """Accounts whose last sync is older than the agreed hours."""
    last = syncs.groupBy(account).agg(F.max(synced).alias("last_sync"))
    return last.filter(F.timestamp_add("HOUR", F.lit(sla_hours), F.col("last_sync")) < as_of)


def missing_today(spend: DataFrame, account: str, day: str, amount: str, as_of: Column) -> DataFrame:
    """Accounts with spend yesterday but none today."""
    flags = spend.groupBy(account).agg(
        F.coalesce(F.sum(F.when(F.col(day) == F.date_sub(as_of, 1), F.col(amount))), F.lit(0)).alias("yesterday"),
        F.coalesce(F.sum(F.when(F.col(day) == as_of, F.col(amount))), F.lit(0)).alias("today"),
    )
    return flags.filter((F.col("yesterday") > 0) & (F.col("today") == 0))


def target_scaffold(combinations: DataFrame, months: tuple[Column, Column], targets: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every valid segment combination in every month, with its target or 0."""
    span = F.sequence(months[0], months[1], F.expr("INTERVAL 1 MONTH"))
    grid = combinations.distinct().select("*", F.explode(span).alias("month"))
    return targets.join(grid, [*on, "month"], "right").fillna(0, ["target"])


MICROS = 1_000_000


def platform_spend(
    raw: DataFrame,
    metadata: DataFrame,
    rates: DataFrame,
    fees: Sequence[tuple[str, str, str, float]],
    counts: Sequence[str] = ("impressions", "clicks"),
    ad: str = "ad_id",
    day: str = "day",
) -> DataFrame:
    """Spend of an ad platform, one row per ad and day in one shape for all platforms.

    raw: ad, account_id, day, currency, spend_micros and the ``counts``; rates: currency, usd_rate, local_rate (1 where unknown).
    Vendor fees are ``(account pattern, from day, to day, percent)``, first match decides. Running sums per ad: spend in account
    currency and USD, each with and without fees, and the counts.
    """
    units = (F.coalesce("spend_micros", F.lit(0)) / F.lit(MICROS)).cast("decimal(18,4)")
    # Ads that fit a task are dealt once, for the sums of a day, the running sums and the names.
    plan = key_plan(raw, [ad])
    known = (raw if plan.keys else dealt(raw, ad)).join(rates, ["currency"], "left")
    in_rate = lambda r: F.sum((units * F.coalesce(r, F.lit(1))).cast("decimal(18,4)"))
    priced = known.groupBy(ad, "account_id", day).agg(
        F.sum(units).alias("spend_account"), in_rate("usd_rate").alias("spend_usd"), in_rate("local_rate").alias("spend_local"),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in counts],
    )
    rate = lambda v: F.lit(str(v)).cast("decimal(6,4)")
    percent = rate(0)
    for pattern, low, high, value in reversed(list(fees)):
        hit = F.col("account_id").ilike(pattern) & F.col(day).between(F.lit(low).cast("date"), F.lit(high).cast("date"))
        percent = F.when(hit, rate(value)).otherwise(percent)
    with_fee = lambda c: (F.col(c) + F.round(F.col(c) * percent, 4)).cast("decimal(28,4)")
    priced = priced.withColumns({"vendor_fee_usd": F.round(F.col("spend_usd") * percent, 4), "account_with_fees": with_fee("spend_account"), "usd_with_fees": with_fee("spend_usd")})
    summed = ["spend_account", "spend_usd", "account_with_fees", "usd_with_fees", *counts]
    names = latest_by(metadata, [ad], ["updated_at"]).drop("updated_at")
    if not plan.keys:
        # An ad of several accounts has several rows a day; all of them count for the day.
        upto = W.partitionBy(ad).orderBy(day).rangeBetween(W.unboundedPreceding, W.currentRow)
        return priced.select("*", *[F.sum(c).over(upto).alias(f"{c}_to_date") for c in summed]).join(names, ad, "left")
    priced = packed(priced)
    daily = priced.groupBy(ad, day).agg(*[F.sum(c).alias(c) for c in summed])
    running = ordered_scan(daily, [ad], [day], [Scan(f"{c}_to_date", "sum", c) for c in summed], plan=plan).drop(*summed)
    return join_keys(priced, running, [ad, day]).join(names, ad, "left")


def split_by_share(df: DataFrame, shares: DataFrame, on: Sequence[str], share: str, cost: str, counts: Sequence[str]) -> DataFrame:
    """Cost and counts split in two by a daily share (1 where unknown); the second side is the exact remainder."""
    s = F.coalesce(F.col(share), F.lit(1)).cast("decimal(18,9)")
    joined = df.join(shares, list(on), "left")
    first_cost = F.round(F.col(cost) * s, 4).cast("decimal(18,4)")
    parts = [first_cost.alias(f"{cost}_first"), (F.col(cost) - first_cost).alias(f"{cost}_second")]
    for c in counts:
        first = F.round(F.col(c) * s).cast("long")
        parts += [first.alias(f"{c}_first"), (F.col(c) - first).alias(f"{c}_second")]
    return joined.select(*df.columns, s.alias(share), *parts)


def cost_share(df: DataFrame, group: Sequence[str], cost: str, out: str) -> DataFrame:
    """Cost of a line as a share of its group."""
    totals = df.groupBy(*group).agg(F.sum(cost).alias("_total"))
    return join_keys(df, totals, group).withColumn(out, ratio(cost, "_total")).drop("_total")


def repaired_increments(posts: DataFrame, post: str, day: str, metric: str) -> DataFrame:
    """Daily increments of a cumulative metric on a gapless calendar per post, spurious zeros carried over."""
    daily = posts.groupBy(post, day).agg(F.max(metric).alias("raw"))
    span = daily.groupBy(post).agg(F.min(day).alias("a"), F.max(day).alias("b"))
    days = span.select(post, F.explode(F.sequence("a", "b")).alias(day))
    grid = join_keys(days, daily, [post, day], "left").withColumn("_v", F.nullif("raw", F.lit(0)))
    plan = KeyPlan()  # a post has one row per calendar day
    filled = ordered_scan(grid, [post], [day], [Scan("_last", "fill", "_v")], plan=plan)
    level = filled.withColumn("cumulative", F.coalesce("_last", F.lit(0)))
    lagged = ordered_scan(level, [post], [day], [Scan("_before", "lag", "cumulative")], plan=plan)
    return lagged.select(
        post, day, F.coalesce("raw", F.lit(0)).alias("raw"), "cumulative",
        (F.col("cumulative") - F.coalesce("_before", F.lit(0))).alias("increment"),
    )


def impact_weights(periods: DataFrame, group: Sequence[str], metrics: Sequence[str], sigmas: int = 3) -> DataFrame:
    """Mean of each metric per group after values above mean + 3 sigma were replaced by the median."""
    values = periods.select(*group, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(list(group), list(metrics), "_metric", "_value")
    by = [*group, "_metric"]
    upper = values.groupBy(*by).agg((F.avg("_value") + sigmas * F.stddev("_value")).alias("_upper"))
    medians = exact_percentile(values, by, "_value", 0.5, "_median")
    joined = join_keys(join_keys(values, upper, by), medians, by, "left")
    tamed = F.when(F.col("_value") > F.col("_upper"), F.col("_median")).otherwise(F.col("_value"))
    return joined.groupBy(*group).pivot("_metric", list(metrics)).agg(F.avg(tamed))



def calibrated(rates: DataFrame, rate: str, sigmas: int = 3, around_mean: bool = False) -> DataFrame:
    """Rows whose rate lies within sigma bounds.

    The bounds lie around 0 by default, as the source has it; ``around_mean`` gives the usual reading.
    """
    centre = F.avg(rate) if around_mean else F.lit(0.0)
    bounds = rates.agg(F.struct((centre - sigmas * F.stddev(rate)).alias("low"), (centre + sigmas * F.stddev(rate)).alias("high")))
    b = bounds.scalar()
    return rates.filter((F.col(rate) > b["low"]) & (F.col(rate) < b["high"]))


def decayed_score(engagement: str, hours: str, exponent: float) -> Column:
    return F.col(engagement).cast("double") / (1 + F.pow(F.col(hours).cast("double"), F.lit(exponent)))


def tiered_ranking(
    tiers: Sequence[tuple[int, DataFrame]], member: str, engagement: str, hours: str, exponent: float,
    incumbents: DataFrame | None = None, places: int | None = None,
    collaborators: DataFrame | None = None, activity: DataFrame | None = None, most_collaborators: int | None = None,
    left_out: dict[int, DataFrame] | None = None,
) -> DataFrame:
    """Members ranked tier by tier on engagement decayed by age; a member counts in its first tier only.

    ``collaborators`` come first (tier -1), at most so many of them, scored on their ``activity`` or, without any, on engagement 100
    and 1000 hours. ``incumbents`` (member, ranking_score) keep their place (tier 1) unless they are collaborators. ``left_out``
    names members that a tier does not take, such as those calibrated lately. ``places`` is the size of the report.
    """
    parts = []
    score = decayed_score("engagement", "hours", exponent)
    if collaborators is not None:
        known = activity.groupBy(member).agg(F.max(engagement).alias("engagement"), F.min(hours).alias("hours"))
        cast = {n: dict(known.dtypes)[n] for n in ("engagement", "hours")}
        filled = collaborators.select(member).distinct().join(known, member, "left").withColumns(
            {"engagement": F.coalesce("engagement", F.lit(100).cast(cast["engagement"])), "hours": F.coalesce("hours", F.lit(1000).cast(cast["hours"]))}
        )
        first = filled.select(member, score.alias("ranking_score"), F.lit(-1).alias("tier"))
        if most_collaborators:
            first = first.orderBy(F.col("ranking_score").desc(), member).limit(most_collaborators)
        parts.append(first)
    for tier, df in tiers:
        if left_out and tier in left_out:
            df = df.join(left_out[tier].select(member).distinct(), member, "left_anti")
        per = df.groupBy(member).agg(F.max(engagement).alias("engagement"), F.min(hours).alias("hours"))
        parts.append(
            per.select(member, score.alias("ranking_score"), F.lit(tier).alias("tier"))
        )
    if incumbents is not None:
        parts.append(incumbents.select(member, "ranking_score", F.lit(1).alias("tier")))
    every = reduce(lambda a, b: a.unionByName(b), parts)
    single = every.groupBy(member).agg(F.min("tier").alias("tier"), F.min_by("ranking_score", "tier").alias("ranking_score"))
    by_tier = dense_ranks(single, ["tier"], "ranking_score", "tier_rank").withColumn("_down", -F.col("ranking_score"))
    ranked = ordered_scan(by_tier, [], ["tier", "_down", member], [Scan("place", "number")]).drop("_down")
    return ranked.filter(F.col("place") <= places) if places else ranked
