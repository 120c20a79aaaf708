"""Credits and points: breakage, roll-forward, outstanding balances, allocations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.semantics import boundaries, join_keys, ratio, row_count
from tidemart.functions.text import month_range
from tidemart.operators.scan import KeyPlan, Scan, ordered_scan
from tidemart.session import reused

# Activity kinds, and the tenures at which the expected rates are read.
KINDS = ("Issued", "Redeemed", "Cancelled", "Expired")
RATE_TENURE, LAST_TENURE = 12, 13
RATE_MONTHS = 24


def cohorts(activity: DataFrame, group: Sequence[str], thru: Column) -> DataFrame:
    """One row per issue month: amount issued, the four activities to date, and the months of the rate window as a list.

    ``activity``: group columns, issued_month, activity_month, kind, amount. All that breakage needs comes from these two aggregates.
    """
    by = [*group, "issued_month"]
    lower = [k.lower() for k in KINDS]
    wide = (
        activity.groupBy(*by, "activity_month").pivot("kind", list(KINDS)).agg(F.sum("amount")).withColumnsRenamed(dict(zip(KINDS, lower, strict=True)))
    )
    low = F.add_months(thru, -(RATE_MONTHS - 1))
    inside = (F.col("activity_month") >= F.col("issued_month")) & (F.col("activity_month") <= thru)
    recent = inside & (F.col("issued_month") >= low)  # so at most RATE_MONTHS entries a row
    tenure = boundaries("month", "issued_month", "activity_month") + 1
    value = lambda k: F.coalesce(k, F.lit(0))
    return (
        wide.groupBy(*by)
        .agg(
            F.sum("issued").alias("issued_amount"),
            *[F.sum(F.when(inside, value(k)).otherwise(F.lit(0))).alias(f"{k}_to_date") for k in lower],
            F.collect_list(F.when(recent, F.struct(tenure.alias("tenure"), *[value(k).alias(k) for k in lower[:3]]))).alias("months"),
        )
        .filter(F.col("issued_amount").isNotNull() & (F.col("issued_month") <= thru))
        .withColumnsRenamed({f"{k}_to_date": k for k in lower})
    )


def expected_rates(issued: DataFrame, rate_group: Sequence[str], thru: Column, shift: Column | None = None) -> DataFrame:
    """Cumulative redeemed and unredeemed shares by tenure over the last 24 months, read at tenures 12 and 13.

    ``issued`` are the cohorts; a cohort counts at every tenure it has reached, active or not. ``shift`` moves share from
    unredeemed to redeemed at tenure 13 (a temporary adjustment).
    """
    low = F.add_months(thru, -(RATE_MONTHS - 1))
    reached = F.sequence(F.lit(1), (boundaries("month", "issued_month", thru) + 1).cast("int"))
    recent = issued.filter(F.col("issued_month") >= low).select(*rate_group, "issued_amount", "months", F.explode(reached).alias("tenure"))
    month = F.get(F.filter("months", lambda m: m["tenure"] == F.col("tenure")), F.lit(0))
    at_tenure = lambda k: F.sum(F.coalesce(month[k], F.lit(0)))
    by_tenure = recent.groupBy(*rate_group, "tenure").agg(
        F.coalesce(ratio(at_tenure("redeemed"), F.sum("issued_amount")), F.lit(0.0)).alias("r"),
        F.coalesce(ratio(at_tenure("issued") - at_tenure("redeemed") - at_tenure("cancelled"), F.sum("issued_amount")), F.lit(0.0)).alias("u"),
    )
    # At most 24 tenures per group: a plain window over aggregated rows.
    upto = W.partitionBy(*rate_group).orderBy("tenure").rowsBetween(W.unboundedPreceding, 0)
    curves = by_tenure.select(*rate_group, "tenure", F.sum("r").over(upto).alias("r"), F.sum("u").over(upto).alias("u"))
    moved = shift if shift is not None else F.lit(0.0)
    at = lambda c, t: F.max(F.when(F.col("tenure") == t, F.col(c)))
    return curves.groupBy(*rate_group).agg(
        at("r", RATE_TENURE).alias("expected_redeemed"),
        (at("r", LAST_TENURE) + moved).alias("expected_redeemed_max"),
        (at("u", LAST_TENURE) - moved).alias("expected_unredeemed"),
    )


def breakage(
    activity: DataFrame, group: Sequence[str], rate_group: Sequence[str], thru: Column, shift: Column | None = None
) -> DataFrame:
    """Breakage to record per issue month as of one booking month.

    Up to tenure 13 the unredeemed amount is capped by the expected share and scaled by how far redemption has come
    against expectation (at most fully); after it all that is unredeemed counts.
    """
    issued = reused(cohorts(activity, group, thru))
    rated = join_keys(issued.drop("months"), expected_rates(issued, rate_group, thru, shift), rate_group)
    d = {c: F.col(c).cast("double") for c in ("issued", "redeemed", "cancelled")}
    unredeemed = d["issued"] - d["redeemed"] - d["cancelled"]
    tenure = boundaries("month", F.col("issued_month"), thru) + 1
    young = tenure <= LAST_TENURE
    ceiling = d["issued"] * F.col("expected_unredeemed")
    below = unredeemed < ceiling
    progress = ratio(ratio("redeemed", "issued"), "expected_redeemed")
    expected = F.when(young & ~below, ceiling).otherwise(unredeemed)
    recorded = F.when(young, expected * F.when(progress > 1, F.lit(1.0)).otherwise(progress)).otherwise(expected)
    rest = lambda c: F.when(young & ~below, c).otherwise(F.lit(0.0))
    return rated.select(
        *group,
        "issued_month",
        tenure.alias("tenure"),
        thru.alias("booking_month"),
        "issued",
        "redeemed",
        "cancelled",
        "expired",
        unredeemed.alias("unredeemed"),
        progress.alias("redemption_progress"),
        rest(F.col("expected_redeemed_max") * d["issued"] - d["redeemed"]).alias("expected_more_redeemed"),
        rest((1 - F.col("expected_unredeemed") - F.col("expected_redeemed_max")) * d["issued"] - d["cancelled"]).alias(
            "expected_more_cancelled"
        ),
        expected.alias("expected_breakage"),
        recorded.alias("breakage_to_record"),
    )


def booking_changes(bookings: DataFrame, group: Sequence[str], month: str, amount: str) -> DataFrame:
    """Change of a recorded amount against the booking before; the first booking counts whole."""
    scanned = ordered_scan(
        bookings, group, [month], [Scan("_before", "lag", amount), Scan("_n", "number")], plan=KeyPlan()
    )
    return scanned.select(
        *bookings.columns,
        F.when(F.col("_n") == 1, F.col(amount)).otherwise(F.col(amount) - F.col("_before")).alias("change"),
    )


def allocate(amounts: DataFrame, weights: DataFrame, on: Sequence[str], amount: str, weight: str, out: str) -> DataFrame:
    """Amount of a group spread over its members by their share of the group's weight."""
    totals = weights.groupBy(*on).agg(F.sum(weight).alias("_total"))
    return (
        join_keys(join_keys(weights, totals, on), amounts.select(*on, F.col(amount).alias("_amount")), on)
        .select(
            *weights.columns,
            ratio(weight, "_total").alias("share"),
            (F.col("_amount").cast("double") * ratio(weight, "_total")).alias(out),
        )
    )


def roll_forward(moves: Sequence[DataFrame], group: Sequence[str]) -> DataFrame:
    """Opening balance, issued, used and closing balance per group and month from several kinds of credit.

    Each frame: group columns, month, issued, used. Months without a move are filled in.
    """
    union = reduce(lambda a, b: a.unionByName(b), moves)
    monthly = union.groupBy(*group, "month").agg(F.sum("issued").alias("issued"), F.sum("used").alias("used"))
    span = monthly.groupBy(*group).agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = month_range(span, "a", "b", "month").select(*group, "month")
    filled = join_keys(months, monthly, [*group, "month"], "left").fillna(0, ["issued", "used"])
    net = filled.withColumn("_net", F.col("issued") - F.col("used"))
    closed = ordered_scan(net, list(group), ["month"], [Scan("closing", "sum", "_net")], plan=KeyPlan())
    return closed.select(*group, "month", (F.col("closing") - F.col("_net")).alias("opening"), "issued", "used", "closing")


def count_bucket(c: Column, cap: int = 10) -> Column:
    """'1' ... '9', '10+'."""
    return F.when(c >= cap, F.lit(f"{cap}+")).otherwise(c.cast("string"))


def outstanding_buckets(credits: DataFrame, customer: str, status: DataFrame, credit: str, amount: str) -> DataFrame:
    """Customers and amount by number of outstanding credits and customer status."""
    per = credits.groupBy(customer).agg(F.count_distinct(credit).alias("_n"), F.sum(amount).alias("_amount"))
    return (
        per.join(status, customer, "left")
        .groupBy(F.coalesce("status", F.lit("unknown")).alias("status"), count_bucket(F.col("_n")).alias("bucket"))
        .agg(row_count().alias("customers"), F.sum("_amount").alias("outstanding"))
    )
