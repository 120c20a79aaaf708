"""A/B tests, funnels and product conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import earliest_by, ratio, row_count
from tidemart.operators.joins import as_of
from tidemart.operators.reshape import split_rows
from tidemart.operators.scan import Scan, ordered_scan
from tidemart.plans.members import state_at_event


def first_exposures(
    exposures: DataFrame, unit: str, test: str, variant: str, moment: str, tie: Sequence[str], labels: dict[str, str]
) -> DataFrame:
    """First exposure per unit and test with the label of its variant."""
    first = earliest_by(exposures, [unit, test], [moment, *tie])
    label = F.lit(None).cast("string")
    for value, text in labels.items():
        label = F.when(F.col(variant) == value, F.lit(text)).otherwise(label)
    return first.select(unit, test, variant, F.col(moment).alias("exposed_at"), label.alias("test_label"))


def exposures_with_state(first: DataFrame, timeline: DataFrame, customer: str, paying: str) -> DataFrame:
    """Membership state and tenure of the customer at the exposure."""
    return state_at_event(first, timeline, customer, "exposed_at", paying)


def test_results(
    first: DataFrame, orders: DataFrame, unit: str, test: str, ordered: str, amount: str, dims: Sequence[str] = ()
) -> DataFrame:
    """Units, orders after exposure, revenue and rates per test and label.

    What a unit ordered after an exposure is its total less its running total just before it, so orders are scanned
    once however many tests a unit is in.
    """
    running = ordered_scan(
        orders.select(unit, ordered, amount), [unit], [ordered, amount], [Scan("_n", "number"), Scan("_s", "sum", amount)]
    )
    whole = orders.groupBy(unit).agg(row_count().alias("_all_n"), F.sum(amount).alias("_all_s"))
    before = as_of(
        first.select(unit, test, "exposed_at"), running, [unit], "exposed_at", ordered, ["_n", "_s"], inclusive=False,
        tie=["_n"],
    )
    per_unit = (
        before.join(whole, unit)
        .select(
            unit,
            test,
            (F.col("_all_n") - F.coalesce("_n", F.lit(0))).alias("orders"),
            (F.col("_all_s") - F.coalesce("_s", F.lit(0))).alias("revenue"),
        )
        .filter("orders > 0")
    )
    joined = first.join(per_unit, [unit, test], "left")
    totals = joined.groupBy(test, "test_label", *dims).agg(
        row_count().alias("units"),
        F.count("orders").alias("converted"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
    )
    return totals.withColumn("conversion", ratio("converted", "units")).withColumn(
        "revenue_per_unit", ratio("revenue", "units")
    )


def dominant_page(views: DataFrame, test: Sequence[str], page: str) -> DataFrame:
    """Most viewed page per test with its share of all views."""
    counts = views.groupBy(*test, page).agg(row_count().alias("views"))
    top = counts.groupBy(*test).agg(
        F.max_by(F.struct(page, "views"), F.struct("views", page)).alias("_top"), F.sum("views").alias("_all")
    )
    return top.select(*test, F.col(f"_top.{page}").alias(page), F.col("_top.views").alias("views"), ratio("_top.views", "_all").alias("share"))


def split_groups(tests: DataFrame, split: str) -> DataFrame:
    """Traffic splits such as '50/50' as one row per group: Control, then Variant (or Variant A, B, C)."""
    count = F.size(F.split(split, "/"))
    rows = split_rows(tests.withColumn("num_splits", count), split, "/", "group_share", "group_number")
    n = F.col("group_number")
    label = (
        F.when(n == 1, "Control")
        .when((n == 2) & (F.col("num_splits") == 2), "Variant")
        .otherwise(F.concat(F.lit("Variant "), F.char(F.lit(63) + n)))
    )
    return rows.withColumn("test_group", label)


def session_funnel(events: DataFrame, session: Sequence[str], kind: str, steps: Sequence[str], dims: Sequence[str] = ()) -> DataFrame:
    """Sessions that reached each step (any order) per group, from one flag row per session."""
    flags = events.groupBy(*session, *dims).agg(*[F.max((F.col(kind) == s).cast("int")).alias(s) for s in steps])
    return flags.groupBy(*dims).agg(row_count().alias("sessions"), *[F.sum(s).alias(s) for s in steps])


def ordered_funnel(events: DataFrame, session: Sequence[str], kind: str, moment: str, steps: Sequence[str]) -> DataFrame:
    """Sessions that reached each step after the step before it, by the first moment of every step."""
    firsts = events.groupBy(*session).agg(
        *[F.min(F.when(F.col(kind) == s, F.col(moment))).alias(s) for s in steps]
    )
    reached, out = F.col(steps[0]).isNotNull(), []
    out.append(F.count_if(reached).alias(steps[0]))
    for before, step in zip(steps, steps[1:]):
        reached = reached & F.coalesce(F.col(step) >= F.col(before), F.lit(False))
        out.append(F.count_if(reached).alias(step))
    return firsts.agg(row_count().alias("sessions"), *out)


def product_conversion(
    impressions: DataFrame, clicks: DataFrame, orders: DataFrame, states: DataFrame, user: str, product: str, moment: str
) -> DataFrame:
    """Impressions, clicks and orders per product, day and the membership state of the user at the moment.

    Each measure is bracketed by the as-of state and pre-aggregated; the measures are stacked and summed once.
    """
    parts = []
    for name, df in (("impressions", impressions), ("clicks", clicks), ("orders", orders)):
        placed = as_of(df.select(user, product, moment), states, [user], moment, "memb_start", ["status"])
        parts.append(
            placed.groupBy(product, F.to_date(moment).alias("day"), F.coalesce("status", F.lit("prospect")).alias("status"))
            .agg(row_count().alias("n"))
            .withColumn("measure", F.lit(name))
        )
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    wide = stacked.groupBy(product, "day", "status").agg(
        *[F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("n"))), F.lit(0)).alias(m) for m in ("impressions", "clicks", "orders")]
    )
    return wide.withColumn("click_rate", ratio("clicks", "impressions")).withColumn("order_rate", ratio("orders", "clicks"))
