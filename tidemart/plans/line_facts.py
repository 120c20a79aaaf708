"""The order-line fact beyond plain shares: bundles, tokens, credits, payments and costs of each line."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys, latest_by, row_count
from tidemart.operators.joins import as_of, effective_lookup
from tidemart.operators.scan import KeyPlan, key_plan, with_totals
from tidemart.plans.facts import together
from tidemart.session import packed as settle

BUNDLE, COMPONENT = "bundle", "component"


LINE, GROUP = ["order_id", "line_id"], ["order_id", "group_key"]


def bundle_discounts(lines: DataFrame, plan: KeyPlan = KeyPlan()) -> DataFrame:
    """Lines with ``discount``: their own, and for what shares a bundle's group its part of the bundle's discount by price.

    lines: order_id, line_id, group_key (null is a group too), kind, price, own_discount, modified. Of several bundles in a group the last
    modified counts; a bundle without a price passes nothing on. plan: the orders that are too large for one task.
    """
    newest = F.max_by(F.struct("price", "own_discount"), F.when(F.col("kind") == BUNDLE, F.struct("modified", "line_id")))
    rated = with_totals(lines, GROUP, {"_bundle": newest}, plan)
    subtotal, off = F.col("_bundle.price").cast("double"), F.col("_bundle.own_discount").cast("double")
    part = off * F.col("price").cast("double") / F.nullif(subtotal, F.lit(0.0))
    return rated.withColumn("discount", F.col("own_discount").cast("double") + F.coalesce(part, F.lit(0.0))).drop("_bundle")


def line_tokens(lines: DataFrame, amounts: dict[str, str], plan: KeyPlan = KeyPlan()) -> DataFrame:
    """Lines with their token amounts: a line's own; a bundle hands its tokens to its components by price and keeps none.

    A bundle without components keeps its tokens. A component's part is rounded to cents; the one of the highest line number takes what
    rounding leaves. Sums per group replace running totals, so a group may be large.

    lines: order_id, line_id, group_key, kind, price, ``_held`` (how many token rows the line has) and ``_own_<amount>``, their sums; amounts:
    name and decimal type.
    """
    bundle, component = (F.col("kind") == BUNDLE) & (F.col("_held") > 0), F.col("kind") == COMPONENT
    totals = {"_open": F.max(component), "_whole": F.sum(F.when(bundle, F.col("price") * F.col("_held"))), "_bundles": F.count(F.when(bundle, 1)), "_last": F.max(F.when(component, F.col("line_id")))}
    totals |= {f"_all_{a}": F.sum(F.when(bundle, F.col(f"_own_{a}"))) for a in amounts}
    grouped = with_totals(lines, GROUP, totals, plan).withColumns({f"_all_{a}": F.col(f"_all_{a}").cast(kind) for a, kind in amounts.items()})
    ratio = F.col("price").cast("double") / F.nullif(F.col("_whole").cast("double"), F.lit(0.0))
    takes = component & (F.col("_bundles") > 0)
    share = lambda a: F.coalesce(F.round(F.col(f"_all_{a}").cast("double") * ratio, 2), F.lit(0.0)).cast(amounts[a])
    parted = grouped.select("*", *[F.when(takes, share(a)).alias(f"_part_{a}") for a in amounts])
    given = with_totals(parted, GROUP, {f"_sum_{a}": F.sum(f"_part_{a}") for a in amounts}, plan)
    rest = lambda a: F.when(F.col("line_id") == F.col("_last"), F.col(f"_all_{a}") - F.col(f"_sum_{a}") + F.col(f"_part_{a}"))
    handed = given.select("*", *[F.when(takes, rest(a).otherwise(F.col(f"_part_{a}"))).cast(kind).alias(f"_handed_{a}") for a, kind in amounts.items()])
    sums = {"_passed": F.max(F.coalesce(bundle & F.col("_open"), F.lit(False)))}
    sums |= {f"_kept_{a}": F.sum(F.when(F.col("_held") > 0, F.col(f"_own_{a}"))) for a in amounts} | {f"_got_{a}": F.sum(f"_handed_{a}") for a in amounts}
    every = with_totals(handed, LINE, sums, plan)
    zero = lambda c: F.coalesce(c, F.lit(0))
    kept = lambda a: F.when(F.col("_passed"), F.lit(0)).otherwise(zero(F.col(f"_kept_{a}")))
    own = [c for c in lines.columns if c != "_held" and not c.startswith("_own_")]
    return every.select(*own, *[(kept(a) + zero(F.col(f"_got_{a}"))).cast(kind).alias(a) for a, kind in amounts.items()])


def credit_breakout(lines: DataFrame, plan: KeyPlan = KeyPlan()) -> DataFrame:
    """Lines with cash_credit, noncash_credit and payment where tokens paid for a part of their order, and ``_by_tokens`` that tells where.

    What a line still has to pay after its tokens sets its part of the order's other credits; what it has to pay after all credits sets its
    part of the order's payment. Cancelled lines take no part. Orders without tokens are left open: their lines share by price.

    lines: order_id, line_id, cancelled, subtotal, discount, tax, cash_token, noncash_token, and the order's order_cash_credit,
    order_noncash_credit, order_paid (amounts as doubles).
    """
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    order, token = ["order_id"], zero("cash_token") + zero("noncash_token")
    base = with_totals(lines, order, {"_tokens": F.sum(token), "_cash_tokens": F.sum("cash_token"), "_noncash_tokens": F.sum("noncash_token")}, plan)
    due = F.when(F.col("cancelled"), F.lit(0.0)).otherwise(zero("subtotal") - zero("discount") + zero("tax") - token)
    open_ = with_totals(base.withColumn("_due", due), order, {"_order_due": F.sum("_due")}, plan)
    ratio = F.coalesce(F.col("_due") / F.nullif(F.col("_order_due"), F.lit(0.0)), F.lit(0.0))
    credited = open_.withColumns({
        "cash_credit": zero("cash_token") + (F.col("order_cash_credit") - zero("_cash_tokens")) * ratio,
        "noncash_credit": zero("noncash_token") + (F.col("order_noncash_credit") - zero("_noncash_tokens")) * ratio,
    })
    cash = F.when(F.col("cancelled"), F.lit(0.0)).otherwise(zero("subtotal") - zero("discount") + zero("tax") - F.col("cash_credit") - F.col("noncash_credit"))
    paid = with_totals(credited.withColumn("_cash", cash), order, {"_order_cash": F.sum("_cash")}, plan)
    part = F.coalesce(F.col("_cash") / F.nullif(F.col("_order_cash"), F.lit(0.0)), F.lit(0.0))
    told = {"cash_credit": F.col("cash_credit"), "noncash_credit": F.col("noncash_credit"), "payment": F.col("order_paid") * part}
    some = F.col("order_id").isNotNull() & (F.col("_tokens") > 0)
    return paid.select(*lines.columns, *[F.when(some, c).alias(n) for n, c in told.items()], some.alias("_by_tokens"))


def converted(df: DataFrame, amount: str, currency: str, wanted: str, day: str, rates: DataFrame) -> DataFrame:
    """An amount in the wanted currency by the rate of its day; 1 where there is no rate. rates: source, target, day, rate (one a day)."""
    priced = rates.select(F.upper("source").alias("_source"), F.upper("target").alias("_target"), F.col("day").alias("_day"), "rate")
    on = (F.upper(F.col(currency)) == F.col("_source")) & (F.upper(F.col(wanted)) == F.col("_target")) & (F.col(day) == F.col("_day"))
    joined = df.join(priced, on, "left")
    local = F.when(F.col(currency) == F.col(wanted), F.col(amount)).otherwise(F.col(amount) * F.coalesce("rate", F.lit(1.0)))
    return joined.withColumn(amount, local).drop("_source", "_target", "_day", "rate")


def line_costs(
    lines: DataFrame, fixed: DataFrame, feed: DataFrame, by_store: DataFrame, by_region: DataFrame, purchases: DataFrame, rates: DataFrame
) -> DataFrame:
    """order_id, line_id, cost, cost_source of each line by the first source that knows it.

    In this order: a fixed cost of the line; the latest feed row of the line, converted; the unit cost of its item in its store, in its region
    (the version that starts last, costs above 0 only); the item's last purchase up to the day, else its first one after. The item
    ignores letter case. Stores, regions and purchases are looked up for the lines that are still open only.

    lines: order_id, line_id, item, store, region, currency, day, units; fixed: order_id, line_id, cost; feed: order_id, line_id, cost,
    currency, number; by_store and by_region: item, store or region, start_at, end_at, unit_cost, currency; purchases: item, day, unit_cost, currency.
    """
    line = ["order_id", "line_id"]
    known: list[DataFrame] = []
    low = lambda df: df.withColumn("item", F.lower("item"))
    names = [*line, "item", "store", "region", "currency", "day", "units"]
    left = low(lines).withColumn("units", F.when(F.col("units") == 0, 1).otherwise(F.col("units")).cast("double")).select(*names)
    # Where every line is one row, what a source leaves open is told by its own rows; else a line that is known goes with all its rows.
    once = lines.groupBy(*line).agg(row_count().alias("_n")).filter("_n > 1").isEmpty()

    # Both sides are files or small, so their keys are counted where they lie instead of in a copy of all rows.
    def counted(a: DataFrame, b: DataFrame, keys: list[str]) -> KeyPlan:
        return key_plan(a.select(*keys).union(b.select(*keys)), keys)

    def settle_part(found: DataFrame, source: Column) -> None:
        nonlocal left
        found = settle(found.select(*names, F.col("cost").cast("double").alias("cost"), source.alias("cost_source")))
        known.append(found.filter(F.col("cost").isNotNull()).select(*line, "cost", "cost_source"))
        left = found.filter(F.col("cost").isNull()).select(*names) if once else join_keys(left, known[-1].select(*line), line, "left_anti")

    # Both tables of single lines are joined by the same keys, so the lines are dealt once for them.
    told = fixed.filter(F.col("cost").isNotNull()).select(*line, F.col("cost").alias("_fixed"))
    last = latest_by(feed, line, ["number"]).select(*line, "cost", F.col("currency").alias("_paid_in"))
    fed = converted(join_keys(join_keys(left, told, line, "left"), last, line, "left"), "cost", "_paid_in", "currency", "day", rates)
    is_fixed = F.col("_fixed").isNotNull()
    first = fed.withColumn("cost", F.when(is_fixed, F.col("_fixed").cast("double")).otherwise(F.col("cost").cast("double")))
    settle_part(first, F.when(is_fixed, F.lit("fixed")).otherwise(F.lit("feed")))
    for place, table, name in (("store", by_store, "same store"), ("region", by_region, "same region")):
        sound = low(table).filter(F.col("unit_cost") > 0).withColumnRenamed("currency", "_paid_in")
        hit = effective_lookup(left, sound, ["item", place], "day", "start_at", "end_at", ["unit_cost", "_paid_in"], plan=counted(left, sound, ["item", place]))
        priced = hit.withColumn("cost", F.col("units") * F.col("unit_cost"))
        settle_part(converted(priced, "cost", "_paid_in", "currency", "day", rates), F.lit(name))
    bought = low(purchases).groupBy("item", F.col("day").alias("_at")).agg(F.max_by(F.struct("unit_cost", "currency"), "unit_cost").alias("_p"))
    for forward, name in ((False, "last purchase"), (True, "next purchase")):
        hit = as_of(left, bought, ["item"], "day", "_at", ["_p"], forward=forward, plan=counted(left, bought, ["item"]))
        priced = hit.withColumns({"cost": F.col("units") * F.col("_p.unit_cost"), "_paid_in": F.col("_p.currency")})
        settle_part(converted(priced, "cost", "_paid_in", "currency", "day", rates), F.lit(name))
    return reduce(lambda a, b: a.unionByName(b), known)


def line_fact(
    keys: DataFrame | None, lines: DataFrame, tokens: DataFrame, orders: DataFrame, costs: DataFrame
) -> DataFrame:
    """Lines of the changed orders with units, discount, tokens, credits, payment and cost.

    lines: order_id, line_id, group_key, kind, cancelled, units, price, own_discount, tax, modified; tokens: order_id, line_id, cash_token,
    noncash_token; orders: order_id, order_paid, order_cash_credit, order_noncash_credit; costs: order_id, line_id, cost, cost_source. In an
    order without tokens credits and payment follow the price; where prices sum to zero, every line has an equal part.
    """
    amounts = {a: dict(tokens.dtypes)[a] for a in ("cash_token", "noncash_token")}
    plan = key_plan(lines.select("order_id").unionByName(tokens.select("order_id")), ["order_id"])
    held = {"_held": F.count("_tokens")} | {f"_own_{a}": F.sum(f"_tokens.{a}") for a in amounts} | {"_costs": F.collect_list("_costs")}
    parts = {"_lines": (lines, LINE), "_tokens": (tokens, LINE), "_costs": (costs, LINE), "_orders": (orders, ["order_id"])}
    rows = together(parts, keys, {"_orders": F.collect_list("_orders")}, plan)
    mine = with_totals(rows.drop("_orders").withColumnRenamed("_of_orders", "_orders"), LINE, {f"_of{n}": c for n, c in held.items()}, plan)
    own = mine.filter(F.col("_lines").isNotNull()).select(*LINE, "_lines.*", "_orders", *[F.col(f"_of{n}").alias(n) for n in held])
    base = line_tokens(bundle_discounts(own, plan), amounts, plan)
    wide = base.withColumn("_o", F.explode_outer("_orders")).select(*[c for c in base.columns if c != "_orders"], "_o.*")
    doubles = (*amounts, "tax", "order_paid", "order_cash_credit", "order_noncash_credit")
    wide = wide.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in doubles} | {"subtotal": F.col("price").cast("double")})
    split = with_totals(credit_breakout(wide, plan), ["order_id"], {"_subtotal": F.sum("subtotal"), "_n": row_count()}, plan)
    even = F.when(F.col("_subtotal") == 0, F.lit(1.0) / F.col("_n")).otherwise(F.col("subtotal") / F.nullif(F.col("_subtotal"), F.lit(0.0)))
    plain = {"cash_credit": "order_cash_credit", "noncash_credit": "order_noncash_credit", "payment": "order_paid"}
    shared = split.withColumns({c: F.when(F.col("_by_tokens"), F.col(c)).otherwise(F.col(total) * even) for c, total in plain.items()})
    costed = shared.withColumn("_c", F.explode_outer("_costs")).select(*shared.columns, "_c.*")
    four = lambda c: F.round(F.col(c), 4).alias(c)
    return costed.select(*LINE, "kind", "units", four("discount"), "cash_token", "noncash_token", *[four(c) for c in plain], four("cost"), "cost_source")
