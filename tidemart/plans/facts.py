"""Fact assembly: changed keys, steps that add columns, and the load into the mart table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.semantics import OPEN_END, earliest_by, join_keys, latest_by, ntz, ratio, row_count
from tidemart.functions.text import country_of_shard, local_time
from tidemart.operators.joins import as_of, effective_lookup
from tidemart.operators.merge import evolve, insert_update, replace_groups, rescue
from tidemart.operators.reshape import first_match, flatten_object
from tidemart.operators.scan import KeyPlan, Scan, key_plan, ordered_scan, with_totals
from tidemart.operators.scd import mart_upsert
from tidemart.session import SMALL_BYTES, dealt, input_bytes, packed, scratch_path, settle

STEPS_PER_CUT = 15


def assemble(
    keys: DataFrame | None, base: DataFrame, key: str, steps: Sequence[Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """Base rows of the changed keys (all rows when ``keys`` is None) run through the steps.

    A long chain of joins makes plans that are slow to optimise, so the lineage is cut by a reliable checkpoint
    after every few steps.
    """
    out = base.join(keys.select(key), key, "left_semi") if keys is not None else base
    for i, step in enumerate(steps, 1):
        out = step(out)
        if i % STEPS_PER_CUT == 0 and i < len(steps):
            out = settle(out)
    return out


def together(parts: dict[str, tuple[DataFrame, list[str]]], keys: DataFrame | None, totals: dict[str, Column], plan: KeyPlan) -> DataFrame:
    """Rows of several tables of the changed orders in one frame that is dealt by order once, with totals of their order (``_of<name>``).

    parts: column that holds a table's row (null on rows of the others), the table, its keys, of which the first is the order. NULL is
    an order too. What follows and stays within an order needs no further shuffle.
    """
    boxed = [df.select(*on, F.struct(*[c for c in df.columns if c not in on]).alias(name)) for name, (df, on) in parts.items()]
    if keys is not None:
        boxed.append(keys.select("order_id", F.lit(True).alias("_changed")))
        totals = totals | {"_changed": F.max("_changed")}
    rows = dealt(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), boxed), "order_id")
    named = with_totals(rows, ["order_id"], {f"_of{n}": c for n, c in totals.items()}, plan)
    return named if keys is None else named.filter("_of_changed").drop("_changed", "_of_changed")


def add_totals(details: DataFrame, key: str, **totals: Column) -> Callable[[DataFrame], DataFrame]:
    """Step: aggregates of a detail table per key, 0 where there is none."""

    def step(df: DataFrame) -> DataFrame:
        sums = details.groupBy(key).agg(*[c.alias(n) for n, c in totals.items()])
        return df.join(sums, key, "left").fillna(0, list(totals))

    return step


def add_first(details: DataFrame, key: str, order: Sequence[Column | str], columns: Sequence[str]) -> Callable:
    """Step: columns of the first detail row per key."""

    def step(df: DataFrame) -> DataFrame:
        return df.join(earliest_by(details.select(key, *columns), [key], order), key, "left")

    return step


def only(details: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    """Detail rows of the changed keys: details are reduced before anything is computed from them."""
    return details if keys is None else details.join(keys.select(key).distinct(), key, "left_semi")


def master_status(child_rank: dict[str, int], orders: DataFrame, key: str, master: str, status: str, out: str) -> Callable:
    """Step: a split master takes the status of the child that ranks first; other rows keep their own.

    ``orders`` holds all children, also those that have not changed themselves.
    """

    def step(df: DataFrame) -> DataFrame:
        rank = F.lit(len(child_rank) + 1)
        for value, place in child_rank.items():
            rank = F.when(F.col(status) == value, F.lit(place)).otherwise(rank)
        children = orders.filter(F.col(key) != F.col(master))
        best = children.groupBy(F.col(master).alias("_master")).agg(F.min_by(status, F.struct(rank, F.col(key))).alias("_best"))
        return df.join(best, F.col(key) == F.col("_master"), "left").withColumn(out, F.coalesce("_best", status)).drop("_master", "_best")

    return step


def by_kind(name: str, kind: str, amount: str, kinds: Sequence[str]) -> dict[str, Column]:
    """Sums of an amount per kind as columns ``name_kind``, for ``add_details``."""
    return {f"{name}_{k}": F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(amount))), F.lit(0)) for k in kinds}


def add_details(details: DataFrame, key: str, totals: dict[str, Column], others: dict[str, Column] | None = None) -> Callable:
    """Step: everything a detail table tells of a key, in one aggregate and one join; totals are 0 where there are no details."""

    def step(df: DataFrame) -> DataFrame:
        sums = details.groupBy(key).agg(*[c.alias(n) for n, c in (totals | (others or {})).items()])
        return df.join(sums, key, "left").fillna(0, list(totals))

    return step


def add_effective(dim: DataFrame, keys: Sequence[str], ts: str, start: str, end: str, column: str, otherwise, disjoint: bool = False) -> Callable:
    """Step: a value valid at the row's moment (a rate, a price), or a default.

    ``disjoint``: the dimension was published without overlaps (``joins.disjoint_versions``), so they are not looked for again.
    """

    def step(df: DataFrame) -> DataFrame:
        return effective_lookup(df, dim, keys, ts, start, end, [column], disjoint=disjoint).withColumn(column, F.coalesce(column, F.lit(otherwise)))

    return step


def add_shipments(shipments: DataFrame, done: str) -> Callable:
    """Step: cost and carrier of the shipments that were carried out. shipments: order_id, carrier, rate, status."""
    carried = F.col("status") == done
    sums = shipments.filter(carried).groupBy("order_id").agg(F.sum("rate").alias("shipping_cost"), F.max("carrier").alias("carrier"))

    def step(df: DataFrame) -> DataFrame:
        return df.join(sums, "order_id", "left").fillna(0, ["shipping_cost"])

    return step


def add_cancellation(cancels: DataFrame, fees: DataFrame) -> Callable:
    """Step: the first cancellation of an order with its reason, and its delivery fees, which a cancelled order does not pay.

    cancels: order_id, at, reason; fees: order_id, fee.
    """
    first = earliest_by(cancels, ["order_id"], ["at", "reason"]).select("order_id", F.col("at").alias("cancelled_at"), F.col("reason").alias("cancel_reason"))
    paid = fees.groupBy("order_id").agg(F.sum("fee").alias("_fee"))

    def step(df: DataFrame) -> DataFrame:
        joined = df.join(first, "order_id", "left").join(paid, "order_id", "left")
        none = F.lit(0).cast(dict(paid.dtypes)["_fee"])
        fee = F.when(F.col("cancelled_at").isNull(), F.coalesce("_fee", none)).otherwise(none)
        return joined.withColumn("delivery_fee", fee).drop("_fee")

    return step


def add_assumption(assumptions: DataFrame, keys: Sequence[str], ts: str, cost: str, units: str) -> Callable:
    """Step: an estimated cost from the assumption of the row's month where the real one is not known yet.

    assumptions: keys, month, per_unit; a month without its own takes the last one before it. They are few beside the rows, which stay where
    they are: each assumption holds until the next, and only a list too long for a broadcast is laid on one time line with the rows.
    """

    def step(df: DataFrame) -> DataFrame:
        dated = assumptions.withColumn("_month", F.col("month").cast("timestamp_ntz"))
        led = ordered_scan(dated, keys, ["_month"], [Scan("_next", "lead", "_month")])
        held = led.withColumn("_until", F.coalesce("_next", ntz(OPEN_END)))
        hit = effective_lookup(df, held, keys, ts, "_month", "_until", ["per_unit"], half_open=True, prefix="_a_", disjoint=True)
        estimate = F.coalesce(F.col("_a_per_unit"), F.lit(0.0)) * F.col(units)
        known = F.col(cost).cast("double")
        return hit.withColumn(f"{cost}_or_estimate", F.when(known > 0, known).otherwise(estimate)).drop("_a_per_unit")

    return step


def add_local(ts: str, zones: dict[str, str], place: str, out: str) -> Callable:
    """Step: a UTC moment in the local time of its place; the zones are a short list."""

    def step(df: DataFrame) -> DataFrame:
        local = F.col(ts)
        for value, zone in zones.items():
            local = F.when(F.col(place) == value, local_time(ts, zone).cast("timestamp_ntz")).otherwise(local)
        return df.withColumn(out, local)

    return step


def add_activation(activations: DataFrame, member: str, ts: str, at: str, plan: KeyPlan | None = None) -> Callable:
    """Step: the member's last activation up to the row's moment, and whether the row is the activation itself.

    ``plan``: the members that are too large for one task, where they were counted before.
    """

    def step(df: DataFrame) -> DataFrame:
        hit = as_of(df, activations.withColumn("activated_at", F.col(at)), [member], ts, at, ["activated_at"], plan=plan)
        known = F.when(F.col(member).isNotNull(), F.col("activated_at"))
        return hit.withColumn("activated_at", known).withColumn("is_activating", F.coalesce(known == F.col(ts), F.lit(False)))

    return step


def add_flag(members: DataFrame, key: str, out: str) -> Callable:
    """Step: whether the key is in a list, such as test customers."""

    def step(df: DataFrame) -> DataFrame:
        listed = members.select(key).distinct().withColumn(out, F.lit(True))
        return df.join(listed, key, "left").withColumn(out, F.coalesce(out, F.lit(False)))

    return step


def order_fact(
    keys: DataFrame | None, orders: DataFrame, lines: DataFrame, payments: DataFrame, credits: DataFrame, vat: DataFrame, rates: DataFrame,
    activations: DataFrame, test_customers: DataFrame, zones: dict[str, str], channels: Sequence[tuple[Column, str]],
    child_rank: dict[str, int], line_states: Sequence[str], payment_kinds: Sequence[str], credit_kinds: Sequence[str],
    more: Sequence[Callable[[DataFrame], DataFrame]] = (), disjoint: bool = False,
) -> DataFrame:
    """Orders of the changed keys with everything the order fact holds: status, dates, units, amounts, payments, credits, VAT, USD
    rate, local time, channel, activation.

    orders: order_id, master_id, customer_id, country, currency, ordered_at, status; lines: order_id, state, units, gross, discount,
    tax, shipped_at; payments: order_id, kind, amount, paid_at; credits: order_id, kind, amount; vat and rates: country or
    currency with start_at, end_at and the value (``disjoint``: without overlaps). ``more``: further steps, such as shipments, cancellations
    and assumptions.
    """
    mine = lambda df: only(df, keys, "order_id")
    lines, payments, credits = mine(lines), mine(payments), mine(credits)
    masters = None if keys is None else mine(orders).select("master_id")
    split = [*[f"units_{s}" for s in line_states]]

    def amounts(df: DataFrame) -> DataFrame:
        without = lambda c: F.round(F.col(c).cast("double") / (1 + F.col("vat_rate")), 4)
        paid = reduce(lambda a, b: a + b, [F.col(f"paid_{k}") for k in payment_kinds])
        return df.withColumns({
            "units": reduce(lambda a, b: a + b, [F.col(c) for c in split]),
            "subtotal_without_vat": without("gross"), "discount_without_vat": without("discount"),
            "paid_total": paid, "cash_gross": paid - F.col("credit_noncash") if "noncash" in credit_kinds else paid,
            "gross_usd": F.round(F.col("gross").cast("double") * F.col("usd_rate"), 4),
        })

    # What goes by the member comes first, while a row is narrow and no copy of it is needed to count its key; what goes by the order
    # follows without a step between, so the rows are dealt twice in all.
    member = ["customer_id"]
    plan = key_plan(orders.select(*member).unionByName(activations.select(*member)), member)
    steps = [
        add_activation(activations, "customer_id", "ordered_at", "at", plan),
        add_flag(test_customers, "customer_id", "is_test"),
        master_status(child_rank, only(orders, masters, "master_id"), "order_id", "master_id", "status", "order_status"),
        add_details(
            lines, "order_id",
            {"gross": F.sum("gross"), "discount": F.sum("discount"), "tax": F.sum("tax"), "lines": row_count()} | by_kind("units", "state", "units", line_states),
            {"first_shipped": F.min("shipped_at"), "last_shipped": F.max("shipped_at")},
        ),
        add_details(
            payments, "order_id", by_kind("paid", "kind", "amount", payment_kinds),
            {"first_paid": F.min("paid_at"), "payment_method": F.max_by("kind", F.struct("amount", "kind"))},
        ),
        add_details(credits, "order_id", by_kind("credit", "kind", "amount", credit_kinds)),
        add_effective(vat, ["country"], "ordered_at", "start_at", "end_at", "vat_rate", 0.0, disjoint),
        add_effective(rates, ["currency"], "ordered_at", "start_at", "end_at", "usd_rate", 1.0, disjoint),
        add_local("ordered_at", zones, "country", "ordered_local"),
        amounts,
        lambda df: first_match(df, channels, "channel", "other"),
        *more,
    ]
    return assemble(keys, orders, "order_id", steps)


# Parts in which a large fact is merged, one after the other.
LOAD_PARTS = 4


def load_fact(target: DataFrame | None, delta: DataFrame, key: Sequence[str], run_ts: Column, newer_by: str | None = None, parts: int = 1) -> DataFrame:
    """``mart_upsert``; with ``parts``, which wants both sides as files, a part of the keys at a time, so that only a part is shuffled at once."""
    if target is None or parts == 1 or input_bytes(target) <= SMALL_BYTES:
        return mart_upsert(target, delta, key, run_ts, newer_by)
    kinds = dict(target.dtypes)
    slot = F.pmod(F.xxhash64(*[F.col(k).cast(kinds[k]) for k in key]), F.lit(parts))
    done = [packed(mart_upsert(target.filter(slot == i), delta.filter(slot == i), key, run_ts, newer_by), "fact-part") for i in range(parts)]
    return reduce(lambda a, b: a.unionByName(b), done)


def line_ratios(lines: DataFrame, order: str, amount: str, out: str) -> DataFrame:
    """Line amount as a share of its order; a free order splits evenly."""
    totals = lines.groupBy(order).agg(F.sum(amount).alias("_total"), row_count().alias("_n"))
    share = F.when(F.col("_total") == 0, F.lit(1.0) / F.col("_n")).otherwise(ratio(amount, "_total"))
    return join_keys(lines, totals, [order]).withColumn(out, share).drop("_total", "_n")


def return_lines(
    lines: DataFrame, returns: DataFrame, order: str, line: Sequence[str], added: str, amount: str, refund: DataFrame
) -> DataFrame:
    """One return per order line (the first request), its order's refund spread by line ratio."""
    first = earliest_by(returns, list(line), [added])
    ratios = line_ratios(lines, order, amount, "line_ratio")
    joined = ratios.join(first, list(line)).join(refund, order, "left")
    return joined.withColumn(
        "refund_share", F.coalesce(F.col("refund").cast("double"), F.lit(0.0)) * F.col("line_ratio")
    )


def discount_keys(
    changed: DataFrame, deleted: DataFrame, errored: DataFrame, key: str
) -> DataFrame:
    """Keys of discounts to rebuild: changed, deleted since, and those that failed validation last time."""
    return reduce(lambda a, b: a.unionByName(b), [df.select(key) for df in (changed, deleted, errored)]).distinct()


def order_line_fact(keys: DataFrame | None, lines: DataFrame, orders: DataFrame, discounts: DataFrame) -> DataFrame:
    """Lines of the changed orders: their share of the order, each kind of discount, and the order's payments and credits spread by it.

    lines: order_id, line_id, gross, units; discounts: order_id, line_id, kind, amount; orders: order_id, paid_total, credit_total.
    """
    line = ["order_id", "line_id"]
    plan = key_plan(lines.select("order_id").unionByName(discounts.select("order_id")), ["order_id"])
    if plan.keys:
        mine = lambda df: only(df, keys, "order_id")
        base = line_ratios(mine(lines), "order_id", "gross", "line_share")
        off = mine(discounts).groupBy(*line).agg(F.sum("amount").alias("discount"), F.count_distinct("kind").alias("discount_kinds"))
        joined = join_keys(base, off, line, "left").fillna(0, ["discount", "discount_kinds"])
        joined = join_keys(joined, mine(orders).select("order_id", "paid_total", "credit_total"), ["order_id"], "left")
    else:
        parts = {"_lines": (lines, line), "_off": (discounts, line), "_orders": (orders.select("order_id", "paid_total", "credit_total"), ["order_id"])}
        sums = {"_orders": F.collect_list("_orders"), "_total": F.sum("_lines.gross"), "_n": F.count("_lines")}
        rows = together(parts, keys, sums, plan)
        # A kind counts where it stands first among its like.
        alike = Window.partitionBy(*line, "_off.kind").orderBy("_off.kind")
        first = rows.withColumn("_first", F.when(F.col("_off.kind").isNotNull(), (F.row_number().over(alike) == 1).cast("long")))
        own = with_totals(first, line, {"discount": F.sum("_off.amount"), "discount_kinds": F.sum("_first")}, plan)
        own = own.filter(F.col("_lines").isNotNull()).fillna(0, ["discount", "discount_kinds"])
        share = F.when(F.col("_of_total") == 0, F.lit(1.0) / F.col("_of_n")).otherwise(ratio("_lines.gross", "_of_total"))
        joined = own.select(*line, "_lines.*", share.alias("line_share"), "discount", "discount_kinds", F.explode_outer("_of_orders").alias("_o")).select("*", "_o.*").drop("_o")
    spread = lambda c: F.round(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.col("line_share"), 4)
    return joined.withColumns({"paid_share": spread("paid_total"), "credit_share": spread("credit_total"), "net": F.col("gross") - F.col("discount")})


def refund_fact(
    keys: DataFrame | None, refunds: DataFrame, returns: DataFrame, orders: DataFrame, vat: DataFrame, chargebacks: DataFrame,
    methods: dict[str, str],
) -> DataFrame:
    """Refunds of the changed keys with their return, order, VAT-free amounts, kind of money and chargeback.

    A return that several refunds name belongs to the latest of them. refunds: refund_id, order_id, method, product, shipping, tax,
    refunded_at; returns: refund_id, return_id, requested_at; orders: order_id, country, ordered_at.
    """
    mine = only(refunds, keys, "refund_id")
    named = latest_by(returns, ["return_id"], ["requested_at", "refund_id"]).select("refund_id", "return_id", "requested_at")
    first = only(latest_by(named, ["refund_id"], ["requested_at", "return_id"]), keys, "refund_id")
    joined = join_keys(mine, first, ["refund_id"], "left").join(orders.select("order_id", "country", "ordered_at"), "order_id", "left")
    rated = effective_lookup(joined, vat, ["country"], "ordered_at", "start_at", "end_at", ["vat_rate"])
    flagged = add_flag(chargebacks, "order_id", "is_chargeback")(rated)
    without = lambda c: F.round(F.col(c).cast("double") / (1 + F.coalesce("vat_rate", F.lit(0.0))), 4)
    kind = F.lit("Unknown")
    for method, name in methods.items():
        kind = F.when(F.lower(F.col("method")) == method, F.lit(name)).otherwise(kind)
    return flagged.withColumns({
        "return_id": F.coalesce("return_id", F.lit(-1)), "requested_at": F.coalesce("requested_at", "refunded_at"), "payment_kind": kind,
        "product_without_vat": without("product"), "shipping_without_vat": without("shipping"),
        "total_without_vat": F.round(without("product") + without("shipping"), 4),
    })


def load_credit_events(target: DataFrame | None, kinds: dict[str, DataFrame], columns: Sequence[str], changed: DataFrame | None, key: str) -> DataFrame:
    """The event fact after a run: all events of the changed credits are computed anew and replace the old ones."""
    events = credit_events({name: only(df, changed, key) for name, df in kinds.items()}, columns)
    if target is None:
        return events
    return replace_groups(target, changed.select(key), [key]).unionByName(events.select(*target.columns))


def credit_events(kinds: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Issue, redemption, cancellation and expiry rows as one event fact, numbered kinds in the given order."""
    parts = [
        df.select(*columns, F.lit(name).alias("credit_activity_type"), F.lit(i).alias("activity_rank"))
        for i, (name, df) in enumerate(kinds.items())
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def event_tables(
    raw: DataFrame,
    message_id: str,
    event: str,
    body: str,
    declared: dict[str, dict[str, str]],
    received: str,
    run_ts: Column,
    known: dict[str, DataFrame] | None = None,
    shard: str | None = None,
    home_brands: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """Raw event documents as one typed table per event.

    Copies of a message are reduced to the first received. Each event's document is flattened, declared columns are
    cast, the rest goes to the rescue column; new columns extend a known table, and rows merge by message id and place
    in the exploded list. ``shard`` names the column with the source's shard, which tells the country. The reduced stream is
    written once, partitioned by event, so each table reads its own part only.
    """
    if shard:
        raw = raw.withColumn("country", country_of_shard(shard, home_brands)).drop(shard)
    path = scratch_path(raw.sparkSession, "events")
    earliest_by(raw, [message_id], [received]).write.partitionBy(event).parquet(path)
    unique = raw.sparkSession.read.schema(raw.schema).parquet(path)
    out = {}
    for name, types in declared.items():
        flat = flatten_object(unique.filter(F.col(event) == name).drop(event), body, position="item_position")
        fixed = {message_id: dict(raw.dtypes)[message_id], "item_position": "int", received: dict(raw.dtypes)[received]}
        if shard:
            fixed["country"] = "string"
        typed = rescue(flat, {**fixed, **types})
        keys = [message_id, "item_position"]
        table = (known or {}).get(name)
        if table is not None:
            empty = typed.filter(F.lit(False))
            table = evolve(table, empty)
            typed = evolve(typed, table.filter(F.lit(False)).select(*[c for c in table.columns if not c.startswith("meta_")]))
        out[name] = insert_update(table, typed, keys, [received], run_ts, tie=[c for c in types if c in typed.columns])
    return out
