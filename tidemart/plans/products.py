"""Baskets, product attributes, rankings, segments and periods."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.semantics import join_keys, latest_by
from tidemart.operators.scan import Scan, dense_ranks, global_tiles, ordered_scan
from tidemart.session import dealt, reused


BLOCK = 1024
PAIR_SLOTS = 1 << 22
# Pairs that one cell of two blocks of items makes, and items of all lists that it holds, about.
CELL_PAIRS = 1 << 29
CELL_ITEMS = 8 << 20
# Pairs that are counted at a time within a cell, and the slots for them.
STEP_PAIRS = 1 << 18
STEP_SLOTS = 1 << 18


def _pairs(unique: DataFrame, by: Sequence[str], item: str, block: int, cell_pairs: int = CELL_PAIRS, least: int = 1) -> DataFrame:
    """Pairs ``item_a`` < ``item_b`` of every basket's distinct items with a weight ``w``; it is not yet summed where there is no ``_i``.

    Baskets of up to ``block`` items become lists; equal lists count once with their weight. Where there are larger baskets, items are dealt to
    blocks, the same in every basket, and pairs lie by the cell ``_i``, ``_j`` of their two blocks: a larger basket sends its blocks there, and the
    pairs between them are made and counted in the cell's task, a few items at a time, so a cell is bounded by the items it holds and blocks are
    few: every row is sent once for each block. Pairs of cells are in ``least`` baskets at least.
    """
    dims = by[:-1]
    sizes = unique.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    large = reused(sizes.filter(F.col("_n") > block))
    n = F.col("_n").cast("double")
    most, made = large.agg(F.max("_n"), F.sum(n * (n - 1) / 2)).first()
    plain = join_keys(unique, large, by, "left_anti") if most else unique
    lists = dealt(plain, *by).groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("set"))
    weighted = lists.groupBy(*dims, "set").agg(F.count(F.lit(1)).alias("w")).filter(F.size("set") > 1)
    firsts = weighted.select(*dims, "set", "w", F.posexplode("set").alias("i", "item_a"))
    pairs = firsts.select(*dims, "item_a", F.explode(F.expr("slice(set, i + 2, size(set))")).alias("item_b"), "w")
    if not most:
        return pairs
    rows = join_keys(unique, large.select(*by), by)
    held = large.agg(F.sum("_n")).first()[0]
    blocks = max(math.ceil(most / block), math.ceil(math.sqrt(2 * made / cell_pairs)), math.ceil(2 * held / CELL_ITEMS))
    tasks = max(int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks * (blocks + 1))  # two a cell, as cells are dealt by hash
    block_of = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    in_cells = lambda df: df.repartition(tasks, *dims, "_i", "_j")
    listed = rows.select(*by, item, block_of(item).alias("_b")).groupBy(*by, "_b").agg(F.collect_list(item).alias("_list"))
    beside = listed.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cells = in_cells(beside.select(*by, "_list", F.least("_b", "_o").alias("_i"), F.greatest("_b", "_o").alias("_j"), "_b"))
    mine = lambda c: F.first(F.when(F.col("_b") == F.col(c), F.col("_list")), ignorenulls=True)
    sides = cells.groupBy(*by, "_i", "_j").agg(mine("_i").alias("left"), mine("_j").alias("right")).filter("left IS NOT NULL AND right IS NOT NULL")
    one = F.lit(1).cast("long").alias("w")
    tiled = sides.select(*dims, "_i", "_j", "left", F.when(F.col("_i") != F.col("_j"), F.col("right")).alias("right"), one)
    # A pair of a smaller basket is a list of its own: two items of one block, or one of each of two.
    a, b = block_of("item_a"), block_of("item_b")
    swap, both = a > b, F.array("item_a", "item_b")
    left = F.when(a == b, both).when(swap, F.array("item_b")).otherwise(F.array("item_a"))
    right = F.when(a != b, F.when(swap, F.array("item_a")).otherwise(F.array("item_b")))
    small = in_cells(pairs.select(*dims, F.least(a, b).alias("_i"), F.greatest(a, b).alias("_j"), left.alias("left"), right.alias("right"), "w"))
    kind = unique.schema[item].dataType
    fields = [*[unique.schema[d] for d in dims], T.StructField("_i", T.IntegerType()), T.StructField("_j", T.IntegerType())]
    out = T.StructType([*fields, T.StructField("x", kind), T.StructField("y", kind), T.StructField("w", T.LongType())])

    def cell(table: pa.Table) -> pa.Table:
        return _cell(least, table)

    counted = small.unionByName(tiled).groupBy(*dims, "_i", "_j").applyInArrow(cell, out)
    return counted.select(*dims, "_i", "_j", F.least("x", "y").alias("item_a"), F.greatest("x", "y").alias("item_b"), "w")


def _cell(least: int, table: pa.Table) -> pa.Table:
    """Pairs of one cell with their weight, those of ``least`` at least; table: a row for each list of items, beside the list of the other block."""
    table = table.combine_chunks()
    names = [n for n in table.column_names if n not in ("left", "right", "w")]
    weight = table["w"].to_numpy()
    diagonal = table["right"].null_count == len(table)

    def coded(column):
        lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        codes = lists.flatten().dictionary_encode()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        return codes.indices.to_numpy().astype(np.int64), sizes, codes.dictionary

    left, left_sizes, left_items = coded(table["left"])
    right, right_sizes, right_items = (left, left_sizes, left_items) if diagonal else coded(table["right"])
    found = list(_counted(left, left_sizes, right, right_sizes, weight, least, diagonal))
    x, y, w = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    same = pa.array(np.zeros(len(x), np.int64))
    return pa.table([*[table[n].take(same) for n in names], left_items.take(pa.array(x)), right_items.take(pa.array(y)), pa.array(w)], names=[*names, "x", "y", "w"])


def _counted(
    left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray, weight: np.ndarray, least: int, diagonal: bool,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Counted pairs (left item, right item, weight) of lists that lie one behind the other; items are numbers from 0.

    Items of the left are taken in turn, as many as make ``STEP_PAIRS`` pairs, so what is held at a time does not grow with the pairs. Pairs are
    counted in hashed slots before they are sorted: a slot below ``least`` holds no pair that reaches it.
    """
    starts = np.cumsum(right_sizes) - right_sizes
    of = np.repeat(np.arange(len(left_sizes)), left_sizes)
    turn = np.argsort(left, kind="stable")
    left, of = left[turn], of[turn]
    made = right_sizes[of]
    upto = np.cumsum(made)
    others = int(right.max()) + 1 if len(right) else 0
    plain = bool((weight == 1).all())
    ends = np.append(np.flatnonzero(np.diff(left)) + 1, len(left)) if len(left) else np.zeros(0, np.int64)
    lo = 0
    while lo < len(left):
        base = upto[lo - 1] if lo else 0
        # The last item that ends within the step; one item that makes more is counted by itself, piece by piece.
        k = np.searchsorted(upto[ends - 1], base + STEP_PAIRS, side="right") - 1
        hi = int(ends[k]) if k >= 0 and ends[k] > lo else int(ends[np.searchsorted(ends, lo, side="right")])
        if upto[hi - 1] - base > STEP_PAIRS:
            total = np.zeros(others, np.int64)
            for r in range(lo, hi):
                total[right[starts[of[r]] : starts[of[r]] + made[r]]] += weight[of[r]]
            if diagonal:
                total[: left[lo] + 1] = 0
            y = np.flatnonzero(total >= max(least, 1))
            yield np.full(len(y), left[lo]), y, total[y]
        else:
            n = made[lo:hi]
            before = np.cumsum(n) - n
            y = right[np.arange(n.sum()) + np.repeat(starts[of[lo:hi]] - before, n)]
            x = np.repeat(left[lo:hi], n)
            w = None if plain else np.repeat(weight[of[lo:hi]], n)
            if diagonal:
                keep = x < y
                x, y, w = x[keep], y[keep], w if plain else w[keep]
            if least > 1:
                slot = (x * 40503 + y) & (STEP_SLOTS - 1)
                keep = (np.bincount(slot, w, STEP_SLOTS) >= least)[slot]
                x, y, w = x[keep], y[keep], w if plain else w[keep]
            pair, back, n = np.unique(x * others + y, return_inverse=True, return_counts=True)
            total = n if plain else np.bincount(back, w, len(pair)).astype(np.int64)
            keep = total >= least
            yield pair[keep] // max(others, 1), pair[keep] % max(others, 1), total[keep]
        lo = hi


def co_occurrence(
    items: DataFrame, basket: str, item: str, dims: Sequence[str] = (), min_baskets: int = 1, block: int = BLOCK, slots: int = PAIR_SLOTS
) -> DataFrame:
    """Number of baskets each unordered pair of items shares, per dimension of the basket; pairs in ``min_baskets`` at least.

    With a minimum, items that are in fewer baskets go first. Pairs of larger baskets lie by cells and are counted where they are made; others
    are, with a minimum, counted in hashed slots before they are counted themselves: a slot below the minimum holds no pair that reaches it. The
    counts are exact either way.
    """
    by = [*dims, basket]
    unique = dealt(items.select(*by, item).filter(F.col(item).isNotNull()), *by, item).distinct()
    total = F.sum("w").alias("baskets")
    if min_baskets > 1:
        known = unique.groupBy(*dims, item).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_baskets)
        unique = reused(join_keys(unique, known, [*dims, item], "left_semi"))
    pairs = _pairs(unique, by, item, block, least=min_baskets)
    if "_i" in pairs.columns:
        return pairs.select(*dims, "item_a", "item_b", F.col("w").alias("baskets"))
    if min_baskets > 1:
        pairs = pairs.withColumn("_slot", F.pmod(F.xxhash64("item_a", "item_b"), F.lit(slots)))
        full = pairs.groupBy(*dims, "_slot").agg(total).filter(F.col("baskets") >= min_baskets)
        pairs = join_keys(pairs, full, [*dims, "_slot"], "left_semi")
    return pairs.groupBy(*dims, "item_a", "item_b").agg(total).filter(F.col("baskets") >= min_baskets)


def combination_label(flags: dict[str, Column]) -> Column:
    """Names of the flags that hold, joined by ' + '."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in flags.items()])), " + ")


def preferred_member(df: DataFrame, group: Sequence[str], preference: Sequence[Column], pick: str, out: str) -> DataFrame:
    """Member of each group that comes first in the preference order, on every row of the group."""
    best = df.groupBy(*group).agg(F.min_by(pick, F.struct(*preference)).alias(out))
    return join_keys(df, best, group)


def group_list(df: DataFrame, group: Sequence[str], member: str, out: str) -> DataFrame:
    """Sorted distinct members of the group as text, on every row (a list aggregate as a window)."""
    listed = df.select(*group, member).distinct().groupBy(*group).agg(
        F.array_join(F.array_sort(F.collect_list(member)), ", ").alias(out)
    )
    return join_keys(df, listed, group)


def top_k_other(
    df: DataFrame, grain: Sequence[str], member: str, amounts: Sequence[str], k: int, separator: str = "|", other: str = "Other Grouping"
) -> DataFrame:
    """All amounts summed over the k best members per grain by the first amount (ties share a rank), the rest as one row.

    A member made of a single name, without the separator, keeps its row whatever its rank; an empty name never does.
    """
    totals = df.groupBy(*grain, member).agg(*[F.sum(a).alias(a) for a in amounts])
    ranked = dense_ranks(totals, grain, amounts[0], "r")
    keep = ((F.col("r") <= k) | ~F.col(member).contains(separator)) & (F.col(member) != "")
    named = ranked.withColumn(member, F.when(keep, F.col(member)).otherwise(F.lit(other)))
    return named.groupBy(*grain, member).agg(*[F.sum(a).alias(a) for a in amounts])


def rfm(orders: DataFrame, customer: str, moment: str, amount: str, as_of: Column, tiles: int = 10) -> DataFrame:
    """Recency, frequency and value per customer, the value as a tile over all customers, and a segment."""
    facts = orders.groupBy(customer).agg(
        F.datediff(F.to_date(as_of), F.to_date(F.max(moment))).cast("long").alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(amount).alias("value"),
    )
    tiled = global_tiles(facts, ["value", customer], tiles, "value_tile")
    segment = (
        F.when((F.col("value_tile") >= tiles - 1) & (F.col("recency_days") <= 180), "champion")
        .when(F.col("value_tile") >= tiles - 1, "lapsed top")
        .when(F.col("recency_days") <= 180, "active")
        .otherwise("dormant")
    )
    return tiled.withColumn("segment", segment)


def path_levels(c: Column, separator: str, levels: int) -> list[Column]:
    """Levels of a category path; missing levels are NULL."""
    parts = F.transform(F.split(c, "\\Q" + separator + "\\E"), lambda p: F.trim(p))
    return [F.get(parts, F.lit(i)).alias(f"level_{i + 1}") for i in range(levels)]


def reactivations(events: DataFrame, customer: str, moment: str, kind: str, cancel: str, activate: str) -> DataFrame:
    """First cancellation per customer and the first activation after it."""
    first = events.filter(F.col(kind) == cancel).groupBy(customer).agg(F.min(moment).alias("first_cancel"))
    later = events.filter(F.col(kind) == activate).join(first, customer).filter(F.col(moment) > F.col("first_cancel"))
    again = later.groupBy(customer).agg(F.min(moment).alias("next_activation"))
    return first.join(again, customer, "left")


def event_periods(
    events: DataFrame, user: str, moment: str, kind: str, tie: str, joins: Sequence[str], cancel: str, open_end: Column
) -> DataFrame:
    """Join events as periods: up to the user's next event if that is a cancel, otherwise open."""
    chosen = events.filter(F.col(kind).isin(*joins, cancel))
    scanned = ordered_scan(
        chosen, [user], [moment, tie], [Scan("next_kind", "lead", kind), Scan("next_moment", "lead", moment)]
    )
    return scanned.filter(F.col(kind) != cancel).select(
        user,
        F.col(moment).alias("start_at"),
        F.when(F.col("next_kind") == cancel, F.col("next_moment")).otherwise(open_end).alias("end_at"),
    )


def audit_extract(
    base: DataFrame, condition: Column, dependants: dict[str, tuple[DataFrame, str, str]]
) -> dict[str, DataFrame]:
    """Bounded subset of a table and, by semi join, of the tables that refer to it."""
    chosen = base.filter(condition)
    out = {"base": chosen}
    for name, (df, own, theirs) in dependants.items():
        out[name] = df.join(chosen.select(F.col(theirs).alias(own)), own, "left_semi")
    return out


def legacy_union(old: DataFrame, new: DataFrame, codes: dict[str, str], code_col: str, id_col: str) -> DataFrame:
    """Rows of a retired platform with those of its successor, whose event codes and ids are mapped back."""
    from tidemart.functions.text import without_company

    chain = F.col(code_col)
    for new_code, old_code in codes.items():
        chain = F.when(F.col(code_col) == new_code, F.lit(old_code)).otherwise(chain)
    mapped = new.withColumn(code_col, chain).withColumn(id_col, without_company(id_col))
    return old.withColumn("platform", F.lit("legacy")).unionByName(
        mapped.withColumn("platform", F.lit("current")), allowMissingColumns=True
    )


def latest_metadata(df: DataFrame, entity: Sequence[str], order: Sequence[str]) -> DataFrame:
    return latest_by(df, entity, order)
