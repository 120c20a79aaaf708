"""Visits and other per-key event logic whose state runs along the time line."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.semantics import row_count
from tidemart.operators.scan import HOT_ROWS, LISTED_KEYS, Scan, hot_keys, key_plan, ordered_scan
from tidemart.session import SMALL_BYTES, input_bytes, settle

VISIT_SECONDS = 300


def islands(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], gap_seconds: int, out: str, **limits) -> DataFrame:
    """Number runs of events whose neighbours are closer than the gap (plain gap sessionisation)."""
    limits = {"plan": key_plan(df, keys, **limits), **limits}
    lagged = ordered_scan(df, keys, [ts, *order], [Scan("_prev", "lag", ts)], **limits)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    wide = F.col("_prev").isNull() | (micros(ts) - micros("_prev") >= gap_seconds * 1_000_000)
    marked = lagged.withColumn("_start", wide.cast("long"))
    return ordered_scan(marked, keys, [ts, *order], [Scan(out, "sum", "_start")], **limits).drop("_prev", "_start")


def _known(key) -> list:
    """Key values with NULL as None, so that NULL equals NULL."""
    return [None if pd.isna(v) else v for v in key]


def _fold_runs(keyed: DataFrame, run: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """Mark visit starts. A run that is shorter than a visit has one, its first event, and stays in generated code.

    Longer runs are streamed over sorted partitions in constant memory; from one start the next is found by a search, not event by event.
    """
    own = Window.partitionBy(*run)
    named = keyed.columns
    spans = keyed.withColumns({
        "_span": F.coalesce(F.max("_at").over(own) - F.min("_at").over(own), F.lit(0)),
        "is_first": F.row_number().over(own.orderBy(*order)) == 1,
    })
    short = spans.filter(F.col("_span") < limit).drop("_span")
    schema = T.StructType([*keyed.schema.fields, T.StructField("is_first", T.BooleanType())])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, start = None, 0
        for pdf in batches:
            at, flags = pdf["_at"].to_numpy(), np.zeros(len(pdf), dtype=bool)
            moved = np.zeros(len(pdf), dtype=bool)
            for c in run:
                now, before = pdf[c], pdf[c].shift()
                moved |= ((now != before) & ~(now.isna() & before.isna())).to_numpy(dtype=bool, na_value=False)
            begins = np.flatnonzero(moved)
            for begin, end in zip([0, *begins[begins > 0]], [*begins[begins > 0], len(pdf)], strict=True):
                who = _known(pdf[c].iloc[begin] for c in run)
                i = begin if who != last else begin + np.searchsorted(at[begin:end], start + limit, "left")
                last = who
                while i < end:
                    flags[i], start = True, at[i]
                    i = i + np.searchsorted(at[i:end], start + limit, "left")
            yield pdf.assign(is_first=flags)

    long = spans.filter(F.col("_span") >= limit).select(*named)
    folded = long.repartition(*run).sortWithinPartitions(*run, *order).mapInPandas(fold, schema)
    return short.select(*named, "is_first").unionByName(folded)


def _fold_long_runs(keyed: DataFrame, run: Sequence[str], order: Sequence[str], limit: int, slices: int) -> DataFrame:
    """Mark visit starts in runs too long for one task.

    A run is cut into slices of bounded size. For each slice, the last visit start is worked out for every event its
    first visit could begin with: those of one visit length from its begin, and the one after. Walking these tables gives the
    visit open at the begin of each slice, and with it every slice is marked on its own.
    """
    cut = settle(keyed.repartitionByRange(slices, *run, *order).withColumn("_slice", F.spark_partition_id()))
    piece = [*run, "_slice"]
    kinds = {f.name: f for f in cut.schema.fields}

    def moves(pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(pdf["_at"].to_numpy())
        following = np.searchsorted(at, at + limit, "left")
        end = np.where(following < len(at), following, np.arange(len(at)))
        while not np.array_equal(end[end], end):
            end = end[end]
        possible = np.searchsorted(at, at[0] + limit, "right") + 1
        begins, ends = at[:possible], at[end[:possible]]
        # Neighbours with one result are one entry, named by the last of them.
        kept = np.append(ends[1:] != ends[:-1], True)
        table = pd.DataFrame({"_low": at[0], "_begin": begins[kept], "_end": ends[kept]})
        return table.assign(**{c: pdf[c].iloc[0] for c in piece})[[*piece, "_low", "_begin", "_end"]]

    marks = [T.StructField(c, T.LongType()) for c in ("_low", "_begin", "_end")]
    tables = cut.groupBy(*piece).applyInPandas(moves, T.StructType([*[kinds[c] for c in piece], *marks]))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, place, start, done = None, None, 0, True
        for pdf in batches:
            out = []
            for *who, number, low, begin, end in pdf.itertuples(index=False, name=None):
                who = _known(who)
                if who != last:
                    last, place, start = who, None, low - limit
                if number != place:
                    place, done = number, False
                    out.append((*who, number, start))
                if not done and begin >= start + limit:
                    start, done = end, True
            yield pd.DataFrame(out, columns=[*piece, "_entry"])

    entry_schema = T.StructType([*[kinds[c] for c in piece], T.StructField("_entry", T.LongType())])
    entries = tables.repartition(*run).sortWithinPartitions(*piece, "_begin").mapInPandas(walk, entry_schema)
    schema = T.StructType([*keyed.schema.fields, T.StructField("is_first", T.BooleanType())])
    names = keyed.columns

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order)).reset_index(drop=True)
        at, flags = pdf["_at"].to_numpy(), np.zeros(len(pdf), dtype=bool)
        i = np.searchsorted(at, pdf["_entry"].iloc[0] + limit, "left")
        while i < len(at):
            flags[i] = True
            i = np.searchsorted(at, at[i] + limit, "left")
        return pdf[names].assign(is_first=flags)

    on = F.col("c._slice") == F.col("e._slice")
    for c in run:
        on = on & F.col(f"c.{c}").eqNullSafe(F.col(f"e.{c}"))
    placed = cut.alias("c").join(entries.alias("e"), on).select("c.*", "e._entry")
    return placed.groupBy(*piece).applyInPandas(mark, schema)


def visit_count(
    df: DataFrame,
    visitor: str,
    ts: str,
    event_key: str,
    carry: Sequence[str] = (),
    visit_seconds: int = VISIT_SECONDS,
    hot_rows: int = HOT_ROWS,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Visits that last a fixed time from their first event: a later event opens the next visit.

    The rule needs state, but a pause of the full length always opens a visit. So events are first cut into runs at
    such pauses (a distributed scan), and only runs are folded; runs of more than ``hot_rows`` events in slices.
    A count over visit starts then numbers the visits.
    """
    limits = {"hot_rows": hot_rows, "small_bytes": small_bytes}
    run, order, limit = [visitor, "_run"], [ts, event_key], visit_seconds * 1_000_000
    cut = islands(df, [visitor], ts, [event_key], visit_seconds, "_run", **limits)
    keyed = cut.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    opened = None
    if input_bytes(df) > small_bytes:
        keyed = settle(keyed)
        long_runs = settle(hot_keys(keyed, run, hot_rows))
        found = long_runs.agg(row_count().alias("n"), F.sum("_rows").alias("rows")).first()
        if found["n"]:
            same = F.col("k._run") == F.col("h._run")
            same = same & F.col(f"k.{visitor}").eqNullSafe(F.col(f"h.{visitor}"))
            listed = F.broadcast(long_runs) if found["n"] <= LISTED_KEYS else long_runs
            every, long = keyed.alias("k"), listed.alias("h")
            slices = max(2, found["rows"] // hot_rows + 1)
            opened = _fold_runs(every.join(long, same, "left_anti"), run, order, limit).unionByName(
                _fold_long_runs(every.join(long, same, "left_semi"), run, order, limit, slices)
            )
    opened = (opened or _fold_runs(keyed, run, order, limit)).withColumn("_one", F.col("is_first").cast("long"))
    begin = F.struct(F.col(event_key).alias("k"), F.col(ts).alias("t"), *[F.col(c).alias(f"c_{c}") for c in carry])
    opened = opened.withColumn("_begin", F.when(F.col("is_first"), begin))
    plan = key_plan(df, [visitor], **limits)
    numbered = ordered_scan(
        opened,
        [visitor],
        order,
        [Scan("visit_count", "sum", "_one"), Scan("_visit", "fill", "_begin"), Scan("_rn", "number")],
        **limits,
        plan=plan,
    )
    first_rn = numbered.withColumn("_first_rn", F.when(F.col("is_first"), F.col("_rn")))
    placed = ordered_scan(first_rn, [visitor], order, [Scan("_open_rn", "fill", "_first_rn")], **limits, plan=plan)
    return placed.select(
        *df.columns,
        "is_first",
        "visit_count",
        (F.col("_rn") - F.col("_open_rn") + 1).alias("visit_seq"),
        F.col("_visit.k").alias("start_key"),
        F.col("_visit.t").alias("visit_start_datetime"),
        *[F.col(f"_visit.c_{c}").alias(f"visit_{c}") for c in carry],
    )


def visit_channel(df: DataFrame, visit: Sequence[str], order: Sequence[str], channel: str, own: str, out: str, **limits) -> DataFrame:
    """First channel of the visit so far that is not the brand's own site."""
    foreign = df.withColumn("_foreign", F.when(F.col(channel) != own, F.struct(F.col(channel).alias("v"))))
    ranked = ordered_scan(foreign, visit, order, [Scan("_rn", "number")], **limits)
    first = (
        ranked.filter(F.col("_foreign").isNotNull())
        .groupBy(*visit)
        .agg(F.min_by(F.col(channel), F.col("_rn")).alias("_v"), F.min("_rn").alias("_at"))
    )
    return ranked.join(first, list(visit), "left").select(
        *df.columns, F.when(F.col("_rn") >= F.col("_at"), F.col("_v")).alias(out)
    )


def effective_customer(df: DataFrame, visitor: str, order: Sequence[str], customer: str, out: str, **limits) -> DataFrame:
    """Last known customer for rows without one; NULL for rows that know their customer."""
    filled = ordered_scan(df, [visitor], order, [Scan("_known", "fill", customer)], **limits)
    return filled.select(*df.columns, F.when(F.col(customer).isNull(), F.col("_known")).alias(out))


def clamped_balance(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, out: str, **limits) -> DataFrame:
    """Running balance that never falls below 0, each clamp feeding the rows after it.

    Closed form: with S the plain running total, the balance is S less its lowest value so far (0 at most).
    """
    limits = {"plan": key_plan(df, keys, **limits), **limits}
    summed = ordered_scan(df, keys, order, [Scan("_s", "sum", amount)], **limits)
    lowest = ordered_scan(summed, keys, order, [Scan("_low", "min", "_s")], **limits)
    zero = F.lit(0).cast(dict(summed.dtypes)["_s"])
    return lowest.select(*df.columns, (F.col("_s") - F.least(zero, F.col("_low"))).alias(out))


def sequential_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], step, initial, out: str, out_type: str) -> DataFrame:
    """Generic state along an ordered key: ``step(state, row) -> state``, the state after each row as a column.

    Rows arrive in sorted batches and only the state is kept, so the memory of a task does not grow with a key. One task walks a
    key from end to end: a rule that is any function of the state cannot be cut. Rules with a closed form or a summary
    per slice (``clamped_balance``, ``ordered_scan``, ``visit_count``) have operators of their own that split hot keys; use those.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T._parse_datatype_string(out_type))])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, initial
        for pdf in batches:
            states = []
            for row in pdf.itertuples(index=False):
                key = _known(getattr(row, k) for k in keys)
                if key != last:
                    last, state = key, initial
                state = step(state, row)
                states.append(state)
            yield pdf.assign(**{out: states})

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(fold, schema)
