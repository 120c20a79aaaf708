"""Finite-state rules along an ordered key.

A rule with few states cannot always be written as a running sum, but what any stretch of rows does to the state is a small map from the
state before it to the state after it, and maps compose. So a key above ``hot_rows`` is cut into slices of its order; every slice reports its
map, the maps of a key are composed in order (one row per slice), and then every slice is walked from the state it begins in.
Smaller keys are walked directly. Rows stream through sorted partitions; a task holds one map.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.semantics import join_keys
from tidemart.operators.scan import HOT_ROWS, LISTED_KEYS, key_plan
from tidemart.operators.sweep import plain_values
from tidemart.session import SMALL_BYTES, input_bytes, settle

MOST_STATES = 256


def _tables(moves: Sequence[Sequence[int]], states: int) -> list[bytes]:
    """Each symbol's map as a translation table; a state that a symbol does not name stays."""
    for row in moves:
        if len(row) != states or not all(0 <= s < states for s in row):
            raise ValueError("each symbol needs a state from 0 on for each state")
    rest = bytes(range(states, MOST_STATES))
    return [bytes(row) + rest for row in moves]


def _walk(batches: Iterator[pa.RecordBatch], n: int, tables: list[bytes], initial: int, out: str) -> Iterator[pa.RecordBatch]:
    """Adds the state after each row; columns: n keys, ``_entry`` (null: ``initial``), ``_symbol`` (null: no move), the rest."""
    now, state = None, initial
    for batch in batches:
        states = []
        columns = [plain_values(batch.column(i)) for i in range(n + 2)]
        for *key, entry, symbol in zip(*columns, strict=True):
            if key != now:
                now, state = key, initial if entry is None else entry
            if symbol is not None:
                state = tables[symbol][state]
            states.append(state)
        arrays = [batch.column(i) for i in range(n + 2, batch.num_columns)]
        names = [f.name for f in list(batch.schema)[n + 2 :]]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(states, pa.int32())], names=[*names, out])


def _maps(batches: Iterator[pa.RecordBatch], n: int, tables: list[bytes], states: int) -> Iterator[pa.RecordBatch]:
    """keys, slice, map: what each run of equal keys and slice (the first n + 1 columns) does to every state."""
    now, held, names, kinds = None, b"", None, None
    same = bytes(range(states))

    def told(rows):
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array(c, k) for c, k in zip(columns, [*kinds, pa.binary()], strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[*names, "_map"])

    for batch in batches:
        kinds, names = [f.type for f in list(batch.schema)[: n + 1]], [f.name for f in list(batch.schema)[: n + 1]]
        done = []
        for *key, symbol in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != now:
                if now is not None:
                    done.append((*now, held))
                now, held = key, same
            if symbol is not None:
                held = held.translate(tables[symbol])
        if done:
            yield told(done)
    if now is not None:
        yield told([(*now, held)])


def _entries(batches: Iterator[pa.RecordBatch], n: int, initial: int) -> Iterator[pa.RecordBatch]:
    """The state each slice begins in, from the maps of a key in the order of its slices."""
    now, state = None, initial
    for batch in batches:
        entries = []
        for *key, _, held in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != now:
                now, state = key, initial
            entries.append(state)
            state = held[state]
        columns = [batch.column(i) for i in range(n + 1)]
        names = [f.name for f in list(batch.schema)[: n + 1]]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(entries, pa.int32())], names=[*names, "_entry"])


def state_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    symbol: Column,
    moves: Sequence[Sequence[int]],
    initial: int,
    out: str,
    hot_rows: int = HOT_ROWS,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Add the state after each row, in ascending ``order`` (total within a key).

    ``symbol`` numbers what a row says (null: nothing); ``moves[symbol][state]`` is the state after it.
    """
    keys, order, states = list(keys), list(order), len(moves[0])
    if states > MOST_STATES:
        raise ValueError(f"at most {MOST_STATES} states")
    tables = _tables(moves, states)
    n, named = len(keys), df.columns
    to = T.StructType([*df.schema.fields, T.StructField(out, T.IntegerType())])
    place = [f"_key{i}" for i in range(n)]

    def walked(rows: DataFrame, entry: Column, part: Column) -> DataFrame:
        runs = [*[F.col(k).alias(p) for k, p in zip(keys, place, strict=True)], part.alias("_part")]
        laid = rows.select(*runs, entry.alias("_entry"), "_symbol", *named)
        return laid.mapInArrow(lambda batches: _walk(batches, n + 1, tables, initial, out), to)

    def whole(rows: DataFrame) -> DataFrame:
        near = rows.repartition(*keys) if keys else rows.repartition(1)
        return walked(near.sortWithinPartitions(*keys, *order), F.lit(None).cast("int"), F.lit(0))

    marked = df.withColumn("_symbol", symbol.cast("int"))
    if input_bytes(df) <= small_bytes:
        return whole(marked)
    marked = settle(marked)
    plan = key_plan(marked, keys, hot_rows, -1)
    if not plan.keys:
        return whole(marked)
    if keys:
        hot = F.broadcast(plan.hot) if plan.keys <= LISTED_KEYS else plan.hot
        cold, large = join_keys(marked, hot.select(*keys), keys, "left_anti"), join_keys(marked, hot.select(*keys), keys, "left_semi")
    else:
        cold, large = marked.limit(0), marked
    slices = max(2, plan.rows // hot_rows + 1)
    cut = settle(large.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()))
    # A partition of the checkpoint is one slice, so this needs no shuffle.
    inside = cut.sortWithinPartitions(*keys, *order).select(*keys, "_slice", "_symbol")
    map_to = T.StructType([*cut.select(*keys, "_slice").schema.fields, T.StructField("_map", T.BinaryType())])
    maps = inside.mapInArrow(lambda batches: _maps(batches, n, tables, states), map_to)
    entry_to = T.StructType([*cut.select(*keys, "_slice").schema.fields, T.StructField("_entry", T.IntegerType())])
    together = (maps.repartition(*keys) if keys else maps.repartition(1)).sortWithinPartitions(*keys, "_slice")
    entries = settle(together.mapInArrow(lambda batches: _entries(batches, n, initial), entry_to))
    begun = join_keys(cut, entries, [*keys, "_slice"]).repartition(slices, "_slice").sortWithinPartitions("_slice", *keys, *order)
    sliced = walked(begun, F.col("_entry"), F.col("_slice"))
    return whole(cold).unionByName(sliced) if keys else sliced
