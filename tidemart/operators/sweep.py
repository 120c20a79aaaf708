"""Which of several overlapping versions holds at each moment, by one sweep over the bounds of a key.

The state of the sweep is a stack of open versions in the order of their starts: the top holds until it ends or a later one starts, and what
it covered comes back when it goes. A key above ``hot_rows`` bounds is cut into slices of its time line, each swept alone. Versions
that start or end in a slice are there anyway; of those that cover a slice from end to end only the one that started last can hold in it, and
it is found by maxima over the nodes of a binary tree of slices. So no key is one task, and no bound is paired with versions.

``held_versions`` gives the times alone; ``cut_versions`` takes whole rows along, so that nothing is joined to them afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.semantics import join_keys
from tidemart.operators.scan import LISTED_KEYS, Scan, key_plan, ordered_scan
from tidemart.session import SMALL_BYTES, input_bytes, settle

# Bounds of one key that a task sweeps at once; they are held in Python.
HOT_BOUNDS = 500_000


def plain_values(column: pa.Array) -> list:
    """Values that compare fast: moments as numbers."""
    if pa.types.is_timestamp(column.type):
        return column.cast(pa.int64()).to_pylist()
    if pa.types.is_date32(column.type):
        return column.cast(pa.int32()).to_pylist()
    return column.to_pylist()


def typed_array(values: Sequence, kind: pa.DataType) -> pa.Array:
    """The way back from ``plain_values``."""
    if pa.types.is_timestamp(kind):
        return pa.array(values, pa.int64()).cast(kind)
    if pa.types.is_date32(kind):
        return pa.array(values, pa.int32()).cast(kind)
    return pa.array(values, kind)


def swept(bounds: list[tuple]) -> Iterator[tuple]:
    """(moment, until, start, stop) of the version that holds from each bound on, or of none, where that changes.

    bounds: (moment, start, stop) of one key in the order of moments, of which a version has one at its start and one at its stop; those of
    versions that hold from before come without their start, and one without any bound here has the moment None.
    """
    first = next((at for at, _, _ in bounds if at is not None), None)
    if first is None:
        return
    starting = sorted({(start, stop) for at, start, stop in bounds if at == start}, reverse=True)
    stack = sorted({(start, stop) for at, start, stop in bounds if start < first})
    begun, holder = None, None
    for at in sorted({at for at, _, _ in bounds if at is not None}):
        while starting and starting[-1][0] <= at:
            stack.append(starting.pop())
        while stack and stack[-1][1] <= at:
            stack.pop()
        now = stack[-1] if stack else None
        if begun is None:
            begun, holder = at, now
        elif now != holder:
            yield (begun, at, *(holder or (None, None)))
            begun, holder = at, now
    yield (begun, None, *(holder or (None, None)))


def _sweep(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows of n key columns, slice, moment, start, stop in order of keys, slice and moment; the key columns and slice stay in front."""
    now, bounds, kinds, names = None, [], None, None

    def close():
        return [(*now, *change) for change in swept(bounds)]

    def batch_of(rows):
        columns = [typed_array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        if kinds is None:
            fields = list(batch.schema)
            kinds = [*[f.type for f in fields[: n + 1]], *[fields[n + 1].type] * 4]
            names = [*[f.name for f in fields[: n + 1]], "_at", "_until", fields[n + 2].name, fields[n + 3].name]
        done = []
        for row in zip(*[plain_values(c) for c in batch.columns], strict=True):
            if row[: n + 1] != now:
                if now is not None:
                    done += close()
                now, bounds = row[: n + 1], []
            bounds.append(row[n + 1 :])
        if done:
            yield batch_of(done)
    if now is not None and (done := close()):
        yield batch_of(done)


def _run(rows: DataFrame, keys: list[str], start: str, stop: str) -> DataFrame:
    """One sweep per (key, slice); rows lie together by slice and in order."""
    kind = rows.schema["_at"].dataType
    out = T.StructType([*rows.select(*keys, "_slice").schema.fields, *[T.StructField(c, kind) for c in ("_at", "_until", start, stop)]])
    return rows.select(*keys, "_slice", "_at", start, stop).mapInArrow(lambda batches: _sweep(batches, len(keys)), out)


def spans(line: Sequence[tuple], starts: Sequence, stops: Sequence) -> Iterator[tuple]:
    """(row, moment, until) of the times at which the version in a row holds; rows come in the order of key, start and stop.

    The stack has the open versions that can hold again: the later one started, the earlier it stops.
    """
    now, stack, at = None, [], None
    for i, (key, start, stop) in enumerate(zip(line, starts, stops, strict=True)):
        if stack and key != now:
            while stack:
                yield stack[-1], at, stops[stack[-1]]
                at = stops[stack.pop()]
        now = key
        while stack and stops[stack[-1]] <= start:
            yield stack[-1], at, stops[stack[-1]]
            at = stops[stack.pop()]
        if stack and at < start:
            yield stack[-1], at, start
        while stack and stops[stack[-1]] <= stop:
            stack.pop()
        stack.append(i)
        at = start
    while stack:
        yield stack[-1], at, stops[stack[-1]]
        at = stops[stack.pop()]


def _cut(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows in order of keys and of their bounds ``_at`` and ``_until``, which become the times at which a row holds."""
    parts, line, starts, stops = [], [], [], []

    def close() -> Iterator[pa.RecordBatch]:
        if not (found := list(spans(line, starts, stops))):
            return
        rows, at, until = zip(*found, strict=True)
        taken = pa.Table.from_batches(parts).take(pa.array(rows, pa.int64()))
        for name, values in (("_at", at), ("_until", until)):
            place = taken.schema.get_field_index(name)
            taken = taken.set_column(place, taken.schema.field(place), typed_array(values, taken.schema.types[place]))
        yield from taken.to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        own = list(zip(*[plain_values(batch.column(k)) for k in keys], strict=True)) if keys else [()] * batch.num_rows
        at, until = plain_values(batch.column("_at")), plain_values(batch.column("_until"))
        # The last key may go on in the next batch.
        last = len(own) - 1
        while last and own[last - 1] == own[-1]:
            last -= 1
        if last or (line and line[-1] != own[-1]):
            parts.append(batch.slice(0, last))
            line, starts, stops = line + own[:last], starts + at[:last], stops + until[:last]
            yield from close()
            parts, line, starts, stops = [], [], [], []
        parts.append(batch.slice(last))
        line += own[last:]
        starts += at[last:]
        stops += until[last:]
    yield from close()


def cut_versions(versions: DataFrame, keys: Sequence[str], start: str, stop: str) -> DataFrame:
    """Each version once for every time at which it holds, from ``_at`` until ``_until``; one pass over the versions of a key.

    Which version holds is as in ``held_versions``; of equal bounds one version stands for all, the same in every run.
    """
    keys, given = list(keys), [c for c in versions.columns if c != stop]
    moment = versions.select(F.coalesce(start, stop).alias("_at")).schema["_at"].dataType
    placed = versions.repartition(*keys) if keys else versions.repartition(1)
    ordered = placed.sortWithinPartitions(*keys, start, stop, F.xxhash64(*given))
    rows = ordered.select("*", F.col(start).cast(moment).alias("_at"), F.col(stop).cast(moment).alias("_until"))
    return rows.mapInArrow(lambda batches: _cut(batches, keys), rows.schema)


def _covers(versions: DataFrame, keys: list[str], start: str, stop: str, levels: int) -> DataFrame:
    """Per node of the slice tree the version that started last among those whose slices strictly inside make up the node.

    versions: keys, start, stop and the slices ``_a``, ``_b`` of both bounds.
    """
    begin = F.struct((F.col("_a") + 1).alias("lo"), F.col("_b").alias("hi"), F.array().cast("array<struct<level:int,node:int>>").alias("nodes"))

    def step(acc, level):
        odd = lambda c: (c % 2 == 1) & (acc["lo"] < acc["hi"])
        lo, hi = acc["lo"], acc["hi"]
        node = lambda at: F.array(F.struct(level.cast("int").alias("level"), at.cast("int").alias("node")))
        none = F.array().cast("array<struct<level:int,node:int>>")
        left, right = F.when(odd(lo), node(lo)).otherwise(none), F.when(odd(hi), node(hi - 1)).otherwise(none)
        lo2, hi2 = F.when(odd(lo), lo + 1).otherwise(lo), F.when(odd(hi), hi - 1).otherwise(hi)
        return F.struct(F.floor(lo2 / 2).cast("int").alias("lo"), F.floor(hi2 / 2).cast("int").alias("hi"), F.concat(acc["nodes"], left, right).alias("nodes"))

    nodes = F.aggregate(F.sequence(F.lit(0), F.lit(levels)), begin, step, lambda acc: acc["nodes"])
    each = versions.filter(F.col("_b") - F.col("_a") >= 2).select(*keys, F.struct(start, stop).alias("_v"), F.explode(nodes).alias("_n"))
    return each.groupBy(*keys, F.col("_n.level").alias("_level"), F.col("_n.node").alias("_node")).agg(F.max("_v").alias("_v"))


def _sliced(versions: DataFrame, keys: list[str], start: str, stop: str, slices: int) -> DataFrame:
    events = versions.select(*keys, start, stop, F.explode(F.array(start, stop)).alias("_at"))
    # The slice number comes from the range partitioner, so it is fixed with a checkpoint before it is used twice.
    cut = settle(events.repartitionByRange(slices, *keys, "_at").withColumn("_slice", F.spark_partition_id()))
    levels = max(1, (slices + 1).bit_length())
    ends = cut.groupBy(*keys, start, stop).agg(F.min("_slice").alias("_a"), F.max("_slice").alias("_b"))
    covers = _covers(ends, keys, start, stop, levels)
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_level")
    places = cut.select(*keys, "_slice").distinct().select(*keys, "_slice", level)
    places = places.withColumn("_node", F.floor(F.col("_slice") / F.pow(F.lit(2), F.col("_level"))).cast("int"))
    above = join_keys(places, covers, [*keys, "_level", "_node"]).groupBy(*keys, "_slice").agg(F.max("_v").alias("_v"))
    carried = above.select(*keys, "_slice", F.lit(None).cast(cut.schema["_at"].dataType).alias("_at"), F.col("_v")[start].alias(start), F.col("_v")[stop].alias(stop))
    rows = cut.select(*keys, "_slice", "_at", start, stop).unionByName(carried).repartition(slices, "_slice")
    changes = _run(rows.sortWithinPartitions(*keys, "_slice", "_at"), keys, start, stop).drop("_until", "_slice")
    # At the begin of a slice the holder may be the one that held before.
    boxed = changes.withColumn("_h", F.struct(start, stop))
    lagged = ordered_scan(boxed, keys, ["_at"], [Scan("_prev", "lag", "_h")])
    moved = lagged.filter(~F.col("_prev").eqNullSafe(F.col("_h"))).drop("_prev", "_h")
    return ordered_scan(moved, keys, ["_at"], [Scan("_until", "lead", "_at")])


def held_versions(
    versions: DataFrame, keys: Sequence[str], start: str, stop: str, hot_rows: int = HOT_BOUNDS, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """keys, start, stop, _at, _until: from which moment until which each version holds.

    Versions are half-open, with start < stop; the one that started last holds, of equal starts the one that ends last. Versions of equal
    bounds are one. Moments without a version have no row.
    """
    keys = list(keys)
    unique = versions.select(*keys, start, stop).distinct()
    plan = None
    if input_bytes(versions) > small_bytes:
        unique = settle(unique)
        plan = key_plan(unique, keys, max(1, hot_rows // 2), -1)

    def whole(part: DataFrame) -> DataFrame:
        events = part.select(*keys, F.lit(0).alias("_slice"), F.explode(F.array(start, stop)).alias("_at"), start, stop)
        placed = events.repartition(*keys) if keys else events.repartition(1)
        return _run(placed.sortWithinPartitions(*keys, "_at"), keys, start, stop).drop("_slice")

    if plan is None or not plan.keys:
        out = whole(unique)
    else:
        slices = max(2, 2 * plan.rows // hot_rows + 1)
        if not keys:
            out = _sliced(unique, keys, start, stop, slices).select(*whole(unique).columns)
        else:
            hot = F.broadcast(plan.hot) if plan.keys <= LISTED_KEYS else plan.hot
            cold = whole(join_keys(unique, hot.select(*keys), keys, "left_anti"))
            out = cold.unionByName(_sliced(join_keys(unique, hot.select(*keys), keys, "left_semi"), keys, start, stop, slices))
    return out.filter(F.col(start).isNotNull()).select(*keys, start, stop, "_at", "_until")
