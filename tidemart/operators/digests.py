"""Comparison of two tables by digests of key ranges.

The rows of a range add up to an order-free digest: their number and two sums of row hashes. Ranges whose digests agree are done; only ranges
that differ are cut finer, and only their rows are read again. At the end the rows of what still differs, and no others, are
compared exactly, with copies. A digest is reduced to one row per range before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys, row_count

FAN_BITS = 8
HASH_BITS = 40
# Differing ranges are a list on the driver up to this length; where more differ, finer digests would not save anything.
LISTED = 2_000
LEAF_ROWS = 1_000_000


@dataclass(frozen=True)
class Difference:
    """``rows``: key, columns and copies (above 0: only in the first table so often, below 0: only in the second). The rest tells how it was found."""

    rows: DataFrame
    levels: int
    ranges: int
    rows_compared: int


def row_marks(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row in which a null is a value of its own."""
    parts = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(*parts), F.xxhash64(*parts, F.lit("second"))


def range_digests(df: DataFrame, place: Column, columns: Sequence[str]) -> DataFrame:
    """_range, n, a, b of the rows at each place."""
    one, two = row_marks(columns)
    wide = lambda c: F.sum(c.cast("decimal(20,0)").cast("decimal(38,0)"))
    return df.groupBy(place.alias("_range")).agg(row_count().alias("n"), wide(one).alias("a"), wide(two).alias("b"))


def _place(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[Column, int, int | None]:
    """Where a row stands (null keys: -1), the bits of places, and the least key if places follow the key itself."""
    kinds = {dict(df.dtypes)[k] for df in (a, b) for k in keys}
    if len(keys) == 1 and kinds <= {"tinyint", "smallint", "int", "bigint"}:
        ends = [df.agg(F.min(keys[0]), F.max(keys[0])).first() for df in (a, b)]
        known = [e for e in ends if e[0] is not None]
        low, high = (min(e[0] for e in known), max(e[1] for e in known)) if known else (0, 0)
        if high - low < 1 << 62:
            return F.coalesce(F.col(keys[0]).cast("long") - F.lit(low), F.lit(-1)), max(1, (high - low).bit_length()), low
    # The same hash in both tables, whatever the types: keys are compared as they would join.
    return F.shiftrightunsigned(F.xxhash64(*[F.col(k).cast("string") for k in keys]), 64 - HASH_BITS), HASH_BITS, None


def _within(df: DataFrame, keys: Sequence[str], place: Column, low: int | None, shift: int, ranges: list[int]) -> DataFrame:
    """The rows of some ranges. Ranges of a key itself are conditions on the column, which reach the scan."""
    runs: list[list[int]] = []
    for r in sorted(ranges):
        if runs and r == runs[-1][1] + 1 and r > 0:
            runs[-1][1] = r
        else:
            runs.append([r, r])
    if len(runs) > 100:
        listed = df.sparkSession.createDataFrame([(r,) for r in ranges], "_range long")
        marked = df.withColumn("_range", F.shiftright(place, shift))
        return marked.join(F.broadcast(listed), "_range", "left_semi").drop("_range")
    chosen = F.lit(False)
    for first, last in runs:
        begin, end = first << shift, ((last + 1) << shift) - 1
        if first < 0:
            chosen = chosen | F.col(keys[0]).isNull()
        elif low is not None:
            chosen = chosen | F.col(keys[0]).between(low + begin, low + end)
        else:
            chosen = chosen | place.between(begin, end)
    return df.filter(chosen)


def table_difference(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, leaf_rows: int = LEAF_ROWS, listed: int = LISTED) -> Difference:
    """What rows of ``keys`` and ``columns`` (default: all others of ``a``) two tables do not share, by descending into differing key ranges.

    Columns of different types are compared as the first table has them.
    """
    keys = list(keys)
    columns = [c for c in a.columns if c not in keys] if columns is None else list(columns)
    named = [*keys, *columns]
    a = a.select(*named)
    b = b.select(*[F.col(c).cast(a.schema[c].dataType).alias(c) for c in named])
    place, bits, low = _place(a, b, keys)
    shift, level, found = max(0, bits - FAN_BITS), 0, None
    x, y = a, b
    while True:
        level += 1
        at = F.shiftright(place, shift)
        left, right = range_digests(x, at, named), range_digests(y, at, named).withColumnsRenamed({"n": "n2", "a": "a2", "b": "b2"})
        both = left.join(right, "_range", "full_outer")
        same = F.col("a").eqNullSafe(F.col("a2")) & F.col("b").eqNullSafe(F.col("b2")) & F.col("n").eqNullSafe(F.col("n2"))
        unlike = both.filter(~same).select("_range", (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("rows")).limit(listed + 1).collect()
        if len(unlike) > listed:  # nearly everything differs: keep the coarser ranges
            break
        found = (shift, [r["_range"] for r in unlike], sum(r["rows"] for r in unlike))
        x, y = (_within(df, keys, place, low, shift, found[1]) for df in (a, b))
        if not unlike or shift == 0 or found[2] <= leaf_rows:
            break
        shift = max(0, shift - FAN_BITS)
    copies = x.withColumn("_s", F.lit(1)).unionByName(y.withColumn("_s", F.lit(-1)))
    rows = copies.groupBy(*named).agg(F.sum("_s").alias("copies")).filter("copies <> 0")
    return Difference(rows, level, len(found[1]) if found else -1, found[2] if found else -1)


def key_report(difference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key of a difference: ``only in first``, ``only in second`` or ``changed``."""
    per = difference.groupBy(*keys).agg(F.max("copies").alias("_most"), F.min("copies").alias("_least"))
    kind = F.when(F.col("_least") > 0, "only in first").when(F.col("_most") < 0, "only in second").otherwise("changed")
    return per.select(*keys, kind.alias("kind"))


def changed_columns(difference: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For changed keys with one row on either side: which columns differ, in the order given."""
    one = lambda sign: difference.filter(F.col("copies") == sign).select(*keys, *[F.col(c).alias(f"{c}_{'a' if sign > 0 else 'b'}") for c in columns])
    both = join_keys(one(1), one(-1), keys)
    differs = [F.when(~F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")), F.lit(c)) for c in columns]
    return both.select(*keys, F.concat_ws(", ", *differs).alias("columns"))
