"""Scalar and ordering helpers that keep the source dialect's meaning where Spark's differs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values shared by all history tables.
FIRST_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"
NULL_MARK = "\u0000"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_count() -> Column:
    return F.count(F.lit(1))


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named keys where NULL meets NULL, as in grouping: what was grouped by the keys comes back to its rows."""
    keys = list(keys)
    if not keys:
        return left.crossJoin(right)  # one row of totals
    other = right.withColumnsRenamed({k: f"_own_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_own_{k}`")) for k in keys])
    joined = left.join(other, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_own_{k}" for k in keys])


def truncated(c: Column | str, digits: int = 0) -> Column:
    """Digits behind are cut off, toward zero on both sides."""
    scaled = as_col(c) * F.lit(10**digits)
    return F.when(scaled < 0, F.ceil(scaled)).otherwise(F.floor(scaled)) / F.lit(10**digits)


def millis_before(c: Column) -> Column:
    return c - F.expr("INTERVAL '0.001' SECOND")


def ascending(c: Column | str) -> Column:
    """Ascending order with NULLs last."""
    return as_col(c).asc_nulls_last()


def descending(c: Column | str) -> Column:
    """Descending order with NULLs first."""
    return as_col(c).desc_nulls_first()


def row_hash(*cols: Column | str) -> Column:
    """64-bit hash that notices NULLs and the position of every value."""
    if not cols:
        return F.lit(0).cast("long")
    return F.xxhash64(*[F.coalesce(as_col(c).cast("string"), F.lit(NULL_MARK)) for c in cols])


def version_order(cols: Sequence[str], df: DataFrame) -> Column:
    """Several version columns in rank order; the first that is set counts, absent means oldest."""
    kind = dict(df.dtypes)[cols[0]]
    floor = "1900-01-01" if kind.startswith(("timestamp", "date")) else "0"
    return F.coalesce(*[F.col(c) for c in cols], F.lit(floor).cast(kind))


def any_null(*cols: Column | str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | as_col(c).isNull()
    return out


def greatest_strict(*cols: Column | str) -> Column:
    """Greatest value, NULL as soon as one argument is NULL."""
    return F.when(~any_null(*cols), F.greatest(*[as_col(c) for c in cols]))


def least_strict(*cols: Column | str) -> Column:
    return F.when(~any_null(*cols), F.least(*[as_col(c) for c in cols]))


def div0(a: Column | str, b: Column | str) -> Column:
    """a / b, 0 where b is 0; NULL stays NULL."""
    a, b = as_col(a), as_col(b)
    return F.when(b == 0, F.when(a.isNotNull(), F.lit(0.0))).otherwise(a / F.nullif(b, F.lit(0)))


def div0_null(a: Column | str, b: Column | str) -> Column:
    """a / b, 0 where b is 0 or NULL."""
    a, b = as_col(a), as_col(b)
    return F.when(F.coalesce(b, F.lit(0)) == 0, F.when(a.isNotNull(), F.lit(0.0))).otherwise(
        a / F.nullif(b, F.lit(0))
    )


def ratio(a: Column | str, b: Column | str) -> Column:
    """Guarded ratio: NULL where the denominator is 0."""
    return as_col(a).cast("double") / F.nullif(as_col(b).cast("double"), F.lit(0.0))


def split_part(text: Column | str, delimiter: str, index: int) -> Column:
    """1-based part, index 0 counts as 1, '' beyond the end, negative from the end."""
    return F.split_part(as_col(text), F.lit(delimiter), F.lit(index or 1))


def full_match(text: Column | str, pattern: str) -> Column:
    return as_col(text).rlike(f"^(?:{pattern})$")


def boundaries(part: str, start: Column | str, end: Column | str) -> Column:
    """Number of calendar boundaries of ``part`` crossed between two moments."""
    start, end = as_col(start), as_col(end)
    part = part.lower()
    if part in ("year", "quarter", "month"):
        months = lambda c: F.year(c) * 12 + F.month(c) - 1
        if part == "month":
            return (months(end) - months(start)).cast("long")
        size = 12 if part == "year" else 3
        unit = lambda c: F.floor(months(c) / F.lit(size))
        return (unit(end) - unit(start)).cast("long")
    if part == "day":
        return F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    if part == "week":
        monday = lambda c: F.to_date(F.date_trunc("week", c))
        return F.floor(F.datediff(monday(end), monday(start)) / 7).cast("long")
    if part in ("hour", "minute", "second"):
        return F.timestamp_diff(part.upper(), F.date_trunc(part, start), F.date_trunc(part, end))
    raise ValueError(f"unknown date part {part}")


def time_slice(ts: Column | str, minutes: int) -> Column:
    """Start of the fixed-width slot a moment falls in."""
    return F.window(as_col(ts), f"{minutes} minutes")["start"]


def week_start_sunday(day: Column | str) -> Column:
    day = F.to_date(as_col(day))
    return F.date_sub(day, F.dayofweek(day) - 1)


def initcap_any(text: Column | str) -> Column:
    """Capitalise after any non-alphanumeric character, not only after blanks."""
    pieces = F.regexp_extract_all(F.lower(as_col(text)), F.lit(r"([\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+)"), F.lit(1))
    capital = lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substring(p, F.lit(2), F.length(p)))
    return F.array_join(F.transform(pieces, capital), "")


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], nulls_newest: bool = False
) -> DataFrame:
    """One row per key: the one with the highest order value.

    A ``max_by`` aggregate instead of a ranked window: rows of a hot key are reduced before the shuffle.
    NULL keys form a group of their own. NULL order values count as oldest unless ``nulls_newest``.
    """
    rank = []
    for c in order:
        if nulls_newest:
            rank.append(as_col(c).isNull())
        rank.append(as_col(c))
    names = df.columns
    picked = df.groupBy(*[F.col(k) for k in keys]).agg(
        F.max_by(F.struct(*[F.col(n) for n in names if n not in keys]), F.struct(*rank)).alias("_row")
    )
    return picked.select(*[F.col(n) if n in keys else F.col(f"_row.{n}").alias(n) for n in names])


def earliest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the one with the lowest order value.

    An order that names all other columns is the row itself, so they are not carried twice.
    """
    names = df.columns
    others = [n for n in names if n not in keys]
    by = F.struct(*[as_col(c) for c in order])
    whole = set(others) <= {c for c in order if isinstance(c, str)}
    picked = df.groupBy(*[F.col(k) for k in keys]).agg(
        (F.min(by) if whole else F.min_by(F.struct(*[F.col(n) for n in others]), by)).alias("_row")
    )
    return picked.select(*[F.col(n) if n in keys else F.col(f"_row.{n}").alias(n) for n in names])
