"""Aggregate views kept up to date by signed changes of their source.

A change is a source row with a sign: +1 for a row that is there now, -1 for one that no longer is; an update is both. Sums, counts and
the support of a group (how many rows it has) add up with the sign. A minimum or maximum cannot be taken back, so for each of its
columns the view also keeps how many rows of a group hold each value: when the last row with the lowest value goes, the next value
is there. A refresh reads the changes and the touched buckets of the view, never the source.

Each state row remembers the number of the last batch it has taken in, and a group without rows stays as an empty one, so a batch that is
repeated after a lost job changes nothing. Batches are numbered upward.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.semantics import join_keys
from tidemart.session import settle
from tidemart.sources.tables import BucketedTable

SIGN = "_sign"


def signed(removed: DataFrame | None, added: DataFrame | None) -> DataFrame:
    """Rows that are gone and rows that are new as signed changes."""
    parts = [df.withColumn(SIGN, F.lit(s)) for df, s in ((removed, -1), (added, 1)) if df is not None]
    return reduce(lambda a, b: a.unionByName(b), parts)


def changes_of(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed changes between two states of the same keyed rows (the touched ones): what differs goes and comes."""
    marked = before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)))
    columns = [c for c in before.columns if c not in keys]
    return marked.groupBy(*keys, *columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)


@dataclass(frozen=True)
class View:
    """A view per ``keys``: ``rows`` counts rows, ``sums`` and ``counts`` (non-null) name source columns by output, ``lows`` and ``highs`` likewise."""

    keys: Sequence[str]
    sums: dict[str, str] = field(default_factory=dict)
    counts: dict[str, str] = field(default_factory=dict)
    lows: dict[str, str] = field(default_factory=dict)
    highs: dict[str, str] = field(default_factory=dict)
    rows: str = "n_rows"

    def additive(self) -> dict[str, Column]:
        """What adds up, per signed row; a sum keeps its count too, since a sum of nothing is null."""
        sign = F.col(SIGN)
        known = lambda c: F.when(F.col(c).isNotNull(), sign).otherwise(0)
        return (
            {"_n": sign}
            | {f"_s_{out}": F.coalesce(F.col(c) * sign, F.lit(0)) for out, c in self.sums.items()}
            | {f"_k_{out}": known(c) for out, c in (self.sums | self.counts).items()}
        )

    def ranked(self) -> list[str]:
        return list(dict.fromkeys([*self.lows.values(), *self.highs.values()]))

    def group_delta(self, changes: DataFrame) -> DataFrame:
        return changes.groupBy(*self.keys).agg(*[F.sum(c).alias(name) for name, c in self.additive().items()])

    def value_delta(self, changes: DataFrame, column: str) -> DataFrame:
        """How the support of each value of a column moves."""
        held = changes.filter(F.col(column).isNotNull())
        return held.groupBy(*self.keys, F.col(column).alias("_value")).agg(F.sum(SIGN).alias("_n")).filter("_n <> 0")

    def result(self, groups: DataFrame, values: dict[str, DataFrame]) -> DataFrame:
        """The view's rows from its state."""
        live = groups.filter("_n > 0")
        columns = [F.col("_n").alias(self.rows)]
        columns += [F.when(F.col(f"_k_{out}") > 0, F.col(f"_s_{out}")).alias(out) for out in self.sums]
        columns += [F.col(f"_k_{out}").alias(out) for out in self.counts]
        for i, c in enumerate(self.ranked()):
            ends = values[c].filter("_n > 0").groupBy(*self.keys).agg(F.min("_value").alias(f"_low{i}"), F.max("_value").alias(f"_high{i}"))
            live = join_keys(live, ends, self.keys, "left")
            columns += [F.col(f"_low{i}").alias(out) for out, source in self.lows.items() if source == c]
            columns += [F.col(f"_high{i}").alias(out) for out, source in self.highs.items() if source == c]
        return live.select(*self.keys, *columns)


def merged(state: DataFrame | None, delta: DataFrame, keys: Sequence[str], batch: int) -> DataFrame:
    """State rows with a delta added, unless they have taken in this batch already; a support below zero is an error."""
    added = [c for c in delta.columns if c not in keys]
    new = delta.select(*keys, *[F.lit(0).alias(f"_old{c}") for c in added], *[F.col(c).alias(f"_new{c}") for c in added], F.lit(None).cast("long").alias("_last"))
    if state is None:
        both = new
    else:
        old = state.select(*keys, *[F.col(c).alias(f"_old{c}") for c in added], *[F.lit(0).alias(f"_new{c}") for c in added], F.col("_batch").alias("_last"))
        both = old.unionByName(new)
    summed = both.groupBy(*keys).agg(F.max("_last").alias("_last"), *[F.sum(f"_{side}{c}").alias(f"_{side}{c}") for c in added for side in ("old", "new")])
    fresh = F.col("_last").isNull() | (F.col("_last") < batch)
    kinds = dict((state if state is not None else delta).dtypes)
    total = lambda c: (F.col(f"_old{c}") + F.when(fresh, F.col(f"_new{c}")).otherwise(F.lit(0))).cast(kinds[c])
    checked = F.when(total("_n") < 0, F.raise_error(F.lit("a change takes back a row that the view never had"))).otherwise(total("_n"))
    return summed.select(*keys, *[(checked if c == "_n" else total(c)).alias(c) for c in added], F.greatest(F.coalesce("_last", F.lit(batch)), F.lit(batch)).cast("long").alias("_batch"))


@dataclass(frozen=True)
class StoredView:
    """A view and its state below a folder, in buckets by group; a refresh rewrites the buckets of touched groups."""

    spark: SparkSession
    path: str
    view: View
    buckets: int = 64

    def _table(self, name: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.path}/{name}", list(self.view.keys), self.buckets)

    def _values(self, column: str) -> BucketedTable:
        return self._table(f"values-{self.view.ranked().index(column)}")

    def _supports(self, column: str, groups: DataFrame | None = None) -> DataFrame:
        """How many rows hold each value of a column; none does while all are null, and then there is a schema only."""
        table = self._values(column)
        if not table.exists():
            return self.spark.read.parquet(f"{table.path}-schema")
        return table.read() if groups is None else table.read_touched(groups)

    def refresh(self, changes: DataFrame, batch: int) -> list[int]:
        """Take in a batch of signed changes; the numbers of the buckets that were rewritten."""
        view, keys = self.view, list(self.view.keys)
        changes = settle(changes)
        for c in view.ranked():
            delta = view.value_delta(changes, c)
            merged(None, delta.limit(0), [*keys, "_value"], 0).write.mode("ignore").parquet(f"{self._values(c).path}-schema")
            self._values(c).merge(delta, lambda state, new: merged(state, new, [*keys, "_value"], batch))
        return self._table("groups").merge(view.group_delta(changes), lambda state, new: merged(state, new, keys, batch))

    def read(self) -> DataFrame:
        return self.view.result(self._table("groups").read(), {c: self._supports(c) for c in self.view.ranked()})

    def touched(self, changes: DataFrame) -> DataFrame:
        """The view's present rows of the groups that changes touch, from their buckets only."""
        keys = list(self.view.keys)
        if not self._table("groups").exists():
            return self.view.result(merged(None, self.view.group_delta(changes.limit(0)), keys, 0), {
                c: merged(None, self.view.value_delta(changes.limit(0), c), [*keys, "_value"], 0) for c in self.view.ranked()})
        groups = changes.select(*keys).distinct()
        part = lambda rows: join_keys(rows, groups, keys, "left_semi")
        return self.view.result(part(self._table("groups").read_touched(groups)), {c: part(self._supports(c, groups)) for c in self.view.ranked()})

    def refresh_with_changes(self, changes: DataFrame, batch: int) -> DataFrame:
        """Refresh, and the signed changes of the view's own rows, which a view on top of it takes in."""
        changes = settle(changes)
        before = settle(self.touched(changes))
        self.refresh(changes, batch)
        return settle(changes_of(before, self.touched(changes), self.view.keys))
