"""Placement of rows on shards by a lookup table that is filled from per-shard permutations.

Every shard has an order of preference over the slots of a prime-sized table: slot ``offset + k * skip`` for
k = 0, 1, 2 ... The shards take turns, and in its turn a shard claims the first free slot of its order. A key's
hash names a slot, the slot names the shard. Shards end up with equal numbers of slots (weights give a shard more
turns), and taking a shard away moves few keys of the others.

The table depends on the shard names alone, never on the data: its size is the parameter ``table_size``, so it can
always be broadcast, and placing a row is one hash and one lookup without a shuffle.

Defined cases: null keys hash like any value; rows with the same key go to the same shard unless ``spread`` is above 1;
an empty table gives an empty result; columns named ``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import quoted

SEED = 20240


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, table_size: int) -> tuple[int, int]:
    """Offset and skip of a shard's order of preference; a prime size makes every skip visit all slots."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % table_size, int.from_bytes(digest[8:], "big") % (table_size - 1) + 1


def fill_table(shards: Sequence[str], table_size: int, weights: Mapping[str, int] | None = None) -> list[int]:
    """The index of the shard that owns each slot. Work is bounded by the table size, not by the data."""
    if not is_prime(table_size) or table_size < len(shards) or not shards or len(set(shards)) < len(shards):
        raise ValueError("the table size must be a prime of at least the number of shards, whose names must differ")
    orders = [preference(s, table_size) for s in shards]
    turns = [i for i, s in enumerate(shards) for _ in range((weights or {}).get(s, 1))]
    if not turns:
        raise ValueError("at least one shard needs a positive weight")
    slots, step, free = [-1] * table_size, [0] * len(shards), table_size
    while free:
        for i in turns:
            offset, skip = orders[i]
            while slots[at := (offset + step[i] * skip) % table_size] >= 0:
                step[i] += 1
            slots[at], free = i, free - 1
            if not free:
                break
    return slots


def lookup_frame(spark: SparkSession, tables: Mapping[str, list[int]]) -> DataFrame:
    """Slot and one column per table, as rows of a constant."""
    first, *rest = tables
    text = ";".join(",".join(map(str, row)) for row in zip(*tables.values(), strict=True))
    row = F.split("col", ",")
    return (
        spark.range(1)
        .select(F.posexplode(F.split(F.lit(text), ";")).alias("slot", "col"))
        .select("slot", *[row[i].cast("int").alias(c) for i, c in enumerate([first, *rest])])
    )


def slot_of(keys: Sequence[Column], table_size: int, salt: Column | None = None) -> Column:
    parts = [F.lit(SEED), *keys, *([salt] if salt is not None else [])]
    return F.pmod(F.xxhash64(*parts), F.lit(table_size)).cast("int")


def place(
    df: DataFrame, keys: Sequence[str], shards: Sequence[str], table_size: int = 65_537, spread: int = 1,
    spread_by: Sequence[str] = (), weights: Mapping[str, int] | None = None, without: Sequence[str] = (),
) -> DataFrame:
    """``df`` with ``slot`` and ``shard``.

    ``spread`` above 1 salts each key with the hash of ``spread_by``, so a key that holds a third of all rows covers
    up to so many slots. ``without`` adds ``shard_without``: the owner of the slot once those shards are gone.
    """
    tables = {"shard": fill_table(shards, table_size, weights)}
    if without:
        left = [s for s in shards if s not in set(without)]
        back = {i: shards.index(s) for i, s in enumerate(left)}
        tables["shard_without"] = [back[i] for i in fill_table(left, table_size, weights)]
    salt = F.pmod(F.xxhash64(*[quoted(c) for c in spread_by]), F.lit(spread)) if spread > 1 else None
    placed = df.withColumn("slot", slot_of([quoted(k) for k in keys], table_size, salt)).drop(*tables)
    return placed.join(F.broadcast(lookup_frame(df.sparkSession, tables)), "slot").select(*[quoted(c) for c in placed.columns], *tables)


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard. A shard's rows are dealt to so many files by slot, so no shard is one task."""
    part = F.pmod("slot", F.lit(files_per_shard))
    placed.repartition("shard", part).write.partitionBy("shard").parquet(path)
