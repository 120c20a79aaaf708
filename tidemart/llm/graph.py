"""Connected components of an edge list by alternating star contractions (large-star, small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("at"), F.least("u", "low").alias("low"))
    return both.join(low, F.col("u") == F.col("at")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("at"), "low")
    moved = down.join(low, F.col("u") == F.col("at")).where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select(F.col("at").alias("u"), F.col("low").alias("v"))).distinct()


def _state(edges: DataFrame):
    """Count and order-free checksum."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node of its component) for every node of the long columns ``u``, ``v``.

    Self links are dropped, so a node without another neighbour has no row. Both contractions keep the components; each round's edges
    are written to the shared folder, so a lost executor costs one round's task. A hub with many
    neighbours is reduced by a map-side minimum, and its join is a plain equi join that Spark splits if it is skewed.
    """
    now = stored(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        after = stored(_small_star(_large_star(now)), "edges")
        new = _state(after)
        now, done = after, new == state
        state = new
        if done:
            break
    else:
        raise RuntimeError("the components did not settle")
    # Settled edges are stars around the smallest node.
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
