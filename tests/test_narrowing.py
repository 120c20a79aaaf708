"""Tiled baskets, range digests, rule tables and narrowed quantiles against plain computations."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.operators import digests as G
from tidemart.operators import quantiles as Q
from tidemart.operators import rules as R
from tidemart.operators.reshape import exact_percentile
from tidemart.plans.products import co_occurrence


def brute_pairs(rows, least=1):
    baskets = {}
    for b, i in rows:
        if i is not None:
            baskets.setdefault(b, set()).add(i)
    found = Counter(p for items in baskets.values() for p in itertools.combinations(sorted(items), 2))
    return {(a, b, n) for (a, b), n in found.items() if n >= least}


@pytest.mark.parametrize("block", [1024, 5, 1])
@pytest.mark.parametrize("least", [1, 3])
def test_pairs_of_small_and_large_baskets(spark, block, least):
    rng = random.Random(block)
    rows = [(rng.choice(["hot"] * 5 + list("abcdefg")), rng.choice([None, *range(60)])) for _ in range(700)] + [("single", 7)]
    frame = spark.createDataFrame(rows, "b string, i int")
    got = co_occurrence(frame, "b", "i", min_baskets=least, block=block, slots=50)
    assert {(r.item_a, r.item_b, r.baskets) for r in got.collect()} == brute_pairs(rows, least)


def test_one_basket_of_many_items_runs_in_many_tasks(spark):
    frame = spark.range(4000).select(F.lit("one").alias("b"), F.col("id").alias("i"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from tidemart.plans.products import _pairs

        pairs = _pairs(frame, ["b"], "i", 250).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"))
        found = [r for r in pairs.collect() if r.n]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.w for r in found) == 4000 * 3999 // 2 and len(found) >= 24 and max(r.n for r in found) < 4000 * 3999 // 2 / 8


def test_pairs_of_larger_baskets_are_counted_where_they_are_made(spark):
    from tidemart.plans.products import _pairs

    rows = [(d, b, i) for d in ("x", None) for b in (1, 2, None) for i in range(0, 90, (b or 3) * (1 if d else 2))]
    frame = spark.createDataFrame(rows, "d string, b int, i int")
    pairs = _pairs(frame, ["d", "b"], "i", 10, cell_pairs=200)
    placed = pairs.withColumn("p", F.spark_partition_id()).groupBy("d", "item_a", "item_b").agg(F.sum("w").alias("n"), F.count_distinct("p").alias("tasks")).collect()
    want = Counter((d, *p) for (d, _), own in itertools.groupby(rows, lambda r: r[:2]) for p in itertools.combinations(sorted(i for _, _, i in own), 2))
    assert {(r.d, r.item_a, r.item_b): r.n for r in placed} == want
    assert {r.tasks for r in placed} == {1}
    small = [("x", 7, 3), ("x", 7, 4)]
    want["x", 3, 4] += 1
    counted = co_occurrence(spark.createDataFrame(rows + small, frame.schema), "b", "i", ["d"], min_baskets=2, block=10)
    assert {(r.d, r.item_a, r.item_b): r.baskets for r in counted.collect()} == {k: n for k, n in want.items() if n > 1}


@pytest.mark.parametrize("step", [1, 40, 10**6])
@pytest.mark.parametrize("least", [1, 3])
def test_a_cell_gives_counted_pairs_only(spark, monkeypatch, step, least):
    """Whatever is counted at a time: one item that makes more than a step, lists of weight above 1, both blocks of a cell or one."""
    import numpy as np

    from tidemart.plans import products as P

    monkeypatch.setattr(P, "STEP_PAIRS", step)
    monkeypatch.setattr(P, "STEP_SLOTS", 16)
    rng = random.Random(step)
    lists = [(rng.sample(range(12), rng.randint(0, 9)), rng.sample(range(15), rng.randint(0, 9)), w) for w in (1, 1, 2, 5) for _ in range(9)]
    for some in (lists, lists[:18]):
        flat = lambda k: (np.array([i for r in some for i in r[k]], np.int64), np.array([len(r[k]) for r in some]))
        weight = np.array([r[2] for r in some])
        for diagonal in (False, True):
            want = Counter()
            for a, b, w in some:
                for x, y in itertools.product(a, a if diagonal else b):
                    want[x, y] += w if x < y or not diagonal else 0
            got = list(P._counted(*flat(0), *flat(0 if diagonal else 1), weight, least, diagonal))
            rows = [tuple(int(v) for v in r) for part in got for r in zip(*part)]
            assert len(rows) == len({r[:2] for r in rows}) and {r[:2]: r[2] for r in rows} == {k: n for k, n in want.items() if n >= least}
    frame = spark.createDataFrame([(b, f"i{i}") for b in range(6) for i in range(b % 3, 40, b % 3 + 1)], "b int, i string")
    rows = [tuple(r) for r in frame.collect()]
    pairs = P._pairs(frame, ["b"], "i", 10, least=least).collect()
    assert len(pairs) == len(brute_pairs(rows, least)) and {(r.item_a, r.item_b, r.w) for r in pairs} == brute_pairs(rows, least)


def test_large_input_is_dealt_to_more_tasks(spark, monkeypatch):
    from tidemart import session

    frame = spark.range(5000).select((F.col("id") % 900).alias("b"), (F.col("id") % 7).alias("i"))
    monkeypatch.setattr(session, "SMALL_BYTES", 0)
    monkeypatch.setattr(session, "TASK_BYTES", 1000)
    assert session.dealt(frame, "b").rdd.getNumPartitions() == 40
    rows = [tuple(r) for r in frame.collect()]
    assert {(r.item_a, r.item_b, r.baskets) for r in co_occurrence(frame, "b", "i").collect()} == brute_pairs(rows)


@pytest.mark.parametrize("leaf", [0, 50, 10**6])
@pytest.mark.parametrize("key", ["id", "name"])
def test_planted_differences(spark, leaf, key):
    a = spark.range(20_000).select("id", F.concat(F.lit("k"), "id").alias("name"), (F.col("id") % 7).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id") / 2).alias("y")).select(key, "x", "y")
    pick = F.col("id") if key == "id" else F.substring("name", 2, 9).cast("long")
    b = a.filter(pick != 77).withColumn("x", F.when(pick == 12_345, F.lit(None).cast("long")).otherwise(F.col("x"))).withColumn("y", F.when(pick == 5, F.lit(0.5)).otherwise(F.col("y")))
    more = a.filter(pick == 19_999)
    b = b.unionByName(more).unionByName(more.withColumn(key, F.lit(None).cast(a.schema[key].dataType)))
    found = G.table_difference(a, b, [key], leaf_rows=leaf)
    rows = found.rows.collect()
    assert Counter(r.copies for r in rows) == Counter({1: 3, -1: 4})
    kinds = {str(r[key]): r.kind for r in G.key_report(found.rows, [key]).collect()}
    name = lambda i: str(i) if key == "id" else f"k{i}"
    assert kinds == {name(77): "only in first", name(12345): "changed", name(5): "changed", name(19999): "only in second", "None": "only in second"}
    assert {str(r[key]): r["columns"] for r in G.changed_columns(found.rows, [key], ["x", "y"]).collect()} == {name(12345): "x", name(5): "y"}
    assert found.levels == (1 if leaf == 10**6 else 2 if key == "id" or leaf == 50 else 5) and found.ranges <= 5
    if leaf == 0 and key == "id":
        assert found.rows_compared < 20
    same = G.table_difference(a, a, [key])
    assert same.ranges == 0 and same.rows.count() == 0


def test_tables_that_differ_everywhere_and_empty_ones(spark):
    a = spark.range(3000).select("id", F.lit(1).alias("x"))
    assert G.table_difference(a, a.withColumn("x", F.lit(2)), ["id"], leaf_rows=0, listed=20).rows.count() == 6000
    assert G.table_difference(a, a.limit(0), ["id"]).rows.count() == 3000 and G.table_difference(a.limit(0), a.limit(0), ["id"]).rows.count() == 0
    nulls = spark.createDataFrame([(1, None, 5), (2, 5, None)], "id long, x int, y int")
    swapped = spark.createDataFrame([(1, 5, None), (2, None, 5)], "id long, x int, y int")
    assert G.table_difference(nulls, swapped, ["id"]).rows.count() == 4


def rule_set(rng, n):
    letters = "abcdeX"
    rules, parts = [], []
    for r in range(n):
        rules.append((r, rng.randint(1, n), f"label{r}"))
        for _ in range(rng.choice([1, 1, 2, 3])):
            parts.append((r, rng.choice(["host", "path"]), rng.choice(R.KINDS), "".join(rng.choices(letters, k=rng.choice([1, 2, 3, 4, 5, 6])))))
    return rules, parts


def brute_label(row, rules, parts):
    held = {r: True for r, _, _ in rules}
    for r, field, kind, text in parts:
        value, text = row[field], text.lower()
        value = value.lower() if value is not None else None
        fits = value is not None and {"equals": value == text, "contains": text in value, "starts": value.startswith(text), "ends": value.endswith(text)}[kind]
        held[r] = held[r] and fits
    best = min(((rank, r, label) for r, rank, label in rules if held[r]), default=None)
    return best[2] if best else "none"


@pytest.mark.parametrize("piece", [4, 2])
def test_rules_against_every_rule_in_turn(spark, piece):
    rng = random.Random(piece)
    rules, parts = rule_set(rng, 60)
    rows = [(i, *("".join(rng.choices("abcdeX", k=rng.randint(0, 9))) if rng.random() < 0.9 else None for _ in range(2))) for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, host string, path string")
    args = spark.createDataFrame(rules, "rule int, rank int, label string"), spark.createDataFrame(parts, "rule int, field string, kind string, text string")
    got = {r.id: r.label for r in R.classify(frame, ["host", "path"], *args, "label", "none", piece).collect()}
    assert got == {i: brute_label({"host": h, "path": p}, rules, parts) for i, h, p in rows}
    # Rules that ask for nothing hold always; an equality with nothing holds for an empty text.
    more = [*rules, (900, 10**6, "rest"), (901, 0, "empty host")]
    asked = [*parts, (901, "host", "equals", "")]
    args = spark.createDataFrame(more, "rule int, rank int, label string"), spark.createDataFrame(asked, "rule int, field string, kind string, text string")
    got = {r.id: r.label for r in R.classify(frame, ["host", "path"], *args, "label", "none", piece).collect()}
    assert got == {i: brute_label({"host": h, "path": p}, more, asked) for i, h, p in rows}


def test_five_thousand_rules_do_not_grow_the_plan(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 7))) for _ in range(5000)]
    rules = spark.createDataFrame([(i, i, w) for i, w in enumerate(words)], "rule int, rank int, label string")
    parts = spark.createDataFrame([(i, "url", "contains", w) for i, w in enumerate(words)], "rule int, field string, kind string, text string")
    urls = ["http://" + "".join(rng.choices("abcdefghij./", k=40)) for _ in range(300)]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    done = R.classify(frame, ["url"], rules, parts, "label")
    assert len(done._jdf.queryExecution().optimizedPlan().toString()) < 40_000
    assert {(r.url, r.label) for r in done.collect()} == {(u, next((w for w in words if w in u), None)) for u in urls}


@pytest.mark.parametrize("share", [0.0, 0.01, 0.5, 0.9, 1.0])
def test_quantiles_equal_those_of_all_values(spark, share):
    n = spark.range(50_000)
    frame = n.select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).when(F.col("id") < 100, "few").otherwise("b").alias("g"), F.when(F.col("id") % 10 > 0, F.xxhash64("id") % 1000 / 8).alias("v"))
    frame = frame.unionByName(frame.sparkSession.createDataFrame([("one", 3.5), ("none", None)], "g string, v double"))
    for keys in (["g"], []):
        got, want = (sorted(map(tuple, f(frame, keys, "v", share, "q").collect()), key=str) for f in (Q.narrowed_quantile, lambda *a: exact_percentile(*a)))
        assert got == want
    assert Q.narrowed_quantile(frame, ["g"], "v", share, "q", accuracy=3).count() == 5


def test_only_what_is_inside_the_brackets_is_shuffled(spark):
    frame = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"))
    bounds = Q.brackets(frame, ["g"], "v", 0.5)
    assert Q.bracketed(frame, ["g"], "v", bounds).count() < 2_000


def test_all_shares_read_the_rows_twice(spark):
    """Once for the sketch of all shares, once for the values inside all brackets; each share is exact, also where brackets overlap or miss."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = spark.range(6_000).select((F.col("id") % 3).alias("g"), (F.xxhash64("id") % 500 / 8).alias("v"))
    shares = (0.1, 0.5, 0.501, 0.99)
    got = Q.narrowed_quantiles(plain.mapInArrow(counted, plain.schema), ["g"], "v", shares, "q").collect()
    assert seen.value == 12_000
    want = {(r.g, s, r.q) for s in shares for r in exact_percentile(plain, ["g"], "v", s, "q").collect()}
    assert {(r.g, r._share, r.q) for r in got} == want
    missing = Q.narrowed_quantiles(plain, ["g"], "v", shares, "q", accuracy=3).collect()
    assert {(r.g, r._share, r.q) for r in missing} == want
