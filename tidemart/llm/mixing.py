"""Mixing sources to target weights by packed blocks of words.

1. A source's words, document after document, form one stream that is cut into blocks of ``block_words`` words (the last
   block of a source is shorter). A document is known by the range of words it covers in that stream.
2. Targets: sources in code-point order (null last) have the weights 5, 2, 1, repeating. They share ``total`` times all words by
   weight; no target exceeds ``most`` times its source, and the excess is shared anew until none is above.
3. The mix is a sequence of slots of one block each, cut into output shards of ``shard_blocks`` slots. The counts of
   sources in a shard are a multinomial draw, conditioned on the totals: a pseudorandom permutation deals every
   slot of every source to an output position, so a shard's counts are what drawing its slots without replacement from
   all targets gives. An unconditioned draw would miss a small source's target by the draw's own noise, and could
   ask for more than ``most`` times a source.
4. Slot j of a source takes block ``perm(j mod blocks)`` of pass ``j div blocks``; each source and pass has a
   permutation of its own. So no block is taken twice in one pass, and no document more often than ``most`` times.
5. The taken blocks meet the documents' ranges in a join on (source, block).

All of it is DataFrame code. A hot source is never one task: streams are laid out slice by slice, slots are generated in
chunks, and joins are on (source, block).

Defined cases: null text counts as empty; a document without words takes nothing; null is a source of its own; rows with equal
doc_id are laid out next to each other and counted apart; an empty table gives an empty result; columns of the input
whose names clash with those added are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import let, partitions, stored, unwrapped, words_column, wrapped

WEIGHTS = (5, 2, 1)
TOTAL, MOST = 1.5, 2
BLOCK_WORDS = 64
SHARD_BLOCKS = 4096
SEED = 7
ROUNDS = 24
# Slices of a source: at least so many, and one for each ``SLICE_ROWS`` rows of all.
SLICES, SLICE_ROWS = 1024, 10_000
CHUNK = 8192
# A row per source is broadcast up to so many sources (a few MB); beyond, the join shuffles.
BROADCAST_SOURCES = 20_000


def permuted(x: Column, n: Column, *keys: Column) -> Column:
    """A pseudorandom bijection of [0, n): swap-or-not rounds, each of which pairs x with K - x and swaps by a hash bit."""
    def step(at: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(F.lit(SEED), *keys, r) - at, n)
        bit = F.xxhash64(F.lit(SEED + 1), *keys, r, F.greatest(at, other)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(at)

    return F.when(n > 1, F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), step)).otherwise(x.cast("long"))


def sized(docs: DataFrame) -> DataFrame:
    """Document, source, a hash of id, source and text, and the number of words; only these move in the steps that follow."""
    return docs.select("doc_id", "source", F.xxhash64("doc_id", "source", "text").alias("_key"), F.size(words_column(F.col("text"))).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """One row per source: source_size, weight, target.

    The windows run over one row per source. Sources are filled by rising size per weight; the first k of them are full where
    the level that the others would get is above their bound.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rise = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rise.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    listed = F.array(*[F.lit(int(w)) for w in weights])
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("weight", listed[F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))])
    s = s.withColumn("bound", F.lit(most) * F.col("source_size"))
    s = s.withColumns({
        "wanted": F.lit(float(total)) * F.sum("source_size").over(every),
        "given": F.coalesce(F.sum("bound").over(before), F.lit(0)),
        "open": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    s = s.withColumn("level", (F.col("wanted") - F.col("given")) / F.col("open"))
    # The level rises as long as sources are full; the first source that is not full fixes it for all that follow.
    s = s.withColumn("fits", F.col("level") * F.col("weight") <= F.col("bound"))
    s = s.withColumn("final", F.min(F.when(F.col("fits"), F.struct("given", "level"))).over(every)["level"])
    target = F.least(F.col("bound").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("bound").cast("double")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def laid_out(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``start``: the words of the source before the document, in the order of a hash of its id and text.

    Each source is cut into slices by that hash; slice totals give the slices' starts, so a source of any size is scanned by many
    tasks. Rows that are equal in all columns are laid out as one of so many times their size, and told apart afterwards.
    """
    counted = sizes.groupBy(*sizes.columns).agg(F.count(F.lit(1)).alias("copies"))
    slices = max(SLICES, sizes.count() // SLICE_ROWS)
    order = F.xxhash64(F.lit(SEED), "doc_id", "_key")
    s = counted.withColumnRenamed("size", "each").withColumn("size", F.col("each") * F.col("copies"))
    s = s.withColumn("order", order).withColumn("slice", F.pmod(F.shiftright("order", 32), F.lit(slices)))
    per_slice = s.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(
        F.col("source").alias("s_source"), F.col("slice").alias("s_slice"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")
    )  # a row per slice of a source
    inside = Window.partitionBy("source", "slice").orderBy("order", "doc_id", "_key", "each").rowsBetween(Window.unboundedPreceding, -1)
    within = s.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    met = within.join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slice") == F.col("s_slice")))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    every = met.withColumn("copy", copy).drop("size").withColumnRenamed("each", "size")
    return every.withColumn("start", F.col("base") + F.col("within") + F.col("copy") * F.col("size")).select(*sizes.columns, "start")


def slots(plan: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, most: int = MOST) -> DataFrame:
    """Every slot of the mix: source, block, pass, output shard and place in it."""
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    wanted = F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), F.lit(most) * F.col("blocks"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    p = plan.where(F.col("source_size") > 0).withColumn("blocks", blocks).withColumn("wanted", wanted).where(F.col("wanted") > 0)
    p = p.withColumn("first", F.coalesce(F.sum("wanted").over(before), F.lit(0))).withColumn("all", F.sum("wanted").over(Window.partitionBy()))
    chunks = p.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("wanted") - 1, F.lit(CHUNK).cast("long"))))
    j = F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + CHUNK, F.col("wanted")) - 1))
    s = chunks.repartition(partitions(plan.sparkSession), "source", "chunk").select("source", "blocks", "first", "all", j.alias("j"))
    source_key = F.xxhash64("source")
    s = s.withColumn("pass", F.floor(F.col("j") / F.col("blocks")).cast("int"))
    s = s.withColumn("block", permuted(F.col("j") % F.col("blocks"), F.col("blocks"), source_key, F.col("pass")))
    s = s.withColumn("place", permuted(F.col("first") + F.col("j"), F.col("all"), F.lit(0)))
    return s.select(
        "source", "block", "pass", F.floor(F.col("place") / shard_blocks).cast("long").alias("shard"), (F.col("place") % shard_blocks).alias("slot")
    )


def shard_counts(taken_slots: DataFrame) -> DataFrame:
    """Blocks of each source in each output shard."""
    return taken_slots.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("blocks"))


def covered(ranges: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document and block it has words in: the words [lo, hi) of the document."""
    at = ranges.where(F.col("size") > 0).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)))
    )
    lo = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    hi = F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("size"))
    return at.withColumn("lo", lo).withColumn("hi", hi)


def drawn(sizes: DataFrame, plan: DataFrame, block_words: int = BLOCK_WORDS, by_pass: bool = False) -> DataFrame:
    """The word ranges that the mix takes: doc_id, (key columns of ``sizes``), pass, lo, hi, joined on (source, block).

    Without ``by_pass`` the passes of a block come as one row with their number, ``times``.
    """
    group = ["source", "block", *(["pass"] if by_pass else [])]
    times = slots(plan, block_words).groupBy(*group).agg(F.count(F.lit(1)).alias("times"))
    b = times.select(F.col("source").alias("t_source"), F.col("block").alias("t_block"), *[c for c in times.columns if c not in ("source", "block")])
    pieces = covered(laid_out(sizes), block_words)
    # Catalyst's estimate does not see that slots multiply the few rows of the plan, and would broadcast them.
    return pieces.join(b.hint("merge"), F.col("source").eqNullSafe(F.col("t_source")) & (F.col("block") == F.col("t_block"))).drop("t_source", "t_block")


def mix_sizes(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken."""
    sizes = stored(sized(docs), "mix-sizes")
    plan = targets(sizes)
    ranges = laid_out(sizes)
    # One row per document, so that rows with one doc_id stay apart: their ranges differ unless they have no words.
    taken = (
        drawn(sizes, plan, block_words)
        .groupBy("source", "start").agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken"))
        .select(F.col("source").alias("k_source"), F.col("start").alias("k_start"), "taken")
    )
    plan = plan.select(F.col("source").alias("p_source"), "source_size", "target")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    met = ranges.join(taken.hint("merge"), F.col("source").eqNullSafe(F.col("k_source")) & (F.col("start") == F.col("k_start")) & (F.col("size") > 0), "left")
    met = met.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
    return met.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents as the mix takes them, with their own columns.

    A document keeps the words of its drawn blocks in their order; what a second pass draws follows after an empty line. A
    document that the first pass takes whole keeps its text as it is. Documents of which nothing is drawn go. Only word
    ranges are shuffled; the texts meet them once.
    """
    keyed = wrapped(docs, "doc_id", "source", "text").withColumn("_key", F.xxhash64("doc_id", "source", "text"))
    sizes = stored(sized(keyed), "mix-sizes")
    ranges = drawn(sizes, targets(sizes), block_words, by_pass=True)
    spans = ranges.groupBy("_key", "source", "start").agg(F.sort_array(F.collect_list(F.struct("pass", "lo", "hi"))).alias("_spans"))
    # Of rows with equal key columns one text is enough: each of their ranges has a row of its own.
    one = keyed.withColumn("_n", F.row_number().over(Window.partitionBy("_key").orderBy("doc_id"))).where(F.col("_n") == 1)
    met = one.join(spans.select("_key", "_spans").hint("merge"), "_key")

    def piece(words: Column, n: int) -> Column:
        taken = F.filter("_spans", lambda s: s["pass"] == n)
        parts = F.transform(taken, lambda s: F.array_join(F.slice(words, (s["lo"] + 1).cast("int"), (s["hi"] - s["lo"]).cast("int")), " "))
        return F.array_join(parts, " ")

    def drawn_words(n: int) -> Column:
        return F.aggregate(F.filter("_spans", lambda s: s["pass"] == n), F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])

    def taken_text(words: Column) -> Column:
        passes = [F.when(drawn_words(n) == F.size(words), F.col("text")).otherwise(piece(words, n)) for n in range(MOST)]
        return F.array_join(F.filter(F.array(*passes), lambda t: t != ""), "\n\n")

    plain = {"doc_id": F.col("doc_id"), "source": F.col("source"), "text": F.col("_taken")}
    if "n_chars" in docs.columns:
        plain["n_chars"] = F.length("_taken").cast("long")
    return unwrapped(met.withColumn("_taken", let(words_column(F.col("text")), taken_text)), docs.columns, **plain)
