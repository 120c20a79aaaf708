"""Document fingerprints by order MinHash, in DataFrame expressions.

A text's k-mers are its runs of ``K`` words, each numbered by how often it has occurred before, so repeats count. A hash of
k-mer and number deals them to bins (one permutation for all bins instead of one for each) and ranks them there.
Each bin selects its ``LENGTH`` smallest, one that has fewer borrows from the next bin with any, puts them back into the order they have in
the text, and hashes the tuple. Texts that
share a tuple share these k-mers in this order, so the share of equal tuples falls with the edit distance, not just with
the overlap of word sets. A fingerprint lists (bin, 16 bits of the tuple's hash) as six hex digits each; bins
without a k-mer are left out.

The work of a text stays in its row: sorting is done on arrays of packed longs, and nothing is exploded.

Defined cases: a null text counts as empty; a text without words has the empty fingerprint, and two of them have likeness 1; a text of fewer
words than a k-mer is one k-mer; positions are told apart up to 33,554,432 words, beyond them the order of a text's k-mers wraps around; rows with equal or null doc_id are separate documents, ordered by text, null ids last (an id on more
than 0.2 % of the rows, or null, is cut into slices by a hash of the text, so that it is no single task's, and a slice is ordered by text); a table of
one row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import let, stored, words_column

K = 2
LENGTH = 2
BIN_BITS = 7
POSITION_BITS = 25
BUCKET_ROWS = 2000
KNOTS, QUANTILES = 64, 1024

_POSITION = (1 << POSITION_BITS) - 1
_KEPT = (1 << (63 - POSITION_BITS)) - 1


def _bin(x: Column) -> Column:
    return F.shiftright(x, 64 - BIN_BITS)


def _changes(values: Column, key) -> Column:
    """The indexes at which a sorted array's key differs from the one before."""
    here = F.sequence(F.lit(0), F.size(values) - 1)
    return F.filter(here, lambda i: (i == 0) | (key(F.get(values, i)) != key(F.get(values, i - 1))))


def kmers(words: Column) -> Column:
    """Hash and position of each k-mer, packed, in the order of the hash and then of the position."""
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    hashes = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (K - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(words, i + n) for n in range(1, K)])
    )
    at = F.when(F.size(words) < K, whole).otherwise(hashes)
    return F.sort_array(F.transform(at, lambda h, i: F.shiftleft(h, POSITION_BITS).bitwiseOR(i.bitwiseAND(F.lit(_POSITION)))))


def numbered(packed: Column) -> Column:
    """A hash of k-mer and occurrence number over each position, packed likewise: bin, rank in the bin, position; sorted."""
    kmer = lambda x: F.shiftright(x, POSITION_BITS)

    def group(starts: Column) -> Column:
        def one(start: Column, g: Column) -> Column:
            end = F.coalesce(F.get(starts, g + 1), F.size(packed))
            same = F.slice(packed, start + 1, end - start)
            return F.transform(
                same, lambda x, n: F.shiftleft(F.xxhash64(kmer(x), n), POSITION_BITS).bitwiseOR(x.bitwiseAND(F.lit(_POSITION)))
            )

        return F.flatten(F.transform(starts, one))

    return F.sort_array(let(_changes(packed, kmer), group))


def selected(ranked: Column) -> Column:
    """The LENGTH smallest of each bin."""
    return F.filter(ranked, lambda x, i: (i < LENGTH) | (_bin(x) != _bin(F.get(ranked, i - LENGTH))))


def tuples(chosen: Column) -> Column:
    """(bin, hash of the bin's k-mers in text order), one integer for each bin that has any."""

    def one(start: Column) -> Column:
        at = _bin(F.get(chosen, start))
        alone = F.filter(F.slice(chosen, start + 1, LENGTH), lambda x: _bin(x) == at)
        # A bin with one k-mer borrows the first of the next bin that has any, so that every tuple carries an order.
        other = F.array(F.coalesce(F.get(chosen, start + 1), F.get(chosen, F.lit(0))))
        own = F.when((F.size(alone) < LENGTH) & (F.size(chosen) > 1), F.concat(alone, other)).otherwise(alone)
        # The position moves to the front for the sort by text order; what stays behind it names the k-mer.
        placed = F.transform(
            own, lambda x: F.shiftleft(x.bitwiseAND(F.lit(_POSITION)), 63 - POSITION_BITS).bitwiseOR(F.shiftright(x, POSITION_BITS).bitwiseAND(F.lit(_KEPT)))
        )
        names = F.transform(F.sort_array(placed), lambda x: x.bitwiseAND(F.lit(_KEPT)))
        slot = F.xxhash64(names).bitwiseAND(F.lit(0xFFFF))
        number = at.bitwiseAND(F.lit((1 << BIN_BITS) - 1))
        return F.shiftleft(number, 16).bitwiseOR(slot).cast("int")

    return F.transform(_changes(chosen, _bin), one)


def signature(text: Column) -> Column:
    """The fingerprint as an array of integers."""
    none = F.array().cast("array<int>")
    chosen = lambda w: let(let(kmers(w), numbered), selected)
    return let(words_column(text), lambda w: F.when(F.size(w) == 0, none).otherwise(let(chosen(w), tuples)))


def spelled(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal tuples among the bins that either text fills."""
    bins = lambda f: F.transform(f, lambda x: F.shiftright(x, 16))
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(bins(a), bins(b))), F.lit(0)), F.lit(1.0))


def _number(n: int, knots: list, bucket_rows: int) -> Column:
    """A number that rises with doc_id: between two of the knots in equal steps."""
    if len(knots) < 2:
        return F.lit(0).cast("long")
    steps = max(1, -(-n // (bucket_rows * (len(knots) - 1))))
    listed = F.array(*[F.lit(k).cast("long") for k in knots])
    below = F.greatest(F.lit(1), F.least(F.lit(len(knots) - 1), F.size(F.filter(listed, lambda k: k <= F.col("doc_id")))))
    lo, hi = F.get(listed, below - 1).cast("double"), F.get(listed, below).cast("double")
    inside = F.floor((F.col("doc_id").cast("double") - lo) / (hi - lo) * steps).cast("long")
    return below.cast("long") * (steps + 1) + F.greatest(F.lit(0).cast("long"), F.least(inside, F.lit(steps).cast("long")))


def _bucket(ids: DataFrame, bucket_rows: int) -> Column:
    """A bucket number that rises with doc_id, of (stretch, number, slice): quantile knots over all ids cut the ids into buckets.

    An id that fills several quantiles, or null, is a stretch of its own and is cut into slices by a hash of the text.
    """
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = ids.agg(F.count(F.lit(1)).alias("rows"), F.count("doc_id").alias("n"), F.percentile_approx("doc_id", shares, 10_000).alias("knots")).first()
    quantiles = list(found.knots or [])
    rows_of = {k: (c - 1) * found.n // QUANTILES for k, c in Counter(quantiles).items()}
    hot = sorted(k for k, rows in rows_of.items() if rows > bucket_rows)  # QUANTILES / 2 at most
    slices, stretch, null = F.lit(1), F.lit(0), F.col("doc_id").isNull()
    if hot:
        rank = F.size(F.filter(F.array(*[F.lit(k).cast("long") for k in hot]), lambda k: k <= F.col("doc_id")))
        own = F.col("doc_id").isin(hot)
        stretch = 2 * rank + F.when(own, 0).otherwise(1)
        slices = F.when(own, F.get(F.array(*[F.lit(-(-rows_of[k] // bucket_rows)) for k in hot]), rank - 1)).otherwise(1)
    slices = F.when(null, F.lit(max(1, -(-(found.rows - found.n) // bucket_rows)))).otherwise(slices)
    part = F.shiftright(F.shiftrightunsigned(F.xxhash64("text"), 33) * slices, 31)
    number = _number(found.n, sorted(set(quantiles[:: QUANTILES // KNOTS])), bucket_rows)
    # One long, so that the window and the join that follows it agree on the partitioning: 11 bits, 31 bits, 21 bits.
    place = F.when(null, F.lit(0).cast("long")).otherwise(F.shiftleft(stretch.cast("long") + 1, 52) + F.shiftleft(number, 21))
    return place + F.when(slices > 1, part).otherwise(F.lit(0).cast("long"))


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, text, print, next_text and next_print: those of the next document by falling doc_id, the first after the last.

    Documents are dealt to buckets that rise with doc_id, so the texts are shuffled once and no task orders them all. The last one of a bucket
    is followed by the first of the next bucket that has any; one row per bucket tells which that is.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("bucket", _bucket(base.select("doc_id"), bucket_rows))
    heads = stored(base.groupBy("bucket").agg(F.max("doc_id").alias("head")), "bucket-heads")
    falling = Window.orderBy(F.col("bucket").desc())
    ends = falling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select(  # ids only, one row per bucket
        F.col("bucket").alias("of"), F.coalesce(F.lead("bucket").over(falling), F.first("bucket").over(ends)).alias("at")
    )
    h = heads.select(F.col("bucket").alias("h_bucket"), "head")
    texts = base.join(h, (F.col("bucket") == F.col("h_bucket")) & F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("bucket").agg(F.min("text").alias("text"))
    follows = following.join(texts, F.col("at") == F.col("bucket")).select("of", F.col("text").alias("_text"))
    follows = stored(follows, "bucket-follows").withColumn("_print", signature(F.col("_text")))
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    rows = base.withColumn("print", signature(F.col("text")))
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "next_print": F.lead("print").over(order)})
    met = rows.join(follows, (F.col("bucket") == F.col("of")) & F.col("next_text").isNull(), "left")
    return met.select("doc_id", "text", "print", F.coalesce("next_text", "_text").alias("next_text"), F.coalesce("next_print", "_print").alias("next_print"))


def edited_fingerprints(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprints of every text and of the text whose last half gives way to the next document's begin, with likenesses."""
    n, half = F.col("n_chars"), F.col("half")
    rows = with_next(docs, bucket_rows).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("half", F.floor(n / 2).cast("int"))
    changed = F.concat(F.substring("text", F.lit(1), n.cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", changed).withColumn("edited_print", signature(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spelled(F.col("print")).alias("fingerprint"),
        spelled(F.col("edited_print")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``fingerprint``."""
    return docs.withColumn("fingerprint", spelled(signature(F.col("text"))))
