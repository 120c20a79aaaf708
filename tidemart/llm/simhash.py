"""SimHash near-duplicates, compared bit-sliced.

A document's fingerprint has bit b set if b is set in over half of the XXH64 hashes of its word shingles. Documents whose
fingerprints differ in at most ``radius`` bits are linked; the linked ones form components.

Equal fingerprints are one class, so copies cost nothing. Classes meet by the pigeonhole principle: with the 64 bits cut
into ``radius + a`` blocks, two fingerprints within the radius agree on some ``a`` blocks. The number of key bits follows
the number of classes, so a bucket holds a few hundred of them on average; a bucket that is still large is dealt again by
longer keys. Inside a bucket fingerprints stand vertically, one machine word per bit plane and 64 of them; a query's
distances to all are kept in carry-save counters, plane by plane, and words in which every distance exceeds the radius are
left out. A bucket reports a spanning star per local component, never its pairs.

Defined cases: null text has no words; texts without words have the fingerprint zero; a text with fewer words than a shingle is
one shingle; null ids are linked like others and count as larger than any id; rows with the same id are separate documents;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import LOWER, UPPER, stored, unwrapped, wrapped
from tidemart.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET = 512
SPLIT = 30_000
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints


def word_hashes(text: str | None, shingle: int = SHINGLE, lowered: bytes = bytes.maketrans(UPPER.encode(), LOWER.encode())) -> np.ndarray:
    """Hashes of all word shingles. ``bytes.split`` cuts at exactly the six characters that separate words."""
    joined = b" ".join(text.encode("utf-8", "surrogatepass").translate(lowered).split()) if text else b""
    if not joined:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)]
    hashed = xxhash.xxh64_intdigest
    found = [hashed(joined[a:b], SEED) for a, b in zip(starts, ends[min(shingle, len(ends)) - 1 :], strict=False)]
    return np.array(found, dtype=np.uint64)


def majority(hashes: np.ndarray, step: int = 1 << 16) -> int:
    """The 64 majority bits; counts run over slices of the hashes, so memory does not grow with the text."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), step):
        part = hashes[i : i + step]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint_of(shingle: int):
    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.array([majority(word_hashes(t, shingle)) for t in batch], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return fingerprint


def hexed(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


# --- bit-sliced comparison


def planes_of(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row p holds bit p of all fingerprints, 64 of them to a machine word."""
    n = len(fps)
    padded = np.zeros((n + 63) // 64 * 64, np.uint64)
    padded[:n] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(len(padded), 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near(queries: np.ndarray, planes: np.ndarray, n: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """All (query, column) positions within the radius (at most 4 + 3 fit the three counter bits between two tests)."""
    if radius != 4:
        return near_any(queries, planes, n, radius)
    q, width = len(queries), planes.shape[1]
    masks = np.where((queries[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1), FULL, np.uint64(0))
    alive, part = np.arange(width), planes
    c0, c1, c2, over = (np.zeros((q, width), np.uint64) for _ in range(4))
    for p in range(0, 64, 3):
        a = part[p] ^ masks[:, p, None]
        if p + 2 < 64:
            b, c = part[p + 1] ^ masks[:, p + 1, None], part[p + 2] ^ masks[:, p + 2, None]
            odd = a ^ b
            carry = (a & b) | (odd & c)
            a = odd ^ c
        else:
            carry = np.zeros_like(a)
        ripple = c0 & a
        c0 ^= a
        both = ripple ^ carry
        top = (ripple & carry) | (c1 & both)
        c1 ^= both
        over |= c2 & top
        c2 ^= top
        over |= c2 & (c0 | c1)
        if p % 9 == 6:
            open_ = (over != FULL).any(axis=0)
            if not open_.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if open_.sum() * 4 <= len(alive) * 3:
                alive, part = alive[open_], part[:, open_]
                c0, c1, c2, over = c0[:, open_], c1[:, open_], c2[:, open_], over[:, open_]
    rows, words = np.nonzero(over != FULL)
    bits = np.unpackbits((~over[rows, words]).view(np.uint8).reshape(len(rows), 8), axis=1, bitorder="little")
    k, bit = np.nonzero(bits)
    columns = alive[words[k]] * 64 + bit
    real = columns < n
    return rows[k][real], columns[real]


def near_any(queries: np.ndarray, planes: np.ndarray, n: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for another radius: a ripple counter of seven bit planes."""
    masks = np.where((queries[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1), FULL, np.uint64(0))
    counter = [np.zeros((len(queries), planes.shape[1]), np.uint64) for _ in range(7)]
    for p in range(64):
        carry = planes[p] ^ masks[:, p, None]
        for i in range(7):
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
    below, equal = np.zeros_like(counter[0]), np.full_like(counter[0], FULL)
    for i in range(6, -1, -1):
        if radius >> i & 1:
            below, equal = below | (equal & ~counter[i]), equal & counter[i]
        else:
            equal = equal & ~counter[i]
    within = below | equal
    rows, words = np.nonzero(within)
    bits = np.unpackbits(within[rows, words].view(np.uint8).reshape(len(rows), 8), axis=1, bitorder="little")
    k, bit = np.nonzero(bits)
    columns = words[k] * 64 + bit
    real = columns < n
    return rows[k][real], columns[real]


def local_components(fps: np.ndarray, radius: int = RADIUS, dense: int = 4096, tries: int = 8) -> np.ndarray:
    """For each fingerprint the position of its component's representative.

    In a large bucket whole components are first peeled off one at a time: what has been reached is compared
    with what has not, so a dense component costs little more than its size. The rest is compared half-matrix.
    """
    n = len(fps)
    root = np.arange(n)
    left = np.arange(n)
    step = max(1, min(256, (1 << 17) // ((n + 63) // 64)))
    if n > dense:
        failed = 0
        while failed < tries and len(left) > dense:
            seed, left = left[:1], left[1:]
            queue, size = seed, 1
            while len(queue) and len(left):
                now, queue = queue[:step], queue[step:]
                _, hit = near(fps[now], planes_of(fps[left]), len(left), radius)
                if len(hit):
                    hit = np.unique(hit)
                    queue = np.concatenate([queue, left[hit]])
                    root[left[hit]] = seed[0]
                    size += len(hit)
                    left = np.delete(left, hit)
            failed = failed + 1 if size < 64 else 0

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(0, len(left), step):
        rest = left[i:]
        a, b = near(fps[rest[:step]], planes_of(fps[rest]), len(rest), radius)
        ahead = b > a
        for x, y in zip(rest[a[ahead]].tolist(), rest[b[ahead]].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    for i in range(n):
        root[i] = find(i)
    return root


# --- candidate keys


def key_masks(bits: int, radius: int = RADIUS) -> list[int]:
    """Masks of which every pair within the radius agrees on at least one, with about ``bits`` bits each."""
    for agree in range(1, 5):
        blocks = radius + agree
        edges = [64 * i // blocks for i in range(blocks + 1)]
        narrow = min(b - a for a, b in zip(edges, edges[1:], strict=False))
        if bits <= agree * narrow or agree == 4:
            each = min(narrow, -(-bits // agree)) if bits else 0
            parts = [((1 << each) - 1) << a for a in edges[:-1]]
            return [sum(parts[i] for i in chosen) for chosen in combinations(range(blocks), agree)] if each else [0]
    raise AssertionError


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_keys(df: DataFrame, masks: list[int], index: str, value: str) -> DataFrame:
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("v")) for i, m in enumerate(masks)]))
    return df.withColumn("_k", keys).select(*df.columns, F.col("_k.i").alias(index), F.col("_k.v").alias(value))


def links(classes: DataFrame, n: int, radius: int = RADIUS, bucket: int = BUCKET, split: int = SPLIT) -> DataFrame:
    """u, v: within each bucket a star per component of the distinct fingerprints ``fp``; n is their number."""
    bits = max(0, int(np.ceil(np.log2(max(1, n) / bucket))))
    keyed = with_keys(classes.select("fp"), key_masks(bits, radius), "i", "v")

    def star(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        root = local_components(fps, radius)
        away = np.flatnonzero(root != np.arange(len(fps)))
        return pa.table({"u": fps[away].view(np.int64), "v": fps[root[away]].view(np.int64)})

    cold = keyed
    hot_links = None
    if n > split:
        hot = keyed.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split).select(F.col("i").alias("hi"), F.col("v").alias("hv"))
        hot = stored(hot, "hot-buckets")
        if not hot.isEmpty():
            same = (F.col("i") == F.col("hi")) & (F.col("v") == F.col("hv"))
            cold = keyed.join(hot, same, "left_anti")
            again = with_keys(keyed.join(hot, same, "left_semi"), key_masks(32, radius), "j", "w")
            hot_links = again.groupBy("i", "v", "j", "w").applyInArrow(star, "u long, v long")
    found = cold.groupBy("i", "v").applyInArrow(star, "u long, v long")
    return found.union(hot_links) if hot_links is not None else found


# --- the operator


def linked(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, *keys: Column) -> DataFrame:
    """doc_id, the keys, fp, root (one fingerprint of the component, which tells it from all others) and component_id."""
    fps = stored(docs.select("doc_id", *keys, fingerprint_of(shingle)("text").alias("fp")), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(links(classes, classes.count(), radius))
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    # Written once, so that both sides of the join are plain shuffles and Spark can split a giant component.
    smallest = stored(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    return fps.join(placed.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (64 bits as a long), component_id: the smallest doc_id of all documents linked to it."""
    return linked(docs, shingle, radius).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, also of one without ids: of the rows with its smallest id the one whose id and text
    have the smallest hash. Ids are not keys: a row comes back by its hash and its id. Of equal rows one stays."""
    row = F.xxhash64("doc_id", "text").alias("_row")
    first = linked(docs, shingle, radius, row).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("root", "_row", "doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    kept = first.groupBy("root").agg(F.min(F.struct("_row", "doc_id", "_rows")).alias("k"))
    kept = stored(kept.select(F.col("k._row").alias("_key"), F.col("k.doc_id").alias("_id"), F.col("k._rows").alias("_rows")), "kept")
    met = wrapped(docs, "doc_id", "text").withColumn("_row", row)
    met = met.join(kept, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    once = met.where(F.col("_rows") == 1)
    if not kept.where(F.col("_rows") > 1).isEmpty():
        once = once.union(met.where(F.col("_rows") > 1).dropDuplicates(["_row", "doc_id"]))
    return unwrapped(once, docs.columns, doc_id=F.col("doc_id"), text=F.col("text"))
