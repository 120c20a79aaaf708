"""Removal of repeated passages by recompression.

The words of a text are rewritten in rounds. The run round merges a word that stands twice in a row, the pair rounds merge neighbours whose
symbols fall into the first and the second half of a hash-drawn split of the alphabet. A symbol's name is a 64-bit hash of
what it is made of, so the same pair or run gets the same name in every document, on every executor, without a dictionary or a
shuffle for each round, and equal passages have equal symbols but for a few at their edges.

After the rounds a symbol has at most 8 words and depends on at most 8 words on either side. So every window of 35 words holds a symbol
that the window's own words determine; the longest of them (then the one with the smallest name, then the leftmost) is the
window's anchor. Equal windows have equal anchors at equal places.

1. Anchors are counted over all documents. Those that occur once are done with, and all their windows.
2. The windows of repeated anchors are verified: an occurrence of an anchor carries a 64-bit hash of each of its windows, and
   windows are equal if anchor and hash are.
3. Words covered by an equal window go.

What repeats inside one batch of a task is settled there, and one row tells the other batches: a passage that a third of all
documents share costs a row per batch, and no key gathers rows in proportion to its number of copies. Windows that differ can share an anchor, such
as a line of 8 to 34 words that stands in many surroundings: the windows of an anchor with over ``HOT`` occurrences are dealt by their own hashes.

Defined cases: null text has no words; texts shorter than a window lose nothing; rows with equal doc_id or equal in all columns are separate
occurrences; runs of one word repeat themselves; an empty table gives an empty result; columns with clashing names are replaced.
A row is known by the 64-bit hash of doc_id and text; equal rows share their lists, which are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import stored, unwrapped, with_fields, wrapped

WINDOW = 35
PAIR_ROUNDS = 2
CONTEXT = 8  # 2 words for the run round, then the 2 and 4 words of a neighbouring symbol
LONGEST = 8
BATCH_BYTES = 2 << 20
TABLE = 1 << 16
BUCKET_ROWS = 20_000
HOT = 10_000
LENGTH_BITS = 32

_rng = np.random.default_rng(20240607)
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
WORD_BASE, WINDOW_BASE = (int(x) | 1 for x in _rng.integers(1, 1 << 63, 2, dtype=np.uint64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


# --- words


def word_hashes(raw: bytes, word_powers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word."""
    b = np.frombuffer(raw, np.uint8)
    gap = SPACE[b]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).view(np.int8)))
    begin, end = edges[0::2], edges[1::2]
    out = np.zeros(len(begin), np.uint64)
    step = 1 << 18
    for i in range(0, len(begin), step):  # so many words at a time
        s = begin[i : i + step]
        lo, hi = int(s[0]), int(end[min(i + step, len(begin)) - 1])
        size = np.diff(np.append(s, hi))
        at = np.minimum(np.arange(hi - lo) - np.repeat(s - lo, size), TABLE - 1)
        value = BYTE_VALUES[b[lo:hi]] * word_powers[at]
        value[gap[lo:hi]] = 0
        out[i : i + step] = np.add.reduceat(value, s - lo)
    out = mixed(out + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for i in np.flatnonzero(end - begin >= TABLE).tolist():
        out[i] = xxhash.xxh64_intdigest(raw[begin[i] : end[i]], 1)
    return out, begin


# --- recompression


def named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * np.uint64(0x9E3779B185EBCA87) + ((b << np.uint64(31)) | (b >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F))


class Parse:
    """The words and the symbols of a batch of documents."""

    def __init__(self, raws: list[bytes], word_powers: np.ndarray):
        joined = b"\n".join(raws)
        self.words, begin = word_hashes(joined, word_powers) if joined else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        sizes = np.array([len(r) + 1 for r in raws], np.int64)
        # Words of document d: from doc[d] to doc[d + 1].
        self.doc = np.append(np.searchsorted(begin, np.cumsum(sizes) - sizes), len(begin))
        self.n = len(begin)
        count = np.diff(self.doc)
        self.owner = np.repeat(np.arange(len(raws)), count)
        self.end = np.repeat(self.doc[1:], count)
        self.symbol, self.start = self.words.copy(), np.arange(self.n)
        self.first = np.zeros(self.n, bool)
        self.first[self.doc[:-1][count > 0]] = True
        self.twice()
        for r in range(PAIR_ROUNDS):
            self.pairs(r)

    def lengths(self) -> np.ndarray:
        return np.diff(np.append(self.start, self.n))

    def _merge(self, at: np.ndarray, names: np.ndarray) -> None:
        self.symbol[at] = names
        keep = np.ones(len(self.symbol), bool)
        keep[at + 1] = False
        self.symbol, self.start, self.first = self.symbol[keep], self.start[keep], self.first[keep]

    def twice(self) -> None:
        """The run round: a word that stands exactly twice. Longer runs have no place inside them that a window could tell."""
        same = np.concatenate([[False], (self.symbol[1:] == self.symbol[:-1]) & ~self.first[1:], [False]])
        at = np.flatnonzero(same[1:-1] & ~same[:-2] & ~same[2:])
        self._merge(at, named(self.symbol[at] ^ np.uint64(0x5851F42D4C957F2D), self.symbol[at]))

    def pairs(self, r: int) -> None:
        second = (self.symbol >> np.uint64(r + 7)) & np.uint64(1) == 1
        at = np.flatnonzero(~second[:-1] & second[1:] & ~self.first[1:])
        self._merge(at, named(self.symbol[at], self.symbol[at + 1]))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Begins of all windows, and for each the word at which its anchor begins."""
        if self.n < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rank = np.full(self.n, np.iinfo(np.uint64).max, np.uint64)
        rank[self.start] = ((LONGEST - self.lengths()).astype(np.uint64) << np.uint64(60)) | (self.symbol >> np.uint64(4))
        best, place = rank, np.arange(self.n)
        # An anchor begins in the 12 words from CONTEXT on: any of them ends CONTEXT words before the window does.
        for k in (1, 2, 4, 4):
            later = best[k:] < best[:-k]
            best, place = np.where(later, best[k:], best[:-k]), np.where(later, place[k:], place[:-k])
        begins = np.flatnonzero(self.end - np.arange(self.n) >= WINDOW)
        return begins, place[begins + CONTEXT]

    def names(self, place: np.ndarray) -> np.ndarray:
        """The symbols that begin at these words."""
        return self.symbol[np.searchsorted(self.start, place)]

    def window_hashes(self, begins: np.ndarray) -> np.ndarray:
        out, base = np.zeros(len(begins), np.uint64), np.uint64(WINDOW_BASE)
        for i in range(WINDOW):
            out = out * base + self.words[begins + i]
        return mixed(out)


def changes(*values: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the entry before, the first included."""
    out = np.zeros(len(values[0]), bool)
    out[:1] = True
    for v in values:
        out[1:] |= v[1:] != v[:-1]
    return out


def repeats(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries occur more than once, and which of those is the first of its kind."""
    order = np.argsort(values, kind="stable")
    new = changes(values[order])
    alone = new & np.append(new[1:], True)[: len(new)]
    again, lead = np.zeros(len(values), bool), np.zeros(len(values), bool)
    again[order[~alone]] = True
    lead[order[new & ~alone]] = True
    return again, lead


def batches_of(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of an Arrow batch with about so many bytes of text, and their texts; only a part's texts are copied at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    begin = size = 0
    for i, n in enumerate([*sizes, limit + 1]):
        if i > begin and (size + n > limit or i == len(sizes)):
            part = batch.slice(begin, i - begin)
            yield part, [x or b"" for x in part.column("text").cast(pa.binary()).to_pylist()]
            begin, size = i, 0
        size += n


# --- the passes over the texts

OCCURRENCES = "key long, row long, place long, weight int, name long"


def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of anchors. One that repeats in this batch is known to be repeated: it gets a key of its own and weight 2, and
    a row without a document, which weighs as much as they are, tells the other batches. Its name stays beside the key of its own."""
    word_powers = powers(WORD_BASE, TABLE)
    for batch in batches:
        for part, raws in batches_of(batch):
            p = Parse(raws, word_powers)
            _, place = p.anchors()
            if not len(place):
                continue
            place = place[changes(place)]
            key, owner = p.names(place), p.owner[place]
            row, place = part.column("row").to_numpy()[owner], place - p.doc[owner]
            again, _ = repeats(key)
            told, times = np.unique(key[again], return_counts=True)
            own = np.where(again, mixed(key + mixed(row.view(np.uint64) ^ place.astype(np.uint64))), key)
            none = np.zeros(len(told), np.int64)
            yield pa.record_batch({
                "key": pa.array(np.concatenate([own, told]).view(np.int64)),
                "row": pa.array(np.concatenate([row, none]), mask=np.repeat([False, True], [len(key), len(told)])),
                "place": pa.array(np.concatenate([place, none])),
                "weight": pa.array(np.concatenate([np.where(again, 2, 1), times]).astype(np.int32)),
                "name": pa.array(np.concatenate([key, told]).view(np.int64), mask=np.concatenate([~again, np.ones(len(told), bool)])),
            })


CANDIDATES = "key long, row long, place long, hashes binary"


def runs(key: np.ndarray, row: np.ndarray, begins: np.ndarray, hashes: np.ndarray) -> tuple[list, list, list, list]:
    """One entry for windows that follow each other and have one anchor: key, row, first window, hashes."""
    if not len(key):
        return [], [], [], []
    cut = np.flatnonzero(changes(key, row, begins - np.arange(len(begins))))
    raw, ends = hashes.tobytes(), [*cut[1:].tolist(), len(key)]
    blobs = [raw[8 * a : 8 * b] for a, b in zip(cut.tolist(), ends, strict=True)]
    return key[cut].view(np.int64).tolist(), row[cut].tolist(), begins[cut].tolist(), blobs


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of repeated anchors with their hashes. Windows that repeat in this batch are settled: they come as ranges of
    words without hashes, and a row without a document tells the other batches. Hot anchors give their windows keys of their own."""
    word_powers = powers(WORD_BASE, TABLE)
    for batch in batches:
        for part, raws in batches_of(batch):
            p = Parse(raws, word_powers)
            begins, place = p.anchors()
            if not len(begins):
                continue
            lists = part.column("places")
            flat = np.concatenate([x.values.to_numpy() + 2 * d if x.is_valid else np.zeros(0, np.int64) for x, d in zip(lists, p.doc.tolist(), strict=False)])
            known, hot = np.zeros(p.n, bool), np.zeros(p.n, bool)
            known[flat >> 1] = True
            hot[flat[flat & 1 == 1] >> 1] = True
            begins, place = begins[use := known[place]], place[use]
            hashes, key, owner = p.window_hashes(begins), p.names(place), p.owner[begins]
            row, at = part.column("row").to_numpy()[owner], begins - p.doc[owner]
            key = np.where(hot[place], mixed(key ^ hashes), key)
            again, lead = repeats(hashes)
            keys, rows, places, blobs = runs(key[~again], row[~again], at[~again], hashes[~again])
            k, _, a, b = runs(key[lead], row[lead], at[lead], hashes[lead])
            keys, rows, places, blobs = keys + k, rows + [None] * len(k), places + a, blobs + b
            spans = ranges(row[again], at[again])
            keys += mixed(spans[0].view(np.uint64) + spans[1].astype(np.uint64)).view(np.int64).tolist()
            rows, places, blobs = rows + spans[0].tolist(), places + spans[1].tolist(), blobs + [None] * len(spans[0])
            yield pa.record_batch({"key": pa.array(keys, pa.int64()), "row": pa.array(rows, pa.int64()), "place": pa.array(places, pa.int64()), "hashes": pa.array(blobs, pa.binary())})


def ranges(row: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and ranges (first word and number of words, packed) that cover these windows; windows that touch make one range."""
    order = np.lexsort((begins, row))
    row, begins = row[order], begins[order]
    new = changes(row)
    new[1:] |= begins[1:] > begins[:-1] + WINDOW
    cut = np.flatnonzero(new)
    last = begins[np.append(cut[1:], len(row))[: len(cut)] - 1]
    return row[cut], (begins[cut] << LENGTH_BITS) | (last + WINDOW - begins[cut])


def verify(table: pa.Table) -> pa.Table:
    """Ranges of the windows in a bucket of anchors that occur at least twice; ranges that are settled pass through."""
    settled = table.filter(pc.is_null(table.column("hashes")))
    open_ = table.filter(pc.is_valid(table.column("hashes")))
    blobs = open_.column("hashes").to_pylist()
    hashes = np.frombuffer(b"".join(blobs), np.uint64)
    each = np.array([len(b) // 8 for b in blobs], np.int64)
    of = np.repeat(np.arange(len(blobs)), each)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    key = open_.column("key").to_numpy()[of]
    named_row = pc.is_valid(open_.column("row")).to_numpy(zero_copy_only=False)[of]
    order = np.lexsort((hashes, key))
    group = np.cumsum(changes(key[order], hashes[order])) - 1
    weight = np.bincount(group, np.where(named_row[order], 1, 2)) if len(group) else np.zeros(0)
    hit = order[(weight[group] >= 2) & named_row[order]]
    row = pc.fill_null(open_.column("row"), 0).to_numpy()[of[hit]]
    rows, places = ranges(row, open_.column("place").to_numpy()[of[hit]] + nth[hit])
    return pa.table({"row": np.concatenate([settled.column("row").to_numpy(), rows]), "place": np.concatenate([settled.column("place").to_numpy(), places])})


def removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of the input without ``row`` and ``places``; kept words, n_words, n_removed."""
    for batch in batches:
        for part, raws in batches_of(batch):
            kept, n_words, n_removed = [], [], []
            for raw, listed in zip(raws, part.column("places"), strict=True):
                words = raw.split()
                n = len(words)
                if listed.is_valid and len(listed):
                    flat = listed.values.to_numpy()
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, flat >> LENGTH_BITS, 1)
                    np.add.at(change, (flat >> LENGTH_BITS) + (flat & ((1 << LENGTH_BITS) - 1)), -1)
                    stay = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                    words = [words[i] for i in stay]
                kept.append(b" ".join(words))
                n_words.append(n)
                n_removed.append(n - len(words))
            columns = {c: part.column(c) for c in part.schema.names if c not in ("row", "places")}
            columns |= {"kept": pa.array(kept, pa.binary()).cast(pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
            yield pa.record_batch(columns)


# --- the operator


def repeated(occurrences: DataFrame, hot: int) -> DataFrame:
    """row, place and name of the occurrences whose key weighs at least 2 over all documents; names that weigh over ``hot``, also without a row.

    The window streams: a key has two rows of a few bytes per batch of texts at most, however often it occurs.
    """
    weighed = occurrences.withColumn("weight", F.sum("weight").over(Window.partitionBy("key")))
    above = F.col("weight") > hot
    kept = weighed.where((F.col("weight") >= 2) & (F.col("row").isNotNull() | above))
    return kept.select("row", "place", F.coalesce("name", "key").alias("name"), F.when(above, F.col("key")).alias("key"))


def flagged(found: DataFrame) -> DataFrame:
    """row, place: the last bit of a place tells that its anchor is hot. The hot names meet the places in a join; they stay a table."""
    places = found.where(F.col("row").isNotNull())
    hot = stored(found.where(F.col("key").isNotNull()).select(F.col("key").alias("h_name")).distinct(), "hot-anchors")
    if hot.isEmpty():
        return places.select("row", F.shiftleft("place", 1).alias("place"))
    met = places.join(hot, F.col("name") == F.col("h_name"), "left")
    return met.select("row", F.shiftleft("place", 1).bitwiseOR(F.col("h_name").isNotNull().cast("long")).alias("place"))


def listed(places: DataFrame) -> DataFrame:
    """The distinct places of a row, no more than its text has words: rows that repeat have equal places, which are one."""
    return places.groupBy("row").agg(F.collect_set("place").alias("places")).withColumnRenamed("row", "l_row")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with kept (the words that stay, joined by one space), n_words and n_removed."""
    base = docs.drop("row", "places", "kept", "n_words", "n_removed")
    texts = base.withColumn("row", F.xxhash64("doc_id", "text"))
    places = flagged(stored(repeated(texts.select("row", "text").mapInArrow(symbols, OCCURRENCES), HOT), "repeated-symbols"))
    hot = F.col("place").bitwiseAND(F.lit(1))
    size = places.agg(F.coalesce(F.sum(1 + CONTEXT * hot), F.lit(0))).first()[0]
    buckets = max(1, -(-size // BUCKET_ROWS))
    with_list = texts.join(listed(places), F.col("row") == F.col("l_row")).drop("l_row")
    candidates = with_list.mapInArrow(windows, CANDIDATES).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    covered = candidates.groupBy("bucket").applyInArrow(lambda t: verify(t), "row long, place long")
    schema = with_fields(base.schema, kept=T.StringType(), n_words=T.LongType(), n_removed=T.LongType())
    return texts.join(listed(covered), F.col("row") == F.col("l_row"), "left").drop("l_row").mapInArrow(removal, schema)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated words. A text that loses nothing stays as it is; the others are their kept words."""
    done = remove_repeats(wrapped(docs, "doc_id", "text"))
    lost = F.col("n_removed") > 0
    plain = {"doc_id": F.col("doc_id"), "text": F.when(lost, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        plain["n_chars"] = F.when(lost, F.length("kept")).otherwise(F.col("_rest.n_chars")).cast("long")
    return unwrapped(done, docs.columns, **plain)
