"""Spelling variants of a vocabulary by finite-state composition.

The vocabulary's acceptor is composed with a transducer of exactly one edit (replace, delete or insert a code point) and with the acceptor
again; what it accepts are the near pairs. The work is dealt by initial states: two words one edit apart share either the first half of
the shorter one's length or its last half, so each word stands in the partitions of its halves (of words of its own length, and of words
one shorter), and each partition composes the acceptor of what its words have left. A state is its right language, equal languages are
one state (the minimised acceptor), so the edits at a state are worked out once for all paths that lead there; chains without a branch
are passed in one step. A pair is accepted at the last place where its edit can stand, and only in the partition that holds this
place, so it counts once.

A partition above ``SPLIT`` words is dealt again by the halves of what is left, down to one code point and two, where the alphabet bounds
it. Counts and best neighbours are reduced per partition; pairs are never rows.

Defined cases: a null text has no words, a null doc_id hashes as an empty one, an empty vocabulary gives no rows, words are told apart by
code points, ties go to the word that is smaller by code points, words that stand alone have no form and are their own root. Words and texts
may be of any length; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO, EVERY = 7, 2, 10, 31
SPLIT = 10_000
# A map task hands on its counts when it holds this many words.
HELD_WORDS = 300_000


def _counts(batches: Iterator[pa.RecordBatch], least: int, every: int) -> Iterator[pa.RecordBatch]:
    # ASCII lower case of the UTF-8 bytes; only runs that can still be long enough after a deletion matter.
    runs = re.compile(f"[{LETTERS}]{{{least},}}")
    held: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            before = zlib.crc32(f"{doc_id}:".encode())
            for run, n in Counter(runs.findall(text.lower().decode())).items():
                mark = zlib.crc32(run.encode(), before)
                if mark % every:
                    held[run] += n
                elif len(run) > least:
                    at = mark % len(run)
                    held[run[:at] + run[at + 1 :]] += n
            if len(held) > HELD_WORDS:
                yield out()
                held = Counter()
    if held:
        yield out()


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """word, n: runs of letters of ``doc_id, text`` with A-Z in lower case, of at least ``least`` code points and ``count`` occurrences.

    Where ``every`` divides h, the crc32 of ``doc_id:run``, the run has lost its code point h % length.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = texts.where("text IS NOT NULL").mapInArrow(lambda batches: _counts(batches, least, every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def _dealt(rows: DataFrame) -> DataFrame:
    """Each row in the partition of its first half and in that of its last half; what is left is ``word[from:to]``, of c or c + 1 code points."""
    half = F.floor(F.col("c") / 2).cast("int")
    rest = F.col("c") - half
    first = F.struct(
        F.concat("key", F.lit("F"), F.substring("word", F.col("from") + 1, half)).alias("key"), (F.col("from") + half).alias("from"), F.col("to").alias("to"),
        rest.alias("c"), F.col("late").alias("late"),
    )
    last = F.struct(
        F.concat("key", F.lit("B"), F.substring("word", F.col("to") - rest + 1, rest)).alias("key"), F.col("from").alias("from"), (F.col("to") - rest).alias("to"),
        half.alias("c"), F.lit(False).alias("late"),
    )
    return rows.withColumn("p", F.explode(F.array(first, last))).select("word", "n", "p.*").where("c > 0")


def compose(rests: list[str], short: int, late: bool) -> Iterator[tuple[int, int]]:
    """Pairs of positions in the sorted, distinct ``rests`` (of ``short`` or ``short + 1`` code points) that are one edit apart.

    Rests of ``short + 1`` are not paired with each other. Unless ``late``, an edit that may stand at the very end is not accepted.
    """
    states: dict[tuple, tuple[list, list]] = {}
    open_ = [(0, len(rests), 0)]
    while open_:
        low, high, depth = open_.pop()
        a, b = rests[low], rests[high - 1]
        if a[depth : depth + 1] == b[depth : depth + 1]:
            depth = _common(a, b, depth)
        language = tuple([w[depth:] for w in rests[low:high]])
        known = states.get((short - depth, language))
        if known is None:
            known = states[short - depth, language] = _edits(language, short - depth, late)
        pairs, arcs = known
        for i, j in pairs:
            yield low + i, low + j
        for i, j in arcs:
            open_.append((low + i, low + j, depth + 1))


def _common(a: str, b: str, depth: int) -> int:
    """Where the common start of two texts that agree up to ``depth`` ends."""
    step, most = 1, min(len(a), len(b))
    while depth < most and a[depth : depth + step] == b[depth : depth + step]:
        depth, step = min(depth + step, most), step * 2
    while step > 1:
        step //= 2
        if a[depth : depth + step] == b[depth : depth + step]:
            depth = min(depth + step, most)
    return depth


def _edits(language: tuple[str, ...], short: int, late: bool) -> tuple[list, list]:
    """Of one state: the accepted pairs whose edit is the next symbol, and the arcs (ranges of words) behind which more may follow."""
    ends: dict[str, list[int]] = {}
    whole = {}
    for i, w in enumerate(language):
        if len(w) == short:
            whole[w] = i
            if w:
                ends.setdefault(w[1:], []).append(i)
    # Replace: after the arcs of two symbols the same word is left.
    pairs = [(x, y) for same in ends.values() if len(same) > 1 for k, x in enumerate(same) for y in same[:k]]
    arcs, start, n = [], 0, len(language)
    for i, w in enumerate(language):
        if len(w) > short and (late or short):
            # Delete: what is left after the arc is a word of the state itself; the edit stands at its last place.
            j = whole.get(w[1:])
            if j is not None and language[j][:1] != w[0]:
                pairs.append((i, j))
        if i + 1 == n or language[i + 1][:1] != w[:1]:
            if i > start and w:
                arcs.append((start, i + 1))
            start = i + 1
    return pairs, arcs


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of each word within its partitions; rows come sorted by partition."""
    held: list[tuple] = []
    now, group = None, []

    def close():
        if len(group) < 2:
            return
        group.sort()
        _, _, _, short, late = group[0]
        found: dict[int, list] = {}
        for i, j in compose([g[0] for g in group], short, late):
            for x, y in ((i, j), (j, i)):
                _, word, n, _, _ = group[y]
                best = found.get(x)
                if best is None:
                    found[x] = [1, n, word]
                else:
                    best[0] += 1
                    if n > best[1] or n == best[1] and word < best[2]:
                        best[1:] = n, word
        held.extend((group[x][1], *best) for x, best in found.items())

    for batch in batches:
        for key, word, n, a, b, c, late in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if key != now:
                close()
                now, group = key, []
            group.append((word[a:b], word, n, c, late))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), NEAR, strict=True)], schema=NEAR)
            held = []
    close()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), NEAR, strict=True)], schema=NEAR)


def neighbours(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """word, n_near, best_n, best: how many words of ``word, n`` (distinct) are one edit away, and the one of largest n (ties: the smaller)."""
    size = F.length("word")
    classes = F.filter(F.array(size, size - 1), lambda c: c > 0)
    rows = words.select("word", "n", F.explode(classes).alias("c"), F.lit(0).alias("from"), size.alias("to"), F.lit(True).alias("late"))
    rows = _dealt(rows.withColumn("key", F.concat(F.col("c").cast("string"), F.lit(":"))))
    done = []
    while True:
        hot = stored(rows.where("c > 1").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > split).select("key"), "variant-keys")
        if hot.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(hot, "key", "left_anti"))
        rows = _dealt(rows.join(hot, "key", "left_semi"))
    parts = []
    for part in done:
        sent = part.select("key", "word", "n", "from", "to", "c", "late")
        parts.append(sent.repartition("key").sortWithinPartitions("key").mapInArrow(_near, "word string, n_near long, best_n long, best string"))
    near = parts[0]
    for more in parts[1:]:
        near = near.unionByName(more)
    best = F.min(F.struct((-F.col("best_n")).alias("down"), F.col("best").alias("word")))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.down")).alias("best_n"), F.col("top.word").alias("best")
    )


def variants(words: DataFrame, ratio: int = RATIO, split: int = SPLIT) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary ``word, n``.

    The form is the near word of largest n, if that is ``ratio`` times the word's n; the root is where the forms lead.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    near = neighbours(words, split)
    frequent = F.col("best_n") >= ratio * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(frequent, F.col("best")).alias("form"),
            F.when(frequent, F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    root = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Each form is ``ratio`` times as frequent, so a path has no more steps than this; every round doubles what a pointer spans.
    most, steps = formed.agg(F.max("n")).first()[0] or 0, 0
    while ratio > 1 and most >= ratio:
        most, steps = most // ratio, steps + 1
    for _ in range(max(steps - 1, 0).bit_length()):
        onward = root.select(F.col("word").alias("at"), F.col("root").alias("next"))
        root = stored(root.join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return formed.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
