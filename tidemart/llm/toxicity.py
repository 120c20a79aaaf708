"""Toxicity of documents behind disguises: texts are restored by a noisy-channel model before they are scored.

1. A character trigram model is counted over all documents. The alphabet is fixed, so the counts are a bounded table, while what is
   counted grows with the input.
2. A token that may be disguised (digits or signs among letters, a letter three times or more in a row, separators inside, letters set
   apart by blanks) becomes a lattice: each place offers the letters its character may stand for, with a cost. Viterbi decoding
   finds the cheapest path under the language model; a separator may be dropped or stay as a word's end. Tokens of any length are decoded
   in one pass, paths share what they have in common, and every state (the last two letters) that a cheapest path may pass is kept. A run of one letter is one
   place; each sign of a run has a place of its own, or the run stands for one letter or a double one. Signs at a token's
   ends that may stand for letters are read both ways, as signs and as letters.
3. Words of the restored text have features (the word, its first 4 to 6 letters). Their weights are lower bounds of log odds, counted over
   labelled documents, and a document's evidence is the sum of its three strongest words; a logistic curve turns it into a score.

Training takes at most ``max_train`` labelled documents, the first by a hash of doc_id; features need a minimum of toxic documents, and the
``max_features`` strongest are kept, so the model that tasks receive is bounded. Everything else covers all documents.

Defined cases: null and empty texts get the score of no evidence; labels that are null are left out, of several labels of one document the highest
counts; rows with an equal doc_id are scored apart; without toxic labels nothing is evidence; empty tables give an empty result; columns
of the input that clash with those added are replaced.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import stored, unwrapped, with_fields, worker_store, wrapped

MAX_TRAIN = 20_000
MAX_FEATURES = 20_000
MIN_TOXIC = 3
PREFIXES = (4, 5, 6)
STRONGEST = 3
CACHED = 200_000

# The letters of the language model, and what signs may stand for.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "(": "c", "{": "c", "<": "c", "§": "s", "¢": "c", "×": "x", "µ": "u",
}
LOOKALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "і": "i", "у": "y", "к": "k", "м": "m", "т": "t", "ο": "o", "α": "a"}
HIDDEN = "​‌‍⁠﻿­"
WILD = "*#%?"

SIZE = 64
CODE = np.zeros(1 << 16, np.uint8)
for _i, _c in enumerate(LETTERS):
    CODE[ord(_c)] = _i + 1
LEET_COST, WILD_COST, DROP_COST, REPEAT_COST = 1.0, 3.0, 2.0, 1.0
DIGIT_END, DIGIT_DROP, BLANK_END, BLANK_DROP = 6.0, 10.0, 1.5, 0.5
DENSE, PROBES = 256, 2  # more transitions of a place are worked out as one matrix; states that probe for a bound

FRONT, READABLE = frozenset("_@$€£"), frozenset([*LEET, *WILD])
LETTER, OTHER = re.compile(r"[^\W\d_]"), re.compile(r"[\W\d_]")
DOUBLE, TRIPLE = re.compile(r"(.)\1"), re.compile(r"([^\W\d_])\1\1")
REPEATS = re.compile(r"(.)\1*", re.S)
SPACED = re.compile(r"(?:(?<=\s)|^)\S(?:[ \t]\S){2,}(?=\s|$)")


# --- language model


def codes(text: str) -> np.ndarray:
    return CODE[np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), np.uint16)]


def trigrams(texts: Iterable[str]) -> np.ndarray:
    """Counts of letter trigrams; everything that is no letter ends a word."""
    total = np.zeros(SIZE**3, np.int64)
    for text in texts:
        c = codes(f"  {text} ").astype(np.int32)
        c = c[np.concatenate([[True, True], (c[2:] > 0) | (c[1:-1] > 0)])]  # one or two ends in a row, no more
        total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
    return total


def language_model(counts: np.ndarray) -> np.ndarray:
    """log p(c | a, b) as a cube: trigrams backed by bigrams, backed by single letters."""
    c3 = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    n = len(LETTERS) + 1
    c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
    p1 = (c1 + 0.5) / (c1.sum() + 0.5 * n)
    p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
    p3 = (c3 + 5 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


def corpus_model(docs: DataFrame) -> np.ndarray:
    """The language model of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            texts = (t for t in batch.column("text").to_pylist() if t)
            for part in joined(texts):
                total += trigrams([part])
        used = np.flatnonzero(total)
        yield pa.record_batch({"gram": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()  # at most 64 ** 3 rows
    counts = np.zeros(SIZE**3, np.int64)
    for r in rows:
        counts[r.gram] = r.n
    return language_model(counts)


def joined(texts: Iterable[str], size: int = 1 << 20) -> Iterator[str]:
    """Texts in parts of about so many characters, long ones cut."""
    part, n = [], 0
    for t in texts:
        for i in range(0, len(t), size):
            part.append(t[i : i + size])
            n += len(part[-1])
            if n >= size:
                yield "\n".join(part)
                part, n = [], 0
    if part:
        yield "\n".join(part)


# --- decoding


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each place what may stand there and at what cost; a blank is a word's end."""
    places = []
    for m in REPEATS.finditer(token):
        c, n = m.group(1), len(m.group())
        c = LOOKALIKE.get(c, c)
        if c in HIDDEN:
            continue
        if c.isalpha():
            if n >= 3:
                places.append([(c, REPEAT_COST), (c * 2, REPEAT_COST)])
            else:
                places.append([(c * n, 0.0)] + ([(c, REPEAT_COST)] if n == 2 else []))
            continue
        options = [(letter, LEET_COST) for letter in LEET.get(c, "")]
        options += [(letter, WILD_COST) for letter in LETTERS[:26]] if c in WILD else []
        end, drop = (DIGIT_END, DIGIT_DROP) if c.isdigit() else (BLANK_END, BLANK_DROP) if c.isspace() else (0.0, DROP_COST)
        options += [(" ", end), ("", drop)]
        readings = [(o, cost) for o, cost in options if o.isalpha()]
        if n == 1 or not readings:
            places.append(options)
            continue
        places.append(options + [(o * 2, cost + LEET_COST) for o, cost in readings])
        places += [[*readings, (" ", end), ("", 0.0)]] * (n - 1)
    return places


def dense(states: dict, single: list[tuple[str, float]], code: dict[str, int], model: np.ndarray, after: dict) -> None:
    """The best way to each state by one letter; for each last letter all states that end in it are compared at once."""
    listed = sorted(states.items(), key=lambda s: s[0][1])
    a, b = (np.array([s[0][i] for s in listed]) for i in (0, 1))
    k = np.array([code.get(c, 0) for c, _ in single])
    total = np.array([s[1][0] for s in listed])[:, None] + np.array([extra for _, extra in single])[None] - model[a[:, None], b[:, None], k[None]].astype(float)
    begins = np.flatnonzero(np.diff(b, prepend=-1))
    for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(listed)], strict=True):
        first = total[begin:end].argmin(axis=0) + begin
        for i, cost, to, (c, _) in zip(first.tolist(), total[first, np.arange(len(k))].tolist(), k.tolist(), single, strict=True):
            at = (listed[i][0][1], to)
            if at not in after or cost < after[at][0]:
                after[at] = (cost, (listed[i][1][1], c))


def step(states: dict, options: list[tuple[str, float]], code: dict[str, int], model: np.ndarray) -> dict[tuple[int, int], tuple[float, tuple | None]]:
    """The states after a place, each with its cheapest path. A path is what was said last and the path before it."""
    after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
    if len(states) * len(options) > DENSE:
        single = [(c, extra) for c, extra in options if len(c) == 1 and c != " "]
        if single:
            dense(states, single, code, model, after)
            options = [o for o in options if len(o[0]) != 1 or o[0] == " "]
    for (a, b), (cost, said) in states.items():
        for letters, extra in options:
            x, y, total = a, b, cost + extra
            if letters == " " and y == 0:
                letters = ""
            for c in letters:
                k = code.get(c, 0) if c != " " else 0
                total -= float(model[x, y, k])
                x, y = y, k
            if (x, y) not in after or total < after[x, y][0]:
                after[x, y] = (total, (said, letters) if letters else said)
    return after


def reach(states: dict, places: list, i: int, code: dict[str, int], model: np.ndarray) -> tuple[int, float]:
    """The next place where all paths meet (behind two plain letters, or the end), and what some path costs up to there."""
    plain = lambda options: len(options) == 1 and len(options[0][0]) == 1 and options[0][0] != " "
    for j in range(i, len(places)):
        states = step(dict(heapq.nsmallest(PROBES, states.items(), key=lambda s: s[1][0])), places[j], code, model)
        if j > i and plain(places[j]) and plain(places[j - 1]):
            break
    return j + 1, min(s[0] for s in states.values())


def decode(token: str, model: np.ndarray) -> str:
    """The cheapest reading of a token: words, with blanks where it falls apart. Costs never fall along a path, so a state that
    costs more than some path up to where all meet is on no cheapest path; no other state is left out."""
    code = {c: int(CODE[ord(c)]) if ord(c) < 1 << 16 else 0 for c in set(token) | set(LETTERS)}
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    places = [*lattice(token), [(" ", 0.0)]]
    until, bound = 0, math.inf
    for i, options in enumerate(places):
        if len(states) * len(options) > DENSE:
            if i >= until:
                until, bound = reach(states, places, i, code, model)
            states = {s: v for s, v in states.items() if v[0] <= bound}
        states = step(states, options, code, model)
    path, parts = min(states.values(), key=lambda s: s[0])[1], []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts)).strip()


def odd(token: str) -> bool:
    """Whether letters stand among other characters, or one three times in a row."""
    return bool((LETTER.search(token) and OTHER.search(token)) or TRIPLE.search(token))


def trimmed(token: str, front: frozenset[str], back: frozenset[str]) -> str:
    """A token without the signs at its ends, but for those in ``front`` and ``back``."""
    i, j = 0, len(token)
    while i < j and not (token[i].isalnum() or token[i] in front):
        i += 1
    while i < j and not (token[j - 1].isalnum() or token[j - 1] in back):
        j -= 1
    return token[i:j]


def ends_there(bare: str, whole: str, model: np.ndarray) -> bool:
    """Whether a plain word ends before the signs behind it: any other reading goes on with one of their letters, and no
    such letter is cheaper than the word's end, after which signs cost nothing. What is left open is decoded."""
    behind = whole[len(bare) :]
    if not whole.startswith(bare) or DOUBLE.search(bare) or any(c.isspace() for c in behind):
        return False
    known = codes(bare)
    if not known.all():
        return False
    row = model[known[-2] if len(known) > 1 else 0, known[-1]]
    costs = [LEET_COST - row[CODE[ord(letter)]] for c in {*behind} for letter in LEET.get(c, "")]
    if any(c in WILD for c in behind):
        costs.append(WILD_COST - row[1:27].max())
    return -row[0] < min(costs)


def restored(token: str, model: np.ndarray) -> list[str]:
    """The words of a lower-case token. Most tokens are words as they stand. One with signs at its ends that may be letters has
    the words of both readings."""
    bare, whole = trimmed(token, FRONT, frozenset()), trimmed(token, READABLE, READABLE)
    disguised = lambda t: odd(t) and any(c.isalpha() or c in LOOKALIKE for c in t)
    if bare.isalpha() and not TRIPLE.search(bare):
        found = [bare]
    else:
        found = decode(bare, model).split() if disguised(bare) else [w for w in re.split(r"[\W\d_]+", bare) if w]
    if whole != bare and disguised(whole) and not (found == [bare] and ends_there(bare, whole, model)):
        found = list(dict.fromkeys([*found, *decode(whole, model).split()]))
    return found


def spaced_out(text: str) -> list[str]:
    """Runs of three single characters or more, as tokens with blanks inside."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    gaps = np.diff(np.flatnonzero((raw == 32) | (raw == 10) | (raw == 9)), prepend=-1, append=len(raw))
    single = (gaps == 2) | (gaps == 3)
    if not (single[:-1] & single[1:]).any():
        return []
    return [m.group() for m in SPACED.finditer(text)]


def tokens_of(text: str | None) -> set[str]:
    """The distinct tokens of a text in lower case, runs of single characters as one more token each."""
    lower = (text or "").lower()
    return {*lower.split(), *spaced_out(lower)}


def words_of(text: str | None, model: np.ndarray, cache: dict[str, list[str]]) -> set[str]:
    """The distinct words of the restored text."""
    out: set[str] = set()
    for token in tokens_of(text):
        found = cache.get(token)
        if found is None:
            if len(cache) > CACHED:
                cache.clear()
            cache[token] = found = restored(token, model)
        out.update(found)
    return out


# --- scorer


def features(word: str) -> list[str]:
    return [word, *["^" + word[:k] for k in PREFIXES if len(word) > k]]


@dataclass
class Model:
    language: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    slope: float = 0.0
    base: float = -2.0

    def weighed(self, token: str) -> tuple[tuple[str, float], ...] | None:
        """The words of a token that are evidence, with their weight; mostly none."""
        found = ((w, max(self.weights.get(f, 0.0) for f in features(w))) for w in restored(token, self.language))
        return tuple((w, x) for w, x in found if x) or None

    def evidence_of(self, text: str | None, cache: dict[str, tuple | None]) -> float:
        """The sum of the strongest distinct words of a text."""
        best: dict[str, float] = {}
        for token in tokens_of(text):
            if token not in cache:
                if len(cache) > CACHED:
                    cache.clear()
                cache[token] = self.weighed(token)
            if found := cache[token]:
                best.update(found)
        return sum(sorted(best.values())[-STRONGEST:])

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * evidence + self.base))))


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and base of a logistic curve, by Newton steps with a small penalty."""
    x = np.stack([evidence, np.ones(len(evidence))], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - toxic) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w -= np.clip(np.linalg.solve(h, g), -2, 2)
    return max(0.0, float(w[0])), float(w[1])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Text and label of at most ``max_train`` labelled documents outside the held-out fifth.

    Documents are told apart by id and text, so an id on many rows does not bring them all; equal rows are one.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
    marks = marked.select("doc_id", "mark").distinct().join(known, "doc_id")
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(max_train).select(F.col("mark").alias("c_mark"), "toxic")
    met = marked.join(F.broadcast(chosen), F.col("mark") == F.col("c_mark"))
    return met.groupBy("mark").agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> Model:
    model = Model(corpus_model(docs))
    rows = stored(training_rows(docs, labels, max_train), "toxic-training")
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    if not n_toxic or not n_clean:
        return model
    language = model.language

    def count(allowed: frozenset[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cache, total = {}, Counter()
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    found = {f for w in words_of(text, language, cache) for f in features(w)}
                    total.update(found if allowed is None else found & allowed)
            yield pa.record_batch({"feature": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

        return run

    def counted(part: DataFrame, allowed: frozenset[str] | None, least: int) -> dict[str, int]:
        sums = part.select("text").mapInArrow(count(allowed), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        return {r.feature: r.n for r in sums.where(F.col("n") >= least).collect()}  # bounded by the training rows

    toxic = counted(rows.where(F.col("toxic") == 1), None, max(MIN_TOXIC, n_toxic // 400))
    clean = counted(rows.where(F.col("toxic") != 1), frozenset(toxic), 1)

    def weight(pos: int, neg: int) -> float:
        odds = math.log((pos + 0.5) / (n_toxic + 1)) - math.log((neg + 0.5) / (n_clean + 1))
        return odds - 1.64 * math.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))

    scored = sorted(((weight(n, clean.get(f, 0)), f) for f, n in toxic.items()), reverse=True)[:max_features]
    model.weights = {f: w for w, f in scored if w > 0.5}

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple | None] = {}
        for batch in batches:
            found = [model.evidence_of(t, cache) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"evidence": pa.array(found, pa.float64()), "toxic": batch.column("toxic")})

    seen = rows.mapInArrow(weigh, "evidence double, toxic int").groupBy("evidence", "toxic").count().collect()  # at most max_train rows
    seen = sorted((r.evidence, r.toxic, r["count"]) for r in seen)
    evidence = np.repeat([r[0] for r in seen], [r[2] for r in seen])
    model.slope, model.base = fit_curve(evidence, np.repeat([float(r[1] == 1) for r in seen], [r[2] for r in seen]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from a score of 0.5)."""
    base = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("toxicity")
        if store.get("weights") != model.weights or store.get("at") != (model.slope, model.base):
            store.update(weights=model.weights, at=(model.slope, model.base), tokens={})
        for batch in batches:
            texts = batch.column("text")
            found = [model.score(model.evidence_of(t.as_py(), store["tokens"])) for t in texts]
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield pa.record_batch(columns | {"score": pa.array(found, pa.float64()), "predicted": pa.array([int(s >= 0.5) for s in found], pa.int32())})

    return base.mapInArrow(run, with_fields(base.schema, score=T.DoubleType(), predicted=T.IntegerType()))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject."""
    return unwrapped(score(wrapped(docs, "text"), model).where(F.col("predicted") == 0), docs.columns, text=F.col("text"))
