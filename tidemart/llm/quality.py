"""Quality of documents from overlapping heuristics: estimated accuracies, posterior labels, a hashed linear scorer.

1. Heuristic labellers vote good (1), bad (0) or nothing (-1) on every document, in DataFrame expressions. Several look at the same fault
   from different sides.
2. Expectation-maximisation estimates how often each labeller is right on good and on bad documents, and with it the chance that a
   document is good given its votes. It needs only how many
   documents have each pattern of votes: at most 3 ** labellers rows, counted over all documents.
3. The posterior labels train a linear scorer on hashed features (shapes of tokens and of neighbouring tokens, repetition) of at most ``max_train`` documents, the
   first by a hash of doc_id. The scorer judges every document, those without a vote too.

Defined cases: null text counts as empty; a text without words gets votes like any other and the score of the labellers and the bias; rows with
equal doc_id are judged apart; an empty table gives an empty result; columns of the input that clash with those added are replaced.
"""

from __future__ import annotations

import math
import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.common import let, unwrapped, with_fields, words_column, worker_store, wrapped

MAX_TRAIN = 6_000
BITS = 16
ROUNDS = 60
PRIOR = 0.85
WRONG, CAUGHT = 0.002, 0.3
KEEP_FROM = 0.35  # in doubt a document stays
CACHED = 200_000


def measures(text: Column, words: Column) -> dict[str, Column]:
    """What the labellers look at: all linear in the text."""
    t = F.coalesce(text, F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    return {
        "n_words": F.size(words),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_chars": F.length(t),
        "n_letters": F.length(t) - F.length(F.regexp_replace(t, r"\p{L}+", "")),
        "n_upper": count(r"\p{Lu}"),
        "n_marks": count(r"[!*#$%&|~^=<>{}]"),
        "n_double": count(r"([!*#$%&])\1"),
        "n_bars": count(r"\|(?<!\S\|)(?=\s|$)"),  # begins with the rare character: alternatives would be tried at every place
        "n_ends": count(r"[.?!](?=\s|$)"),
        "n_again": F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))),
    }


def votes(m: Column) -> dict[str, Column]:
    """The labellers over a struct of measures: 1 good, 0 bad, 2 no opinion.

    Where a fault is absent its labeller has no opinion: texts have faults of different kinds, and lacking one says little.
    """
    n = F.greatest(m["n_words"], F.lit(1))
    letters = m["n_letters"] / F.greatest(m["n_chars"], F.lit(1))
    some, many = m["n_words"] >= 5, m["n_words"] >= 20

    def vote(bad: Column, good: Column | None = None) -> Column:
        return F.when(bad, "0").when(good, "1").otherwise("2") if good is not None else F.when(bad, "0").otherwise("2")

    return {
        "marks": vote(some & (m["n_marks"] / n > 0.5)),
        "double": vote(some & (m["n_double"] / n > 0.3)),
        "upper": vote(some & (m["n_upper"] / F.greatest(m["n_letters"], F.lit(1)) > 0.4)),
        "letters": vote(many & (letters < 0.68), letters > 0.76),
        "bars": vote(some & (m["n_bars"] / n > 0.12)),
        "cells": vote((m["n_bars"] >= 3) & (m["n_bars"] / n > 0.25)),
        "again": vote(some & (m["n_again"] / n > 0.25)),
        "variety": vote(many & (m["n_distinct"] / F.sqrt(n) < 2.0), many & (m["n_distinct"] / F.sqrt(n) > 3.0)),
        "sentences": vote((m["n_words"] >= 60) & (m["n_ends"] / n < 0.008), (m["n_ends"] / n > 0.02) & (m["n_ends"] / n < 0.4)),
    }


def voted(docs: DataFrame) -> DataFrame:
    """``docs`` with votes: one digit per labeller. The text is measured once."""
    measured = let(words_column(F.col("text")), lambda words: F.struct(*[c.alias(k) for k, c in measures(F.col("text"), words).items()]))
    return docs.withColumn("votes", let(measured, lambda m: F.concat(*votes(m).values())))


@dataclass
class Labellers:
    """Chance of a good document, and per labeller the chances of its three answers on bad and on good documents."""

    good: float
    answers: np.ndarray  # [labeller, class, answer]

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.log(np.array([1 - self.good, self.good]))[None, :].repeat(len(patterns), axis=0)
        for j in range(patterns.shape[1]):
            logs += np.log(self.answers[j][:, patterns[:, j]]).T
        logs -= logs.max(axis=1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, prior: float = PRIOR) -> Labellers:
    """Expectation-maximisation over vote patterns.

    What is known beforehand weighs a fixed share of the documents, so it counts alike at every size: a labeller rarely calls a good document
    bad (``WRONG``), and calls a fair part of the bad ones so (``CAUGHT``); its other answers are as frequent as overall.
    """
    total = counts.sum()
    bad, good = (patterns == 0).sum(axis=1), (patterns == 1).sum(axis=1)
    p = np.clip(1 / (1 + np.exp(4.0 * bad - 0.5 * good - 1.0)), 0.01, 0.99)
    model = Labellers(prior, np.full((patterns.shape[1], 2, 3), 1 / 3))
    known = np.zeros_like(model.answers)
    for j in range(patterns.shape[1]):
        other = np.bincount(patterns[:, j], counts, 3)[1:] + 1e-9
        for c, zero in ((0, CAUGHT), (1, WRONG)):
            known[j, c] = [zero, *((1 - zero) * other / other.sum())]
    for _ in range(rounds):
        share = np.stack([(1 - p) * counts, p * counts])  # [class, pattern]
        model.good = float(np.clip((share[1].sum() + prior * 0.2 * total) / (1.2 * total), 0.05, 0.99))
        for j in range(patterns.shape[1]):
            for c, weight in ((0, 0.05 * total), (1, total)):
                seen = np.bincount(patterns[:, j], share[c], 3) + weight * known[j, c]
                model.answers[j, c] = seen / seen.sum()
        p = model.posterior(patterns)
    return model


# --- scorer

_SHAPES = ((re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "0"))


def shape(token: str) -> str:
    """Runs of capitals, of other letters and of digits as one mark each."""
    for pattern, mark in _SHAPES:
        token = pattern.sub(mark, token)
    return token


def place(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def hashed(text: str | None, shapes: dict[str, str], places: dict) -> tuple[list[int], list[float]]:
    """Hashed features of a text and their weight: the root of their share of the tokens."""
    tokens = (text or "").split()
    missing = set(tokens).difference(shapes)
    if len(shapes) + len(missing) > CACHED:
        shapes.clear()
        missing = set(tokens)
    shapes.update((t, shape(t)) for t in missing)
    seen = [shapes[t] for t in tokens]
    counts = Counter(seen)
    counts.update(zip(["^", *seen], seen, strict=False))
    counts["again"] = sum(map(operator.eq, tokens, tokens[1:]))
    counts["many"] = len(set(tokens))
    n = len(tokens) + 8  # a short text says little
    if len(places) > CACHED:
        places.clear()
    at = []
    for f in counts:
        k = places.get(f)
        if k is None:
            places[f] = k = place(f if isinstance(f, str) else "\t".join(f))
        at.append(k)
    return at, [math.sqrt(c / n) for c in counts.values()]


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, at: list[int], share: list[float]) -> float:
        z = float(self.weights[at] @ np.array(share)) + self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 8, rate: float = 0.5) -> Scorer:
    """Adaptive gradient descent on soft labels, in a fixed order."""
    w, bias, norm = np.zeros(1 << BITS), 0.0, np.full(1 << BITS, 1e-2)
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)).tolist():
            at, share = rows[i]
            z = float(w[at] @ share) + bias
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - target[i]
            g = error * share
            norm[at] += g * g
            w[at] -= rate * g / np.sqrt(norm[at])
            bias -= 0.05 * rate * error
    return Scorer(w, bias)


# --- the operator


def label_model(all_votes: DataFrame) -> tuple[Labellers | None, dict[str, float]]:
    """The labellers' estimate, and the posterior of each vote pattern that occurs."""
    counted = all_votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** labellers rows
    if not counted:
        return None, {}
    patterns, counts = zip(*sorted((r.votes, r.n) for r in counted), strict=True)
    matrix = np.array([[int(c) for c in v] for v in patterns])
    labellers = estimate(matrix, np.array(counts, float))
    return labellers, dict(zip(patterns, labellers.posterior(matrix).tolist(), strict=True))


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> tuple[dict[str, float], Scorer]:
    _, posterior = label_model(voted(docs.select("text")))
    # Rows are chosen by id and text, so an id on many rows does not bring them all; equal rows are one.
    marked = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
    marks = marked.select("doc_id", "mark").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(max_train).select(F.col("mark").alias("c_mark"))
    chosen = marked.join(F.broadcast(marks), F.col("mark") == F.col("c_mark"), "left_semi").groupBy("mark").agg(F.first("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, places = {}, {}
        for batch in batches:
            found = [hashed(t, shapes, places) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "votes": batch.column("votes"), "at": pa.array([a for a, _ in found], pa.list_(pa.int32())), "share": pa.array([s for _, s in found], pa.list_(pa.float32())),
            })

    schema = "votes string, at array<int>, share array<float>"
    rows = voted(chosen.select("text")).mapInArrow(features, schema).collect()  # max_train documents
    rows = sorted(((r.votes, r.at, r.share) for r in rows))
    return posterior, fit([(np.array(a, np.int64), np.array(s)) for _, a, s in rows], np.array([posterior[v] for v, _, _ in rows]))


def assess(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` with votes, label_posterior (from the votes), quality_score (from the scorer) and keep (0 or 1)."""
    added = ["votes", "label_posterior", "quality_score", "keep"]
    base = docs.drop(*added)
    posterior, scorer = train(base, max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("quality")
        shapes, places = store.setdefault("shapes", {}), store.setdefault("places", {})
        for batch in batches:
            found = [scorer.score(*hashed(t.as_py(), shapes, places)) for t in batch.column("text")]
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns["label_posterior"] = pa.array([posterior.get(v, 0.5) for v in batch.column("votes").to_pylist()], pa.float64())
            columns["quality_score"] = pa.array(found, pa.float64())
            columns["keep"] = pa.array([int(s >= KEEP_FROM) for s in found], pa.int32())
            yield pa.record_batch(columns)

    labelled = voted(base)
    schema = with_fields(labelled.schema, label_posterior=T.DoubleType(), quality_score=T.DoubleType(), keep=T.IntegerType())
    return labelled.mapInArrow(run, schema)


def keep_good(docs: DataFrame) -> DataFrame:
    kept = assess(wrapped(docs, "doc_id", "text")).where(F.col("keep") == 1)
    return unwrapped(kept, docs.columns, doc_id=F.col("doc_id"), text=F.col("text"))
