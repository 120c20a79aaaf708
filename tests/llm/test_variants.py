"""Spelling variants against brute force: vocabulary, near pairs, forms and roots."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tidemart.llm import variants as v
from tidemart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_vocabulary(rows, least=7, count=2):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= count}


def brute_variants(words):
    """By deletion neighbourhoods: words meet at what one deletion leaves, or at the place that one replacement changes."""
    near = {w: set() for w in words}
    holes = {}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
            holes.setdefault((i, shorter), []).append(w)
    for same in holes.values():
        for a in same:
            near[a].update(b for b in same if b != a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.add((w, f, root, n, len(near[w]), words[f] if f else None))
    return out


def result(spark, words, **how):
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    return {tuple(r) for r in v.variants(frame, **how).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def some_words(n, seed, letters="abé", least=1, most=9):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(least, most))): rng.choice([2, 3, 7, 30, 400, 5000, 60_000]) for _ in range(n)}


@pytest.mark.parametrize("split", [10_000, 40, 3])
def test_dense_words_and_dealt_partitions(spark, split):
    words = some_words(700, 1)
    assert result(spark, words, split=split) == brute_variants(words)


def test_long_words_and_chains(spark):
    rng = random.Random(2)
    words = some_words(100, 3, "xy", 7, 12)
    for k in range(6):
        base = "".join(rng.choices("abcd", k=3000))
        for _ in range(4):
            i = rng.randrange(3000)
            words[base[:i] + rng.choice(["", "q", base[i] + "q", base[i] * 2]) + base[i + 1 :]] = 10 ** (k % 4) * 3
    for k in range(7):
        words["spelling"[:7] + "z" * k] = 3 * 10**k
    assert result(spark, words) == brute_variants(words)


def test_one_half_for_a_third_of_the_words(spark):
    words = {"prefix" + w: n for w, n in some_words(500, 4, "abcdefgh", 1, 4).items()} | some_words(800, 5, "ab", 5, 12)
    assert result(spark, words, split=60) == brute_variants(words)


def test_vocabulary(spark):
    rows = [(i % 40, t) for i, t in enumerate(["Straße ABCDEFGH abcdefgh", None, "", "ÉTATSUNIS étatsunis x×÷yzabcd", "a" * 9000 + " b", "Ĳsselmeer_foobarbaz"] * 30)]
    rows += [(None, "nothing whatever")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS n", "2 AS `my col`", "'x' AS word")
    assert {r.word: r.n for r in v.vocabulary(frame).collect()} == brute_vocabulary(rows)


def test_empty(spark):
    assert result(spark, {}) == set()
    assert v.vocabulary(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_variants"](spark, FOLDER)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = got.collect()
    want = brute_variants(brute_vocabulary([tuple(r) for r in docs]))
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
