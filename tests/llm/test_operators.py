"""The operators on small tables that hold every awkward case, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemart.llm import fingerprints, mixing, neighbours, packing, quality, sharding, simhash, substrings, toxicity, urls
from tidemart.llm.common import let, lower_words, split_words, words_column

GAP = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return [w for w in GAP.split(text or "") if w]


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and very long texts, copies, near copies, shared passages, repeated rows, odd blanks, runs."""
    rng = np.random.default_rng(11)
    passage = prose(rng, 70)
    texts = [prose(rng, int(rng.integers(1, 300))) for _ in range(60)]
    texts += [texts[3], texts[3], texts[5].replace(" ", "\t\n ")]
    near = texts[7].split()
    for i in range(6):
        changed = [*near]
        changed[i * 3 % len(near)] = f"new{i}"
        texts.append(" ".join(changed))
    for i in range(6):
        w = texts[20 + i].split()
        texts.append(" ".join([*w[: i * 5], passage, *w[i * 5 :]]))
    texts += [None, "", " \n\t ", "one", "Eins Zwei", "ÄÖ é\u00a0x", "the " * 300, "a b " * 200, "y" * 70_000 + " z", prose(rng, 30_000)]
    sources = ["b", "a", "c", None, "", "Z", "é"]
    out = [(i * 7 % 1009, t, "en", sources[0] if i % 3 == 0 else sources[i % 7], len(t or "")) for i, t in enumerate(texts)]
    return [*out, out[4], out[4], (None, "null id " + texts[0], "en", "a", 1), (None, texts[0], "en", "a", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def clashing(df):
    """More columns, with names that operators might use themselves."""
    names = "row places kept fp _key slot bucket start order score predicted votes keep key value _id n_words words".split()
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


def none(df):
    return df.limit(0)


# --- words


def test_words_are_those_of_the_definition():
    for t in ("a b", " a\t\x0b b\x0c\r\nc ", "x\u00a0y z", None, "", "\x1c a"):
        assert split_words(t) == words(t)
    assert lower_words("ÄB aC") == ["Äb", "ac"]


# --- near duplicates


def brute_fingerprint(text):
    w = words((text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    counts = np.zeros(64, int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        counts += [(h >> b) & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(fps, radius=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius).tolist():
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_simhash_equals_brute_force(docs, rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(fps)
    least = defaultdict(lambda: None)
    for r, c in zip(rows, root, strict=True):
        if r[0] is not None:
            least[c] = r[0] if least[c] is None else min(least[c], r[0])
    want = Counter((r[0], f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, root, strict=True))
    got = simhash.near_duplicates(clashing(docs)).select("doc_id", simhash.hexed(F.col("fp")), "component_id").collect()
    assert Counter(map(tuple, got)) == want
    kept = simhash.keep_first(clashing(docs))
    assert kept.columns == clashing(docs).columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {least[c] for c in root}
    assert simhash.near_duplicates(none(docs)).count() == 0 and simhash.keep_first(none(docs)).count() == 0


def test_one_document_of_each_component_stays(spark):
    rng = np.random.default_rng(23)
    a, b, c, d, e, f = (prose(rng, 8000) for _ in range(6))
    near = c + " more"
    # Unlike texts without id; one id on two unlike texts; one id on a text of its own and on a near copy of a smaller id.
    table = [(None, a), (None, b), (None, b), (7, d), (7, e), (3, c), (9, near), (9, f)]
    kept = simhash.keep_first(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, a), (0, b), (7, d), (7, e), (3, c), (9, f)])


@pytest.mark.parametrize("kind", ["sparse", "dense"])
def test_bit_sliced_comparison(kind):
    rng = np.random.default_rng(2)
    if kind == "sparse":
        a = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        a[:200] = a[200:400] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    else:
        a = np.array([sum(1 << int(b) for b in rng.choice(16, rng.integers(0, 9), replace=False)) for _ in range(6000)], np.uint64) ^ np.uint64(1 << 50)
    a = np.unique(a)
    for dense in (64, 100_000):
        got, want = simhash.local_components(a, dense=dense), brute_components(a.tolist())
        assert len(set(zip(got.tolist(), want, strict=True))) == len(set(want)) == len(set(got.tolist()))
    for radius in (3, 4, 7):
        q, c = simhash.near(a[:50], simhash.planes_of(a), len(a), radius)
        assert set(zip(q.tolist(), c.tolist(), strict=True)) == {(i, j) for i in range(50) for j in range(len(a)) if int(a[i] ^ a[j]).bit_count() <= radius}


@pytest.mark.parametrize("bits", [0, 1, 9, 12, 15, 20, 26, 31, 40])
def test_keys_lose_no_pair(bits):
    rng = np.random.default_rng(bits)
    masks = simhash.key_masks(bits)
    for _ in range(500):
        apart = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(apart & m == 0 for m in masks)


def test_large_buckets_are_dealt_again(spark):
    rng = np.random.default_rng(9)
    fps = np.unique(rng.integers(0, 1 << 12, 800).astype(np.uint64) * np.uint64(0x1001) ^ np.uint64(5 << 40))
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    found = simhash.links(df, len(fps), bucket=64, split=20)
    edges = {(r.u, r.v) for r in found.collect()}
    root = {int(x): int(x) for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        assert int(u ^ v).bit_count() <= 64
        root[find(u)] = find(v)
    want = brute_components(fps.tolist())
    assert len({(find(int(x)), w) for x, w in zip(fps, want, strict=True)}) == len(set(want))


# --- packing


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_word_cache_gives_the_tokenizers_ids(tokenizer_path, rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path)
    odd = ["It's  DON'T 3,5% x²y", "a\x01b \x01", "Ω ΟΔΟΣ straße İx", "<|endoftext|> and <|x", "e\u0301 z\u0338= ＡＢ", "a\u2028b\x1cc\x85d", "x_y__ -- ...", "ab,;: (c)!!", "日本 語"]
    texts = [r[1] or "" for r in rows] + odd
    for cached in (1, 50, 1_000_000):
        got = packing.WordTokens(tokenizer_path, cached).encode(texts)
        assert [packing.ids_of(x).tolist() for x in got] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    long = " ".join(odd * 30)
    assert " ".join(packing.slices(long, 100)) == long


def test_packing_covers_every_token_once(docs, rows, tokenizer_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path)
    ids = [[*plain.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows]
    for shard_tokens in (4000, 10**6):
        got = packing.packed(clashing(docs), tokenizer_path, shard_tokens=shard_tokens).collect()
        # Rows with one doc_id are told apart by their ids.
        want = Counter((r[0], len(x), zlib.crc32(np.array(x[:1], "<u4").tobytes())) for r, x in zip(rows, ids, strict=True))
        assert sum(r.length for r in got) == sum(map(len, ids)) and len(want)
        single = {r[0]: x for r, x in zip(rows, ids, strict=True) if sum(q[0] == r[0] for q in rows) == 1}
        at = defaultdict(int)
        for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
            if r.doc_id in single:
                x = single[r.doc_id]
                assert r.start == at[r.doc_id] and r.doc_tokens == len(x)
                assert r.ids_crc32 == zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes())
                at[r.doc_id] += r.length
        assert dict(at) == {k: len(x) for k, x in single.items()}
        length = defaultdict(int)
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == length[r.sequence_id]
            length[r.sequence_id] += r.length
        assert all(n <= 4096 and n & (n - 1) == 0 for n in length.values())
    assert packing.packed(none(docs), tokenizer_path).count() == 0
    tokens = packing.stored(packing.tokenised(docs, tokenizer_path), "tokens")
    sequences = packing.sequences(tokens, shard_tokens=4000).collect()
    assert sum(len(r.ids) for r in sequences) == 2 * sum(map(len, ids))


def test_windows_hold_neighbours():
    """Documents about two subjects: a window's documents are about its seed's."""
    rng = np.random.default_rng(4)
    docs = [rng.integers(10, 400, 50).astype("<u2") if i % 2 else rng.integers(500, 900, 50).astype("<u2") for i in range(80)]
    docs = [np.concatenate([d, np.array([2], "<u2")]) for d in docs]
    df = Counter(int(t) for d in docs for t in set(d.tolist()))
    idf = np.zeros(1 << 16)
    for t, n in df.items():
        idf[t] = max(0.0, math.log((80 - n + 0.5) / (n + 0.5)))
    packed = packing.pack(docs, idf, 51.0, window=512)
    full = [s for s in packed if sum(n for *_, n in s) == 512]
    pure = [len({i % 2 for i, *_ in s}) == 1 for s in full]
    assert len(full) == 80 * 51 // 512 and sum(pure) >= len(full) - 1


def test_scores_are_bm25():
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, 60, int(rng.integers(1, 40))).astype("<u2") for _ in range(30)]
    idf = np.zeros(1 << 16)
    idf[:60] = rng.random(60) * (rng.random(60) > 0.2)
    index, mean = packing.Index(docs, idf, 20.0), 20.0
    for q in (docs[3], np.array([], "<u2"), np.array([999], "<u2")):
        want = [
            sum(idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t, tf in Counter(d.tolist()).items() if t in set(q.tolist())) for d in docs
        ]
        assert np.allclose(index.scores(q), want)


# --- fingerprints


def brute_edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for i, r in enumerate(order):
        text, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        yield r[0], text, text[: len(text) - half] + nxt[:half], nxt


@pytest.mark.parametrize("bucket_rows", [3, 2000])
def test_fingerprints_follow_the_next_document(docs, rows, bucket_rows):
    got = fingerprints.edited_fingerprints(clashing(docs), bucket_rows).collect()
    want = Counter((i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in brute_edited(rows))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    prints = {r.fingerprint: None for r in got}
    assert len(prints) > 50
    assert fingerprints.edited_fingerprints(none(docs)).count() == 0


@pytest.mark.parametrize("hot", [7, 10_000, -3, None])
def test_an_id_on_a_third_of_the_rows_is_many_buckets(spark, hot):
    rows = [(hot if i % 3 == 0 else i, f"text {i % 500} of many", "en", "s", 1) for i in range(3000)] + [(None, "x", "en", "s", 1)] * 5
    docs = spark.createDataFrame(rows, SCHEMA)
    base = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    sizes = base.groupBy(fingerprints._bucket(base.select("doc_id"), 50).alias("b")).count().collect()
    assert max(r["count"] for r in sizes) < 200
    got = fingerprints.with_next(docs, 50).select("doc_id", "text", "next_text").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in rows)
    # Every row follows once, and only one row of an id is followed by one of the next id.
    assert Counter(r.next_text for r in got) == Counter(r[1] for r in rows)
    of = defaultdict(Counter)
    after = defaultdict(Counter)
    for r in got:
        of[r.doc_id][r.text] += 1
        after[r.doc_id][r.next_text] += 1
    order = sorted(of, key=lambda i: (i is None, -(i or 0)))
    for i, nxt in zip(order, order[1:] + order[:1], strict=True):
        first, brought = of[i] - after[i], after[i] - of[i]
        assert sum(first.values()) <= 1 and sum(brought.values()) <= 1 and set(brought) <= set(of[nxt])


def test_one_document_follows_itself(spark):
    row = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "a b c d", "en", "s", 7)], SCHEMA)).first()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()[:0] + hashlib.sha256(("a b " + "a b").encode()).hexdigest()


def test_fingerprints_fall_with_edits_and_mind_order(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 1500)]
    shuffled = [b for i in range(0, 1500, 20) for b in base[1480 - i : 1500 - i]]
    texts = [" ".join(base), " ".join([*base[:1400], *["z"] * 100]), " ".join([*base[:700], *[f"v{i}" for i in range(800)]]), " ".join(shuffled), " ".join(base)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("f", fingerprints.signature(F.col("text")))
    prints = [r.f for r in df.orderBy("i").collect()]
    pairs = spark.createDataFrame([(i, prints[0], p) for i, p in enumerate(prints)], "i int, a array<int>, b array<int>")
    near = [r.n for r in pairs.select("i", fingerprints.likeness(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()]
    assert near[0] == near[4] == 1.0
    assert near[0] > near[1] > 0.6 > near[2] > 0.02
    assert near[3] < 0.75  # the same k-mers but for 5 of 100, in another order


# --- mixing


def brute_targets(rows, total=1.5, most=2):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = total * sum(sizes.values()), set(names), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return sizes, target | share
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.remove(s)


def test_mix_meets_its_targets(docs, rows):
    got = mixing.mix_sizes(clashing(docs), block_words=8).collect()
    sizes, target = brute_targets(rows)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 16
    again = mixing.mix_sizes(docs.repartition(3), block_words=8).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mix_sizes(none(docs)).count() == 0


def test_mixed_texts_are_drawn_blocks(docs, rows):
    mixed = mixing.mix(clashing(docs), block_words=8)
    assert mixed.columns == clashing(docs).columns
    got = mixed.collect()
    sizes = mixing.mix_sizes(docs, block_words=8).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in sizes if r.taken)
    # Which of two rows with one doc_id and size takes which range is open; their sum is not.
    per_id = lambda rows_, size: {k: sum(size(r) for r in rows_ if r.doc_id == k) for k in {r.doc_id for r in rows_}}
    want = {k: v for k, v in per_id(sizes, lambda r: r.taken).items() if v}
    assert sum(want.values()) == pytest.approx(sum(len(words(r.text)) for r in got), abs=64)
    texts = defaultdict(set)
    for r in rows:
        texts[r[0]] |= set(words(r[1]))
    for r in got:
        assert set(words(r.text)) <= texts[r.doc_id] and r.n_chars == len(r.text) and r.slot == "own slot"


def test_permutations_are_bijections(spark):
    for n in (1, 2, 3, 10, 97, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("x")).collect()
        assert sorted(r.x for r in got) == list(range(n))


def test_shard_counts_vary_like_a_draw(spark):
    plan = spark.createDataFrame([("a", 640_000, 320_000.0), ("b", 640_000, 640_000.0)], "source string, source_size long, target double")
    taken = mixing.slots(plan, 64, shard_blocks=500)
    assert taken.select("shard", "slot").distinct().count() == taken.count() == 15_000
    counts = {(r.shard, r.source): r.blocks for r in mixing.shard_counts(taken).collect()}
    a = np.array([counts[k, "a"] for k in range(30)])
    assert a.sum() == 5000 and 5 < a.std() < 16


# --- quality


def test_expectation_maximisation_finds_the_labellers():
    rng = np.random.default_rng(5)
    good = rng.random(6000) < 0.8
    answers = np.full((6000, 5), 2)
    for j, (catch, wrong) in enumerate([(0.8, 0.002), (0.7, 0.003), (0.6, 0.004), (0.5, 0.002), (0.7, 0.003)]):
        answers[:, j] = np.where(rng.random(6000) < np.where(good, wrong, catch), 0, np.where(rng.random(6000) < 0.7, 1, 2))
    patterns, of, counts = np.unique(answers, axis=0, return_inverse=True, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float))
    judged = model.posterior(patterns)[of] > 0.5
    assert (judged == good).mean() > 0.97 and 0.7 < model.good < 0.9
    assert model.answers[0, 0, 0] > model.answers[3, 0, 0] > 0.3


def test_quality_patterns_begin_with_one_character_and_count_as_written_out(spark):
    parts = ["|", "||", " ", "\n", "\r\n", "\u2028", "\u0085", "a", "\U0001f600", "!", "!!", "!!!", "**", "#$", "$$$$", "%%", "&&&", "\u00a0", "x x", "\t"]
    rng = random.Random(5)
    texts = ["", None, "|", "a|", "|\n", "| | |", *["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    whole = F.coalesce("text", F.lit(""))
    words = words_column(F.col("text"))
    plain = {
        "n_double": F.regexp_count(whole, F.lit(r"(?:!!|\*\*|##|\$\$|%%|&&)")), "n_bars": F.regexp_count(whole, F.lit(r"(?:^|\s)\|(?=\s|$)")),
        "n_again": let(words, lambda ws: F.size(F.filter(F.transform(ws, lambda w, i: w == F.get(ws, i - 1)), lambda x: x))),
    }
    new = let(words, lambda ws: F.struct(*[c.alias(k) for k, c in quality.measures(F.col("text"), ws).items()]))
    rows = frame.select("text", new.alias("m"), F.struct(*[c.alias(k) for k, c in plain.items()]).alias("p")).collect()
    assert [r.text for r in rows if any(r.m[k] != r.p[k] for k in plain)] == []
    assert all(sum(r.p[k] for r in rows) > 100 for k in plain)
    # An alternative or an anchor at the front would be tried at every place of the text.
    shown = frame.select(new.alias("m"))._jdf.queryExecution().analyzed().toString()
    assert "(?:!!" not in shown and "(?:^" not in shown


def test_quality_keeps_prose_and_drops_junk(spark, docs):
    rng = np.random.default_rng(6)

    def sentence(n):
        letters = "abcdefghijklmnopqrstuvwxyz"
        return " ".join("".join(letters[k] for k in rng.integers(0, 26, int(rng.integers(2, 9)))) for _ in range(n)).capitalize() + "."

    clean = [" ".join(sentence(int(rng.integers(4, 12))) for _ in range(int(rng.integers(1, 30)))) for _ in range(300)]
    junk = [" ".join(w + "***" for w in clean[i].split() * 3) for i in range(20)] + [clean[i].upper().replace(" ", "!! ") * 2 for i in range(20, 40)]
    junk += [" | ".join(clean[i].split() * 4) for i in range(40, 60)] + [" ".join(w for w in clean[i].split()[:6] for _ in range(30)) for i in range(60, 80)]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(clean + junk)], SCHEMA)
    keep = {r.doc_id: r.keep for r in quality.assess(clashing(table)).collect()}
    assert sum(keep[i] for i in range(300)) >= 297 and sum(keep[i] for i in range(300, 380)) <= 6
    odd = quality.assess(docs)
    assert odd.count() == docs.count() and quality.assess(none(docs)).count() == 0
    assert quality.keep_good(clashing(table)).columns == clashing(table).columns


# --- toxicity


@pytest.fixture(scope="module")
def insults(spark):
    rng = np.random.default_rng(7)
    syllables = "the and that with ing tion ever stone river moon green light paper table idea story patient stupor clone".split()
    bad = ["idiot", "stupid", "moron"]
    rows_, labels = [], []
    for i in range(900):
        w = [str(x) for x in rng.choice(syllables, int(rng.integers(5, 80)))]
        toxic = i % 6 == 0
        for _ in range(2 * toxic):
            w.insert(int(rng.integers(len(w))), bad[int(rng.integers(3))])
        rows_.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows_, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_learns_and_sees_through_disguises(spark, insults, docs):
    table, labels = insults
    model = toxicity.train(clashing(table), labels)
    found = {r.doc_id: r for r in toxicity.score(clashing(table), model).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum(found[i].predicted == truth[i] for i in truth) >= 890
    disguised = ["the moon 1d10t light", "green st*pid paper", "you i d i o t now", "story s.t.u.p.i.d table", "a stuuuupid idea", "mor0n with light"]
    clean = ["the moon light", "10 green 3rd paper", "a b c with table", "www.paper-table.com 12.5%", "", None, "the patient had a stupor"]
    seen = toxicity.score(spark.createDataFrame(list(enumerate(disguised + clean)), "doc_id long, text string"), model)
    by_id = {r.doc_id: r.predicted for r in seen.collect()}
    assert sum(by_id[i] for i in range(len(disguised))) >= 5
    assert not any(by_id[i] for i in range(len(disguised), len(by_id)))
    kept = toxicity.keep_clean(clashing(table), model)
    assert kept.columns == clashing(table).columns and kept.count() == sum(not found[i].predicted for i in found)
    odd = toxicity.score(docs, model)
    assert odd.count() == docs.count() and all(0 <= r.score <= 1 for r in odd.select("score").collect())


def test_toxicity_without_labels(insults, docs):
    table, labels = insults
    model = toxicity.train(table, none(labels))
    assert toxicity.score(docs, model).where("predicted = 1").count() == 0
    empty = toxicity.train(none(table), labels)
    assert toxicity.score(none(docs), empty).count() == 0


def test_viterbi_finds_the_cheapest_path():
    model = toxicity.language_model(toxicity.trigrams(["the idiot and the river and the idiom " * 50]))
    for token in ("1d1ot", "id.iot", "r1v*r", "idiooot", "th3"):
        places = toxicity.lattice(token)
        best = None

        def walk(k, said, cost, places=places):
            nonlocal best
            if k == len(places):
                total, x, y = cost, 0, 0
                for c in said + " ":
                    z = int(toxicity.CODE[ord(c)]) if c != " " else 0
                    if z == 0 and y == 0:
                        continue
                    total -= float(model[x, y, z])
                    x, y = y, z
                best = min(best or (1e9, ""), (total, said.strip()))
                return
            for letters, extra in places[k]:
                walk(k + 1, said + letters, cost + extra)

        walk(0, "", 0.0)
        assert toxicity.decode(token, model).split() == best[1].split()


def test_every_reading_is_a_candidate():
    model = toxicity.language_model(toxicity.trigrams(["the idiot is the clown and the ass and the evil river and the idiom " * 50]))
    for token, word in {"!diot": "idiot", "|diot": "idiot", "(lown": "clown", "idio+": "idiot", "a$$": "ass", "id**t": "idiot", '"(lown,"': "clown", "ev11": "evil"}.items():
        assert word in toxicity.restored(token, model), token
    for token in ("(the", "idiot!", "river?", "clown."):  # the plain reading stays
        assert token.strip("(!?.") in toxicity.restored(token, model)
    assert {"ii", "il", "li", "ll"} <= {x + y for x, _ in toxicity.lattice("a11")[1] for y, _ in toxicity.lattice("a11")[2]}

    def cheapest(token):
        """All paths, told apart by nothing: the cost of every state without the beam, letter by letter."""
        costs = {(0, 0): 0.0}
        for options in [*toxicity.lattice(token), [(" ", 0.0)]]:
            after = defaultdict(lambda: math.inf)
            for ((x, y), cost), (letters, extra) in ((s, o) for s in costs.items() for o in options):
                total, p, q = cost + extra, x, y
                for c in letters if letters != " " or y else "":
                    z = int(toxicity.CODE[ord(c)]) if c != " " else 0
                    total, p, q = total - float(model[p, q, z]), q, z
                after[p, q] = min(after[p, q], total)
            costs = dict(after)
        return min(costs.values())

    def spoken(token, said):
        """The cost of a reading: the cheapest way to say it."""
        costs = {(0, 0, 0): 0.0}
        for options in [*toxicity.lattice(token), [(" ", 0.0)]]:
            after = defaultdict(lambda: math.inf)
            for ((n, x, y), cost), (letters, extra) in ((s, o) for s in costs.items() for o in options):
                total, p, q, at = cost + extra, x, y, n
                for c in letters if letters != " " or y else "":
                    if (said + " ")[at : at + 1] != c:
                        break
                    z = int(toxicity.CODE[ord(c)]) if c != " " else 0
                    total, p, q, at = total - float(model[p, q, z]), q, z, at + 1
                else:
                    after[at, p, q] = min(after[at, p, q], total)
            costs = dict(after)
        return min(c for (n, _, _), c in costs.items() if n >= len(said))

    for token in ("i#*?t", "*#?*iot", "r**%r", "a?#*?#b", "cl#*#?n"):
        assert abs(spoken(token, toxicity.decode(token, model)) - cheapest(token)) < 1e-6, token
    for bare in ("idio", "the", "river", "clow", "evi", "as", "a", "x"):  # the short way out agrees with decoding
        for signs in ("?", "***", "+", ",%%", "$$", "!!", "|"):
            if toxicity.ends_there(bare, bare + signs, model):
                assert toxicity.decode(bare + signs, model) == bare, bare + signs
    assert toxicity.ends_there("the", "the***", model) and not toxicity.ends_there("idio", "idio+", model)


def test_disguises_of_any_length():
    model = toxicity.language_model(toxicity.trigrams(["you are the idiot and the river of the idiom " * 50]))
    plain = ["you", "are", "the", "idiot"] * 8
    for gap in (" ", "."):
        token = gap.join("".join(plain))
        assert len(token) > 64 and toxicity.restored(token, model).count("idiot") == 8
    assert toxicity.spaced_out("x " + " ".join("youaretheidiot" * 8)) == ["x " + " ".join("youaretheidiot" * 8)]
    assert toxicity.restored("idio" + 100 * "o" + "t", model) == ["idiot"]
    long = ".".join("idiot" * 20_000)  # linear: some seconds
    assert len(toxicity.decode(long, model)) >= 100_000


def test_held_out_fifth(spark):
    got = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


# --- URL filter


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [(len(h + p), h + p) for h, p, _ in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


def test_url_rules_and_parts(spark):
    cases = [
        "http://a.example.org/es/1", "https://EXAMPLE.org/en/123?x", "http://badexample.org/es/1", "http://org", "http://x.org?q=/es/", "http://x.org/",
        "https://sub.com/fr/1", "https://com/de/1#://a.org/", "http://x.com/FR/", "nothing", None, "", "://x.org/a", "http:///p", "a://b://c.org/d", "http://É.ORG/es/",
        "http://x.com/de/\nline", "http://cheap-pills.example.net/en/1", "http://library.example.net/en/1", "http://x.org/a", "http://x.org/a",
    ]
    df = spark.createDataFrame([(i, u, "own") for i, u in enumerate(cases)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    verdict = {h + p: v for h, p, v in urls.RULES}
    for i, u in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule) == brute_url(u)
        assert got[i].verdict in ("allow", "block") and (got[i].rule is None or got[i].verdict == verdict[got[i].rule])
    assert got[17].verdict == "block" and got[18].verdict == "allow"
    assert urls.judge(none(df)).count() == 0


def test_url_model_generalises():
    rows_ = [(*brute_url(u)[:2], label == "block") for u, label in urls.labelled_urls()]
    right = 0
    hosts = sorted({h for h, *_ in rows_})
    fold_of = {h: i % 3 for i, h in enumerate(hosts)}  # hosts that were not seen
    for fold in range(3):
        w, b = urls.train([r for r in rows_ if fold_of[r[0]] != fold])
        for h, p, block in (r for r in rows_ if fold_of[r[0]] == fold):
            g = urls.grams(h, p)
            right += (w[g].sum() / math.sqrt(len(g)) + b > 0) == block
    assert right >= 0.9 * len(rows_)


# --- repeated passages


def brute_repeats(rows):
    texts = [words(r[1]) for r in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in texts for i in range(len(w) - 34))
    for r, w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        yield r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()


def test_repeated_passages_equal_brute_force(docs, rows):
    want = Counter(brute_repeats(rows))
    got = substrings.remove_repeats(clashing(docs)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == want
    done = substrings.deduplicate(clashing(docs))
    assert done.columns == clashing(docs).columns
    assert sum(len(words(r.text)) for r in done.collect()) == sum(k[1] * n - k[2] * n for k, n in want.items())
    assert substrings.remove_repeats(none(docs)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_repeats_among_few_words(spark, seed):
    """Small alphabets, where everything nearly repeats; small batches, so that copies meet in and across batches."""
    rng = np.random.default_rng(seed)
    rows_ = []
    for i in range(80):
        w = [f"{x}" for x in rng.integers(0, 2 + seed * 3, int(rng.integers(0, 120)))]
        if rng.random() < 0.4:
            w += ["p"] * int(rng.integers(0, 80))
        if rows_ and rng.random() < 0.5:
            other = words(rows_[int(rng.integers(len(rows_)))][1])
            a = int(rng.integers(0, len(other) + 1))
            w = w[: int(rng.integers(0, len(w) + 1))] + other[a : a + int(rng.integers(20, 60))] + w
        rows_.append((i, " ".join(w)))
    df = spark.createDataFrame(rows_, "doc_id long, text string").repartition(3)
    got = substrings.remove_repeats(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(rows_))


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    word_powers = substrings.powers(substrings.WORD_BASE, substrings.TABLE)
    for vocabulary in (2, 5, 1000):
        inner = rng.integers(0, vocabulary, 35)
        places = set()
        for _ in range(40):
            left, right = (rng.integers(0, vocabulary, int(rng.integers(0, 30))) for _ in range(2))
            text = " ".join(map(str, [*left, *inner, *right])).encode()
            p = substrings.Parse([b"x y", text], word_powers)
            begins, place = p.anchors()
            at = np.flatnonzero(begins == 2 + len(left))[0]
            places.add((int(place[at] - begins[at]), int(p.names(place[at : at + 1])[0])))
        assert len(places) == 1


@pytest.mark.parametrize("hot", [3, 10_000])
def test_frequent_line_in_different_surroundings(spark, monkeypatch, hot):
    """A line shorter than a window is one anchor of many unlike windows; hot anchors deal them by their hashes."""
    rng = np.random.default_rng(5)
    line = prose(rng, 20)
    rows_ = [(i, f"{prose(rng, 40)} {line} {prose(rng, 40)}") for i in range(60)]
    rows_ += [(100 + i, rows_[i % 7][1]) for i in range(20)] + [(200 + i, f"{line} {rows_[i][1]} {line}") for i in range(9)]
    monkeypatch.setattr(substrings, "HOT", hot)
    df = spark.createDataFrame(rows_, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(rows_))
    texts = df.withColumn("row", F.xxhash64("doc_id", "text")).select("row", "text")
    told = substrings.repeated(texts.mapInArrow(substrings.symbols, substrings.OCCURRENCES), hot).where("key is not null").select("key").distinct().collect()
    assert bool(told) == (hot == 3)
    if told:
        found = substrings.repeated(texts.mapInArrow(substrings.symbols, substrings.OCCURRENCES), hot)
        plain = found.where("row is not null").select("row", F.shiftleft("place", 1).alias("place"))

        def most(places):
            listed = texts.join(substrings.listed(places), F.col("row") == F.col("l_row"))
            return listed.mapInArrow(substrings.windows, substrings.CANDIDATES).where("hashes is not null").groupBy("key").count().agg(F.max("count")).first()[0]

        assert most(substrings.flagged(found)) < 10 < 40 < most(plain)


def test_rows_that_repeat_share_one_list(spark):
    rng = np.random.default_rng(6)
    text = prose(rng, 120)
    rows_ = [(1, text)] * 400 + [(None, text)] * 50 + [(i, prose(rng, 60)) for i in range(2, 40)]
    df = spark.createDataFrame(rows_, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(rows_))
    texts = df.select(F.xxhash64("doc_id", "text").alias("row"), "text")
    places = substrings.flagged(substrings.repeated(texts.mapInArrow(substrings.symbols, substrings.OCCURRENCES), 10))
    assert substrings.listed(places).agg(F.max(F.size("places"))).first()[0] <= 120


def test_columns_with_odd_names(spark, insults):
    """Blanks, dots and quotes in the names of further columns."""
    rng = np.random.default_rng(7)
    rows_ = [(i, prose(rng, 60), "s", i) for i in range(40)]
    odd = spark.createDataFrame(rows_, "doc_id long, text string, source string, `a.b` long").withColumns({"my col": F.lit(1), "it's \"quoted\"": F.lit("x"), "row": F.lit(2)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    kept = (
        toxicity.keep_clean(odd, toxicity.train(odd, labels)), simhash.keep_first(odd), substrings.deduplicate(odd), mixing.mix(odd), quality.keep_good(odd), sharding.place(odd, ["a.b"], ["x", "y"]).drop("slot", "shard"),
    )
    for df in kept:
        assert df.columns == odd.columns and df.count() <= 40
    fingerprints.fingerprints(odd).count()


def test_one_id_on_many_rows_stays_within_the_training_bound(spark):
    rng = np.random.default_rng(8)
    rows_ = [(1, prose(rng, 30)) for _ in range(300)] + [(None, prose(rng, 30)) for _ in range(100)] + [(i, "same text") for i in range(50, 90)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    assert toxicity.training_rows(df, labels, 21).count() <= 21
    seen = []
    fit, quality.fit = quality.fit, lambda rows, target: seen.append(len(rows)) or fit(rows, target)
    try:
        quality.train(df, 21)
    finally:
        quality.fit = fit
    assert seen == [21]


def test_swapped_halves_differ_in_short_texts(spark):
    rng = np.random.default_rng(9)
    for n, most in ((30, 0.75), (100, 0.6), (300, 0.6), (1500, 0.6)):
        words_ = [prose(rng, n).split(" ") for _ in range(20)]
        rows_ = [(" ".join(w), " ".join(w[len(w) // 2 :] + w[: len(w) // 2])) for w in words_]
        df = spark.createDataFrame(rows_, "a string, b string")
        near = df.select(F.avg(fingerprints.likeness(fingerprints.signature(F.col("a")), fingerprints.signature(F.col("b"))))).first()[0]
        assert near < most, (n, near)
        print(n, near)


# --- neighbours


def test_repeated_query_rows(spark):
    rng = np.random.default_rng(4)
    table = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    asked = df.where("vec_id in (0, 50)")
    other = spark.createDataFrame([(50, [1.0, 2.0, 3.0, 4.0])], df.schema)
    rank = lambda found: sorted((r.query_id, r.rank, r.vec_id) for r in found.collect())
    once = rank(neighbours.nearest(df, asked, relax=1.0))
    assert rank(neighbours.nearest(df, asked.union(asked).union(asked), relax=1.0)) == once
    both = rank(neighbours.nearest(df, asked.union(other), relax=1.0))
    assert both == sorted(once + rank(neighbours.nearest(df, other, relax=1.0))) and len(both) == 15


def brute_nearest(vectors, k=5):
    ok = {i: np.array(v, float) for i, v in vectors if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    for q in ok:
        if q % 50 == 0:
            near = sorted((-round(float(ok[q] @ v / (np.linalg.norm(ok[q]) * np.linalg.norm(v))), 12), i) for i, v in ok.items() if i != q)[:k]
            yield from ((q, n + 1, i) for n, (_, i) in enumerate(near))


def test_vectors_of_other_lengths_take_no_part(spark):
    rows_ = [(i, [float(i), 1.0, 2.0]) for i in range(1, 30)] + [(100 + i, [1.0, float(i)]) for i in range(10)] + [(1, [5.0])]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df, relax=1.0, shard_rows=4).collect()
    assert {r.query_id for r in got} == set(range(1, 30)) and {r.vec_id for r in got} <= set(range(1, 30))
    two = neighbours.nearest(df, df, relax=1.0, dim=2).collect()
    assert {r.query_id for r in two} == {100 + i for i in range(10)}
    assert neighbours.nearest(df, df, dim=9).count() == 0 and neighbours.nearest(df.limit(0), df).count() == 0


def test_one_id_on_a_third_of_the_mixed_rows(spark):
    rng = np.random.default_rng(4)
    rows_ = [(None, prose(rng, 20), "a") for _ in range(300)] + [(7, "the same few words", "a")] * 200 + [(i, prose(rng, 20), "b") for i in range(300)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string").repartition(6)
    sizes = mixing.sized(df)
    laid = mixing.laid_out(sizes).collect()
    for source in "ab":
        at = 0
        for r in sorted((r for r in laid if r.source == source), key=lambda r: r.start):
            assert r.start == at
            at += r["size"]
    got = mixing.mix_sizes(df).collect()
    _, target = brute_targets([(a, b, None, c) for a, b, c in rows_])
    assert len(got) == 800 and all(r.taken <= 2 * r.size for r in got)
    for source, t in target.items():
        assert abs(sum(r.taken for r in got if r.source == source) - t) <= 64
    sliced = F.pmod(F.shiftright(F.xxhash64(F.lit(mixing.SEED), "doc_id", "_key"), 32), F.lit(mixing.SLICES))
    assert sizes.where("doc_id is null").select(sliced.alias("s")).distinct().count() > 100


def test_neighbours_are_exact_at_factor_one(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 6))
    vectors = [(i, [float(x) for x in base[int(rng.integers(40))]]) if i % 3 else (i, [float(x) for x in rng.normal(size=6)]) for i in range(1200)]
    vectors += [(1250, None), (1300, [0.0] * 6), (1350, [float("nan")] * 6), (1351, [None, *[1.0] * 5]), (1400, [float("inf")] * 6), (1450, [1e-300] * 6), (1500, [1e300, -1e300, 1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<double>, rank string")
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(batch)
    spark.conf.set(batch, "7")  # rows and queries of a shard come in many batches
    got = neighbours.nearest(df, df.where("vec_id % 50 = 0"), relax=1.0, shard_rows=200, leaf=16).collect()
    spark.conf.set(batch, old)
    tiny = {1450: [1.0] * 6, 1500: [1.0, -1.0, 1e-300, 1e-300, 1e-300, 1e-300]}
    want = list(brute_nearest([(i, tiny.get(i, v)) for i, v in vectors]))
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(want)
    few = df.where("vec_id in (50, 51, 52)")
    assert neighbours.nearest(few, few.where("vec_id = 50")).count() == 2
    assert neighbours.nearest(none(df), none(df)).count() == 0


def test_relaxed_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asked = df.where("vec_id % 50 = 0")
    exact = {(r.query_id, r.vec_id) for r in neighbours.nearest(df, asked, relax=1.0).collect()}
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(df, asked, leaf=8).collect()}
    assert len(exact & got) >= 0.9 * len(exact)


def test_relaxing_leaves_out_subtrees():
    rng = np.random.default_rng(0)
    points = neighbours.unit(rng.normal(size=(4000, 3)))
    queries, visited = neighbours.unit(rng.normal(size=(50, 3))), []
    for relax in (1.0, 4.0):
        s = neighbours.Search(neighbours.Tree(points, 16), np.arange(4000), queries, 5, relax)
        s.run(0, np.arange(50))
        visited.append(s.visited)
    assert visited[1] < visited[0] < 0.5 * 50 * 4000


# --- sharding


def test_lookup_table_is_fair_and_stable():
    names = [f"s{i}" for i in range(20)]
    table = sharding.fill_table(names, 65_537)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    left = sharding.fill_table(names[:-1], 65_537)
    moved = sum(a != b for a, b in zip(table, left, strict=True) if a != 19) / 65_537
    assert moved < 0.05
    # The turns, told in another way: every shard walks its own list.
    small, size = names[:4], 101
    lists = [[(sharding.preference(s, size)[0] + k * sharding.preference(s, size)[1]) % size for k in range(size)] for s in small]
    assert all(sorted(x) == list(range(size)) for x in lists)
    owner: dict[int, int] = {}
    while len(owner) < size:
        for i, x in enumerate(lists):
            if len(owner) < size:
                owner[next(s for s in x if s not in owner)] = i
    assert sharding.fill_table(small, size) == [owner[s] for s in range(size)]
    weighted = Counter(sharding.fill_table(small, 65_537, {"s0": 3}))
    assert weighted[0] == pytest.approx(3 * weighted[1], rel=0.01)
    for bad in (([], 7), (["a", "a"], 7), (["a"], 8)):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_place_rows(spark, docs, tmp_path):
    shards = [f"s{i}" for i in range(8)]
    placed = sharding.place(clashing(docs), ["doc_id"], shards, 1009, without=["s7"]).collect()
    assert len(placed) == docs.count()
    table, left = sharding.fill_table(shards, 1009), sharding.fill_table(shards[:-1], 1009)
    by_id = defaultdict(set)
    for r in placed:
        assert r.shard == table[r.slot] and r.shard_without == left[r.slot]
        by_id[r.doc_id].add(r.shard)
    assert all(len(x) == 1 for x in by_id.values())
    hot = spark.range(3000).select(F.lit("one key").alias("k"), "id")
    spread = sharding.place(hot, ["k"], shards, 1009, spread=64, spread_by=["id"]).groupBy("shard").count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 1000
    assert sharding.place(none(docs), ["doc_id"], shards, 1009).count() == 0
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.place(docs, ["doc_id"], shards, 1009), path, 2)
    assert spark.read.parquet(path).count() == docs.count()
