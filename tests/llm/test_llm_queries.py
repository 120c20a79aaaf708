"""The registered queries over whole tables, against brute force, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from test_operators import brute_components, brute_edited, brute_fingerprint, brute_nearest, brute_repeats, brute_targets, brute_url, words

from tidemart.llm import packing, sharding, simhash, toxicity
from tidemart.llm.queries import QUERIES, SHARDS, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")


@pytest.fixture(scope="module")
def rows(tables):
    return [tuple(r) for r in tables("documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(scope="module")
def run(spark):
    done = {}

    def result(name):
        if name not in done:
            done[name] = QUERIES[name](spark, FOLDER).collect()
        return done[name]

    return result


def groups(rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = brute_components(fps)
    least = {}
    for r, c in zip(rows, root, strict=True):
        least[c] = min(least.get(c, r[0]), r[0])
    return [(r[0], f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, root, strict=True)]


def test_op1(run, rows):
    assert sorted(map(tuple, run("op1_simhash"))) == sorted(groups(rows))


def check_packed(pieces, rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    ids = {r[0]: [*e.ids, 2] for r, e in zip(rows, plain.encode_batch([r[1] or "" for r in rows], add_special_tokens=False), strict=True)}
    at, length = defaultdict(int), defaultdict(int)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        x = ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(x)
        at[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(np.array(x[r.start : at[r.doc_id]], "<u4").tobytes())
    assert dict(at) == {k: len(x) for k, x in ids.items()}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == length[r.sequence_id]
        length[r.sequence_id] += r.length
    assert all(n == packing.WINDOW or n & (n - 1) == 0 and n < packing.WINDOW for n in length.values())


def test_op2(run, rows):
    check_packed(run("op2_packing"), rows)


def test_op3(run, rows):
    want = {i: (len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in brute_edited(rows)}
    got = run("op3_fingerprints")
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    by_text = defaultdict(set)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95


def test_op4(run, rows):
    sizes, target = brute_targets(rows)
    taken = defaultdict(int)
    for r in run("op4_mixing"):
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert {r.doc_id: r.size for r in run("op4_mixing")} == {r[0]: len(words(r[1])) for r in rows}
    assert all(abs(taken[s] - t) <= 64 for s, t in target.items())


def test_op5_and_op6(run, rows, tables):
    labels = {r.doc_id: r for r in tables("labels").collect()}
    quality = {r.doc_id: r for r in run("op5_quality")}
    toxic = {r.doc_id: r for r in run("op6_toxicity")}
    ids = {r[0] for r in rows}
    assert set(quality) == set(toxic) == ids
    known = [i for i in labels if i in ids]
    assert np.mean([quality[i].keep == labels[i].quality for i in known]) > 0.9
    assert np.mean([toxic[i].predicted == labels[i].toxic for i in known]) > 0.85
    for i, r in toxic.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1


def test_held_out_toxicity_on_more_documents(spark):
    folder = FOLDER.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    done = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels)).join(labels, "doc_id")
    held = done.where(toxicity.held_out(done.doc_id)).select("predicted", "toxic").collect()
    assert len(held) > 500 and np.mean([r.predicted == r.toxic for r in held]) > 0.98


def test_op7(run, tables):
    urls = {r.page_id: r.url for r in tables("pages").collect()}
    got = run("op7_url_filter")
    assert {r.page_id: (r.host, r.path, r.rule) for r in got} == {i: brute_url(u) for i, u in urls.items()}
    assert {r.verdict for r in got} <= {"allow", "block"}


def test_op8(run, rows):
    assert Counter(map(tuple, run("op8_substrings"))) == Counter(brute_repeats(rows))


def test_op9(run, tables):
    vectors = [(r.vec_id, r.embedding) for r in tables("embeddings").collect()]
    want = {(q, i) for q, _, i in brute_nearest(vectors)}
    got = run("op9_neighbours")
    assert len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want) and len(got) == len(want)
    by_id = {i: np.array(v, float) for i, v in vectors}
    for r in got:
        a, b = by_id[r.query_id], by_id[r.vec_id]
        assert r.score == pytest.approx(float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), abs=1e-12)


def test_op10(run, rows):
    table = sharding.fill_table(SHARDS, 65_537)
    got = run("op10_sharding")
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(table[r.slot] == r.shard for r in got)


def test_pipeline_stages(spark, tables, rows):
    docs, columns = tables("documents"), tables("documents").columns
    toxic, near, repeats, mixed, packed = (f for _, f in corpus_pipeline.STAGES)
    fixed = lambda df: spark.createDataFrame(df.collect(), df.schema)  # noqa: E731  a stage's output, computed once
    clean = fixed(toxic(spark, docs, FOLDER))
    model = toxicity.train(docs, tables("labels"))
    kept = {r.doc_id for r in toxicity.score(docs.select("doc_id", "text"), model).collect() if not r.predicted}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == kept
    one = fixed(near(spark, clean, FOLDER))
    rows_in = [tuple(r) for r in clean.select("doc_id", "text").collect()]
    assert one.columns == columns and sorted(r.doc_id for r in one.collect()) == sorted({c for *_, c in groups(rows_in)})
    cut = fixed(repeats(spark, one, FOLDER))
    rows_in = [(r.doc_id, r.text) for r in one.collect()]
    want = {i: h for i, _, _, h in brute_repeats(rows_in)}
    assert cut.columns == columns
    assert {r.doc_id: hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest() for r in cut.collect()} == want
    drawn = fixed(mixed(spark, cut, FOLDER))
    rows_in = [(r.doc_id, r.text, r.lang, r.source) for r in cut.collect()]
    _, target = brute_targets(rows_in)
    taken, size = defaultdict(int), {r[0]: len(words(r[1])) for r in rows_in}
    for r in drawn.collect():
        n = len(words(r.text))
        assert n <= 2 * size[r.doc_id]
        taken[r.source] += n
    assert drawn.columns == columns and all(abs(taken[s] - t) <= 64 for s, t in target.items())
    check_packed(packed(spark, drawn, FOLDER).collect(), [(r.doc_id, r.text) for r in drawn.collect()])
    whole = QUERIES["pipeline"](spark, FOLDER)
    assert whole.count() > 0 and simhash.RADIUS == 4
