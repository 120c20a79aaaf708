"""The queries that SQL can express, against their statements: on the smallest tables and on odd rows."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import compare

from tidemart.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, name, QUERIES[name], SQL[name], FOLDER)
    assert ok, note


def odd_documents():
    dice = random.Random(5)
    words = ["".join(dice.choice("abcdeéÀÿ") for _ in range(dice.randint(1, 9))) for _ in range(300)]
    passage = " ".join(words[:60])
    texts = [None, "", " \t\n", "one", "One TWO three", "\u0085  x", passage, passage + "\n", "\x0b".join(words[40:140]) + " " + passage]
    texts += [" ".join(["word"] * 200), " ".join(["word"] * 34), "İstanbul KK ÀÉß " + passage.upper(), "😀 " * 50, passage]
    texts += [" ".join(dice.choices(words, k=dice.randint(1, 400))) for _ in range(40)]
    texts += [" ".join([t + x for t, x in zip(dice.choices(words, k=80), dice.choices(["", "a", "é"], k=80), strict=True)]) for _ in range(20)]
    return pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string()), "lang": ["x"] * len(texts), "source": ["s"] * len(texts),
                     "n_chars": pa.array([len(t or "") for t in texts], pa.int64())})


def odd_pages():
    html = [None, "", "é" * 49, "é" * 50, "é" * 50, "a" * 99, "a" * 99, "a" * 100, "a" * 100, "x\r\ny" * 9000, "x\r\ny" * 9000, "😀" * 40_000]
    ids = list(range(len(html)))[::-1]
    return pa.table({"page_id": pa.array(ids, pa.int64()), "url": [f"http://a.org/{i}" for i in ids], "html": pa.array(html, pa.string())})


def odd_conversations():
    dice = random.Random(7)
    rows = []
    for conv in range(250):
        for turn in range(dice.choice([1, 2, 5, 9, 30])):
            role = dice.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = dice.choice(["", " ", None, "Yes.", "Why? ", "cut off", "No!\n", f"Line {turn}.", f"Line {turn}", " "])
            rows.append((conv if conv else None, turn if dice.random() > 0.05 else None, role, text))
    rows += rows[:20]
    names = ["conv_id", "turn", "role", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})


TABLE = {"op1_simhash": "documents", "op8_substrings": "documents", "op11_conversations": "conversations", "op12_variants": "documents", "op13_warc": "pages"}
ODD = {"documents": odd_documents, "conversations": odd_conversations, "pages": odd_pages}


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("name", sorted(TABLE))
def test_odd_rows_equal_sql(spark, tmp_path, name, empty):
    import duckdb

    table = TABLE[name]
    rows = ODD[table]()
    pq.write_table(rows[:0] if empty else rows, tmp_path / f"{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet')")
    ok, note = compare(spark, con, name, QUERIES[name], SQL[name], str(tmp_path))
    assert ok, note


def test_every_statement_is_of_a_query():
    assert set(SQL) == set(TABLE) <= set(QUERIES)
