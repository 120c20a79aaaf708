"""WARC archives: round trips, the format itself, and records against brute force."""

from __future__ import annotations

import gzip
import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from tidemart.llm import warc
from tidemart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TEXTS = ["", None, "short", "é" * 49, "é" * 50, "x" * 99, "x" * 100, "\r\n" * 60, "\n" * 130, "\r" * 131, "a\r\r\nb\r" * 40, "WARC/1.1\r\n\r\n0\r\n\r\n" * 9, "日本語\u0000 " * 33]


def brute(rows):
    """(page, bytes, digest, type, refers) of rows (page_id, html)."""
    whole = [(p, (h or "").encode()) for p, h in rows]
    by, out = defaultdict(list), Counter()
    for p, x in whole:
        by[x].append(p)
    for x, pages in by.items():
        pages = sorted(pages, key=lambda p: (p is None, p or 0))
        for i, p in enumerate(pages):
            plain = len(x) < 100 or i == 0
            out[p, len(x), hashlib.sha256(x).hexdigest(), "response" if plain else "revisit", None if plain else pages[0]] += 1
    return out


def back(spark, rows, path, **how):
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), path, **how)
    found = warc.resolve(warc.read_records(spark, path)).collect()
    assert len({r.record_id for r in found}) == len(found) == len(rows)
    number = lambda x: None if x is None else int(x)
    return Counter((number(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in found)


@pytest.mark.parametrize("chunk", [1, 7, 100, 1 << 14])
def test_records_against_brute_force(spark, tmp_path, chunk):
    rows = [(i, f"http://a/{i}", TEXTS[i % len(TEXTS)]) for i in range(40)] + [(None, None, "x" * 100), (3, "u\r\nWARC: 1%0A", "x" * 100)] + [(50, "same", "same " * 30)] * 9
    assert back(spark, rows, str(tmp_path / "w"), chunk=chunk) == brute([(p, h) for p, _, h in rows])


def test_hot_payload_and_hot_row(spark, tmp_path):
    rows = [(i, "u", "hot " * 40) for i in range(300)] + [(7, "u", "row " * 40)] * 300 + [(None, None, None)] * 100
    assert back(spark, rows, str(tmp_path / "w")) == brute([(p, h) for p, _, h in rows])


def test_empty_table_and_odd_columns(spark, tmp_path):
    assert back(spark, [], str(tmp_path / "none")) == Counter()
    frame = spark.createDataFrame([(b"x", "1", "p", "u", "h" * 200, "k")], "payload binary, `my col` string, page_id string, url string, html string, key string")
    warc.write(frame.withColumn("a.b", frame["key"]), str(tmp_path / "w"))
    assert [(r.page_id, r.payload_bytes) for r in warc.read_records(spark, str(tmp_path / "w")).collect()] == [("p", 200)]


def test_chunk_rows_carry_running_digests(spark, tmp_path):
    html = "".join(f"line {i} ä\r\n" for i in range(5000))
    warc.write(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"), str(tmp_path / "w"), chunk=1000)
    found = warc.read_chunks(spark, str(tmp_path / "w")).orderBy("chunk_no").collect()
    raw = html.encode()
    assert [r.chunk_no for r in found] == list(range(len(found))) and max(len(r.data) for r in found) == 1000
    for r in found:
        assert r.digest_so_far == hashlib.sha256(raw[: r.bytes_so_far]).hexdigest()
    assert b"".join(bytes(r.data) for r in found) == raw


def test_archives_are_warc(spark, tmp_path):
    """A reader that knows only Content-Length walks the files."""
    rows = [(i, f"http://a/{i}", TEXTS[i % len(TEXTS)]) for i in range(40)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"), chunk=50)
    seen = Counter()
    for file in Path(tmp_path / "w").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            n = int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
            block, data = rest[:n], rest[n + 4 :]
            http, _, body = block.partition(b"\r\n\r\n")
            kind = re.search(rb"WARC-Type: (\w+)", head)[1].decode()
            page = int(re.search(rb"X-Page-ID: (\d+)", head)[1])
            if kind == "response":
                payload = b""
                while (size := int(body[:8].split(b"\r\n")[0], 16)) :
                    payload, body = payload + body[10 : 10 + size], body[12 + size :]
                assert body == b"0\r\n\r\n" and payload == (rows[page][2] or "").encode()
            else:
                assert not body and b"Transfer-Encoding" not in http
            seen[kind] += 1
    assert sum(seen.values()) == 40 and seen["revisit"] > 5


def test_a_damaged_archive_is_an_error(spark, tmp_path):
    warc.write(spark.createDataFrame([(1, "u", "text " * 50)], "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    file = next(f for f in Path(tmp_path / "w").glob("*.gz") if gzip.decompress(f.read_bytes()))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/x.txt.gz").write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"text text", b"text lext", 1)))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_records(spark, str(tmp_path / "bad")).collect()


def test_whole_table(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()
    got = QUERIES["op13_warc"](spark, FOLDER)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, got.collect())) == brute([tuple(r) for r in pages])
