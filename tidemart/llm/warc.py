r"""WARC archives as a chunked record table.

``write`` turns pages into WARC/1.1 records, one per row. A payload is written in chunks: rows of (record, part) in which part 0 is the
header, the parts after it are pieces of at most ``CHUNK`` bytes, and the last part ends the record. The pieces are HTTP chunks
(``Transfer-Encoding: chunked``), so each row is a line that ends with CR LF, Spark's text writer lays them down one by one, and no
task builds a whole record. Archives are gzip files, which no reader splits.

``read_chunks`` reads them back as (record, chunk) rows, each with the bytes and the SHA-256 of its payload so far; ``read_records`` keeps the
state at the end of each record. Both stream: a task holds one piece and a running digest. A stated length or digest that does
not hold is an error.

Of payloads of at least ``LEAST`` bytes that are equal, the row with the smallest id is a response, the others are ``revisit`` records
without a payload that refer to it; ``resolve`` gives them its length and digest again.

Defined cases: a null html is an empty payload; a null id comes after all others, and null ids and urls have no header line; rows that
repeat id, url and payload are records of their own (of an equal payload the first copy is the response); line ends in ids and urls are
percent-encoded and decoded again; other columns are ignored; an empty table makes an archive without records.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import stored

# Small enough for a full batch of rows that all are pieces (10,000 by default) to stay below 160 MB.
CHUNK = 16 << 10
LEAST = 100
DATE = "2024-01-01T00:00:00Z"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
CHUNKED = "Transfer-Encoding: chunked\r\n"


def _escaped(value: Column) -> Column:
    value = value.cast("string")
    for plain, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def _unescaped(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _urn(key: Column, copy: Column) -> Column:
    h = F.md5(F.concat_ws(":", key, copy.cast("string")))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, nothing for a null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def typed(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per record with its payload: key, copy, page_id, url, digest, bytes, payload, record_id, type, refers, refers_id.

    Rows that repeat are reduced to one payload and a count before they are shuffled. The payload is shuffled once.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select("page_id", "url", payload.alias("payload"))
    digested = named.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    keyed = digested.withColumn("key", F.sha2(F.to_json(F.struct("page_id", "url", "digest")), 256))
    first = [F.first(c).alias(c) for c in ("page_id", "url", "digest", "bytes")]
    heads = stored(keyed.groupBy("key").agg(*first), "warc-heads")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "key")
    chosen = heads.where(F.col("bytes") >= least).groupBy("digest").agg(F.min(order).alias("best"))
    chosen = chosen.select("digest", F.col("best.key").alias("best_key"), F.col("best.page_id").alias("best_id"))
    known = heads.select("key", "digest").join(chosen, "digest", "left").select("key", "best_key", "best_id")
    rows = keyed.groupBy("key").agg(*first, F.first("payload").alias("payload"), F.count(F.lit(1)).alias("n"))
    copies = rows.join(known, "key").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    is_first = F.col("best_key").isNull() | ((F.col("best_key") == F.col("key")) & (F.col("copy") == 1))
    return copies.select(
        "page_id", "url", "digest", "bytes", F.when(is_first, F.col("payload")).alias("payload"), _urn(F.col("key"), F.col("copy")).alias("record_id"),
        F.when(is_first, "response").otherwise("revisit").alias("type"), F.when(~is_first, _urn(F.col("best_key"), F.lit(1))).alias("refers"),
    )


def parts(records: DataFrame, chunk: int = CHUNK, date: str = DATE) -> DataFrame:
    """The chunked record table: record_id, part and the bytes that part adds to the archive, in order."""
    response = F.col("type") == "response"
    pieces = F.when(response, F.ceil(F.col("bytes") / chunk)).otherwise(0).cast("long")
    length = F.when(response, len(HEAD + CHUNKED) + 2 + pieces * 12 + F.col("bytes") + 5).otherwise(len(HEAD) + 2)
    header = F.concat(
        F.lit("WARC/1.1" + END), _line("WARC-Type", F.col("type")), _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", _escaped(F.col("url"))), _line("X-Page-ID", _escaped(F.col("page_id"))),
        _line("WARC-Refers-To", F.col("refers")), _line("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", length.cast("string")),
        F.lit(END + HEAD), F.when(response, CHUNKED).otherwise(END + END),
    )
    split = records.withColumn("pieces", pieces).withColumn("header", header)
    each = split.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.when(response, F.col("pieces") + 1).otherwise(0))))
    start = ((F.col("part") - 1) * chunk).cast("int")
    size = F.lpad(F.hex(F.least(F.lit(chunk).cast("long"), F.col("bytes") - start)), 8, "0")
    piece = F.concat(size.cast("binary"), F.lit(END).cast("binary"), F.substring("payload", start + 1, F.lit(chunk)))
    value = F.when(F.col("part") == 0, F.col("header").cast("binary")).when(F.col("part") <= F.col("pieces"), piece).otherwise(F.lit("0" + 3 * END).cast("binary"))
    return each.select("record_id", "part", value.alias("value"))


def write(pages: DataFrame, path: str, chunk: int = CHUNK, least: int = LEAST, date: str = DATE) -> None:
    """Write a record per row of ``page_id, url, html`` to the folder ``path``; parts of a record follow each other in one file."""
    table = parts(typed(pages, least), chunk, date)
    table.select(F.col("value").cast("string")).write.option("lineSep", END).option("compression", "gzip").text(path)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        yield from batch.column(0).to_pylist()


def _parsed(lines: Iterator[bytes]) -> Iterator[tuple]:
    """(headers, chunk number, piece, payload bytes so far, running digest) per piece; at the end of a record the piece is None."""
    for line in lines:
        if not line:
            continue
        if line != b"WARC/1.1":
            raise ValueError(f"not the start of a record: {line[:60]!r}")
        headers, block = {}, 0
        while line := next(lines):
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        while line := next(lines):
            block += len(line) + 2
        block += 2
        digest, total, number = hashlib.sha256(), 0, 0
        if headers["WARC-Type"] == "response":
            while True:
                left = int(next(lines), 16)
                if not left:
                    block += 3 + 2 + len(next(lines))
                    break
                held = [next(lines)]
                left -= len(held[0])
                while left > 0:
                    held.append(next(lines))
                    left -= len(held[-1]) + 2
                if left:
                    raise ValueError(f"a piece of {headers['WARC-Record-ID']} is longer than stated")
                piece = b"\r\n".join(held)
                digest.update(piece)
                total += len(piece)
                block += 12 + len(piece)
                yield headers, number, piece, total, digest
                number += 1
            if headers["WARC-Payload-Digest"] != f"sha256:{digest.hexdigest()}":
                raise ValueError(f"the payload of {headers['WARC-Record-ID']} does not have its digest")
        if block != int(headers["Content-Length"]):
            raise ValueError(f"{headers['WARC-Record-ID']} has {block} bytes, not {headers['Content-Length']}")
        yield headers, number, None, total, digest


def _flushed(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", END).text(path).select(F.col("value").cast("binary"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """record_id, chunk_no (from 0), data, bytes_so_far, digest_so_far of all payload pieces in the archives of a folder."""
    schema = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int64()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string())])

    def pieces(batches):
        found = ((h["WARC-Record-ID"], i, x, n, d.hexdigest()) for h, i, x, n, d in _parsed(_lines(batches)) if x is not None)
        return _flushed(found, schema, 500)

    return _raw(spark, path).mapInArrow(pieces, "record_id string, chunk_no long, data binary, bytes_so_far long, digest_so_far string")


RECORD = ("record_id", "record_type", "page_id", "url", "refers", "payload_bytes", "payload_digest", "chunks")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, page_id, url (texts), refers, payload_bytes, payload_digest and chunks of every record; null for a revisit's payload."""
    text, number = pa.string(), pa.int64()
    schema = pa.schema(list(zip(RECORD, (text, text, text, text, text, number, text, number), strict=True)))

    def told(h, i, n, d):
        page, url = (None if h.get(x) is None else _unescaped(h[x]) for x in ("X-Page-ID", "WARC-Target-URI"))
        whole = h["WARC-Type"] == "response"
        return h["WARC-Record-ID"], h["WARC-Type"], page, url, h.get("WARC-Refers-To"), n if whole else None, d.hexdigest() if whole else None, i

    def ends(batches):
        return _flushed((told(h, i, n, d) for h, i, x, n, d in _parsed(_lines(batches)) if x is None), schema, 1000)

    kinds = ("string", "string", "string", "string", "string", "long", "string", "long")
    return _raw(spark, path).mapInArrow(ends, ", ".join(f"{c} {k}" for c, k in zip(RECORD, kinds, strict=True)))


def resolve(records: DataFrame) -> DataFrame:
    """Records with the payload length and digest of what they refer to, and its page in ``refers_to``."""
    whole = records.where("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_n"), F.col("payload_digest").alias("_d")
    )
    found = records.join(whole, F.col("refers") == F.col("_id"), "left")
    full = {"payload_bytes": F.coalesce("payload_bytes", "_n"), "payload_digest": F.coalesce("payload_digest", "_d")}
    return found.select(*[full.get(c, F.col(c)).alias(c) for c in RECORD], "refers_to")
