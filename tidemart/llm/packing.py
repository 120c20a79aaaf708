"""Packing documents into token windows by lexical retrieval.

Documents are tokenised once and dealt to shards of about ``shard_tokens`` tokens. Corpus statistics (document frequencies, mean length)
come from all documents; a token vocabulary bounds them. Each shard holds a BM25 inverted index over the pieces that are still to be
packed. A seed document opens a window, its unused neighbours by falling BM25 score fill it, and the last one is cut where
the window is full; what is left of it is the next seed. A document that is longer than a window fills windows of its
own first. So every window but a shard's last is full; the last is cut into lengths that are powers of two, which need
no padding.

Defined cases: a null text counts as empty, and an empty text is its end token alone; rows with an equal or null doc_id are separate
documents; ties of scores go to the smaller (doc_id, tokens); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored, worker_store

WINDOW = 4096
END_ID = 2
SHARD_TOKENS = 1_000_000
K1, B = 1.2, 0.75
# A worker holds at most so many words, none longer than this: about 130 MB in all.
CACHED_WORDS, CACHED_LENGTH = 600_000, 40
# Texts are worked on together up to so many characters.
TOGETHER = 6 << 20
LETTERS_THEN_SIGNS = re.compile(r"([^\W\d_]*)([.,!?;:*#$%&|]*)\Z").match
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# --- tokens


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell a byte: printable ones as themselves, the others as letters from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Ids of lower-case words as two-byte integers, worked out when a word is first asked for.

    What is held is bounded: a full table is begun anew.
    """

    def __init__(self, tokenizer, cached: int):
        super().__init__()
        self.tokenizer, self.model, self.spelling, self.cached = tokenizer, tokenizer.model, byte_letters(), cached

    def __missing__(self, word: str) -> bytes:
        ids = self.learn(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= self.cached:
                self.clear()
            self[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        """Ids of a run of letters or of signs."""
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.spelling)
        return array("H", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def learn(self, word: str) -> bytes:
        if word.isascii() and word.isalpha() and word.islower():
            return array("H", [t.id for t in self.model.tokenize(word)]).tobytes()
        m = LETTERS_THEN_SIGNS(word)
        letters, signs = m.groups() if m else ("", "")
        if not m or letters and not (letters.isalpha() and (letters.isascii() or unicodedata.is_normalized("NFC", letters)) and letters == letters.lower()):
            return array("H", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if letters and signs:
            return self[letters] + self[signs]
        return self._part(word) if word else b""


class WordTokens:
    """Token ids of a text, worked out once per distinct word.

    The tokenizer drops white space, lowers case, and joins neither what white space separates nor letters with signs, so a text's ids are
    its words' ids in a row. Words of plain letters with signs behind them go to the tokenizer's merge model directly, letters and signs apart;
    all other words go through the whole tokenizer.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        store = worker_store("tokens")
        if store.get("path") != path:
            store.update(path=path, words=Words(Tokenizer.from_file(path), cached))
        self.words = store["words"]

    def together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many there are up to the end of each text."""
        # The tokenizer lowers letter by letter; Python differs for one letter only, at a word's end.
        lower = pa.array([(t if "\u03a3" in t else t.lower()).replace("\n", " ") for t in texts], pa.string())
        split = pc.split_pattern(lower, " ")
        coded = split.flatten().dictionary_encode()
        known = [*map(self.words.__getitem__, coded.dictionary.to_pylist())]
        pool, lengths = ids_of(b"".join(known)), np.fromiter(map(len, known), np.int32, len(known)) >> 1
        word = coded.indices.to_numpy()
        size, starts = lengths[word], (np.cumsum(lengths, dtype=np.int32) - lengths)[word]
        after = np.cumsum(size, dtype=np.int32)
        take = np.repeat(starts - (after - size), size) + np.arange(after[-1], dtype=np.int32)
        return pool[take], np.concatenate([[0], after]).astype(np.int64)[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as two-byte integers."""
        ids, ends = self.together(texts)
        return [x.tobytes() for x in np.split(ids, ends[:-1])]


def slices(text: str, size: int = 1 << 19) -> Iterator[str]:
    """Parts of a long text, cut at spaces, so that the words of one part are held at a time."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def tokenised(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (two bytes each, with the end token), tokens, salt (deals rows with one doc_id to different shards)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end, seen = WordTokens(tokenizer_path), np.array([END_ID], "<u2"), 0
        for batch in batches:
            texts, first = [t or "" for t in batch.column("text").to_pylist()], 0
            while first < batch.num_rows:
                last, held = first, 0
                while last < batch.num_rows and (held := held + len(texts[last])) <= TOGETHER:
                    last += 1
                if last == first:  # one that is longer
                    last += 1
                    ids = np.concatenate([coder.together([part])[0] for part in slices(texts[first])])
                    ends = np.array([len(ids)])
                else:
                    ids, ends = coder.together(texts[first:last])
                n = last - first
                begin = np.concatenate([[0], 2 * (ends + np.arange(1, n + 1))])
                raw = pa.py_buffer(np.insert(ids, ends, end[0]).tobytes())
                packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(begin.astype(np.int32).tobytes()), raw])
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(first, n), "ids": packed, "tokens": pa.array(np.diff(begin) >> 1, pa.int64()),
                    "salt": pa.array(np.arange(seen, seen + n), pa.int64()),
                })
                first, seen = last, seen + n

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary, tokens long, salt long")


def ids_of(raw) -> np.ndarray:
    return np.frombuffer(raw, "<u2")


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct two-byte ids and where they begin in their sorted order (a radix sort)."""
    s = np.sort(ids, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[begin], begin


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def document_frequencies(tokens: DataFrame) -> dict[int, int]:
    """In how many documents each token occurs: at most one row per token of the vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for raw in batch.column("ids"):
                total[distinct(ids_of(raw.as_buffer()))[0]] += 1
        used = np.flatnonzero(total)
        yield pa.record_batch({"token": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    parts = tokens.select("ids").mapInArrow(count, "token long, n long")
    return {r.token: r.n for r in parts.groupBy("token").agg(F.sum("n").alias("n")).collect()}


# --- one shard


class Index:
    """BM25 postings of the pieces of a shard, each posting with its share of the score."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(p) for p in pieces], np.int64)
        parts = [distinct(p) for p in pieces]
        owner = np.repeat(np.arange(len(pieces)), [len(t) for t, _ in parts])
        token = np.concatenate([t for t, _ in parts] or [np.zeros(0, np.uint16)])
        tf = np.concatenate([np.diff(np.append(b, n)) for (_, b), n in zip(parts, lengths.tolist(), strict=True)] or [np.zeros(0, np.int64)])
        use = idf[token] > 0  # a term in over half of all documents tells nothing
        order = np.argsort(token[use], kind="stable")
        token, owner, tf = token[use][order], owner[use][order], tf[use][order]
        self.n, self.doc = len(pieces), owner
        # Postings of token t: from begin[t] to begin[t + 1].
        self.begin = np.searchsorted(token, np.arange((1 << 16) + 1))
        self.part = idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[owner] / mean))

    def scores(self, ids: np.ndarray) -> np.ndarray:
        wanted = distinct(ids)[0].astype(np.int64)
        a, b = self.begin[wanted], self.begin[wanted + 1]
        a, size = a[b > a], (b - a)[b > a]
        if not len(a):
            return np.zeros(self.n)
        take = np.arange(size.sum()) + np.repeat(a - (np.cumsum(size) - size), size)
        return np.bincount(self.doc[take], self.part[take], self.n)


def powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) over the documents of one shard."""
    done: list[list[tuple[int, int, int]]] = []
    at = [0] * len(docs)
    for i, ids in enumerate(docs):
        while len(ids) - at[i] >= window:
            done.append([(i, at[i], window)])
            at[i] += window
    index = Index([ids[a:] for ids, a in zip(docs, at, strict=True)], idf, mean)
    unused = np.array([len(ids) > a for ids, a in zip(docs, at, strict=True)])
    seed, following = None, iter(range(len(docs)))
    while True:
        if seed is None and (seed := next((i for i in following if unused[i]), None)) is None:
            return done
        score = index.scores(docs[seed][at[seed] :])
        unused[seed] = False
        others = np.flatnonzero(unused)
        order = iter(others[np.argsort(-score[others], kind="stable")].tolist())
        sequence, room, now, seed = [], window, seed, None
        while now is not None:
            take = min(room, len(docs[now]) - at[now])
            sequence.append((now, at[now], take))
            unused[now] = False
            at[now] += take
            room -= take
            if at[now] < len(docs[now]):
                seed = now
            now = next(order, None) if room else None
        if not room:
            done.append(sequence)
            continue
        for size in powers(window - room):  # nothing is unused any more
            cut: list[tuple[int, int, int]] = []
            while size:
                i, start, length = sequence.pop(0)
                take = min(size, length)
                cut.append((i, start, take))
                if take < length:
                    sequence.insert(0, (i, start + take, length - take))
                size -= take
            done.append(cut)
        return done


# --- the operator


def packed(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packed_tokens(stored(tokenised(docs, tokenizer_path), "tokens"), window, shard_tokens)


def packed_tokens(tokens: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """The same from stored tokens; ``with_ids`` adds each piece's ids."""
    whole = tokens.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")).first()
    n, total = whole.n, whole.tokens or 0
    idf = np.zeros(1 << 16)
    for token, df in document_frequencies(tokens).items():
        idf[token] = max(0.0, np.log((n - df + 0.5) / (df + 0.5)))
    mean = max(1.0, total / max(1, n))
    shards = max(1, -(-total // shard_tokens))

    def run(table: pa.Table) -> pa.Table:
        worker_store("packing")  # the words of the stage before go
        raw, shard = table.column("ids").to_pylist(), table.column("shard")[0].as_py()
        keys = table.column("doc_id").to_pylist()
        order = sorted(range(len(raw)), key=lambda i: (keys[i] is None, keys[i] or 0, raw[i]))
        docs, keys = [ids_of(raw[i]) for i in order], [keys[i] for i in order]
        rows = []
        for k, sequence in enumerate(pack(docs, idf, mean, window)):
            offset = 0
            for i, start, length in sequence:
                ids = docs[i][start : start + length]
                rows.append((keys[i], start, length, crc32(ids), len(docs[i]), (shard << 32) + k, offset, ids.tobytes() if with_ids else None))
                offset += length
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*rows, strict=True)) or [()] * 8
        out = {name: pa.array(c, pa.int64()) for name, c in zip(names, columns, strict=False)}
        return pa.table(out | ({"ids": pa.array(columns[7], pa.binary())} if with_ids else {}))

    dealt = tokens.withColumn("shard", F.pmod(F.xxhash64("doc_id", "salt"), F.lit(shards)))
    return dealt.select("shard", "doc_id", "ids").groupBy("shard").applyInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def sequences(tokens: DataFrame, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (two bytes each), doc_ids."""
    pieces = packed_tokens(tokens, window, shard_tokens, with_ids=True)
    listed = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return pieces.groupBy("sequence_id").agg(listed.alias("p")).select(
        "sequence_id", F.aggregate("p.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"), F.col("p.doc_id").alias("doc_ids")
    )  # at most one window of pieces per sequence
