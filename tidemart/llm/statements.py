"""Statements in DuckDB's SQL of the queries that SQL can express; each one works on the given tables alone, by a plainer way than its operator."""

from __future__ import annotations

# CRC-32 by half bytes, from its reflected polynomial.
POLYNOMIAL = 0xEDB88320


def _half_byte(n: int) -> int:
    for _ in range(4):
        n = (n >> 1) ^ (POLYNOMIAL if n & 1 else 0)
    return n


def crc32(digits: str) -> str:
    """The unsigned CRC-32 of the bytes whose hex digits stand in the column ``digits``."""
    table = ", ".join(f"{_half_byte(n)}::BIGINT" for n in range(16))
    halves = f"list_transform(range(length({digits})), lambda i: (instr('0123456789ABCDEF', substr({digits}, xor(i, 1)::BIGINT + 1, 1)) - 1)::BIGINT)"
    return f"xor(list_reduce({halves}, lambda c, h: xor(c >> 4, ([{table}])[xor(c & 15, h & 15) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"


SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

# The five primes of XXH64 (fixed values).
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
SEED = 42
LOW = f"{2**64 - 1}::UHUGEINT"


def _times(a: str, b: int) -> str:
    return f"((({a}) * {b}::UHUGEINT) & {LOW})"


def _plus(*terms: str) -> str:
    return f"(({' + '.join(terms)}) & {LOW})"


def _turned(x: str, n: int) -> str:
    return f"list_transform([({x}) * {1 << n}::UHUGEINT], lambda p: (p & {LOW}) + p // {1 << 64}::UHUGEINT)[1]"


def _round(so_far: str, lane: str) -> str:
    return _times(_turned(_plus(so_far, _times(lane, P2)), 31), P1)


def _lane(start: str, width: int) -> str:
    """The little-endian number of ``width`` bytes of the column ``b`` from ``start`` on."""
    return "(" + " + ".join(f"b[{start} + {k + 1}] * {1 << 8 * k}::UHUGEINT" for k in range(width)) + ")"


def xxhash64(source: str) -> str:
    """Expressions of common tables that end in ``hashed`` (shingle, h UBIGINT), of the texts ``shingle`` of a table."""
    starts = [(SEED + P1 + P2) % 2**64, (SEED + P2) % 2**64, SEED, (SEED - P1) % 2**64]
    lanes = ", ".join(
        f"list_reduce(list_transform(range(n // 32), lambda i: {_lane(f'32 * i + {8 * k}', 8)}), lambda v, x: {_round('v', 'x')}, {first}::UHUGEINT) AS v{k}"
        for k, first in enumerate(starts)
    )
    joined = _plus(*(_turned(f"v{k}", n) for k, n in enumerate((1, 7, 12, 18))))
    merged = f"list_reduce([v0, v1, v2, v3], lambda h, v: {_plus(_times('xor(h, ' + _round('0::UHUGEINT', 'v') + ')', P1), f'{P4}::UHUGEINT')}, {joined})"
    eights = f"list_transform(range(n // 32 * 4, n // 8), lambda i: {_lane('8 * i', 8)})"
    by_eight = _plus(_times(_turned("xor(h, " + _round("0::UHUGEINT", "x") + ")", 27), P1), f"{P4}::UHUGEINT")
    by_four = _plus(_times(_turned(f"xor(h, {_times(_lane('(n // 8 * 8)', 4), P1)})", 23), P2), f"{P3}::UHUGEINT")
    by_one = _times(_turned(f"xor(h, {_times('x', P5)})", 11), P1)
    return f"""encoded AS (
    SELECT shingle, hex(encode(shingle)) AS digits FROM (SELECT DISTINCT shingle FROM {source})
), bytes AS (
    SELECT shingle, length(digits) // 2 AS n, list_transform(range(length(digits) // 2), lambda i: (16 * (instr('0123456789ABCDEF',
        substr(digits, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(digits, 2 * i + 2, 1)) - 1)::UHUGEINT) AS b FROM encoded
), lanes AS (
    SELECT shingle, n, b, {lanes} FROM bytes
), stripes AS (
    SELECT shingle, n, b, (CASE WHEN n >= 32 THEN {merged} ELSE {SEED + P5}::UHUGEINT END + n::UHUGEINT) & {LOW} AS h FROM lanes
), eights AS (
    SELECT shingle, n, b, list_reduce({eights}, lambda h, x: {by_eight}, h) AS h FROM stripes
), fours AS (
    SELECT shingle, n, b, CASE WHEN n % 8 >= 4 THEN {by_four} ELSE h END AS h FROM eights
), ones AS (
    SELECT shingle, list_reduce(b[n // 4 * 4 + 1:], lambda h, x: {by_one}, h) AS h FROM fours
), mixed AS (
    SELECT shingle, {_times(f"xor(h, h // {1 << 33}::UHUGEINT)", P2)} AS h FROM ones
), mixed_again AS (
    SELECT shingle, {_times(f"xor(h, h // {1 << 29}::UHUGEINT)", P3)} AS h FROM mixed
), hashed AS (
    SELECT shingle, xor(h, h // {1 << 32}::UHUGEINT)::UBIGINT AS h FROM mixed_again
)"""


MAJORITY = " + ".join(f"CASE WHEN 2 * count(*) FILTER ((h >> {i}) & 1 = 1) > count(*) THEN {1 << i}::UBIGINT ELSE 0::UBIGINT END" for i in range(64))

# Every pair of fingerprints compared, and all that each one reaches.
SIMHASH = rf"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
), shingles AS (
    SELECT r, unnest(list_transform(range(greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i + 1:i + 4], ' '))) AS shingle FROM texts WHERE len(w) > 0
), {xxhash64("shingles")}, majority AS (
    SELECT r, {MAJORITY} AS fp FROM shingles JOIN hashed USING (shingle) GROUP BY r
), prints AS (
    SELECT doc_id, coalesce(fp, 0::UBIGINT) AS fp FROM texts LEFT JOIN majority USING (r)
), classes AS (
    SELECT fp, min(doc_id) AS first FROM prints GROUP BY fp
), links AS (
    SELECT a.fp, b.fp AS other FROM classes a JOIN classes b ON bit_count(xor(a.fp, b.fp)::HUGEINT) <= 4
), reached AS (
    SELECT fp, fp AS other FROM classes UNION SELECT r.fp, l.other FROM reached r JOIN links l ON l.fp = r.other
), components AS (
    SELECT r.fp, min(c.first) AS component_id FROM reached r JOIN classes c ON c.fp = r.other GROUP BY r.fp
)
SELECT doc_id, lpad(lower(to_hex(fp)), 16, '0') AS fingerprint, component_id FROM prints JOIN components USING (fp)
"""

# Windows as texts, told apart by their count; a word goes if one of the 35 windows that cover it is repeated.
SUBSTRINGS = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), words AS (
    SELECT r, unnest(range(1, len(w) + 1)) AS nr, unnest(w) AS word FROM texts
), windows AS (
    SELECT r, unnest(range(1, len(w) - 33)) AS nr, w FROM texts WHERE len(w) >= 35
), named AS (
    SELECT r, nr, sha256(array_to_string(w[nr:nr + 34], ' ')) AS name FROM windows
), repeated AS (
    SELECT r, nr, count(*) OVER (PARTITION BY name) > 1 AS again FROM named
), covered AS (
    SELECT r, nr, word, coalesce(bool_or(again) OVER (PARTITION BY r ORDER BY nr ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), false) AS gone
    FROM words LEFT JOIN repeated USING (r, nr)
), kept AS (
    SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY nr) FILTER (NOT gone) AS kept FROM covered GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

# Every state of the search row by row: of the edits that lead to one place in the pattern, the least (cost, audit).
CONVERSATIONS = rf"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS digits
    FROM conversations
), marked AS (
    SELECT *, {crc32("digits")} % 20 AS damage FROM given
), damaged AS (
    SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
        CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM marked
), placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text), copy) AS nr
    FROM damaged
), judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^{SPACE}]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nr) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][{SPACE}]*\z') THEN 'truncated' ELSE '' END AS fault,
        nr > 1 AND lag(initial) OVER (PARTITION BY conv_id ORDER BY nr) || initial NOT IN ('su', 'ua', 'au') AS illegal
    FROM placed
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM judged GROUP BY conv_id
), places(place) AS (
    VALUES ('start'), ('system'), ('user'), ('assistant')
), inserts AS (
    SELECT place, 0 AS paid, '' AS edits, '' AS lines, place AS reached FROM places
    UNION ALL SELECT place, 5, 'I', CASE place WHEN 'user' THEN 'assistant:' ELSE 'user:' END || chr(10),
        CASE place WHEN 'user' THEN 'assistant' ELSE 'user' END FROM places
    UNION ALL SELECT place, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10), 'assistant' FROM places WHERE place <> 'user'
    UNION ALL SELECT place, 10, 'II', 'assistant:' || chr(10) || 'user:' || chr(10), 'user' FROM places WHERE place = 'user'
), moves AS (
    SELECT place, paid + 2 AS paid, edits || 'D' AS edits, lines, 'D' AS edit, NULL AS initial, reached AS after FROM inserts
    UNION ALL SELECT place, paid + 1, edits || 'R', lines, 'R', NULL, CASE reached WHEN 'user' THEN 'assistant' ELSE 'user' END FROM inserts
    UNION ALL SELECT place, paid, edits || 'K', lines, 'K', 's', 'system' FROM inserts WHERE reached = 'start'
    UNION ALL SELECT place, paid, edits || 'K', lines, 'K', 'u', 'user' FROM inserts WHERE reached <> 'user'
    UNION ALL SELECT place, paid, edits || 'K', lines, 'K', 'a', 'assistant' FROM inserts WHERE reached = 'user'
), search AS (
    SELECT conv_id, 0::BIGINT AS done, 'start' AS place, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} AS best FROM counts
    UNION ALL
    SELECT s.conv_id, s.done + 1, m.after, min({{
        'cost': s.best.cost + m.paid + CASE WHEN m.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END,
        'audit': s.best.audit || m.edits,
        'lines': s.best.lines || m.lines || CASE m.edit WHEN 'D' THEN '' WHEN 'K' THEN j.role || ':' || j.text || chr(10)
            ELSE m.after || ':' || j.text || chr(10) END}})
    FROM search s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.nr = s.done + 1 JOIN moves m ON m.place = s.place
    WHERE (m.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate')) AND (m.initial IS NULL OR m.initial = j.initial)
    GROUP BY s.conv_id, s.done, m.after
), ended AS (
    SELECT c.conv_id, min({{'cost': s.best.cost + i.paid, 'audit': s.best.audit || i.edits, 'lines': s.best.lines || i.lines}}) AS best
    FROM counts c JOIN search s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.done = c.n JOIN inserts i ON i.place = s.place
    WHERE i.reached IN ('start', 'assistant') GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.lines, length(best.lines) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

# Near words meet in what is left without one code point: at the same place (a replacement), or as the other word itself.
VARIANTS = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents
), counted AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM runs WHERE length(run) >= 7 GROUP BY ALL
), encoded AS (
    SELECT run, n, hex(encode(doc_id || ':' || run)) AS digits FROM counted
), marked AS (
    SELECT run, n, {crc32("digits")} AS h FROM encoded
), edited AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM marked
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), places AS (
    SELECT word, n, unnest(range(length(word))) AS nr FROM words
), shorter AS (
    SELECT word, n, nr, left(word, nr) || substr(word, nr + 2) AS rest FROM places
), near AS (
    SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b USING (nr, rest) WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min({{'n': -n, 'other': other}}) AS top FROM near GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.n >= 10 * n THEN top.other END AS form, CASE WHEN -top.n >= 10 * n THEN -top.n END AS form_n
    FROM words LEFT JOIN best USING (word)
), followed AS (
    SELECT word, word AS nr FROM formed
    UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.nr WHERE g.form IS NOT NULL
), roots AS (
    SELECT f.word, f.nr AS root FROM followed f JOIN formed g ON g.word = f.nr WHERE g.form IS NULL
)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN roots USING (word)
"""

# What the archives give back: of equal payloads of 100 bytes and more the first page is the response.
WARC = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest,
        row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS copy,
        min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 100 AND copy > 1 THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND copy > 1 THEN first END AS refers_to
FROM payloads
"""

SQL = {
    "op1_simhash": SIMHASH,
    "op8_substrings": SUBSTRINGS,
    "op11_conversations": CONVERSATIONS,
    "op12_variants": VARIANTS,
    "op13_warc": WARC,
}
