"""Conversation repair against exhaustive search, by rows and by slices."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemart.llm import conversations as c

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def brute_row(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) of ordered (turn, role, text); places hold their least (cost, audit, lines)."""
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    names = {"u": "user", "a": "assistant"}
    now = {"": (0, "", ())}

    def inserted(now):
        for _ in range(4):
            for place, (cost, audit, lines) in list(now.items()):
                for r in "ua":
                    if (place, r) in NEXT:
                        new = (cost + 5, audit + "I", (*lines, f"{names[r]}:"))
                        now[NEXT[place, r]] = min(now.get(NEXT[place, r], new), new)
        return now

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for place, (cost, audit, lines) in inserted(now).items():
            new = [(place, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (place, role[:1]) in NEXT:
                    new.append((NEXT[place, role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}"))))
                for r in "ua":
                    if (place, r) in NEXT:
                        new.append((NEXT[place, r], (cost + more + 1, audit + "R", (*lines, f"{names[r]}:{text}"))))
            for p, x in new:
                after[p] = min(after.get(p, x), x)
        now = after
    cost, audit, lines = min(x for p, x in inserted(now).items() if p in ("", "a"))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def text_order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())


def brute_damaged(rows):
    by, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        by[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {i: brute_row(sorted(by[i], key=text_order)) for i in ids}


def shape(rows):
    found = {r[0]: (*r[1:7], r.audit, r.repaired_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def result(spark, rows, schema="conv_id long, turn long, role string, text string"):
    return shape(c.repair_damaged(spark.createDataFrame(rows, schema)).select(*COLUMNS).collect())


def every_edit(codes):
    """All edit sequences with up to two inserts at a place, the plainest way."""
    gaps = [""] + ["I", "II"]
    best = None
    for edits in itertools.product("DKR", repeat=len(codes)):
        for ins in itertools.product(gaps, repeat=len(codes) + 1):
            cost, place, ok = 0, "", True
            audit = "".join(i + e for i, e in zip(ins, edits)) + ins[-1]
            row = 0
            for e in audit:
                r = "a" if place == "u" else "u"
                if e != "I":
                    kind, initial = divmod(c.CODES.index(codes[row]), 4)
                    initial = "suao"[initial]
                    row += 1
                    if e == "D":
                        cost += 2
                        continue
                    ok = ok and kind < 2
                    cost += 5 * (kind == 1) + (e == "R")
                    r = initial if e == "K" else r
                else:
                    cost += 5
                ok = ok and (place, r) in NEXT
                if not ok:
                    break
                place = NEXT[place, r]
            if ok and place in ("", "a"):
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("codes", ["", "u", "a", "s", "sa", "uu", "ua", "sua", "uaU", "Uu", "1ua", "oau", "uUaA"])
def test_search_against_all_edit_sequences(codes):
    steps = [c._row_steps()[x] for x in codes]
    assert c.search(steps, c.START, c.ENDS)[:2] == every_edit(codes)


def test_search_of_long_conversations_equals_forward_tables():
    rng = random.Random(5)
    for n in (7, 40, 400):
        codes = "".join(rng.choices(c.CODES, [1, 9, 9, 1, 0.3, 3, 3, 0.3, 0.2, 1, 1, 0.2], k=n))
        best = {c.START: (0, "")}
        for x in codes:
            after = {}
            for p, (cost, audit) in best.items():
                for more, label, t in c._row_steps()[x][p]:
                    after[t] = min(after.get(t, (1 << 50, "")), (cost + more, audit + label))
            best = after
        want = min((cost + c.ENDS[p][0], audit + c.ENDS[p][1]) for p, (cost, audit) in best.items())
        assert c.search([c._row_steps()[x] for x in codes], c.START, c.ENDS)[:2] == want


def make(conversations, seed, most=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", None, "robot"])
            text = rng.choice(["Yes.", "No!", "Why?", "so", " ", None, "Über. ", "a.  \n", f"{rng.random()}.", "x\x0b"])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, text))
    return rows


def test_damaged_conversations_against_brute_force(spark):
    rows = make(150, 1)
    assert result(spark, rows) == brute_damaged(rows)


def test_long_conversations_are_searched_in_slices(spark, monkeypatch):
    monkeypatch.setattr(c, "SLICE", 5)
    monkeypatch.setattr(c, "COPIES", 3)
    rows = [*make(25, 2, 60), *[(3, 7, "user", "Again.")] * 23, *[(None, None, None, None)] * 12, *[(None, 1, "assistant", "So.")] * 2]
    assert result(spark, rows) == brute_damaged(rows)


def test_a_third_of_all_rows_in_one_conversation(spark):
    rng = random.Random(8)
    rows = make(60, 3) + [(7, t, "user" if (t + (rng.random() < 0.2)) % 2 == 0 else "assistant", f"{t % 90}{rng.choice('.  ?')}") for t in range(3000)]
    assert result(spark, rows) == brute_damaged(rows)


def test_empty_table_odd_columns_and_text_ids(spark):
    assert result(spark, []) == {}
    rows = make(12, 4)
    frame = spark.createDataFrame([(str(a), b, r, t, 1, "x") for a, b, r, t in rows], "conv_id string, turn int, role string, text string, `n` int, `my col` string")
    want = brute_damaged([(str(a), *rest) for a, *rest in rows])
    assert shape(c.repair_damaged(frame.withColumn("a.b", frame["n"])).select(*COLUMNS).collect()) == want


def test_repaired_rows_are_legal_conversations(spark):
    rows = make(40, 6)
    done = c.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by = defaultdict(str)
    for r in done.rows.orderBy("conv_id", "slice", "at", "step").collect():
        by[r.conv_id] += r.role[0]
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in by.values())


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = shape(c.repair_damaged(table).select(*COLUMNS).collect())
    assert got == brute_damaged([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
