"""Repair of conversation structure by depth-first branch-and-bound.

A repaired conversation reads ``(system? (user assistant)+)?``. Every row is kept (0), given the role user or assistant (1) or
deleted (2, the only choice for blank rows and repeats); an empty row of user or assistant may be inserted anywhere (5); a row that ends
without ``.``, ``!`` or ``?`` costs 5 more unless it is deleted. The cheapest edits win; of several the one whose audit (initials of
Delete, Insert, Keep, Rerole in order) is least in ASCII.

The search keeps an explicit stack, suffix lower bounds (of a relaxation in which the place in the pattern may change for nothing at
a few rows), an incumbent (cost, audit), and per node (row, place in the pattern) a dominance table that cuts worse prefixes; it ends when
nothing open can beat the incumbent. Conversations above ``SLICE`` rows are searched slice by slice, from each place to each place, and a
second search of the same kind picks the places between the slices, so no conversation is one task's text or rows: the second search
sees 16 costs per ``SLICE`` rows. Only one letter per row reaches Python, never a text.

Defined cases: a null role or text is one space; a null conv_id is a conversation of its own, a null turn comes first; rows of a turn are
taken by role, then by the SHA-256 of role and text; equal rows of a turn count as often as they stand. An empty role has no
initial and fits nowhere. Other columns are ignored. An empty table gives empty results.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored
from tidemart.operators.scan import Scan, ordered_scan

SLICE = 256
# The relaxation lets the place change at every so many rows, but at three of them at most: what the bound lacks then does not grow with the length.
RELAXED = 16
COPIES = 65_536
BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5

# Places in the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
# One letter per row: its initial (o: any other), first sound, then cut off, then blank or repeated.
CODES = "suaoSUAO1234"
# What is inserted after the last row: cost, edits.
ENDS = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}
ENDLESS = 1 << 60


def _next_role(place: int) -> str:
    return "a" if place == USER else "u"


def _options(code: str, place: int) -> tuple:
    """(cost, edits, place after) of one row with what is inserted before it; per place the best one."""
    kind, initial = divmod(CODES.index(code), 4)
    initial = "suao"[initial]
    best: dict[int, tuple[int, str]] = {}
    before = ""
    while len(before) < 3:  # two inserts reach every place
        paid = INSERT * len(before)
        found = [(DELETE, "D", place)]
        if kind < 2:
            more = CUT_OFF if kind else 0
            if (place, initial) in STEP:
                found.append((more, "K", STEP[place, initial]))
            found.append((more + REROLE, "R", STEP[place, _next_role(place)]))
        for cost, edit, after in found:
            best[after] = min(best.get(after, (ENDLESS, "")), (paid + cost, before + edit))
        before, place = before + "I", STEP[place, _next_role(place)]
    return tuple((cost, edits, after) for after, (cost, edits) in best.items())


@functools.cache
def _row_steps() -> dict[str, tuple]:
    return {code: tuple(_options(code, place) for place in range(4)) for code in CODES}


def search(steps: list, entry: int, ends: dict[int, tuple[int, str]]) -> tuple[int, str, int] | None:
    """The cheapest way through ``steps`` from a place to one of ``ends``, its audit (the least of several) and its end.

    ``steps[i][place]`` lists (cost, label, place after); no label of a step is the start of another one, so audits compare label by label.
    """
    n = len(steps)
    free = max(RELAXED, -(-n // 4))
    bounds = [[ends[p][0] if p in ends else ENDLESS for p in range(4)]]
    for i in range(n - 1, -1, -1):
        after = bounds[-1]
        if (n - i) % free == 0:
            after = [min(after)] * 4
        bounds.append([min([c + after[t] for c, _, t in options], default=ENDLESS) for options in steps[i]])
    bounds.reverse()
    best, best_audit, best_end = ENDLESS, "", None
    reached: list[list] = [[None] * 4 for _ in range(n + 1)]
    stack = [(0, entry, 0, "")]
    while stack:
        i, place, cost, audit = stack.pop()
        least = cost + bounds[i][place]
        if least >= ENDLESS or least > best or (least == best and audit > best_audit[: len(audit)]):
            continue
        known = reached[i][place]
        if known is not None and known <= (cost, audit):
            continue
        reached[i][place] = (cost, audit)
        if i == n:
            more, tail = ends[place]
            if best_end is None or (cost + more, audit + tail) < (best, best_audit):
                best, best_audit, best_end = cost + more, audit + tail, place
            continue
        onward = [(c + bounds[i + 1][t], label, c, t) for c, label, t in steps[i][place]]
        for _, label, c, t in sorted(onward, reverse=True):
            stack.append((i + 1, t, cost + c, audit + label))
    return None if best_end is None else (best, best_audit, best_end)


def replay(codes: str, entry: int, audit: str) -> tuple[list[str], list[str]]:
    """Edits and roles (k: its own) of each row; what is inserted after the last row stands with it."""
    edits, roles, place, row = [""] * len(codes), [""] * len(codes), entry, 0
    for edit in audit:
        at = min(row, len(codes) - 1)
        edits[at] += edit
        if edit == "D":
            roles[at] += "-"
        elif edit == "K":
            roles[at] += "k"
            place = STEP[place, "suao"[CODES.index(codes[row]) % 4]]
        else:
            roles[at] += _next_role(place)
            place = STEP[place, _next_role(place)]
        row += edit != "I"
    return edits, roles


def illegal_pairs(codes: str) -> int:
    """Adjacent rows whose initials are not su, ua or au."""
    initials = ["suao"[CODES.index(c) % 4] for c in codes]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


@functools.lru_cache(4096)
def ways(codes: str, lone: bool) -> tuple:
    """(entry, exit, cost, rank of the audit in ASCII, edits and roles by row) of a slice; of a whole conversation the one repair."""
    steps = [_row_steps()[c] for c in codes]
    if lone:
        found = {(START, ASSISTANT): search(steps, START, ENDS)}
    else:
        found = {(a, b): search(steps, a, {b: (0, "")}) for a in range(4) for b in range(4)}
    found = {k: v for k, v in found.items() if v is not None}
    ranks = {audit: i for i, audit in enumerate(sorted({v[1] for v in found.values()}))}
    out = []
    for (a, b), (cost, audit, _) in found.items():
        edits, roles = replay(codes, a, audit)
        out.append((a, b, cost, ranks[audit], ",".join(edits), ",".join(roles)))
    return tuple(out)


def _solve(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    names = ("entry", "exit", "cost", "rank", "edits", "roles")
    for batch in batches:
        codes, lone = batch.column("codes").to_pylist(), batch.column("lone").to_pylist()
        solved = [[dict(zip(names, w, strict=True)) for w in ways(c, x)] for c, x in zip(codes, lone, strict=True)]
        columns = [batch.column("conv_id"), batch.column("slice"), batch.column("lone"), batch.column("codes"), pa.array(solved, schema.field("ways").type)]
        columns.append(pa.array([illegal_pairs(c) for c in codes], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _connect(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """The places between the slices of one long conversation."""
    rows = sorted(table.select(["slice", "ends", "ways"]).to_pylist(), key=lambda r: r["slice"])
    steps = []
    for r in rows:
        options: list[list] = [[], [], [], []]
        for w in r["ways"]:
            options[w["entry"]].append((w["cost"], chr(w["rank"] + 1), w["exit"]))
        steps.append(options)
    # Ranks tell the ways from one place apart; what is inserted at the very end is settled by the places.
    _, audit, end = search(steps, START, {p: (cost, "") for p, (cost, _) in ENDS.items()})
    out, place = [], START
    for i, (r, mark) in enumerate(zip(rows, audit, strict=True)):
        after = next(t for _, label, t in steps[i][place] if label == mark and (i + 1 < len(rows) or t == end))
        joint = int(i > 0 and rows[i - 1]["ends"][1] + r["ends"][0] not in ("su", "ua", "au"))
        out.append((r["slice"], place, after, joint, ENDS[end][1] if i + 1 == len(rows) else ""))
        place = after
    columns = [table.column("conv_id").combine_chunks().take(pa.array([0] * len(out))), *[pa.array(c) for c in zip(*out, strict=True)]]
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the lines of each conversation; lines come in order, so one running digest is all that is held."""
    now, digest = None, None

    def row(key):
        return pa.RecordBatch.from_arrays([pa.array([key], schema.field(0).type), pa.array([digest.hexdigest()])], schema=schema)

    for batch in batches:
        for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest is None or key != now:
                if digest is not None:
                    yield row(now)
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line)
    if digest is not None:
        yield row(now)


def _same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    on = [left[k].eqNullSafe(right[k]) for k in keys]
    return functools.reduce(lambda a, b: a & b, on)


def _arrow(df: DataFrame, name: str) -> pa.Field:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.field(name, to_arrow_type(df.schema[name].dataType))


@dataclass(frozen=True)
class Repair:
    """``report``: one row per conversation. ``rows``: the repaired rows; in a conversation slice, at, step give their order."""

    report: DataFrame
    rows: DataFrame


def repair(rows: DataFrame) -> Repair:
    """Faults and cheapest repair of the conversations in ``conv_id, turn, role, text``.

    report: conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit. rows: conv_id, slice, at, step, turn, edit, role, text; an
    inserted row has the turn of the row it stands by.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    clean = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    counted = clean.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    mark = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    base = stored(counted.withColumn("mark", mark), "conversations")

    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    light = base.select(
        "conv_id", "turn", "role", "mark", "n", (F.length(bare) == 0).alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
    )
    first = light.groupBy("conv_id", "mark").agg(F.min(F.struct("turn")).alias("first"))
    seen = light.join(first, _same(light, first, "conv_id", "mark")).select(light["*"], (~first["first"]["turn"].eqNullSafe(light["turn"])).alias("again"))
    kind = F.when(F.col("blank") | F.col("again"), "must").when(F.col("cut"), "cut").otherwise("sound")
    coded = seen.select("conv_id", "turn", "role", "mark", "n", "initial", kind.alias("kind"), "blank", "again")
    placed = stored(ordered_scan(coded, ["conv_id"], ["turn", "role", "mark"], [Scan("upto", "sum", "n")]), "conversation-rows")

    n = F.col("n")
    repeats = F.when(F.col("blank"), F.lit(0)).otherwise(n - F.when(F.col("again"), 0).otherwise(1))
    gaps = F.when(F.count("turn") > 0, F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).otherwise(0)
    counts = placed.groupBy("conv_id").agg(
        F.sum(n).alias("n_rows"), gaps.cast("long").alias("gaps"), F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(repeats).alias("duplicate"), F.sum(F.when(F.col("kind") == "cut", 1).otherwise(0)).cast("long").alias("truncated"),
    )

    # A row of n copies takes n places; the first may be sound, the others repeat it.
    ones = lambda c: F.sequence(c, F.least(c + (COPIES - 1), n))
    copies = placed.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), n, F.lit(COPIES).cast("long"))))
    copies = copies.withColumn("copy", F.explode(ones(F.col("from"))))
    place = F.col("upto") - n + F.col("copy") - 1
    at_kind = F.when((F.col("copy") > 1) | (F.col("kind") == "must"), 8).when(F.col("kind") == "cut", 4).otherwise(0)
    code = F.substring(F.lit(CODES), at_kind + F.instr(F.lit("suao"), F.col("initial")), F.lit(1))
    spread = copies.select(
        "conv_id", F.floor(place / SLICE).cast("long").alias("slice"), (place % SLICE).cast("int").alias("at"), "turn", "mark", code.alias("code")
    )
    letters = F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"])
    strings = spread.groupBy("conv_id", "slice").agg(F.array_join(letters, "").alias("codes"))
    sliced = strings.join(counts, _same(strings, counts, "conv_id")).select(strings["*"], (F.col("n_rows") <= SLICE).alias("lone"))

    way = "array<struct<entry:int,exit:int,cost:bigint,rank:int,edits:string,roles:string>>"
    key = _arrow(base, "conv_id")
    one = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("edits", pa.string()), ("roles", pa.string())])
    solved_schema = pa.schema([key, ("slice", pa.int64()), ("lone", pa.bool_()), ("codes", pa.string()), ("ways", pa.list_(one)), ("illegal", pa.int64())])
    to = sliced.select("conv_id", "slice", "lone", "codes").schema.add("ways", _type(way)).add("illegal", "long")
    solved = stored(sliced.mapInArrow(lambda batches: _solve(batches, solved_schema), to), "conversation-slices")

    whole = solved.where("lone").select("conv_id", "slice", F.col("ways")[0].alias("way"), "illegal", F.lit("").alias("tail"))
    ends = F.array(*[F.translate(f("codes", F.lit(1)), CODES, "suao" * 3) for f in (F.left, F.right)])
    costs = F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["exit"].alias("exit"), w["cost"].alias("cost"), w["rank"].alias("rank")))
    long = solved.where("NOT lone").select("conv_id", "slice", ends.alias("ends"), costs.alias("ways"))
    joint_schema = pa.schema([key, ("slice", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("joint", pa.int64()), ("tail", pa.string())])
    joint_to = long.select("conv_id", "slice").schema.add("entry", "integer").add("exit", "integer").add("joint", "long").add("tail", "string")
    joints = long.groupBy("conv_id").applyInArrow(lambda table: _connect(table, joint_schema), joint_to)
    parts = solved.where("NOT lone")
    picked = F.filter(parts["ways"], lambda w: (w["entry"] == joints["entry"]) & (w["exit"] == joints["exit"]))[0]
    connected = parts.join(joints, _same(parts, joints, "conv_id", "slice")).select(
        parts["conv_id"], parts["slice"], picked.alias("way"), (F.col("illegal") + F.col("joint")).alias("illegal"), "tail"
    )
    chosen = stored(whole.unionByName(connected), "conversation-repairs")
    edits = F.concat("way.edits", "tail")
    # What is inserted at the very end of a long conversation reads (user) assistant.
    roles = F.concat("way.roles", F.when(F.col("tail") == "II", "ua").when(F.col("tail") == "I", "a").otherwise(""))

    audit = F.transform(F.sort_array(F.collect_list(F.struct("slice", F.replace(edits, F.lit(",")).alias("part")))), lambda x: x["part"])
    summed = chosen.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum(F.col("way.cost") + INSERT * F.length("tail")).alias("cost"), F.array_join(audit, "").alias("audit")
    )
    report = counts.join(summed, _same(counts, summed, "conv_id")).select(counts["*"], "illegal", "cost", "audit")

    by_row = F.explode(F.arrays_zip(F.split(edits, ",").alias("edits"), F.split(roles, ",").alias("roles"), F.sequence(F.lit(0), F.size(F.split(edits, ",")) - 1).alias("at")))
    done = chosen.select("conv_id", "slice", by_row.alias("r")).where("r.edits <> 'D'").select("conv_id", "slice", "r.*")
    lines = done.join(spread, _same(done, spread, "conv_id", "slice", "at")).select(done["*"], spread["turn"], spread["mark"])
    texts = lines.join(base, _same(lines, base, "conv_id", "turn", "mark")).select(lines["*"], base["role"], base["text"])
    step = F.explode(F.transform(F.sequence(F.lit(1), F.length("edits")), lambda k: F.struct(
        k.alias("step"), F.substring("edits", k, F.lit(1)).alias("edit"), F.substring("roles", k, F.lit(1)).alias("to"))))
    made = texts.withColumn("s", step).where("s.edit <> 'D'")
    new_role = F.when(F.col("s.to") == "k", F.col("role")).when(F.col("s.to") == "u", "user").otherwise("assistant")
    new_text = F.when(F.col("s.edit") == "I", "").otherwise(F.col("text"))
    out = made.select("conv_id", "slice", "at", "s.step", "turn", "s.edit", new_role.alias("role"), new_text.alias("text"))
    return Repair(report, out)


def _type(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(f"x {ddl}")["x"].dataType


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 over the ``role:text`` lines of repaired rows, streamed in order; a conversation is never held."""
    key = _arrow(rows, "conv_id")
    schema = pa.schema([key, ("repaired_sha256", pa.string())])
    # The lines leave the sort with their keys, so nothing else is carried to Python.
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "at", "step").select("conv_id", F.concat_ws(":", "role", "text").cast("binary").alias("line"))
    return ordered.mapInArrow(lambda batches: _digests(batches, schema), rows.select("conv_id").schema.add("repaired_sha256", "string"))


def damage(rows: DataFrame) -> DataFrame:
    """Planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes out ``. ! ?``, 3 repeats it, 4 makes it the user's."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.encode(F.concat_ws(":", *named), "UTF-8")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return hit.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def repair_damaged(rows: DataFrame) -> DataFrame:
    """Every conversation of ``rows`` after ``damage`` and ``repair``: one row of counts, cost, audit and digest."""
    done = repair(damage(rows))
    hashed, report = digests(done.rows), done.report
    ids = rows.select("conv_id").distinct()
    zero = lambda c: F.coalesce(report[c], F.lit(0).cast("long")).alias(c)
    told = ids.join(report, _same(ids, report, "conv_id"), "left").select(
        ids["conv_id"], *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit")
    )
    nothing = hashlib.sha256().hexdigest()
    return told.join(hashed, _same(told, hashed, "conv_id"), "left").select(told["*"], F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
