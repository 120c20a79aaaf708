"""Run registered queries against their SQL statements in DuckDB and compare the rows exactly.

    python tests/compare.py [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("null",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("float", v)
    return (type(v).__name__, v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(cell(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, name, fn, sql, folder) -> tuple[bool, str]:
    from tidemart.session import clear_scratch

    df = fn(spark, folder)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    clear_scratch(spark)
    if sql is None:
        return True, f"{len(got)} rows, no SQL"
    res = con.execute(sql)
    want_cols, want = [d[0] for d in res.description], res.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return False, f"columns {sorted(got_cols)} vs {sorted(want_cols)}"
    a, b = rows_of(got_cols, got), rows_of(want_cols, want)
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}; e.g. {sorted(set(a) - set(b), key=repr)[:2]} / {sorted(set(b) - set(a), key=repr)[:2]}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return False, f"{len(bad)} of {len(a)} rows differ, cols {sorted(got_cols)}; e.g. {bad[0]}"
    return True, f"{len(a)} rows" + (" EMPTY" if not a else "")


def main() -> int:
    from tidemart.session import get_session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf = "0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"{DATA}/sf{sf}"
    con = oracle(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, name, fn, sqls.get(name), folder)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        if not ok or "-q" not in args:
            print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failures")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main())
