"""Run catalogued queries against their SQL twins: python tests/compare.py SF_DIR [prefix…]"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return "∅" if v is None else str(v)


def rows_of(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def connect(folder):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, name, fn, text):
    df = fn(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(text)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got == want:
        return None
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    only_a, only_b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return (f"rows {len(got[1])}/{len(want[1])} spark-only {len(only_a)} sql-only {len(only_b)}\n   S {sorted(only_a)[:2]}"
            f"\n   D {sorted(only_b)[:2]}")


def main():
    import __spark_entry__ as entry
    from rootloom.session import build_session
    folder, prefixes = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, "8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, texts, bad = connect(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if name not in texts or (prefixes and not any(name.startswith(p) for p in prefixes)):
            continue
        started = time.time()
        try:
            problem = compare(spark, con, folder, name, fn, texts[name])
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:500]}"
        bad += problem is not None
        print(f"{'OK  ' if problem is None else 'BAD '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main()
