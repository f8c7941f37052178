"""Compare every registered query with its oracle SQL; usable from pytest and by hand:

    python tests/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v if isinstance(v, int) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, folder):
    df = query(spark, folder)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"no oracle, {sum(got.values())} rows" if got else "EMPTY (no oracle)"
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"COLUMNS differ: {got_cols} / {want_cols}"
    if got != want:
        extra, lack = got - want, want - got
        return (
            f"ROWS differ: {sum(got.values())} / {sum(want.values())}, extra {list(extra.items())[:3]}, "
            f"missing {list(lack.items())[:3]}"
        )
    return f"ok, {sum(got.values())} rows" if got else "ok but EMPTY"


def main(argv):
    from resight.registry import ORACLES, QUERIES
    from resight.session import local_session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session(), connect(folder)
    bad, began = 0, time.time()
    for name in names:
        start = time.time()
        try:
            result = compare(spark, con, name, QUERIES[name], ORACLES.get(name), folder)
        except Exception as e:  # report and go on with the next query
            result = "ERROR " + " ".join(str(e).split())[:600]
        if not result.startswith(("ok", "no oracle")) or "EMPTY" in result:
            bad += 1
            print(f"{name}: {result} ({time.time() - start:.1f}s)", flush=True)
        else:
            print(f"{name}: {result} ({time.time() - start:.1f}s)", flush=True)
    print(f"{len(names)} queries, {bad} to look at, {time.time() - began:.0f}s")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
