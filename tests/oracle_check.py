"""Run every query beside its SQL and compare rows: ``python tests/oracle_check.py [folder] [name ...]``."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def cell(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        f = float(v)
        return None if math.isnan(f) else round(f, 4) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(timespec="microseconds")
    if hasattr(v, "tolist"):
        return cell(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(cell(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr), sorted(columns)


def views(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(f)[:-8]
        con.execute(f"create view {name} as select * from read_parquet('{f}')")
    return con


def compare(spark, con, folder, name, query, sql):
    df = query(spark, folder)
    got, got_columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows only ({len(got)})" if got else "NO ROWS"
    cursor = con.execute(sql)
    want, want_columns = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"COLUMNS {got_columns} != {want_columns}"
    if got != want:
        extra = [r for r in got if r not in want][:2] if len(got) < 20000 else "?"
        lack = [r for r in want if r not in got][:2] if len(got) < 20000 else "?"
        return f"ROWS {len(got)} != {len(want)}; only spark {str(extra)[:600]}; only sql {str(lack)[:600]}"
    return f"ok ({len(got)})"


def main():
    import __spark_entry__ as entry
    from tests.conftest import new_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = new_session(), views(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            outcome = compare(spark, con, folder, name, query, sqls.get(name))
        except Exception as e:
            outcome = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        good = outcome.startswith(("ok", "rows only"))
        bad += not good
        print(f"{'  ' if good else '!!'} {name:32s} {time.time() - start:6.2f}s {outcome}", flush=True)
    print("failed:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
