"""Run a registered query in Spark and its SQL in DuckDB and compare the rows.

    python tests/compare.py [folder] [name prefix ...]
"""

import datetime
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, datetime.datetime) and value.tzinfo is None:
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, build, sql):
    """Return (equal, note, Spark rows)."""
    df = build(spark, folder)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, "rows only", len(got)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_cols, want = rows_of(names, cursor.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}", len(got)
    if got != want:
        extra = sorted(set(got) - set(want))[:3]
        lacking = sorted(set(want) - set(got))[:3]
        return False, f"{len(got)} rows against {len(want)}\n  spark only {extra}\n  sql only   {lacking}", len(got)
    return True, "equal", len(got)


def main():
    from skyloom.plans.suite import ORACLES, QUERIES
    from skyloom.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = get_session("local[8]")
    con = duck(folder)
    bad = 0
    for name, build in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            ok, note, n = compare(spark, con, folder, name, build, ORACLES.get(name))
        except Exception as exc:  # report and go on to the next query
            ok, note, n = False, f"{type(exc).__name__}: {str(exc)[:900]}", 0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {n:8d} rows {time.time() - start:6.2f} s  {note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
