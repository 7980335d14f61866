"""Runs registered queries beside their SQL twins and compares the rows.

    python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows], key=repr)


def compare(spark, con, sf_dir, build, sql):
    """None when equal, else what differs."""
    df = build(spark, sf_dir)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    relation = con.sql(sql)
    want = rows_of(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    kinds = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    wrong = {c: (k, kinds[c]) for c, k in df.dtypes if SPARK_TO_SQL.get(k, k) != kinds[c]}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}: {got[:3]} vs {want[:3]}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(bad)} of {len(got)} rows differ ({sorted(df.columns)}): {bad[:3]}"
    return "empty on both sides" if not got else None


def main() -> int:
    import __spark_entry__ as entry
    from ebbtide.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed, done = entry.oracle_sql(), 0, 0
    for name, build in entry.queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        began = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, build, oracles[name])
            else:
                problem = None if build(spark, sf_dir).count() else "no rows"
        except Exception:
            problem = traceback.format_exc(limit=3)[-1500:]
        done += 1
        failed += problem is not None
        kind = "" if name in oracles else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{kind} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{done - failed} of {done} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
