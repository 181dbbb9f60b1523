"""Run registered queries next to their SQL twins and compare the rows.

    python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from leadframe.plans import QUERIES, TWINS
from leadframe.plans.fixtures import TABLES
from leadframe.session import build_session


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str):
    """(agrees, message, seconds)"""
    began = time.time()
    df = QUERIES[name](spark, sf_dir)
    mine = canonical(df.columns, df.collect())
    spent = time.time() - began
    if name not in TWINS:
        return len(mine[1]) > 0, f"{len(mine[1])} rows, no twin", spent
    result = con.execute(TWINS[name])
    theirs = canonical([c[0] for c in result.description], result.fetchall())
    if mine == theirs:
        return True, f"{len(mine[1])} rows", spent
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} / {theirs[0]}", spent
    a, b = set(mine[1]), set(theirs[1])
    show = lambda rows: [tuple(v[:160] for v in r) for r in sorted(rows)[:3]]
    return False, f"rows {len(mine[1])} / {len(theirs[1])}\n   mine  {show(a - b)}\n   twin  {show(b - a)}", spent


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    names = argv[1:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        try:
            ok, message, spent = compare(spark, con, sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            ok, message, spent = False, f"{type(exc).__name__}: {str(exc)[:700]}", 0.0
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {spent:6.2f}s {message}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
