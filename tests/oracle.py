"""Run registered queries beside their SQL and compare strictly.

    python -m tests.oracle [--sf DIR] [--explain] [name-regex ...]
"""

from __future__ import annotations

import math
import os
import re
import sys
import time
from datetime import datetime

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SIMPLE = {"BIGINT", "DOUBLE", "VARCHAR", "BOOLEAN", "TIMESTAMP"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, datetime):
        return x.isoformat()
    return repr(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(df, sql, con):
    """List of differences; empty when equal."""
    got = df.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"], len(got)
    odd = {n: k for n, k in kinds.items() if k not in SIMPLE}
    if odd:
        problems.append(f"sql types {odd}")
    spark_kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    mismatch = {n: (t, kinds[n]) for n, t in df.dtypes if spark_kinds.get(t) != kinds[n]}
    if mismatch:
        problems.append(f"types {mismatch}")
    a, b = _rows(df.columns, got), _rows(names, want)
    if a != b:
        extra = sorted(set(a) - set(b))[:3]
        missing = sorted(set(b) - set(a))[:3]
        problems.append(f"rows {len(a)} vs {len(b)}\n   only spark {extra}\n   only sql   {missing}\n   order {sorted(names)}")
    return problems, len(got)


def main(argv):
    import __spark_entry__ as entry
    from millrace.sources.session import local_session

    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i : i + 2]
    explain = "--explain" in argv
    patterns = [a for a in argv if not a.startswith("--")]
    spark = local_session(8)
    con = connect(sf)
    sqls = entry.oracle_sql()
    bad = []
    for name, build in entry.queries().items():
        if patterns and not any(re.search(p, name) for p in patterns):
            continue
        t0 = time.time()
        try:
            df = build(spark, sf)
            if explain:
                df.explain("formatted")
            if name in sqls:
                problems, n = compare(df, sqls[name], con)
            else:
                problems, n = [], df.count()
        except Exception as e:
            problems, n = [f"{type(e).__name__}: {str(e)[:1500]}"], -1
        mark = "ok  " if not problems else "FAIL"
        note = "" if name in sqls else " (no sql)"
        print(f"{mark} {name} rows={n} {time.time() - t0:.2f}s{note}" + (" EMPTY" if n == 0 else ""), flush=True)
        for p in problems:
            print("   ", p, flush=True)
        if problems:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    sys.path.insert(0, os.getcwd())
    main(sys.argv[1:])
