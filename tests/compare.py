"""Run queries next to their oracle SQL and report differences.

    python tests/compare.py [sf_dir] [prefix …]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(sf: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(out, key=repr)


def family(name: str) -> str:
    name = name.lower()
    if name.startswith("decimal"):
        return "decimal"
    return {"string": "varchar", "timestamp_ntz": "timestamp", "integer": "int"}.get(name, name)


def compare(spark, con, fn, sql, sf) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    got_cols, got = rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = rows([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    described = {r[0]: family(r[1]) for r in con.execute("describe " + sql).fetchall()}
    spark_types = {f.name: family(f.dataType.simpleString()) for f in df.schema.fields}
    if described != spark_types:
        diff = {k: (spark_types[k], described[k]) for k in described if described[k] != spark_types[k]}
        return f"types (spark, oracle) {diff}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            diff = {c: (x, y) for c, x, y in zip(got_cols, a, b) if x != y}
            return f"first difference (spark, oracle) {diff} in {a}"
    return None


def main(argv):
    from ledgerlake.session import local_session

    import __spark_entry__ as entry

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session("compare", 8)
    con = oracle_connection(sf)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, fn, oracles[name], sf)
                status = "ok" if problem is None else "DIFF " + problem
            else:
                status = f"rows {fn(spark, sf).count()} (no oracle)"
        except Exception as exc:  # report and go on
            status = "ERROR " + str(exc).replace("\n", " ")[:900]
        bad += status.startswith(("DIFF", "ERROR"))
        print(f"{name:38s} {time.time() - start:6.2f}s {status[:1000]}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
