"""Runs registered queries in Spark and their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf):
    """(ok, message) for one query."""
    start = time.time()
    df = query(spark, sf)
    mine = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return bool(mine), f"{len(mine)} rows, no SQL, {took:.1f}s", took
    start = time.time()
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    duck_took = time.time() - start
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}", took
    left, right = canonical_rows(df.columns, mine), canonical_rows(columns, theirs)
    if left != right:
        only_left = sorted(set(left) - set(right))[:3]
        only_right = sorted(set(right) - set(left))[:3]
        return False, f"{len(left)} vs {len(right)} rows; spark {only_left} sql {only_right}", took
    return True, f"{len(left)} rows equal, {took:.1f}s (sql {duck_took:.1f}s)", took


def main():
    from tillwork.plans import ORACLES, QUERIES
    from tillwork.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(QUERIES)
    spark, con = local_session(8), duck(sf)
    bad = []
    for name in names:
        try:
            ok, message, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} ok; failed: {bad}")


if __name__ == "__main__":
    main()
