"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf] [names...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import importlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return round(float(value), 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return len(got), None
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    problems = []
    if sorted(columns) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lacking = [r for r in want if r not in set(got)][:3]
        problems.append(f"values differ; only spark {extra}; only sql {lacking}")
    return len(got), problems


def main():
    from gaugeflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    entry = importlib.import_module("__spark_entry__")
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark, con = local_session(8), connect(sf_dir)
    failed = []
    for name in wanted or list(queries):
        start = time.time()
        try:
            n, problems = compare(spark, con, name, queries[name], oracle.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            n, problems = -1, [str(error).strip()[:900]]
        mark = "rows-only" if problems is None else ("ok" if not problems else "FAIL")
        print(f"{mark:9} {name:26} {n:8} rows {time.time() - start:6.2f}s", flush=True)
        if problems:
            failed.append(name)
            print("   ", "\n    ".join(problems), flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
