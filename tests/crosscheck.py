"""Compare registered queries with their SQL on DuckDB.

    python tests/crosscheck.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def plain(v):
    """A comparable form that keeps int, float and text apart."""
    if v is None:
        return ("null",)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("null",) if math.isnan(v) else ("float", v)
    if isinstance(v, (list, tuple)):
        return ("list", tuple(plain(x) for x in v))
    return (type(v).__name__, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, name, fn, sql):
    """Return (verdict, rows, seconds)."""
    start = time.time()
    df = fn(spark, folder)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return "rows-only", len(got), took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), took
    a, b = rows_of(df.columns, [tuple(r) for r in got]), rows_of(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(got), took
    for x, y in zip(a, b):
        if x != y:
            return f"value {x} != {y}", len(got), took
    return "match", len(got), took


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").appName("siltgate-crosscheck")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    from __spark_entry__ import oracle_sql, queries

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark, con = session(), duck(folder)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in args.names or qs:
        try:
            verdict, n, took = compare(spark, con, folder, name, qs[name], sqls.get(name))
        except Exception as err:  # report and go on with the next query
            verdict, n, took = f"ERROR {str(err)[:600]}", 0, 0.0
        bad += verdict not in ("match", "rows-only")
        print(f"{name:28s} {n:7d} rows {took:6.2f}s  {verdict}", flush=True)
    print(f"{bad} problem(s)")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
