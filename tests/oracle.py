"""Compare registered queries with their SQL on one scale folder."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, sql):
    """An error text, or None when names, rows and values agree."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{str(a)[:300]} != {str(b)[:300]}"
    return None


if __name__ == "__main__":
    from textloom.queries import QUERIES, SQL
    from textloom.session import local_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            error = compare(spark, con, sf_dir, QUERIES[name], SQL[name]) if name in SQL else (
                f"no SQL, {QUERIES[name](spark, sf_dir).count()} rows"
            )
        except Exception as e:  # report and go on with the next query
            error = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name:32s} {time.time() - start:6.1f}s {error or 'ok'}", flush=True)
