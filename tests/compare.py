"""Run registered queries in Spark and their check statements in DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (value + 0.0)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b and type(a) is type(b)


def compare(spark, con, query, sf_dir: str) -> tuple[str, int, float]:
    """('' or what differs, number of Spark rows, seconds of the Spark run)."""
    started = time.perf_counter()
    df = query.spark(spark, sf_dir)
    spark_rows = df.collect()
    seconds = time.perf_counter() - started
    if query.sql is None:
        return "", len(spark_rows), seconds
    cur = con.execute(query.oracle())
    names = [d[0] for d in cur.description]
    other = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}", len(spark_rows), seconds
    left, right = rows_of(df.columns, spark_rows), rows_of(names, other)
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}", len(left), seconds
    for a, b in zip(left, right):
        if not all(close(x, y) for x, y in zip(a, b)):
            return f"first difference {sorted(df.columns)}\n  {a}\n  {b}", len(left), seconds
    return "", len(left), seconds


if __name__ == "__main__":
    from tidemill.plans.catalogue import QUERIES
    from tidemill.session import local_session

    sf = sys.argv[1]
    keys = sys.argv[2:] or list(QUERIES)
    session = local_session()
    connection = oracle_connection(sf)
    bad = 0
    for key in keys:
        try:
            problem, n, sec = compare(session, connection, QUERIES[key], sf)
        except Exception as error:  # report and go on with the next query
            problem, n, sec = f"{type(error).__name__}: {str(error)[:900]}", -1, 0.0
        bad += bool(problem)
        mark = "FAIL" if problem else ("rows" if QUERIES[key].sql is None else "ok")
        print(f"{mark:5} {key:28} {n:7} rows {sec:6.2f}s {problem}", flush=True)
    print("failures:", bad)
