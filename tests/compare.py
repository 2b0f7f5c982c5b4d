"""Runs queries on Spark and their SQL on DuckDB and compares all rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return ("b", bool(value))
    if isinstance(value, float):
        return ("f", repr(value + 0.0))
    if isinstance(value, int):
        return ("i", value)
    return ("s", str(value))


def differences(spark_rows, spark_columns, sql_rows, sql_columns) -> str | None:
    """None when both sides hold the same rows, in any order."""
    if sorted(spark_columns) != sorted(sql_columns):
        return f"columns {sorted(spark_columns)} vs {sorted(sql_columns)}"
    order = sorted(spark_columns)
    left = [tuple(cell(r[spark_columns.index(c)]) for c in order) for r in spark_rows]
    right = [tuple(cell(r[sql_columns.index(c)]) for c in order) for r in sql_rows]
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}; only left {list(set(left) - set(right))[:2]}; only right {list(set(right) - set(left))[:2]}"
    a, b = sorted(left, key=repr), sorted(right, key=repr)
    if a != b:
        first = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return f"{order}: {first}"
    return None


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> str | None:
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    return differences(rows, df.columns, result.fetchall(), [d[0] for d in result.description])


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from crossfoot.runtime import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    session = build_session("compare", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    connection = connect(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name not in sqls:
                print(f"NOSQL {name} {query(session, sf_dir).count()} rows", flush=True)
                continue
            problem = compare(session, connection, sf_dir, name, query, sqls[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
