"""Runs queries on Spark and their SQL on DuckDB and compares the rows.

As a program: ``python tests/compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def compare(columns, spark_rows, sql_columns, sql_rows) -> str | None:
    """None if both hold the same rows, else what differs."""
    if sorted(columns) != sorted(sql_columns):
        return f"columns {sorted(columns)} against {sorted(sql_columns)}"
    order = sorted(columns)
    left = sorted(
        (tuple(_plain(r[columns.index(c)]) for c in order) for r in spark_rows), key=_key
    )
    right = sorted(
        (tuple(_plain(r[sql_columns.index(c)]) for c in order) for r in sql_rows), key=_key
    )
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            wrong = [(c, x, y) for c, x, y in zip(order, a, b) if x != y]
            return f"{wrong[:3]} in {str(a)[:300]}"
    return None


def check(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[str | None, int, float, float]:
    begin = time.time()
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spent = time.time() - begin
    if sql is None:
        return None, len(rows), spent, 0.0
    begin = time.time()
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    sql_types = {d[0]: SPARK_TYPE.get(str(d[1]), str(d[1])) for d in result.description}
    sql_rows = result.fetchall()
    problem = compare(df.columns, rows, sql_columns, sql_rows)
    if problem is None and dict(df.dtypes) != sql_types:
        problem = f"types {[(n, t, sql_types[n]) for n, t in df.dtypes if t != sql_types[n]]}"
    return problem, len(rows), spent, time.time() - begin


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tickertide.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = local_session(8)
    connection = connect(folder)
    sqls = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            problem, n, took, sql_took = check(session, connection, folder, name, build, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            problem, n, took, sql_took = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0, 0.0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} rows={n} spark={took:.1f}s sql={sql_took:.1f}s "
              f"{'' if name in sqls else '(no sql) '}{problem or ''}", flush=True)
    print("failed", failed)
