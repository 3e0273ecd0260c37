"""Run a registered query in Spark and its oracle text in DuckDB, compare.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of the values (rows sorted after columns are sorted by name).
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(round(v, 9)))
    if isinstance(v, (dt.date, dt.datetime)):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    return (5, repr(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    sdf = fn(spark, sf_dir)
    s_names = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_names = list(rel.columns)
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark={sorted(s_names)} duckdb={sorted(d_names)}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duckdb={len(d_rows)}")
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    if a != b:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        problems.append(f"values differ: spark-only={diff_a} duckdb-only={diff_b}")
    return problems
