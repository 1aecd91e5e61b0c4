"""Run a Spark query and its DuckDB oracle on the same parquet tables and compare.

Mirrors the driver's check: same column names, same row count, same multiset
of rows (columns sorted by name; doubles rounded to 6 places).
"""

from __future__ import annotations

import datetime as _dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 6) + 0.0))
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, _dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    if isinstance(v, dict):
        return (5, repr(sorted((k, _norm(x)) for k, x in v.items())))
    return (6, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(columns)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    s_norm, s_sorted = rows_of(s_cols, s_rows)
    d_norm, d_sorted = rows_of(d_cols, d_rows)
    problems = []
    if s_sorted != d_sorted:
        problems.append(f"columns differ: spark={s_sorted} oracle={d_sorted}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} oracle={len(d_rows)}")
    if not problems:
        a, b = sorted(s_norm), sorted(d_norm)
        if a != b:
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            problems.append(f"values differ; spark-only {diff_a} oracle-only {diff_b}")
    return problems, len(s_rows)
