"""Runs registered queries and their SQL statements side by side and compares the rows."""

from __future__ import annotations

import math
import time
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, plan, sql: str) -> tuple[bool, bool, str]:
    """(rows equal to 12 digits, rows equal bit for bit, explanation)."""
    started = time.time()
    df = plan(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    spark_seconds = time.time() - started
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    note = f"{len(spark_rows)} rows, spark {spark_seconds:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, False, f"columns {sorted(df.columns)} <> {sorted(names)}"
    ours, theirs = _bag(df.columns, spark_rows), _bag(names, sql_rows)
    if ours != theirs:
        left = list((ours - theirs).items())[:2]
        right = list((theirs - ours).items())[:2]
        return False, False, f"{note}; {len(sql_rows)} in SQL; only spark {left}; only sql {right}"
    exact = Counter(
        tuple(r[i] for i in sorted(range(len(names)), key=lambda i: df.columns[i]))
        for r in spark_rows
    ) == Counter(
        tuple(r[i] for i in sorted(range(len(names)), key=lambda i: names[i])) for r in sql_rows
    )
    return True, exact, note
