"""Compare registered queries with their DuckDB statements: ``python -m tests.compare [sf] [name...]``."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from workload.views import TABLES  # noqa: E402


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value) if value is not None else "\0"


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def duckdb_tables(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark_df, con, sql):
    """None when both results have the same columns and rows, else a description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = sorted_rows(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = sorted_rows(spark_df.columns, spark_df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for got, want in zip(actual, expected, strict=True):
        if got != want:
            cells = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
            return f"first differing row: {cells[:4]}"[:1500]
    return None


def main(sf="0.01", *names):
    from tests.session import local_session

    from __spark_entry__ import oracle_sql, queries

    spark = local_session()
    sf_dir = f"/root/testdata/sf{sf}"
    con = duckdb_tables(sf_dir)
    oracles = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name not in oracles:
                outcome = f"rows only: {run(spark, sf_dir).count()}"
            else:
                outcome = difference(run(spark, sf_dir), con, oracles[name]) or "same"
        except Exception as error:  # noqa: BLE001 - report every query
            outcome = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - start:6.1f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
