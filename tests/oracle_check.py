"""Compares the registered queries with their SQL twins.

    python tests/oracle_check.py <table folder> [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """One spelling per value, whichever engine it comes from."""
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value == int(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.sql(f"create view {name} as select * from '{path}'")
    return connection


def differences(spark_df, connection, sql) -> str:
    """Empty when both results are equal."""
    result = connection.sql(sql)
    want_names, want = normal(result.columns, result.fetchall())
    got_names, got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want_names != got_names:
        return f"columns: only Spark {set(got_names) - set(want_names)}, only SQL {set(want_names) - set(got_names)}"
    if len(want) != len(got):
        return f"rows: Spark {len(got)}, SQL {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        g, w = wrong[0]
        cells = [(n, a, b) for n, a, b in zip(got_names, g, w) if a != b]
        return f"{len(wrong)} of {len(got)} rows differ, e.g. {cells[:4]}"
    return ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:]
    db, statements, bad = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problem = differences(query(session, folder), db, statements[name])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name:34s} {time.time() - start:5.1f}s {problem}", flush=True)
    print(f"{bad} bad")
