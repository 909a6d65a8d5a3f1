"""Run a named query in Spark and its SQL in DuckDB, and compare the rows.

Used by the tests, and by hand: ``python -m tests.oracle [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.12g}"))
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def exact_form(value):
    """As strict as a hash of the values: no tolerance for doubles."""
    if isinstance(value, decimal.Decimal):
        return "decimal " + str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(names, rows, form):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(str(form(row[at])) for at in order) for row in rows)


def compare(spark, connection, name, folder):
    """(problem or None, remark, rows, Spark seconds)"""
    import __spark_entry__ as entry

    started = time.time()
    df = entry.queries()[name](spark, folder)
    got = [tuple(row) for row in df.collect()]
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return (None if got else "no rows"), "rows only", len(got), took
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", "", len(got), took
    if len(got) != len(want):
        return f"{len(got)} rows, oracle {len(want)}", "", len(got), took
    if not got:
        return "empty result", "", 0, took
    ours, theirs = rows_of(df.columns, got, canonical), rows_of(names, want, canonical)
    if ours != theirs:
        first = next((pair for pair in zip(ours, theirs) if pair[0] != pair[1]))
        off = sum(pair[0] != pair[1] for pair in zip(ours, theirs))
        return f"{off} rows differ, first {first[0]} != {first[1]}", "", len(got), took
    strict = rows_of(df.columns, got, exact_form) == rows_of(names, want, exact_form)
    return None, "" if strict else "equal to 12 digits", len(got), took


def test_session():
    from kerbside.session import build_session

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("check", f"local[{cpus}]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and glob.glob(f"{arguments[0]}/*.parquet") else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    names = arguments or list(entry.queries())
    spark, connection = test_session(), duck(folder)
    failed = []
    for name in names:
        try:
            problem, remark, rows, took = compare(spark, connection, name, folder)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem, remark, rows, took = f"{type(error).__name__}: {str(error)[:600]}", "", 0, 0.0
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name:22} {rows:8} rows {took:6.2f} s  {problem or remark}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} good; failed: {failed}")
    spark.stop()


if __name__ == "__main__":
    main()
