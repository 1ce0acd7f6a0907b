"""Compare registered queries with their SQL counterparts: ``python tests/oracle_check.py DIR``."""

from __future__ import annotations

import datetime
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def compare(spark, connection, query, sql: str, folder: str) -> tuple[int, str]:
    """(rows, problem); the problem is empty when rows and columns agree exactly."""
    ours = query(spark, folder)
    theirs = connection.sql(sql)
    if sorted(ours.columns) != sorted(theirs.columns):
        return 0, f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    names = sorted(ours.columns)
    theirs = theirs.project(", ".join(f'"{n}"' for n in names))
    kinds = [_kind(str(t)) for t in theirs.types]
    our_kinds = [_kind(ours.schema[n].dataType.simpleString()) for n in names]
    if kinds != our_kinds:
        return 0, f"types {list(zip(names, our_kinds, kinds))}"
    got = Counter(tuple(map(_plain, row)) for row in ours.select(*names).collect())
    expected = Counter(tuple(map(_plain, row)) for row in theirs.fetchall())
    rows = sum(got.values())
    if got == expected:
        return rows, ""
    extra, missing = got - expected, expected - got
    return rows, (
        f"{extra.total()} extra {list(extra)[:3]}, {missing.total()} missing {list(missing)[:3]}"
    )


def _kind(name: str) -> str:
    name = name.lower()
    return {"varchar": "string", "integer": "int", "timestamp_ntz": "timestamp"}.get(name, name)


def main(folder: str, *only: str) -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = contract.oracle_sql()
    failures = 0
    for name, query in contract.queries().items():
        if name not in oracles or (only and name not in only):
            continue
        start = time.time()
        try:
            rows, problem = compare(spark, connection, query, oracles[name], folder)
        except Exception as error:  # report and go on with the next query
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        failures += bool(problem)
        state, took = "FAIL" if problem else "ok  ", time.time() - start
        print(f"{state} {name} {rows} rows {took:.1f}s {problem}")
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
