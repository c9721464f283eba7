"""Runs the named queries and their SQL counterparts and compares the results by value.

    python -m tests.oracle_check /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _table(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when both results agree, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    cursor = connection.execute(contract.oracle_sql()[name])
    want_names = [column[0] for column in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    got, want = _table(df.columns, got_rows), _table(want_names, want_rows)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for mine, other in zip(got, want):
        if mine != other:
            count = sum(a != b for a, b in zip(got, want))
            return f"{count} rows differ in {sorted(df.columns)}: {mine} != {other}"
    if not got:
        return "no rows on either side"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, *names = sys.argv[1:]
    connection = connect(sf_dir)
    failed = 0
    for name in names or contract.queries():
        started = time.time()
        try:
            if name in contract.oracle_sql():
                problem = compare(spark, connection, name, sf_dir)
            else:
                problem = None if contract.queries()[name](spark, sf_dir).collect() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
