"""Run registered queries next to their SQL: ``python tests/oracle_check.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


SPARK_SECONDS: dict[str, float] = {}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def differences(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when both results agree, else what differs."""
    start = time.time()
    frame = entry_points.queries()[name](spark, sf_dir)
    got = as_rows(frame.columns, [tuple(r) for r in frame.collect()])
    SPARK_SECONDS[name] = time.time() - start
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return None if got[1] else "no rows"
    result = connection.execute(sql)
    want = as_rows([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    unequal = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(unequal)} rows differ, first: {unequal[0]}" if unequal else None


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in names or entry_points.queries():
        start = time.time()
        try:
            problem = differences(spark, connection, name, sf_dir)
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        print(f"{name:24s} {SPARK_SECONDS.get(name, 0):6.1f}s of {time.time() - start:6.1f}s {'ok' if problem is None else problem[:2500]}", flush=True)


if __name__ == "__main__":
    main()
