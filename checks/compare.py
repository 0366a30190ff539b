"""Run registered queries beside their SQL and compare rows: `python -m checks.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .oracle import SQL
from .queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _table(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str | None:
    """None when both sides give the same rows, else a short account."""
    frame = QUERIES[name](spark, sf_dir)
    columns, rows = _table(frame.columns, frame.collect())
    found = connection.execute(SQL[name])
    wanted_columns, wanted = _table([d[0] for d in found.description], found.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} vs {wanted_columns}"
    if rows != wanted:
        extra, lacking = set(rows) - set(wanted), set(wanted) - set(rows)
        return (
            f"{len(rows)} vs {len(wanted)} rows; only in Spark {len(extra)}: {sorted(extra, key=repr)[:2]}; "
            f"only in SQL {len(lacking)}: {sorted(lacking, key=repr)[:2]}"
        )
    return None if rows else "no rows"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = oracle(sf_dir), 0
    for name in names or SQL:
        start = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
