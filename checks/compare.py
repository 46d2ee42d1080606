"""Run queries in Spark and in DuckDB over the same Parquet files and compare the rows.

    python -m checks.compare [--sf 0.01 | --dir PATH] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from checks import oracle, registry
from shelfmark.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return con


def _value(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    return value if value is None else str(value)


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(row) for row in df.collect()]


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, name: str) -> tuple[str, int]:
    """Empty text where `df` holds the rows DuckDB finds for the query, and the number of rows."""
    columns, rows = spark_rows(df)
    sql = oracle.statements().get(name)
    if sql is None:
        return "no SQL", len(rows)
    result = con.execute(sql)
    expected_columns, expected = [d[0] for d in result.description], result.fetchall()
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} against {sorted(expected_columns)}", len(rows)
    got, wanted = _rows(columns, rows), _rows(expected_columns, expected)
    if got == wanted:
        return "", len(rows)
    extra, missing = got - wanted, wanted - got
    return (f"{len(rows)} rows against {len(expected)}; only Spark {list(extra.items())[:3]}; "
            f"only DuckDB {list(missing.items())[:3]}"), len(rows)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--dir", help="another directory with the same tables")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = args.dir or f"/root/testdata/sf{args.sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_tables(sf_dir)
    for name in args.names or registry.queries():
        started = time.time()
        try:
            fault, count = differences(registry.queries()[name](spark, sf_dir), con, name)
        except Exception as error:  # report and go on with the next query
            fault, count = f"{type(error).__name__}: {str(error)[:600]}", -1
        print(f"{'ok  ' if not fault else 'FAIL'} {name} rows={count} {time.time() - started:.1f}s {fault}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
