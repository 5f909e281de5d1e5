"""Runs registered queries against their SQL in DuckDB.

``python tests/compare.py <sf_dir> [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


# DuckDB type names of the Spark types that occur.
SQL_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when rows, column names and values agree; else a short report."""
    columns = sorted(df.columns)
    actual = sorted(tuple(plain(v) for v in row) for row in df.select(*columns).collect())
    result = con.sql(sql)
    if sorted(result.columns) != columns:
        return f"columns {columns} != {sorted(result.columns)}"
    types = {name: SQL_TYPES.get(dtype, dtype) for name, dtype in df.dtypes}
    other = {n: (types[n], str(t)) for n, t in zip(result.columns, result.types) if types[n] != str(t)}
    if other:
        return f"types differ: {other}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(tuple(plain(v) for v in row) for row in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ in {columns}, e.g. {wrong[0]}" if wrong else None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            report = difference(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            report = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += report is not None
        print(f"{'ok  ' if report is None else 'FAIL'} {name} {time.time() - started:.2f}s {report or ''}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
