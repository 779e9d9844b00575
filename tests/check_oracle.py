"""Run every registered query beside its SQL in DuckDB and compare the rows.

Usage: python tests/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


# Spark type -> DuckDB type of the same width.
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float) and math.isnan(value):
            return "NaN"
        return value

    canonical = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(canonical, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def compare(spark, con, name: str, sf_dir: str) -> tuple[str | None, int, float]:
    """What differs (None if nothing), the number of rows, and Spark's seconds."""
    start = time.time()
    df = entry_points.queries()[name](spark, sf_dir)
    mine = [tuple(row) for row in df.collect()]
    seconds = time.time() - start
    cursor = con.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    expected = {d[0]: str(d[1]) for d in cursor.description}
    got = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if got != expected:
        return f"schema {got} is not {expected}", len(mine), seconds
    a, b = _canonical(df.columns, mine), _canonical(columns, theirs)
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), None)
        return f"{len(a)} rows against {len(b)}; first difference {first}", len(mine), seconds
    return None, len(mine), seconds


if __name__ == "__main__":
    from cardlens.session import builder

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        builder("check").master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in sys.argv[2:] or entry_points.queries():
        try:
            difference, rows, seconds = compare(spark, con, name, sf_dir)
        except Exception as error:  # report every query, then fail
            difference, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0
        failed += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {name:32} {rows:7} rows {seconds:6.2f}s {difference or ''}", flush=True)
    sys.exit(1 if failed else 0)
