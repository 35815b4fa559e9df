"""Run registered queries in Spark and their check SQL in DuckDB and compare whole results.

    python tests/compare.py [sf_dir] [ID ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "\0" if value is None else str(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str, limit: int = 3) -> list[str]:
    """Empty when names, types and all values agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if TYPES.get(kind, kind) != types[name]:
            found.append(f"type of {name}: {kind} != {types[name]}")
    actual = df.collect()
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
    got, want = sorted_rows(df.columns, actual), sorted_rows(names, expected)
    if got != want:
        extra = [r for r in got if r not in set(want)][:limit]
        missing = [r for r in want if r not in set(got)][:limit]
        found.append(f"columns {sorted(names)}\n   spark {extra}\n   check {missing}")
    if not expected:
        found.append("empty result")
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, checks = driver.queries(), driver.oracle_sql()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = differences(df, con, checks[name]) if name in checks else ["no check"]
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{name} {'DIFF' if found else 'ok'} {time.time() - start:.2f}s", *found, sep="\n  " if found else " ", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
