"""Compare registered queries with their SQL: `python tests/check_oracles.py [folder] [query ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    df = entry.queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only: {len(rows)}"
    got = con.execute(sql)
    columns, expected = [d[0] for d in got.description], got.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"DIFFERENT columns {sorted(df.columns)} / {sorted(columns)}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    theirs = {d[0]: str(d[1]) for d in got.description}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = {c: (k, theirs[c]) for c, k in kinds.items() if same.get(k) != theirs[c]}
    a, b = normal(df.columns, rows), normal(columns, expected)
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a, only_b = [r for r in a if r not in in_b][:2], [r for r in b if r not in in_a][:2]
        return f"DIFFERENT {len(a)} / {len(b)} rows; spark {only_a} sql {only_b} {odd or ''}"
    return f"equal: {len(a)} rows" + (f"; TYPES {odd}" if odd else "")


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    for name in names:
        start = time.time()
        try:
            result = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name}: {result} ({time.time() - start:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
