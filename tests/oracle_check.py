"""Run registered queries beside their SQL oracle: ``python tests/oracle_check.py [dir] [name...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "customer orders lineitem part".split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


def oracle_rows(sf_dir: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    result = connection.execute(sql)
    return {d[0]: str(d[1]) for d in result.description}, result.fetchall()


def comparable(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark, sf_dir: str, name: str) -> str | None:
    """None if Spark and the oracle agree in columns and values, else what differs."""
    from lakefold.plans.oracle import ORACLE
    from lakefold.plans.registered import QUERIES

    df = QUERIES[name](spark, sf_dir)
    columns, expected = oracle_rows(sf_dir, ORACLE[name])
    actual_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if actual_types != columns:
        return f"columns {actual_types} != {columns}"
    actual = comparable(df.columns, [tuple(row) for row in df.collect()])
    expected = comparable(list(columns), expected)
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"{got} != {want}"
    return None


def main() -> None:
    from lakefold.plans.registered import QUERIES
    from lakefold.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    settings = {
        "spark.master": "local[8]",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    spark = build_session("oracle check", settings)
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or QUERIES:
        started = time.time()
        try:
            found = difference(spark, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - started:.1f}s", found or "", flush=True)


if __name__ == "__main__":
    main()
