"""Compare a query of the subpackage with its SQL: ``python tests/llm/oracle_llm.py [dir] [name...]``."""

from __future__ import annotations

import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

TABLES = ("documents", "embeddings", "pages", "benchmark")


def sql_rows(sql: str, paths: dict[str, str]) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for name, path in paths.items():
        connection.execute(f"create view {name} as select * from '{path}'")
    result = connection.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def in_order(columns: list[str], rows) -> list[tuple]:
    places = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


def difference(df, sql: str, paths: dict[str, str]) -> str | None:
    """None if ``df`` and the SQL over the Parquet ``paths`` agree in columns and values."""
    columns, expected = sql_rows(sql, paths)
    if sorted(columns) != sorted(df.columns):
        return f"columns {df.columns} != {columns}"
    got = in_order(df.columns, [tuple(row) for row in df.collect()])
    expected = in_order(columns, expected)
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    return next((f"{a} != {b}" for a, b in zip(got, expected) if a != b), None)


def main() -> None:
    import time

    import __spark_entry__ as entry
    from lakefold.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                   "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    paths = {t: f"{sf_dir}/{t}.parquet" for t in TABLES}
    sqls = entry.oracle_sql()
    for name in sys.argv[2:] or [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]:
        started = time.time()
        df = entry.queries()[name](spark, sf_dir)
        found = difference(df, sqls[name], paths) if name in sqls else f"no SQL, {df.count()} rows"
        print("ok  " if found is None else "look", name, f"{time.time() - started:.1f}s", found or "", flush=True)


if __name__ == "__main__":
    main()
