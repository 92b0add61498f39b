"""Run queries and their SQL side by side: ``python -m oracles.compare [folder] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def comparable(value: object) -> str:
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.6f}"
    if isinstance(value, int):
        return f"{value:.6f}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()[:19].removesuffix("T00:00:00")
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


def difference(spark, connection, function, sql: str, folder: str) -> str | None:
    """None if both sides give the same columns and rows, else what differs."""
    frame = function(spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(set(frame.columns) ^ set(names))}"
    if got != expected:
        extra = [r for r in got if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(got)][:2]
        return f"{len(got)} rows, expected {len(expected)}\n  only Spark: {extra}\n  only SQL:   {missing}"
    return None


def main() -> None:
    from catalog import ENTRIES
    from leadloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(ENTRIES)
    spark, connection, failed = local_session(8), connect(folder), 0
    for name in names:
        function, sql = ENTRIES[name]
        started = time.time()
        try:
            problem = difference(spark, connection, function, sql, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
