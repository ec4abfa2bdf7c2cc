"""Compare every registered query with its SQL counterpart.

    python -m tests.crosscheck [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def _plain(value) -> str:
    if isinstance(value, decimal.Decimal):
        raise TypeError("a decimal left a query")
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def normal_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(f"{_kind(r[i])}:{_plain(r[i])}" for i in order) for r in rows)


def compare(frame, connection, statement: str) -> str | None:
    """None if equal, else what differs first."""
    actual = normal_rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(statement)
    names = [d[0] for d in result.description]
    expected = normal_rows(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns differ: {sorted(set(frame.columns) ^ set(names))}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for mine, wanted in zip(actual, expected):
        if mine != wanted:
            parts = [
                f"{n}: {a} / {b}" for n, a, b in zip(sorted(names), mine, wanted) if a != b
            ]
            return "; ".join(parts[:6])
    return None


def main(arguments: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.session import local_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:]
    spark, connection = local_session(), connect(folder)
    statements, bad = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        if name not in statements:
            rows = query(spark, folder).collect()
            print(f"rows {name}: {len(rows)} ({time.time() - start:.1f} s)", flush=True)
            continue
        try:
            difference = compare(query(spark, folder), connection, statements[name])
        except Exception as error:  # report and go on to the next query
            difference = f"{type(error).__name__}: {str(error)[:700]}"
        bad += difference is not None
        print(f"{'FAIL' if difference else 'ok'} {name} ({time.time() - start:.1f} s) {difference or ''}", flush=True)
    print(f"{bad} differ")
    return int(bad > 0)


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
