"""Run registered queries on Spark and on DuckDB and compare all rows.

    python tools/check_queries.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandloom.queries import ORACLE, QUERIES  # noqa: E402
from demandloom.session import local_session  # noqa: E402
from demandloom.sources import drop_staged  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def normalise(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(frame, connection, sql: str) -> str:
    """An empty string if both sides hold the same rows, otherwise what differs."""
    rows = [tuple(r) for r in frame.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns differ: {sorted(set(frame.columns) ^ set(names))}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    left, right = normalise(frame.columns, rows), normalise(names, expected)
    wrong = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    if not wrong:
        return ""
    ordered = sorted(names)
    a, b = wrong[0]
    cells = [(n, x, y) for n, x, y in zip(ordered, a, b, strict=True) if x != y]
    return f"{len(wrong)} of {len(rows)} rows differ, first: {cells[:6]}"


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    connection = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLE:
                problem = compare(frame, connection, ORACLE[name])
                verdict = problem or "same"
            else:
                problem = ""
                verdict = f"{len(frame.collect())} rows, no SQL"
        except Exception as error:  # keep going: the report lists every query
            problem = verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:30s} {time.time() - start:6.2f}s {verdict}",
              flush=True)
    drop_staged(spark)
    print(f"{len(names) - failed} of {len(names)} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
