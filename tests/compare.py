"""Run the registered queries on both engines and compare rows by value."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return value


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_df, connection, sql: str) -> str | None:
    """What differs between the two results, or None."""
    relation = connection.execute(sql)
    columns = [d[0] for d in relation.description]
    wanted = _rows(columns, relation.fetchall())
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(columns)}"
    found = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(found) != len(wanted):
        return f"{len(found)} rows instead of {len(wanted)}"
    bad = [(f, w) for f, w in zip(found, wanted) if f != w]
    bad += [(f, w) for f, w in zip(found, wanted) if list(map(type, f)) != list(map(type, w)) and f == w]
    return f"{len(bad)} of {len(found)} rows differ, first: {str(bad[0])[:1500]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidewatch.session import local_session

    folder = sys.argv[1]
    names = sys.argv[2:]
    spark = local_session(8)
    connection = open_tables(folder)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, folder)
            if name in oracles:
                result = difference(frame, connection, oracles[name]) or "ok"
            else:
                result = f"{frame.count()} rows, no SQL"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:30s} {time.time() - start:6.2f}s {result}", flush=True)
