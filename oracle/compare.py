"""Run queries beside their oracle SQL and report differences: ``python -m oracle.compare FOLDER [key ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from oracle.statements import oracle_sql


def open_duckdb(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _kind(type_name: str) -> str:
    name = str(type_name).lower()
    if name.startswith(("bigint", "int", "smallint", "tinyint", "long")):
        return "int"
    if name.startswith(("double", "float", "decimal")):
        return name.split("(")[0]
    if name.startswith(("varchar", "string")):
        return "text"
    return name


def differences(spark, connection, query, sql: str, folder: str) -> tuple[int, list[str]]:
    """Row count and what differs: columns, types, or rows found on one side only."""
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*columns).collect()]
    cursor = connection.execute(sql)
    described = {d[0]: _kind(d[1]) for d in cursor.description}
    found = []
    if sorted(described) != columns:
        return len(got), [f"columns {columns} / {sorted(described)}"]
    kinds = {name: _kind(kind) for name, kind in df.dtypes}
    found += [f"type of {n}: {kinds[n]} / {described[n]}" for n in columns if kinds[n] != described[n]]
    names = [d[0] for d in cursor.description]
    places = [names.index(name) for name in columns]
    want = [tuple(row[i] for i in places) for row in cursor.fetchall()]
    if len(got) != len(want):
        found.append(f"rows {len(got)} / {len(want)}")
    left, right = sorted(map(repr, got)), sorted(map(repr, want))
    if left != right:
        only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        found.append(f"{len(only_left)} rows differ, e.g.\n    spark  {only_left[:2]}\n    duckdb {only_right[:2]}")
    return len(got), found


def main() -> int:
    from shelfline.plans.registry import queries
    from shelfline.session import local_session

    folder, keys = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, statements = open_duckdb(folder), oracle_sql()
    failed = 0
    for key, query in queries().items():
        if keys and key not in keys:
            continue
        started = time.time()
        if key not in statements:
            print(f"{key}: no oracle, {query(spark, folder).count()} rows", flush=True)
            continue
        try:
            rows, found = differences(spark, connection, query, statements[key], folder)
        except Exception as error:  # report and go on with the next query
            rows, found = 0, [str(error)[:600]]
        failed += bool(found)
        print(f"{key}: {rows} rows {time.time() - started:.1f}s {'ok' if not found else '; '.join(found)}", flush=True)
    print(f"{failed} failed", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
